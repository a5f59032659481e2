"""Document quality by weak supervision.

Simple rules look at a document and vote clean (+1), junk (-1) or abstain (0).
No rule is trusted by itself. The true class is hidden - clean, or one of
several kinds of junk, since a table and a repeated line have little in
common - and expectation-maximisation estimates from the agreement of the
votes how frequent each class is and how often each rule votes clean in it.
A document's posterior probability of being clean replaces the usual test
that every rule must pass.

How it runs: one scan computes measures and votes inside each row (column
expressions only, no shuffle of texts) and writes them, narrow, to the shared
folder. EM needs only how often each combination of votes occurs, a table of
at most 3^rules rows whatever the corpus size; every iteration is one
aggregate over it that returns a row of sums for each rule and vote. The
posterior is then an expression over each row's own votes, so nothing is
joined. The estimates enter the expressions as one array literal, so all
iterations share one compiled plan.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import WORD, fill, materialize

#: rule: (kind of junk, measure, junk below, junk above, clean from, clean to).
#: A measure in [clean from, clean to] votes clean, outside [junk below, junk
#: above] junk, in between the rule abstains.
RULES = {
    "symbols": ("noise", "n_symbols / greatest(word_chars, 1)", -1.0, 0.05, 0.0, 0.005),
    "word_length": ("noise", "word_chars / greatest(n_words, 1)", 3.0, 10.0, 4.0, 6.0),
    "letters": ("noise", "n_letters / greatest(word_chars, 1)", 0.4, 2.0, 0.9, 2.0),
    "repeated_lines": ("repetition", "n_dup_lines / greatest(n_lines, 1)", -1.0, 0.35, 0.0, 0.1),
    "repeated_words": ("repetition", "n_repeat_words / greatest(n_words, 1)", -1.0, 0.2, 0.0, 0.05),
    "doubled_words": ("repetition", "n_doubled_words / greatest(n_words, 1)", -1.0, 0.2, 0.0, 0.05),
    "distinct_words": ("repetition", "n_distinct_words / greatest(least(n_words, 500), 1)", 0.25, 1000.0, 0.5, 1000.0),
    "bars": ("table", "n_bars / greatest(n_words, 1)", -1.0, 0.05, 0.0, 0.005),
    "capitals": ("form", "n_capital_runs / greatest(n_words, 1)", -1.0, 0.3, 0.0, 0.05),
    "sentences": ("form", "n_sentence_ends / greatest(n_words, 1)", 0.005, 0.5, 0.03, 0.3),
}
CLASSES = ("clean", "noise", "repetition", "table", "form")
ITERATIONS = 20
ERROR = 0.02
MIN_WORDS, MAX_REPEATED_PERCENT, RUN = 10, 20, 5


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column, run: int = RUN) -> Column:
    """Words inside windows of ``run`` words that occur twice or more in the text.

    Windows are compared by 64-bit hashes. Where none repeats (a hash set
    tells) nothing else is done; otherwise the windows are sorted with their
    places, so the cost is n log n for texts of any length.
    """

    def starts(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def same(x: Column, j: Column) -> Column:
                left = F.when(j > 0, F.get(s, j - 1)["h"])
                return (left == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])

            return F.sort_array(F.transform(F.filter(s, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))

        return let(placed, twice)

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, j: F.least(F.lit(run), F.coalesce(F.get(places, j + 1) - p, F.lit(run))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def count(windows: Column) -> Column:
        unique = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(unique, F.lit(0)).otherwise(let(starts(windows), covered))

    places = F.sequence(F.lit(0), F.size(hashes) - run)
    windows = F.transform(places, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(run))))
    return F.when(F.size(hashes) <= run, F.lit(0)).otherwise(let(windows, count))


def measures(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, the measures that the rules look at, and the columns in ``keep`` as ``_keep_0`` and so on.

    Null text: no words, all measures 0. Null, tied or repeated keys: each row
    stands for itself. Empty table: no rows. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("_wk"), fill(text).alias("_wt"), *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)))
    t = F.col("_wt")
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
    rows = rows.withColumn("_words", words)

    def per_word(h: Column) -> Column:
        return F.struct(
            F.size(h).cast("long").alias("n_words"),
            _repeat_words(h).cast("long").alias("n_repeat_words"),
            F.size(F.filter(h, lambda x, i: F.coalesce(F.get(h, i + 1) == x, F.lit(False)))).cast("long").alias("n_doubled_words"),
            F.size(F.array_distinct(h)).cast("long").alias("n_distinct_words"),
        )

    def per_line(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(t, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    rows = rows.select(
        "*",
        let(F.transform("_words", lambda w: F.xxhash64(w)), per_word).alias("_w"),
        let(lines, per_line).alias("_l"),
    )
    return rows.select(
        F.col("_wk").alias(key),
        "_w.*",
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        "_l.*",
        (F.size("_words") - F.size(F.array_remove("_words", "|"))).cast("long").alias("n_bars"),
        F.char_length(F.regexp_replace(t, r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.regexp_count(t, F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_capital_runs"),
        F.regexp_count(t, F.lit(r"[.!?]+([\x20\x09-\x0D]|$)")).cast("long").alias("n_sentence_ends"),
        *(f"_keep_{i}" for i in range(len(keep))),
    )


def vote(rule: str) -> Column:
    _, measure, low, high, clean_low, clean_high = RULES[rule]
    m = F.expr(measure)
    return F.when((m < low) | (m > high), -1).when((m >= clean_low) & (m <= clean_high), 1).otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def votes_array() -> Column:
    return F.array(*(F.col(f"vote_{r}") for r in RULES))


def _normed(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return let(total, lambda t: F.transform(weights, lambda w: w / t))


def first_shares(votes: Column) -> Column:
    """Shares of the classes before any estimate: a junk vote speaks for its kind."""
    kinds = [kind for kind, *_ in RULES.values()]

    def junk(kind: str | None) -> Column:
        counted = [F.when(F.get(votes, F.lit(i)) == -1, 1.0).otherwise(0.0) for i, k in enumerate(kinds) if kind in (None, k)]
        return reduce(lambda a, b: a + b, counted)

    weights = F.array(F.exp(-2.0 * junk(None)), *(F.exp(2.0 * junk(k)) - 1.0 for k in CLASSES[1:]))
    return let(weights, _normed)


def shares(votes: Column, model: Column) -> Column:
    """Posterior of each class. ``model``: per class its log frequency, then per
    rule the log rates of a clean and of a junk vote."""

    def score(rates: Column) -> Column:
        def add(total: Column, i: Column) -> Column:
            v = F.get(votes, i)
            up, down = F.get(rates, 2 * i + 1), F.get(rates, 2 * i + 2)
            return total + F.when(v == 1, up).when(v == -1, down).otherwise(0.0)

        return F.aggregate(F.sequence(F.lit(0), F.lit(len(RULES) - 1)), F.get(rates, F.lit(0)), add)

    def weigh(scores: Column) -> Column:
        return let(F.array_max(scores), lambda best: F.transform(scores, lambda x: F.exp(x - best)))

    return let(let(F.transform(model, score), weigh), _normed)


def fit(rows: DataFrame, iterations: int = ITERATIONS) -> list[list[float]] | None:
    """EM over the table of vote combinations; the model as ``shares`` reads it.

    Abstentions don't count. Each rate has a prior worth one vote: a rule errs
    in ``ERROR`` of its votes outside its own kind of junk, and inside it
    either vote is as likely; frequencies are smoothed by one document. None
    for a table without rows.
    """
    combined = rows.groupBy(votes_array().alias("votes")).agg(F.count("*").cast("double").alias("n"))
    table = materialize(combined.coalesce(1), "votes")
    model: list[list[float]] | None = None
    for _ in range(iterations):
        now = first_shares(F.col("votes")) if model is None else shares(F.col("votes"), array_literal(model))
        weighed = table.select(F.transform(now, lambda p: p * F.col("n")).alias("p"), F.posexplode("votes").alias("rule", "vote"))
        sums = weighed.groupBy("rule", "vote").agg(*(F.sum(F.get("p", F.lit(k))).alias(f"p{k}") for k in range(len(CLASSES)))).collect()
        if not sums:
            return None
        by = {(r["rule"], r["vote"]): [r[f"p{k}"] for k in range(len(CLASSES))] for r in sums}  # at most 3 rows a rule
        none = [0.0] * len(CLASSES)
        mass = [sum(by.get((0, v), none)[k] for v in (-1, 0, 1)) for k in range(len(CLASSES))]
        model = []
        for k in range(len(CLASSES)):
            rates = [math.log((mass[k] + 1) / (sum(mass) + len(CLASSES)))]
            for i, (kind, *_) in enumerate(RULES.values()):
                up, down = by.get((i, 1), none)[k], by.get((i, -1), none)[k]
                prior = 0.5 if kind == CLASSES[k] else ERROR
                rates += [math.log((up + 1 - prior) / (up + down + 1)), math.log((down + prior) / (up + down + 1))]
            model.append(rates)
    return model


def array_literal(model: list[list[float]]) -> Column:
    return F.from_json(F.lit(repr(model)), "array<array<double>>")


def judge(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = 0.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Measures, votes, ``quality`` (posterior of clean), ``base_failed`` and ``kept`` per row."""
    rows = measures(docs, key=key, text=text, keep=keep)
    rows = rows.select("*", *(vote(r).alias(f"vote_{r}") for r in RULES))
    rows = materialize(rows, "quality")
    model = fit(rows)
    votes = votes_array()
    clean = (first_shares(votes) if model is None else shares(votes, array_literal(model)))[0]
    rows = rows.withColumn("quality", clean).withColumn("base_failed", base_failed())
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_clean(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns as they were."""
    columns = docs.columns
    named = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))  # no clash with the measures
    judged = judge(named, key=f"c{columns.index(key)}", text=f"c{columns.index(text)}", keep=tuple(named.columns))
    return judged.filter("kept").select(*(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(columns)))


BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(*BASE)


def _oracle() -> str:
    """The same in DuckDB; EM unrolled over the table of vote combinations."""
    word = r"'[^\x20\x09-\x0D]+'"
    lead = ", ".join(f"lead(word, {k}) OVER (PARTITION BY row_id ORDER BY i)" for k in range(1, RUN))
    ctes = [f"""w AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {word}) AS words FROM documents
), u AS (SELECT row_id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word, len(words) AS n FROM w
), x AS (SELECT row_id, i, n, concat_ws(' ', word, {lead}) AS run FROM u
), g AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, run) AS times FROM x WHERE i + {RUN - 1} <= n
), r AS (SELECT row_id, count(DISTINCT place) AS n FROM (SELECT row_id, unnest(range(i, i + {RUN})) AS place FROM g WHERE times > 1) GROUP BY 1
), f AS (
  SELECT w.row_id, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {word})))::BIGINT AS n_lines,
    (len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {word})))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {word})))))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1]))::BIGINT AS n_doubled_words,
    len(list_distinct(words))::BIGINT AS n_distinct_words, len(list_filter(words, lambda x: x = '|'))::BIGINT AS n_bars,
    length(regexp_replace(t, '\\P{{L}}', '', 'g'))::BIGINT AS n_letters,
    len(regexp_extract_all(t, '\\p{{Lu}}{{2,}}'))::BIGINT AS n_capital_runs,
    len(regexp_extract_all(t, '[.!?]+([\\x20\\x09-\\x0D]|$)'))::BIGINT AS n_sentence_ends
  FROM w LEFT JOIN r ON w.row_id = r.row_id
)"""]
    votes = []
    for rule, (_, measure, low, high, clean_low, clean_high) in RULES.items():
        m = f"({measure})"
        votes.append(f"CASE WHEN {m} < {low} OR {m} > {high} THEN -1 WHEN {m} >= {clean_low} AND {m} <= {clean_high} THEN 1 ELSE 0 END AS vote_{rule}")
    names = ", ".join(f"vote_{r}" for r in RULES)
    ctes.append(f"v AS MATERIALIZED (SELECT *, {', '.join(votes)} FROM f)")
    ctes.append(f"k AS MATERIALIZED (SELECT {names}, count(*)::DOUBLE AS n FROM v GROUP BY {names})")

    def bad(kind: str | None = None) -> str:
        return "(" + " + ".join(f"(vote_{r} = -1)::INT" for r in RULES if kind in (None, RULES[r][0])) + ")"

    start = [f"exp(-2.0 * {bad()})", *(f"exp(2.0 * {bad(k)}) - 1.0" for k in CLASSES[1:])]

    def shared(weights: list[str]) -> str:
        total = " + ".join(f"({w})" for w in weights)
        return ", ".join(f"({w}) / ({total}) AS p{k}" for k, w in enumerate(weights))

    def scored(m: str, source: str) -> str:
        columns = []
        for k in range(len(CLASSES)):
            terms = [f"{m}.f{k}"] + [f"CASE vote_{r} WHEN 1 THEN {m}.{r}_{k} WHEN -1 THEN {m}.{r}_{k}_no ELSE 0.0 END" for r in RULES]
            columns.append(" + ".join(terms) + f" AS s{k}")
        gone = ", ".join(f"s{k}" for k in range(len(CLASSES)))
        best = "greatest(" + ", ".join(f"s{k}" for k in range(len(CLASSES))) + ")"
        return f"SELECT * EXCLUDE ({gone}), {shared([f'exp(s{k} - {best})' for k in range(len(CLASSES))])} FROM (SELECT {source}.*, {', '.join(columns)} FROM {source}, {m})"

    ctes.append(f"p0 AS MATERIALIZED (SELECT *, {shared(start)} FROM k)")
    every = " + ".join(f"p{k}" for k in range(len(CLASSES)))
    for it in range(1, ITERATIONS + 1):
        sums = []
        for k in range(len(CLASSES)):
            sums.append(f"ln((sum(n * p{k}) + 1) / (sum(n * ({every})) + {len(CLASSES)})) AS f{k}")
            for r in RULES:
                prior = 0.5 if RULES[r][0] == CLASSES[k] else ERROR
                both = f"(coalesce(sum(n * p{k}) FILTER (vote_{r} <> 0), 0) + 1)"
                sums.append(f"ln((coalesce(sum(n * p{k}) FILTER (vote_{r} = 1), 0) + {1 - prior}) / {both}) AS {r}_{k}")
                sums.append(f"ln((coalesce(sum(n * p{k}) FILTER (vote_{r} = -1), 0) + {prior}) / {both}) AS {r}_{k}_no")
        ctes.append(f"m{it} AS MATERIALIZED (SELECT {', '.join(sums)} FROM p{it - 1})")
        if it < ITERATIONS:
            ctes.append(f"p{it} AS MATERIALIZED ({scored(f'm{it}', 'k')})")
    last = f"m{ITERATIONS}"
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)"
    return (
        "WITH " + ", ".join(ctes) + f" SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed,"
        f" NOT {failed} AND p0 >= 0.5 AS kept FROM ({scored(last, 'v')})"
    )


ORACLE_SQL = _oracle()

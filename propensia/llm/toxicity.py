"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

Lexicon. From all labelled training rows words and productive word beginnings
(stems that many different words share) are kept whose counts in toxic and clean
texts differ beyond chance (likelihood ratio against the number of
candidates) and threefold at least. Near copies count once: documents with a common minimum hash of
their word triples are represented by one of them.

Matching. The lexicon is a trie; the Levenshtein automata of all its terms,
run along the trie together, form one automaton over input letters: a state is
a set of (trie node, errors). It is made deterministic on demand and
remembered, so a word costs a table look-up a letter and mostly dies after a
few. Terms of 5 letters or more accept one error, of 9 or more two.

Context. A window of words round each match decides what it counts: inside
quotation marks or after words of reporting it counts little, beside a second
person more. Weights of matches (exact, stem, misspelled, quoted) and their
density are the inputs of a logistic regression, which gives the score. It is
fitted on a bounded sample (``sample`` rows by a hash of the key, toxic ones
first up to one half) and its bias then set back to the share of all rows. Key, language, source and labels are no inputs.

Terms are counted by Spark and only those that pass the test come
to the driver; scoring is one scan without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import fill, hold_out, materialize, ship

EDGE = ".,;:!?\"'()[]{}<>«»„“”‚‘’…*_~|#-$%&@+=/\\^`"
QUOTES = "\"«»„“”"
WINDOW = 6
REPORTING = frozenset(
    "said says saying quoted quotes called calls wrote writes according term word insult"
    " sagte sagt zitierte nannte schrieb laut begriff wort"
    " dijo dice citó llamó escribió según término palabra"
    " dit disait cité appelé écrit selon terme mot".split()
)
SECOND_PERSON = frozenset("you your you're yourself u ur du dich dir dein deine ihr euch tú tu te ti usted vosotros toi vous votre vos".split())
STEMS = (4, 5, 6, 7, 8)
REMEMBERED = 1 << 19  # words kept per task
SMALL_KEYS = 64 << 20  # bytes of keys that are sent to all tasks; more are shuffled


def bare(word: str) -> str:
    return word.strip(EDGE)


def errors_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    """Levenshtein automata of all terms, intersected with their trie.

    ``find(word)`` gives (term, errors) of the best match or None; equal
    errors: the term with the larger weight, then the first in order.
    """

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.limit: list[int] = [0]  # the most errors any term below accepts
        self.weight = terms
        for term in sorted(terms):
            node, allowed = 0, errors_allowed(term)
            self.limit[0] = max(self.limit[0], allowed)
            for letter in term:
                nxt = self.children[node].get(letter)
                if nxt is None:
                    nxt = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.limit.append(0)
                node = nxt
                self.limit[node] = max(self.limit[node], allowed)
            self.term[node] = term
        self.states: list[dict[int, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._number(self._closure({0: 0}))

    def _closure(self, state: dict[int, int]) -> dict[int, int]:
        """Letters of a term may be left out, at one error each."""
        todo = list(state.items())
        while todo:
            node, errors = todo.pop()
            for child in self.children[node].values():
                if errors + 1 <= self.limit[child] and errors + 1 < state.get(child, 99):
                    state[child] = errors + 1
                    todo.append((child, errors + 1))
        return state

    def _number(self, state: dict[int, int]) -> int:
        if not state:
            return -1
        name = frozenset(state.items())
        if (n := self.numbers.get(name)) is None:
            n = self.numbers[name] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            ends = [(e, -self.weight[t], t) for node, e in state.items() if (t := self.term[node]) is not None and e <= errors_allowed(t)]
            self.found.append((min(ends)[2], min(ends)[0]) if ends else None)
        return n

    def _step(self, state: dict[int, int], letter: str) -> dict[int, int]:
        out: dict[int, int] = {}
        for node, errors in state.items():
            for label, child in self.children[node].items():
                cost = errors + (label != letter)
                if cost <= self.limit[child] and cost < out.get(child, 99):
                    out[child] = cost
            if errors + 1 <= self.limit[node] and errors + 1 < out.get(node, 99):
                out[node] = errors + 1  # a letter too many
        return self._closure(out)

    def find(self, word: str) -> tuple[str, int] | None:
        at = self.start
        for letter in word:
            if at < 0:
                return None
            to = self.moves[at].get(letter)
            if to is None:
                to = self.moves[at][letter] = self._number(self._step(self.states[at], letter))
            at = to
        return self.found[at] if at >= 0 else None


@dataclass
class ToxicModel:
    """What scoring needs; small (bounded by ``max_terms``) and picklable."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0] * N_FEATURES)


FEATURES = ("bias", "exact", "stem", "misspelled", "quoted", "strongest", "density", "stem_density")
N_FEATURES = len(FEATURES)


class Scorer:
    """Features of texts under a lexicon; words seen are remembered per task."""

    def __init__(self, model: ToxicModel):
        self.model, self.automaton = model, LexiconAutomaton(model.words)
        self.seen: dict[str, tuple[int, float] | None] = {}

    def match(self, raw: str) -> tuple[int, float] | None:
        """(kind: 1 exact, 2 stem, 3 misspelled; weight)."""
        word = bare(raw)
        if len(word) < 3:
            return None
        if (w := self.model.words.get(word)) is not None:
            return 1, w
        for n in reversed(STEMS):
            if len(word) > n and (w := self.model.stems.get(word[:n])) is not None:
                return 2, w
        if (hit := self.automaton.find(word)) is not None:
            return 3, self.model.words[hit[0]] / (1 + hit[1])
        return None

    def features(self, text: str) -> list[float]:
        words, seen = text.lower().split(), self.seen
        hits = []
        for i, word in enumerate(words):
            try:
                m = seen[word]
            except KeyError:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                m = seen[word] = self.match(word)
            if m is not None:
                hits.append((i, *m))
        sums, quoted, strongest = [0.0] * 4, 0.0, 0.0
        if hits:
            marks = np.cumsum([sum(w.count(q) for q in QUOTES) for w in words])
            for i, kind, weight in hits:
                near = words[max(0, i - WINDOW) : i + WINDOW + 1]
                before = words[max(0, i - WINDOW) : i]
                inside = marks[i - 1] % 2 == 1 and marks[-1] > marks[i - 1] if i else False
                inside = inside or words[i][0] in QUOTES and words[i][-1] in QUOTES + EDGE
                value = weight * (0.2 if inside else 1.0)
                value *= 0.5 if any(bare(w) in REPORTING for w in before) else 1.0
                value *= 1.3 if any(bare(w) in SECOND_PERSON for w in near) else 1.0
                if value < 0.6 * weight:
                    quoted += weight
                sums[kind] += value
                strongest = max(strongest, value if kind < 3 else 0.0)
        per = 100.0 / (len(words) + 20)
        last = quoted, strongest, per * (sums[1] + sums[2]), per * sums[2]
        return [1.0, *(math.log1p(s) for s in (*sums[1:], *last))]

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.model.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Newton's method with a ridge penalty (not on the bias)."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 4.0 / max(np.abs(move).max(), 1e-12))
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w




def _terms(text: str) -> dict[str, set[str]]:
    """Distinct words (key ``w:``) and stems (``s:``, with the words that begin so)."""
    out: dict[str, set[str]] = {}
    for raw in set(text.lower().split()):
        word = bare(raw)
        if len(word) < 3 or len(word) > 40:
            continue
        out.setdefault("w:" + word, set())
        for n in STEMS:
            if len(word) > n:
                out.setdefault("s:" + word[:n], set()).add(word)
    return out


def _joined(rows: DataFrame, keys: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with a written table of keys, sent to all tasks if it is small."""
    size = keys.agg(F.sum(F.octet_length(F.col(on).cast("string")) + 24)).first()[0] or 0
    return rows.join(F.broadcast(keys) if size <= SMALL_KEYS else keys, on, how)


def labelled_rows(docs: DataFrame, labels: DataFrame, *, key: str, text: str, modulus: int) -> DataFrame:
    """All labelled training rows: key, text, toxic, hash of the key, a number of the row and three minimum hashes of word triples.

    Rows of the fold 0 (``hold_out``) are never among them; a key labelled
    twice is toxic if any of its labels is.
    """
    marked = labels.select(F.col(key).alias("k"), (F.col("toxic").cast("int") > 0).cast("int").alias("toxic")).filter("k is not null and toxic is not null")
    marked = marked.filter(hold_out("k", modulus) != 0).groupBy("k").agg(F.max("toxic").alias("toxic"))
    marked = materialize(marked.withColumn("h", F.xxhash64(F.lit("toxicity"), "k")), "toxic-labels")
    chosen = _joined(docs.select(F.col(key).alias("k"), fill(text).alias("t")), marked, "k").withColumn("r", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures = []
            for t in batch.column(1).to_pylist():
                words = t.lower().split()
                grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
                hashes = np.fromiter((xxhash.xxh3_64_intdigest(g) for g in grams), np.uint64, len(grams))
                with np.errstate(over="ignore"):
                    signatures.append([int((hashes * np.uint64(m)).min() >> np.uint64(1)) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)])
            arrays = [batch.column(i) for i in range(5)] + [pa.array([s[j] for s in signatures], pa.int64()) for j in range(3)]
            yield pa.RecordBatch.from_arrays(arrays, names=["k", "t", "toxic", "h", "r", "s0", "s1", "s2"])

    kind = docs.schema[key].dataType.simpleString()
    return materialize(chosen.select("k", "t", "toxic", "h", "r").mapInArrow(run, f"k {kind}, t string, toxic int, h long, r long, s0 long, s1 long, s2 long"), "toxic-rows")


def one_of_copies(rows: DataFrame) -> DataFrame:
    """Rows that stand for those which share a minimum hash with them (and the
    label). Repeated rows count once."""
    signed = ["k", "s0", "s1", "s2", "r"]
    single = rows.select("h", "toxic", *signed)
    for s in ("s0", "s1", "s2"):
        best = single.groupBy(s, "toxic").agg(F.min(F.struct("h", *signed)).alias("b")).select("b.r")
        single = single.join(best, "r", "left_semi")
    return _joined(rows, materialize(single.select("r"), "toxic-single"), "r", "left_semi")


def regression_keys(rows: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """At most ``sample`` keys by hash, half of them toxic if there are as many,
    and what the log odds of toxic gain by that against all rows."""
    keys = rows.select("k", "toxic", "h").distinct()
    sizes = {r["toxic"]: r["n"] for r in keys.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic = min(sizes[1], max(sample // 2, sample - sizes[0]))
    share = {1: toxic, 0: min(sizes[0], sample - toxic)}
    picked = []
    for label, n in share.items():
        found = keys.filter(F.col("toxic") == label)
        if 2 * n + 1000 < sizes[label]:  # hashes are even: twice as many as needed lie below
            found = found.filter(F.col("h") < int(-(2**63) + 2**64 * (2 * n + 1000) / sizes[label]))
        picked.append(found.orderBy("h", "k").limit(n).select("k"))
    return picked[0].union(picked[1]), math.log(share[1] / share[0]) - math.log(sizes[1] / sizes[0])


def learn(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", modulus: int = 5, sample: int = 12_000, max_terms: int = 4_000
) -> ToxicModel:
    """Lexicon from all labelled training rows, regression on a bounded sample of them.

    ``sample`` (at least 2) bounds the regression's rows, ``max_terms`` the
    lexicon (the terms with the largest likelihood ratio). Without labelled
    rows the model knows no term and scores every text near 0.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = labelled_rows(docs, labels, key=key, text=text, modulus=modulus)
    single = one_of_copies(rows)
    totals = {r["toxic"]: r["n"] for r in single.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    model = ToxicModel()
    model.weights[0] = math.log((n_toxic + 0.5) / (n_clean + 10.0))
    if not n_toxic or not n_clean:
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, masks = (Counter(), Counter()), {}

        def flush() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            columns = [terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms], [masks.get(t, 0) for t in terms]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["term", "toxic", "clean", "mask"])

        for batch in batches:
            for t, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term, words in _terms(t).items():
                    counts[1 if toxic else 0][term] += 1
                    if toxic and words:
                        mask = masks.get(term, 0)
                        for w in words:
                            mask |= 1 << (xxhash.xxh3_64_intdigest(w) % 63)
                        masks[term] = mask
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield flush()
                counts, masks = (Counter(), Counter()), {}
        yield flush()

    terms = single.select("t", "toxic").mapInArrow(count, "term string, toxic long, clean long, mask long")
    terms = terms.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"), F.expr("bit_or(mask)").alias("mask")).filter("a >= 3")
    terms = materialize(terms.withColumn("g", _likelihood_ratio(n_toxic, n_clean)).withColumn("words", F.bit_count("mask")), "toxic-terms")
    bar = 2 * math.log(max(terms.count(), 2))
    often = F.col("a") / n_toxic >= 3 * (F.col("b") + 0.5) / n_clean
    kept = terms.filter((F.col("g") >= bar) & often & (F.col("term").startswith("w:") | (F.col("words") >= 4)))
    chosen = kept.orderBy(F.desc("g"), "term").limit(max_terms).collect()
    weight = {r["term"]: math.log((r["a"] + 0.5) / (n_toxic + 1)) - math.log((r["b"] + 0.5) / (n_clean + 1)) for r in chosen}
    seen = {r["term"]: r["a"] for r in chosen}
    model.words = {t[2:]: w for t, w in weight.items() if t[0] == "w"}
    stems = {t[2:]: w for t, w in weight.items() if t[0] == "s"}
    longer = lambda s: any(o != s and o.startswith(s) and seen["s:" + o] >= 0.9 * seen["s:" + s] for o in stems)
    model.stems = {s: w for s, w in stems.items() if not longer(s)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            made = [scorer.features(t) for t in batch.column(0).to_pylist()]
            columns = [pa.array([m[i] for m in made], pa.float64()) for i in range(N_FEATURES)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1), batch.column(2)], names=[*FEATURES, "toxic", "h"])

    schema = ", ".join(f"{f} double" for f in FEATURES) + ", toxic int, h long"
    picked, gain = regression_keys(rows, sample)
    measured = rows.join(F.broadcast(picked), "k").select("t", "toxic", "h").mapInArrow(measure, schema)
    # One row of those with a tied key; at most `sample` rows.
    points = measured.groupBy("h").agg(F.min(F.struct(*FEATURES, "toxic")).alias("p")).orderBy("h").select("p.*").collect()
    x = np.array([[p[f] for f in FEATURES] for p in points])
    y = np.array([float(p["toxic"] > 0) for p in points])
    model.weights = [float(w) for w in fit_logistic(x, y)]
    model.weights[0] -= gain
    return model


def _likelihood_ratio(n_toxic: int, n_clean: int) -> Column:
    """G^2 of a term's counts a (toxic) and b (clean) against equal rates."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    rate = (a + b) / (n_toxic + n_clean)

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    inner = part(a, n_toxic * rate) + part(b, n_clean * rate)
    outer = part(F.lit(float(n_toxic)) - a, n_toxic * (1 - rate)) + part(F.lit(float(n_clean)) - b, n_clean * (1 - rate))
    return 2.0 * (inner + outer)


def score_column(spark: SparkSession, model: ToxicModel, text: str = "text") -> Column:
    """The score of a text column, 0 to 1 (null text: as empty)."""
    ship(spark)
    scorers: list[Scorer] = []

    @F.pandas_udf("double")
    def score(column):
        import pandas as pd

        if not scorers:
            scorers.append(Scorer(model))
        return pd.Series([scorers[0].score(t) for t in column], dtype="float64")

    return score(fill(text))


def score_documents(docs: DataFrame, model: ToxicModel, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column of scores; all other columns stay as they are.

    Null and empty texts get the score of a text without matches. Repeated
    rows and tied keys: each row is scored. Empty table: no rows.
    """
    return docs.withColumn(out, score_column(docs.sparkSession, model, text))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document; fold 0 of 5 is never learned from."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_documents(docs.select("doc_id", "text"), learn(docs, labels))
    return rows.select(
        "doc_id", (hold_out("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

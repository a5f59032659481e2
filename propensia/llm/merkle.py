"""Merkle trees over sections, paragraphs and sentences of a text.

A section ends at a blank line, a paragraph at a line end, a sentence after
``.``, ``!`` or ``?`` and a space. Sentences are hashed (SHA-256), a paragraph
is the hash of its sentences' hashes, a section of its paragraphs', and the
root of its sections'. The cuts lose nothing, so equal roots mean equal texts,
and comparing two trees from the root down, only into branches that differ,
leads to the edited paragraphs without reading the texts again. Children are
matched by hash, not by position, so what stands behind an insertion stays equal.

Everything is a column expression: a tree is built inside its row, without
shuffle or Python. ``next_texts`` pairs each row with its successor in key
order by one shuffle of the texts: split points come from approximate
percentiles of the key, each range is one window group, and the first row of a
range is also sent to the range before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensia.llm.common import fill, literal_table, unused

#: Cut mark put after the end of a sentence (a raw one in a text cuts as well).
MARK = "\x1f"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def tree(text: Column) -> Column:
    """struct(root, sections array<struct(hash, paragraphs array<struct(hash, sentences array<string>)>)>)."""

    def paragraph(p: Column) -> Column:
        sentences = F.split(F.regexp_replace(p, "([.!?]) ", f"$1 {MARK}"), MARK)
        hashed = F.transform(sentences, lambda s: F.sha2(s, 256))
        return let(hashed, lambda h: F.struct(F.sha2(F.array_join(h, ""), 256).alias("hash"), h.alias("sentences")))

    def section(s: Column) -> Column:
        inner = F.transform(F.split(s, "\n"), paragraph)
        return let(inner, lambda p: F.struct(F.sha2(F.concat(F.lit("p"), F.array_join(p["hash"], "")), 256).alias("hash"), p.alias("paragraphs")))

    outer = F.transform(F.split(text, "\n\n"), section)
    return let(outer, lambda s: F.struct(F.sha2(F.concat(F.lit("s"), F.array_join(s["hash"], "")), 256).alias("root"), s.alias("sections")))


def leaves(node: Column) -> Column:
    """The distinct sentence hashes of a tree."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(node["sections"], lambda s: s["paragraphs"]["sentences"]))))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two sets of leaf hashes, 0 to 1."""
    return F.lit(2.0) * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def numbered(keys: Column) -> Column:
    """The strings, each with the number of equal ones before it, so that all differ."""

    def start_of(starts: Column, j: Column) -> Column:
        """The last of the ascending ``starts`` that is at most j."""
        span = F.struct(F.lit(0).alias("lo"), F.size(starts).alias("hi"))

        def halve(s: Column, _: Column) -> Column:
            middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            below = F.get(starts, middle) <= j
            return F.struct(F.when(below, middle).otherwise(s["lo"]).alias("lo"), F.when(below, s["hi"]).otherwise(middle).alias("hi"))

        steps = F.sequence(F.lit(1), F.length(F.bin(F.size(starts))))
        return F.get(starts, F.aggregate(steps, span, halve, lambda s: s["lo"]))

    def by_runs(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: ~F.get(s, j - 1)["k"].eqNullSafe(F.get(s, j)["k"]))
        code = lambda starts: lambda e, j: F.struct(e["i"].alias("i"), F.concat(e["k"], F.lit(":"), j - start_of(starts, j)).alias("k"))
        return F.array_sort(let(first, lambda starts: F.transform(s, code(starts))))

    ordered = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    alike = F.transform(keys, lambda k: F.concat(k, F.lit(":0")))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), alike).otherwise(F.transform(let(ordered, by_runs), lambda e: e["k"]))


def apart(x: Column, y: Column) -> Column:
    """struct(x, y, both_x, both_y): places of the strings only in x, only in y, and in both;
    neither holds a string twice. Found by sorting both together."""

    def marked(keys: Column, side: int) -> Column:
        return F.transform(keys, lambda k, i: F.struct(k.alias("k"), F.lit(side).alias("side"), i.alias("i")))

    def matched(s: Column) -> Column:
        same = lambda e, j: F.coalesce(F.get(s, j)["k"] == e["k"], F.lit(False))
        return F.transform(s, lambda e, j: F.struct(e["side"].alias("side"), e["i"].alias("i"), (same(e, j - 1) | same(e, j + 1)).alias("both")))

    def pick(m: Column, side: int, both: bool) -> Column:
        return F.array_sort(F.transform(F.filter(m, lambda e: (e["side"] == side) & (e["both"] == both)), lambda e: e["i"]))

    found = let(F.array_sort(F.concat(marked(x, 0), marked(y, 1))), matched)
    return let(found, lambda m: F.struct(pick(m, 0, False).alias("x"), pick(m, 1, False).alias("y"), pick(m, 0, True).alias("both_x"), pick(m, 1, True).alias("both_y")))


KINDS = ("deleted", "inserted", "moved")
EDITS = "array<struct<kind:string,section:int,paragraph:int>>"


def _follows(nodes: Column, keys: Column, kept: Column) -> Column:
    """Each kept child after the kept one before it in its section."""

    def after(i: Column, j: Column) -> Column:
        before = F.get(kept, j - 1)
        near = F.get(nodes, before)["section"] == F.get(nodes, i)["section"]
        return F.concat(F.when(near, F.get(keys, before)).otherwise(F.lit("")), F.lit(">"), F.get(keys, i))

    return F.transform(kept, after)


def _compare(df: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """Adds ``name``: struct(x, y, moved), the places of the children that only one of two
    arrays of struct(hash, section, ...) holds, and of those of y that moved."""
    key, found, chain = (unused(f"{name}_{part}", df.columns) for part in ("key", "found", "chain"))
    hashes = lambda c: F.transform(c, lambda n: n["hash"])
    step = df.withColumn(key, F.struct(numbered(hashes(F.col(x))).alias("x"), numbered(hashes(F.col(y))).alias("y")))
    step = step.withColumn(found, apart(F.col(key)["x"], F.col(key)["y"]))
    m, k = F.col(found), F.col(key)
    chains = apart(_follows(F.col(x), k["x"], m["both_x"]), _follows(F.col(y), k["y"], m["both_y"]))
    step = step.withColumn(chain, chains)
    moved = F.transform(F.col(chain)["y"], lambda i: F.get(m["both_y"], i))
    return step.withColumn(name, F.struct(m["x"].alias("x"), m["y"].alias("y"), moved.alias("moved"))).drop(key, found, chain)


def locate_edits(df: DataFrame, a: str, b: str, out: str = "edits") -> DataFrame:
    """``df`` with what turns the tree of column ``a`` into that of ``b``:
    array of struct(kind, section, paragraph). An ``out`` that ``df`` has is replaced.

    Children are matched by their hashes, equal ones in their order, from the
    root down: sections that both trees hold are not entered; of the others'
    paragraphs those that only a holds are ``deleted`` (place in a), those that
    only b holds ``inserted`` (place in b). A change inside a paragraph is one
    of each; the rest of the text keeps its match, however far it is shifted.
    ``moved`` (place in b; paragraph null: a section) are children of both that
    follow another kept child than before, or now open a section: a child that
    changes its place is reported with its new and its old follower. No edits if
    and only if the roots are equal. Null trees: null. Work grows as n log n
    with the number of children.
    """
    top_a, top_b, sections, in_a, in_b, paragraphs = (
        unused(f"_{n}", [*df.columns, out]) for n in ("top_a", "top_b", "sections", "in_a", "in_b", "paragraphs")
    )
    differs = F.col(f"{a}.root") != F.col(f"{b}.root")

    def top(tree: str) -> Column:  # all sections lie in the text alike
        nodes = F.transform(F.col(f"{tree}.sections"), lambda s: F.struct(s["hash"].alias("hash"), F.lit(0).alias("section")))
        return F.when(differs, nodes).when(~differs, F.array().cast("array<struct<hash:string,section:int>>"))

    def inner(tree: str, places: Column) -> Column:
        """The paragraphs of the sections at ``places``, with their own places."""

        def of(i: Column) -> Column:
            found = F.get(F.col(f"{tree}.sections"), i)["paragraphs"]
            return F.transform(found, lambda p, j: F.struct(p["hash"].alias("hash"), i.alias("section"), j.alias("paragraph")))

        return F.flatten(F.transform(places, of))

    def edit(kind: str, nodes: str, places: Column) -> Column:
        at = lambda i: F.get(F.col(nodes), i)
        return F.transform(places, lambda i: F.struct(F.lit(kind).alias("kind"), at(i)["section"].alias("section"), at(i)["paragraph"].alias("paragraph"))).cast(EDITS)

    step = _compare(df.withColumn(top_a, top(a)).withColumn(top_b, top(b)), top_a, top_b, sections)
    step = step.withColumn(in_a, inner(a, F.col(sections)["x"])).withColumn(in_b, inner(b, F.col(sections)["y"]))
    step = _compare(step, in_a, in_b, paragraphs)
    p, none = F.col(paragraphs), F.lit(None).cast("int").alias("paragraph")
    whole = F.transform(F.col(sections)["moved"], lambda i: F.struct(F.lit("moved").alias("kind"), i.alias("section"), none)).cast(EDITS)
    every = F.concat(edit("deleted", in_a, p["x"]), edit("inserted", in_b, p["y"]), edit("moved", in_b, p["moved"]), whole)
    return step.withColumn(out, every).drop(top_a, top_b, sections, in_a, in_b, paragraphs)


def fingerprints(docs: DataFrame, *, text: str = "text", out: str = "tree") -> DataFrame:
    """``docs`` with the tree of each text. Null text: as empty (one empty leaf)."""
    return docs.withColumn(out, tree(fill(text)))


def next_texts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rows_per_range: int = 4096, most_ranges: int = 20_000) -> DataFrame:
    """key, text and ``next_text``: the text of the row that follows in ascending key order.

    After the last comes the first. The key is an integer; null keys come
    first, tied keys are ordered by text (binary). A single row follows
    itself. Empty table: no rows. Extra columns are not read.

    ``rows_per_range`` sets the size of a window group up to ``most_ranges``
    groups; beyond that the groups grow (windows spill, nothing is dropped).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("k"), fill(text).alias("t"))
    count = rows.count()
    ranges = max(1, min(most_ranges, -(-count // rows_per_range)))
    splits: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        found = rows.agg(F.percentile_approx("k", shares, max(10_000, 10 * ranges)).alias("q")).first()["q"]
        splits = sorted(set(found or []))
    range_of = F.lit(0)
    if splits:
        steps = len(splits).bit_length()
        table = F.from_json(F.lit(str(splits)), "array<bigint>")
        start = F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi"))

        def halve(s: Column, _: Column) -> Column:
            middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            above = F.get(table, middle) <= F.col("k")
            narrowed = F.struct(F.when(above, middle + 1).otherwise(s["lo"]).alias("lo"), F.when(above, s["hi"]).otherwise(middle).alias("hi"))
            return F.when(s["lo"] < s["hi"], narrowed).otherwise(s)

        range_of = F.when(F.col("k").isNull(), F.lit(0)).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])
        )
    # The smallest key of every range that has rows: at most `ranges` rows.
    heads = rows.select("k", range_of.alias("r")).groupBy("r").agg(F.min("k").alias("k"), F.max(F.col("k").isNull()).alias("has_null")).orderBy("r").collect()
    borders = [{"head": None if h["has_null"] else h["k"], "to": heads[i - 1]["r"]} for i, h in enumerate(heads)]
    table = literal_table(spark, borders, "head long, to int")
    sent = rows.withColumn("r", range_of).join(F.broadcast(table), F.col("k").eqNullSafe(F.col("head")), "left")
    own = F.struct(F.col("r").alias("r"), F.lit(0).alias("late"))
    copy = F.struct(F.col("to").alias("r"), F.lit(1).alias("late"))
    dealt = sent.select("k", "t", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"))
    dealt = dealt.select("k", "t", "at.r", "at.late")
    order = Window.partitionBy("r").orderBy("late", F.col("k").asc_nulls_first(), "t")
    found = dealt.withColumn("n", F.lead("t").over(order)).filter("late = 0")
    return found.select(F.col("k").alias(key), F.col("t").alias(text), F.col("n").alias("next_text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all documents, of their edited texts and of the next documents."""
    rows = next_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n_chars = F.char_length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n_chars.cast("long").alias("n_chars"), "text", "next_text", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "edited", tree(F.col("text")).alias("a"), tree(F.col("edited")).alias("b"), tree(F.col("next_text")).alias("c"))
    rows = locate_edits(rows, "a", "b", "places").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.col("a.root").alias("fingerprint"), F.col("b.root").alias("edited_fingerprint"),
        leaves(F.col("a")).alias("la"), leaves(F.col("b")).alias("lb"), leaves(F.col("c")).alias("lc"), "places",
    )
    count = lambda kind: F.size(F.filter("places", lambda e: e["kind"] == kind)).cast("long").alias(f"{kind}_parts")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("la"), F.col("lb")).alias("near_edited"),
        likeness(F.col("la"), F.col("lc")).alias("near_next"),
        *map(count, KINDS),
    )


def _tree_sql(text: str) -> str:
    """DuckDB: struct(root, sections[]{hash, paragraphs[]{hash, sentences[]}}) of a text column."""
    sentences = "string_split(regexp_replace(p, '([.!?]) ', '\\1 ' || chr(31), 'g'), chr(31))"
    paragraph = f"list_transform(list_transform([list_transform({sentences}, lambda z: sha256(z))], lambda h: {{'hash': sha256(array_to_string(h, '')), 'sentences': h}}), lambda q: q)[1]"
    section = (
        f"list_transform([list_transform(string_split(s, chr(10)), lambda p: {paragraph})],"
        " lambda h: {'hash': sha256('p' || array_to_string(list_transform(h, lambda y: y.hash), '')), 'paragraphs': h})[1]"
    )
    return (
        f"list_transform([list_transform(string_split({text}, chr(10) || chr(10)), lambda s: {section})],"
        " lambda h: {'root': sha256('s' || array_to_string(list_transform(h, lambda y: y.hash), '')), 'sections': h})[1]"
    )


def _leaves_sql(node: str) -> str:
    return f"list_distinct(flatten(flatten(list_transform({node}.sections, lambda s: list_transform(s.paragraphs, lambda p: p.sentences)))))"


def _numbered_sql(nodes: str) -> str:
    """Hashes of a list of nodes, each with the number of equal ones before it."""
    return f"list_transform(list_transform({nodes}, lambda n: n.hash), lambda h, i: h || ':' || len(list_filter(list_transform({nodes}, lambda n: n.hash)[1:i - 1], lambda o: o = h)))"


def _chain_sql(nodes: str, keys: str, other: str) -> str:
    """Keys that the other list holds too, after the one before them in their section."""
    kept = f"list_filter(list_zip({keys}, list_transform({nodes}, lambda n: n.section)), lambda z: list_contains({other}, z[1]))"
    return (
        f"list_transform(list_zip({kept}, list_concat([NULL], list_slice({kept}, 1, -2))),"
        " lambda z: CASE WHEN z[1][2] = z[2][2] THEN z[2][1] ELSE '' END || '>' || z[1][1])"
    )


def _paragraphs_sql(tree: str, own: str, other: str) -> str:
    """Paragraphs of the sections that the other tree does not hold."""
    return (
        f"flatten(list_transform(list_filter(list_zip({own}, {tree}.sections, range(0, len({own}))), lambda z: NOT list_contains({other}, z[1])),"
        " lambda z: list_transform(z[2].paragraphs, lambda p: {'hash': p.hash, 'section': z[3]})))"
    )


def _only_sql(x: str, y: str) -> str:
    return f"len(list_filter({x}, lambda k: NOT list_contains({y}, k)))"


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS next_text
  FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST, coalesce(text, '') ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT doc_id, length(text) AS n_chars, text, next_text,
    substring(text, 1, length(text) - length(text) // 2) || substring(next_text, 1, length(text) // 2) AS edited
  FROM d
), t AS (
  SELECT doc_id, n_chars, edited, {_tree_sql('text')} AS a, {_tree_sql('edited')} AS b, {_tree_sql('next_text')} AS c FROM e
), l AS (
  SELECT *, {_leaves_sql('a')} AS la, {_leaves_sql('b')} AS lb, {_leaves_sql('c')} AS lc,
    list_transform(a.sections, lambda s: {{'hash': s.hash, 'section': 0}}) AS ta,
    list_transform(b.sections, lambda s: {{'hash': s.hash, 'section': 0}}) AS tb FROM t
), s AS (
  SELECT *, {_numbered_sql('ta')} AS sa, {_numbered_sql('tb')} AS sb FROM l
), p AS (
  SELECT *, {_paragraphs_sql('a', 'sa', 'sb')} AS pa, {_paragraphs_sql('b', 'sb', 'sa')} AS pb FROM s
), q AS (
  SELECT *, {_numbered_sql('pa')} AS ka, {_numbered_sql('pb')} AS kb FROM p
), f AS (
  SELECT *, {_chain_sql('ta', 'sa', 'sb')} AS csa, {_chain_sql('tb', 'sb', 'sa')} AS csb,
    {_chain_sql('pa', 'ka', 'kb')} AS cka, {_chain_sql('pb', 'kb', 'ka')} AS ckb FROM q
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, a.root AS fingerprint, b.root AS edited_fingerprint,
  2.0::DOUBLE * len(list_intersect(la, lb)) / (len(la) + len(lb)) AS near_edited,
  2.0::DOUBLE * len(list_intersect(la, lc)) / (len(la) + len(lc)) AS near_next,
  {_only_sql('ka', 'kb')}::BIGINT AS deleted_parts, {_only_sql('kb', 'ka')}::BIGINT AS inserted_parts,
  ({_only_sql('csb', 'csa')} + {_only_sql('ckb', 'cka')})::BIGINT AS moved_parts
FROM f
"""

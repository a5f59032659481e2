"""Manifest, proofs and verification against a plain tree."""

import hashlib
import os
import subprocess
import sys

import pytest
from awkward_rows import SF0001, awkward, norm, nothing  # noqa: F401
from propensia.llm import dataset_manifest as dm
from pyspark.sql import functions as F


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, fields=dm.FIELDS):
    values = [None if row[f] is None else str(row[f]) for f in fields]
    return H("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def levels_of(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return levels


def siblings(levels, at, fan):
    out = []
    for nodes in levels[:-1]:
        first = at // fan * fan
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fan])))
        at //= fan
    return out


def brute(rows, fan, tamper=lambda r: False):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault((r["source"] is not None, (r["source"] or "").encode()), []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    trees = {g: (sorted(members, key=lambda m: m[:3]), None) for g, members in sorted(groups.items())}
    trees = {g: (members, levels_of([m[2] for m in members], fan)) for g, (members, _) in trees.items()}
    top = levels_of([levels[-1][0] for _, levels in trees.values()], fan)
    out = []
    for t, (members, levels) in enumerate(trees.values()):
        for at, (_, _, own, r) in enumerate(members):
            path = siblings(levels, at, fan) + siblings(top, t, fan)
            lowered = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            node = leaf({**r, "text": lowered}) if tamper(r) else own
            for left, right in path:
                node = H(left + node + right)
            out.append((r["doc_id"], own, levels[-1][0], top[-1][0], H("".join(x + y for x, y in path)), node))
    return norm(out)


@pytest.mark.parametrize(("fan", "band"), [(16, 3), (2, 3), (3, 2), (2, 1)])
def test_awkward_rows(spark, awkward, fan, band):
    docs = awkward.withColumn("source", F.when(F.col("doc_id") > 6, "b").when(F.col("doc_id") < 4, "ä"))
    rows = [r.asDict() for r in docs.collect()]
    even = lambda r: r["doc_id"] is not None and r["doc_id"] % 2 == 0
    probe = F.when(F.col("doc_id") % 2 == 0, dm.leaf([dm.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in dm.FIELDS]))
    made = dm.build(docs, probe=probe, fan=fan, band=band)
    want = brute(rows, fan, even)
    assert norm(made.verify().collect()) == want
    assert made.root() == want[0][3]
    # every given proof leads to the root
    for r in made.proofs().collect():
        assert dm.fold(r["leaf"], [tuple(s) for s in r["siblings"]])[-1] == want[0][3]


def test_many_levels_and_a_hot_group(spark):
    """Subtrees of several bands; one source holds most rows; only every third level is stored."""
    docs = spark.range(700).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 60).cast("string"))).alias("source"),
        F.lit("en").alias("lang"), F.lit(3).cast("long").alias("n_chars"), F.concat(F.lit("Text "), F.col("id").cast("string")).alias("text"),
    )
    made = dm.build(docs, fan=2, band=3)
    want = brute([r.asDict() for r in docs.collect()], 2)
    assert norm(made.verify().collect()) == want
    kept = sum(level.count() for level in made.groups.stored)
    assert kept < 700 * 1.3  # all levels together hold about twice the leaves


def test_changed_key_order_or_text_changes_the_root(spark):
    docs = spark.createDataFrame([(i, "a", "en", 1, f"t{i}") for i in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    root = dm.build(docs).root()
    assert dm.build(docs.orderBy(F.desc("doc_id"))).root() == root
    assert dm.build(docs.withColumn("text", F.when(F.col("doc_id") == 7, "T7").otherwise(F.col("text")))).root() != root
    assert dm.build(docs.filter("doc_id <> 3")).root() != root


def test_empty_table(spark, nothing):
    made = dm.build(nothing)
    assert made.root() is None
    assert made.verify().count() == 0 and made.proofs().count() == 0


def test_query_equals_sql():
    script = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "oracle_check.py")
    res = subprocess.run([sys.executable, script, SF0001, "op12_dataset_manifest"], capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stdout[-3000:]

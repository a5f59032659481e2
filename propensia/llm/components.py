"""Connected components of a link table by contraction.

Each round every vertex points to the smallest of itself and its neighbours,
and the links are rewritten to the pointed-at vertices: those that fall
together vanish, every vertex that is no local minimum disappears from the
link table, and a component never loses its smallest vertex. Links shrink
geometrically; a star of any size is gone after one round. The pointers are
aggregates with map-side combine, so a hub with a third of all links is one
row a task; its links are joined by skew-aware sort-merge joins. Rounds are
written to the shared folder. Nothing is collected but one count a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensia.llm.common import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, root) of every vertex in ``links``; root is the smallest of its component.

    Vertices are longs. Self links and repeated links change nothing; rows
    with a null end are left out. Empty table: no rows.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    edges = materialize(_ordered(edges), "links")
    pointers = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
        pointer = materialize(both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("p")), "pointers")
        pointers.append(pointer)
        ahead = edges.join(pointer.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a")
        ahead = ahead.join(pointer.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        edges = materialize(_ordered(ahead.select(F.col("pa").alias("a"), F.col("pb").alias("b")).filter("a <> b")), "links")
    if not pointers:
        return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    roots = pointers[0].select(F.col("v").alias("vertex"), F.col("p").alias("root"))
    for pointer in pointers[1:]:
        step = pointer.select(F.col("v").alias("root"), F.col("p").alias("next"))
        roots = roots.join(step, "root", "left").select("vertex", F.coalesce("next", "root").alias("root"))
    return roots


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

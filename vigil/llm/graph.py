"""Connected components as DataFrame rounds of hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import drop_tables, materialize


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every end of ``edges (a, b)``; root is the component's least node.

    First every node goes to the least of its closed neighbourhood, and on to
    that node's own choice. The edges between the nodes gone to, far fewer
    where groups are dense, are what the rounds join.
    """
    whole = materialize(
        edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    first = _least_around(whole)
    up = first.select(F.col("v").alias("f"), F.col("f").alias("g"))
    gone = materialize(first.join(up, "f").select("v", F.col("g").alias("f")), "gone")
    to = lambda c: gone.select(F.col("v").alias(c), F.col("f").alias(f"f{c}"))
    carried = whole.join(to("u"), "u").join(to("v"), "v").filter("fu <> fv")
    rest = materialize(carried.select(F.least("fu", "fv").alias("u"), F.greatest("fu", "fv").alias("v")).distinct(), "edges")
    drop_tables(whole)
    if rest.isEmpty():
        drop_tables(rest)
        return gone.select("v", F.col("f").alias("root"))
    roots = _rounds(rest)
    found = materialize(
        gone.join(roots.select(F.col("v").alias("f"), "root"), "f", "left").select("v", F.coalesce("root", "f").alias("root")), "components"
    )
    drop_tables(rest, gone, roots)
    return found


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select("v", "u"))


def _least_around(edges: DataFrame) -> DataFrame:
    """``(v, f)``: every node's least among itself and its neighbours."""
    return _both_ways(edges).groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("f"))


def _rounds(edges: DataFrame) -> DataFrame:
    """``components`` of distinct ``edges (u, v)`` with u < v.

    Each round hooks the parent of a node, and the node itself, to the least
    grandparent among its neighbours. Only a count and a checksum reach the
    driver; a round's table is written to the shared folder.
    """
    both = _both_ways(edges)
    parent = materialize(_least_around(edges), "parent")
    seen = None
    while True:
        up = parent.select(F.col("v").alias("f"), F.col("f").alias("g"))
        grand = materialize(parent.join(up, "f").select("v", "f", "g"), "grand")
        least = both.join(grand.select("v", "g"), "v").groupBy("u").agg(F.min("g").alias("m"))
        joined = grand.join(least, grand["v"] == least["u"])
        moves = joined.select(
            F.explode(
                F.array(
                    F.struct(F.col("f").alias("v"), F.col("m").alias("f")),
                    F.struct(F.col("v").alias("v"), F.least("m", "g", "f").alias("f")),
                )
            ).alias("x")
        ).select("x.*")
        newer = materialize(moves.groupBy("v").agg(F.min("f").alias("f")), "parent")
        state = newer.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("v", "f").cast("decimal(38,0)"))
        ).first()
        drop_tables(grand, parent)
        parent = newer
        if state == seen:
            return parent.select("v", F.col("f").alias("root"))
        seen = state

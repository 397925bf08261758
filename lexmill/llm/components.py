"""Connected components by alternating large and small stars, all in joins and aggregations.

After every round each node hangs on smaller ones only; the rounds end when
the edges no longer change, after some log n of them. Edges are staged between
rounds, and none are collected. The hub of a large star is a hot key: its
neighbours learn their least one by a broadcast of hubs, see
:func:`~.staging.spread_join`.

Defined cases: no link, or none but loops, gives an empty table; links may
repeat and run in both directions; nulls link nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .staging import spread_join, staged


def _stars(edges: DataFrame, rows: int, large: bool) -> DataFrame:
    """Hang the neighbours of every node on the least of them: the larger neighbours (large) or the smaller ones."""
    if large:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("many")).withColumn("least", F.least("a", "least"))
    hung = spread_join(around, least, "a", rows, "many")
    if large:
        out = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a staged table, with their number and a sum of hashes, taken as they are written."""
    seen = Observation()
    table = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "components")
    return table, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """``links`` has two columns of comparable ids. Return node and label (the least id reachable) of every node that has a link."""
    a, b = links.columns
    edges, before = _kept(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(F.col("a") != F.col("b")).distinct())
    while before[0]:
        around = staged(_stars(edges, 2 * before[0], large=True), "components")
        edges, after = _kept(_stars(around, before[0], large=False))
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)

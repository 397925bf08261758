"""Layout: shards of bounded size, compaction with provenance and its replay, maps from ids to shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

GIGABYTE = 1_000_000_000
#: Rows to a block of the running sums, and blocks at most.
BLOCK_ROWS, BLOCKS = 50_000, 4096


def even_bounds(df: DataFrame, col: str, rows: int, most: int) -> list[float]:
    """Values of a number that part it into ranges of some ``rows`` rows, ``most`` at most: quantiles, so that clustered values are parted as well."""
    n = max(1, min(most, -(-df.count() // rows)))
    if n == 1:
        return []
    found = df.select(F.col(col).cast("double").alias("x")).approxQuantile("x", [k / n for k in range(1, n)], 1 / (4 * n))
    return sorted(set(found))


def cell_of(df: DataFrame, col: str, bounds: list[float], out: str) -> DataFrame:
    """Add the range that a number falls in, from 0; it never falls where the number rises, and nulls come last."""
    at = F.col(col).cast("double")
    if not bounds:
        return df.withColumn(out, F.when(at.isNull(), 1).otherwise(0))
    split = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol=f"{out}_of", outputCol=f"{out}_at", handleInvalid="keep")
    placed = split.transform(df.withColumn(f"{out}_of", F.coalesce(at, F.lit(float("nan")))))
    return placed.withColumn(out, F.col(f"{out}_at").cast("int")).drop(f"{out}_of", f"{out}_at")


def shard_name(shard: Column, name: str, digits: int = 5) -> Column:
    """00012_name"""
    text = shard.cast("string")
    return F.concat_ws("_", F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text), F.lit(name))


def running_size(df: DataFrame, order: str, size: Column, out: str = "size_before") -> DataFrame:
    """Add the total size of the rows before each in an order, without sorting all in one task.

    Rows are cut into ranges of the order (a number) with about as many rows
    each; totals of the ranges, a table of BLOCKS rows at most, are summed up
    first. Rows of equal order follow by a hash of their values, rows without an
    order come last.
    """
    bounds = even_bounds(df, order, BLOCK_ROWS, BLOCKS)
    ties = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))])
    rows = df.select(F.struct("*").alias("row"), F.col(order).alias("at"), size.cast("long").alias("size"), ties.alias("tie"))
    placed = cell_of(rows, "at", bounds, "block")
    totals = placed.groupBy("block").agg(F.sum("size").alias("total"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("block").orderBy(F.col("at").asc_nulls_last(), "tie").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return summed.join(F.broadcast(offsets), "block").select("row.*", (F.col("before") + F.col("offset")).alias(out))


def even_shards(df: DataFrame, order: str, size: Column, most: int, first: int = 0) -> DataFrame:
    """Add shard: rows in order, cut wherever the running size passes a multiple of ``most``."""
    return running_size(df, order, size).withColumn("shard", (F.expr(f"size_before div {most}") + first).cast("int")).drop("size_before")


def greedy_cuts(sizes: np.ndarray, most: int, held: int = 0) -> np.ndarray:
    """Places of the rows that open a shard, after rows that hold ``held``: a row that would fill the shard opens the next, and does not count there."""
    total = np.cumsum(sizes)
    cuts: list[int] = []
    base = -held
    while (at := int(np.searchsorted(total, base + most))) < len(total):
        cuts.append(at)
        base = int(total[at])
    return np.array(cuts, np.int64)


#: Rows that one task cuts, blocks that one task walks, and cuts that are broadcast at most.
CUT_ROWS, WALKED, BROADCAST_CUTS = 200_000, 64, 2_000_000
#: What a run of rows does to a shard that enters it, by the least size of the intervals: shards opened, and the size that leaves, to which the one that entered is added where none is opened.
_STEPS = "low long, opened long, left long, added boolean"


def cut_steps(sizes: np.ndarray, most: int) -> pd.DataFrame:
    """The steps of a block.

    Where the size that enters and the running total reach the limit is the first
    cut; all sizes that are first cut at the same row leave alike. From each row that
    opens a shard a pointer leads to the next, and they are followed from the end.
    """
    total = np.cumsum(sizes)
    n = len(total)
    reach = int(np.searchsorted(total, most))  # later rows are never the first cut
    following = np.searchsorted(total, total + most)
    opened, left = np.ones(n, np.int64), (total[-1] - total).astype(np.int64)
    for k in range(n - 1, -1, -1):
        if following[k] < n:
            opened[k], left[k] = opened[following[k]] + 1, left[following[k]]
    rows = np.arange(min(reach, n - 1), -1, -1)
    steps = pd.DataFrame({"low": np.maximum(most - total[rows], 0), "opened": opened[rows], "left": left[rows], "added": False})
    if reach == n:
        steps = pd.concat([pd.DataFrame({"low": [0], "opened": [0], "left": [int(total[-1])], "added": [True]}), steps])
    return _merged(steps, most)


def _merged(steps: pd.DataFrame, most: int) -> pd.DataFrame:
    """Without empty intervals, and with neighbours that do the same as one."""
    steps = steps[steps["low"] < most]
    steps = steps[steps["low"] != steps["low"].shift(-1)]
    same = (steps[["opened", "left", "added"]] == steps[["opened", "left", "added"]].shift()).all(axis=1)
    return steps[~same].reset_index(drop=True)


def _step(steps: pd.DataFrame, held: int) -> tuple[int, int]:
    """Shards opened and the size that leaves, for one that enters."""
    at = int(np.searchsorted(steps["low"].to_numpy(), held, "right")) - 1
    opened, left, added = (steps[c].iat[at] for c in ("opened", "left", "added"))
    return int(opened), int(left) + (held if added else 0)


def chained(first: pd.DataFrame, then: pd.DataFrame, most: int) -> pd.DataFrame:
    """The steps of two runs of rows, one after the other."""
    parts, lows = [], then["low"].to_numpy()
    for low, opened, left, added in first.itertuples(index=False):
        if added:  # sizes up to the first cut pass through: they meet the second run's steps
            own = then.assign(low=np.maximum(lows - left, 0), left=then["left"] + np.where(then["added"], left, 0))
            own = own[own["low"] != own["low"].shift(-1)]
            parts.append(own[own["low"] < (most - left)])
        else:
            more, rest = _step(then, left)
            parts.append(pd.DataFrame({"low": [low], "opened": [opened + more], "left": [rest], "added": [False]}))
    return _merged(pd.concat(parts, ignore_index=True), most)


def greedy_shards(df: DataFrame, order: str, size: Column, most: int, first: int = 0) -> DataFrame:
    """Add shard by the greedy rule, in which every cut depends on the last. ``order`` is a number; rows without one come last, those without a size hold nothing.

    Rows are cut into blocks of the order. Each block says in a task of its own what
    it does to any shard that enters it (:func:`cut_steps`), in as many steps at most
    as a shard has rows. Blocks are walked by their steps, WALKED of them in a task:
    they are chained to one, those are walked, and so is then each of them, with what
    enters it. Then every block makes its cuts. No task holds more than a block or
    the steps of WALKED blocks.
    """
    bounds = even_bounds(df, order, CUT_ROWS, WALKED * WALKED)
    ties = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))])
    rows = df.select(F.struct("*").alias("row"), F.col(order).alias("at"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"), ties.alias("tie"))
    inside = Window.partitionBy("block")
    numbered = cell_of(rows, "at", bounds, "block").withColumn("n", F.row_number().over(inside.orderBy(F.col("at").asc_nulls_last(), "tie")) - 1)
    thin = numbered.select("block", "n", "size")

    def sizes(pdf: pd.DataFrame) -> np.ndarray:
        return pdf.sort_values("n")["size"].to_numpy(np.int64)

    def steps_of(pdf: pd.DataFrame) -> pd.DataFrame:
        return cut_steps(sizes(pdf), most).assign(block=pdf["block"].iat[0])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for _, own in pdf.groupby("block"):
            own = own[["low", "opened", "left", "added"]].sort_values("low")
            whole = own if whole is None else chained(whole, own, most)
        return whole.assign(walk=pdf["walk"].iat[0])

    def walked(pdf: pd.DataFrame, held: int, shard: int, key: str) -> pd.DataFrame:
        out = []
        for block, own in pdf.groupby(key):
            out.append((block, held, shard))
            opened, held = _step(own.sort_values("low"), held)
            shard += opened
        return pd.DataFrame(out, columns=[key, "held", "shard"])

    steps = durable(thin.groupBy("block").applyInPandas(steps_of, f"block int, {_STEPS}").withColumn("walk", F.expr(f"block div {WALKED}").cast("int")))
    walks = steps.groupBy("walk").applyInPandas(together, f"walk int, {_STEPS}")
    entered = walks.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lambda pdf: walked(pdf, 0, first, "walk"), "walk int, held long, shard long")
    each = steps.join(entered, "walk").groupBy("walk").applyInPandas(lambda pdf: walked(pdf, int(pdf["held"].iat[0]), int(pdf["shard"].iat[0]), "block"), "block int, held long, shard long")
    entering = F.broadcast(durable(each))  # a row per block

    def cuts_of(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": pdf["block"].iat[0], "n": greedy_cuts(sizes(pdf), most, int(pdf["held"].iat[0])), "cut": 1})

    cuts = durable(thin.join(entering, "block").groupBy("block").applyInPandas(cuts_of, "block int, n int, cut int"))
    small = cuts.count() <= BROADCAST_CUTS
    marked = numbered.join(F.broadcast(cuts) if small else cuts.hint("merge"), ["block", "n"], "left").join(entering.select("block", "shard"), "block")
    opened = F.coalesce(F.sum("cut").over(inside.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return marked.select("row", (F.col("shard") + opened).cast("int").alias("shard")).select("row.*", "shard")


def _place(order: str) -> Column:
    """Something to compare places by: rows without an order come last."""
    return F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("at"))


def compacted(df: DataFrame, order: str, size: Column, most: int, file_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their new shard, and for each shard its files in order, first and last id, the places where it begins and ends, and rows."""
    rows = even_shards(df, order, size, most)
    files = F.transform(F.array_sort(F.collect_list("_file")), lambda x: x["file"])
    known = F.when(F.col(order).isNotNull(), F.struct(F.col(order).alias("at"), F.col(id_col).alias("id")))
    per_file = rows.groupBy("shard", F.col(file_col).alias("file")).agg(F.min(_place(order)).alias("first_at"), F.max(_place(order)).alias("last_at"), F.count(F.lit(1)).alias("n"), F.min(known).alias("_first"), F.max(known).alias("_last"))
    per_shard = per_file.withColumn("_file", F.struct("first_at", "file")).groupBy("shard")
    shards = per_shard.agg(files.alias("files"), F.min("_first")["id"].alias("first_id"), F.max("_last")["id"].alias("last_id"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.sum("n").alias("rows"))
    return rows, shards


def replay(df: DataFrame, shards: DataFrame, order: str, file_col: str, id_col: str) -> DataFrame:
    """Give the rows of another version the shards of a compaction: those of its files, from its first id to its last.

    An id that the other version lacks is where it was when the shards were
    made, so the order must mean the same in both versions. Rows without an
    order come last; where they are in several shards, nothing tells which.
    """
    edges = shards.select("shard", F.posexplode("files").alias("k", "_f"), F.size("files").alias("_n"), "first_id", "last_id", "first_at", "last_at")
    place = df.filter(F.col(order).isNotNull()).select(F.col(id_col).alias("_id"), _place(order).alias("_at"))
    begin = edges.filter("k = 0").join(place, F.col("_id") == F.col("first_id"), "left").select("shard", F.coalesce("_at", "first_at").alias("_from"))
    end = edges.filter("k = _n - 1").join(place, F.col("_id") == F.col("last_id"), "left").select("shard", F.when(F.col("last_at.none"), F.col("last_at")).otherwise(F.coalesce("_at", "last_at")).alias("_to"))
    spans = edges.join(begin, "shard").join(end, "shard").select("shard", "_f", "k", "_n", "_from", "_to")
    inside = ((F.col("k") > 0) | (_place(order) >= F.col("_from"))) & ((F.col("k") < F.col("_n") - 1) | (_place(order) <= F.col("_to")))
    return df.join(spans, F.col(file_col).eqNullSafe(F.col("_f")) & inside).drop("_f", "k", "_n", "_from", "_to")


def shard_of_ids(df: DataFrame, id_col: str, file_col: str) -> DataFrame:
    """Id and the shard number that its file's name starts with; of several, the last."""
    number = F.regexp_extract(F.element_at(F.split(file_col, "/"), -1), r"^(\d{5})_", 1)
    return df.select(id_col, number.alias("shard")).groupBy(id_col).agg(F.max("shard").alias("shard"))


def next_shard(files: DataFrame, file_col: str) -> Column:
    """One more than the greatest shard number in the names of the files."""
    return F.coalesce(F.max(F.regexp_extract(F.element_at(F.split(file_col, "/"), -1), r"^(\d+)_", 1).try_cast("int")) + 1, F.lit(0))


def numbered(df: DataFrame, order: list[str], out: str = "number") -> DataFrame:
    """Add the place of each row in an order, from 0, without sorting all in one task; nulls come first, equal rows follow in any order.

    Rows are cut into ranges, which are kept, as they are cut by a sample; each task
    numbers its range, after the rows of those before it, a number per range.
    """
    hashed = [F.col(f"`{f.name}`") for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    rows = df.select(F.struct("*").alias("row"), *[F.col(c).alias(f"at{k}") for k, c in enumerate(order)], F.xxhash64(*hashed).alias("tie"))
    by = [*[f"at{k}" for k in range(len(order))], "tie"]
    ranged = durable(rows.repartitionByRange(*by).withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("many"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("range", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*by)) - 1
    return ranged.withColumn("place", place).join(F.broadcast(offsets), "range").select("row.*", (F.col("place") + F.col("offset")).alias(out))


def renumbered(files: DataFrame, stem: str, counter: str) -> DataFrame:
    """New five-digit numbers by stem and counter. files: one row per file."""
    placed = numbered(files, [stem, counter])
    text = F.col("number").cast("string")
    return placed.withColumn("number", F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text))

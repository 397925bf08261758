"""Proportional stratified interleaving: shards that all hold the same source mixture.

Rows are shuffled by a seeded hash within their source, ranked there, and
placed at the fractional rank (rank + 1/2) / source size. Sorting by it spreads
every source evenly, so equal cuts of that order match the mixture. Only row
numbers, sizes and checksums move; the texts stay where they are.

Law ``rows``: with n rows and s shards, shard k holds the positions p with
floor(p * s / n) = k, so counts differ by one at most. Equal texts need not
meet in a shard under that law.

Defined cases: a null source is a source of its own; a null text has no bytes;
a null id is hashed as an empty one; repeated rows are ranked one after the
other and each get a slot; an empty table gives an empty result; columns other
than the three named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import exact_rank, hash_bucket, rank_buckets, spread_join, staged

SEED = "interleave-1"


def interleave(
    docs: DataFrame, shards: int = 40, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Return id, source, size, text_crc32, shard and slot (gapless from 0 in each shard)."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    source = F.col(source_col).cast("string")
    rows = staged(
        docs.select(
            F.col(id_col).alias("id"),
            source.alias("source"),
            F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("stratum"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("key"),
        ),
        "sharding",
    )
    n = rows.count()
    buckets = rank_buckets(n)
    ties = ["key", "id", "text_crc32", "size"]
    ranked = exact_rank(rows, ["stratum"], hash_bucket(F.col("key"), buckets), ties, "rank")
    sizes = rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("_n"))
    placed = staged(
        spread_join(ranked, sizes, "stratum", n, "_n").select(
            "id", "source", "stratum", "size", "text_crc32", "key", ((2 * F.col("rank") + 1) / (2 * F.col("_n"))).alias("fraction")
        ),
        "sharding",
    )
    at = F.floor(F.col("fraction") * buckets).cast("int")
    whole = exact_rank(placed.withColumn("_all", F.lit(0)), ["_all"], at, ["fraction", "stratum", *ties], "position")
    shard = F.expr(f"position * {shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return (
        whole.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("position") - first)
        .select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "text_crc32", "shard", "slot")
    )

"""Helpers shared by the operators: staged tables, joins on hot keys, exact distributed ranks, filters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder


#: Paths that the enclosing :func:`cleared` will delete.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage at a table that survives lost executors. Within
    :func:`cleared` the files go with its end, else when the driver's JVM ends,
    as results stay lazy until then.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    inside = _scope.get()
    if inside is None:
        files, hadoop = _file_system(spark, path)
        files.deleteOnExit(hadoop)
    else:
        inside.append(path)
    return spark.read.schema(schema).parquet(path)


def cleared(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``make`` as a staged table; the tables that it staged on its way are deleted."""
    own: list[str] = []
    token = _scope.set(own)
    try:
        made = make()
        _scope.reset(token)
        token = None
        return staged(made, name)
    finally:
        if token is not None:
            _scope.reset(token)
        for path in own:
            files, hadoop = _file_system(spark, path)
            files.delete(hadoop, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """A staged table that outlives :func:`cleared`."""
    token = _scope.set(None)
    try:
        return staged(df, name)
    finally:
        _scope.reset(token)


#: A key of more than one in so many rows is hot; there can be no more such keys than this.
HOT = 1000


def spread_join(left: DataFrame, right: DataFrame, key: str, rows: int, many: str) -> DataFrame:
    """Join ``right``, which has one row per key and in ``many`` the rows that ``left`` has of it; ``rows`` are all of left's.

    Rows of hot keys meet their partner by a broadcast of at most HOT rows and
    stay where they are; only keys of less than one in HOT rows are shuffled.
    """
    hot, cold = right.filter(F.col(many) * HOT > rows), right.filter(F.col(many) * HOT <= rows)
    at_once = left.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return at_once.unionByName(rest)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a lowercase hex key by its first 32 bits; monotone in the key."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * buckets / F.lit(float(1 << 32))).cast("int")


def rank_buckets(rows: int) -> int:
    """Buckets for :func:`exact_rank`: some 20,000 rows each, 64 to 65,536 of them."""
    return min(65_536, max(64, rows // 20_000))


def exact_rank(df: DataFrame, by: list[str], bucket: Column, order: list, out: str) -> DataFrame:
    """Number the rows from 0 within ``by`` (no nulls there), in ``order``, without one task per group.

    ``bucket`` must rise with ``order``. Rows are numbered within (by, bucket);
    bucket counts, a table of at most 65,536 rows a group, give the offsets.
    """
    keyed = df.withColumn("_bucket", bucket)
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    numbered = keyed.withColumn("_number", F.row_number().over(inside))
    return (
        numbered.join(offsets, [*by, "_bucket"])
        .withColumn(out, F.col("_number").cast("long") - 1 + F.col("_offset"))
        .drop("_bucket", "_number", "_offset")
    )


#: Bits of the filter of :func:`maybe_in` for every key, and bits at most: 1,048,576 words of 64 bits are broadcast.
KEY_BITS, FILTER_BITS = 16, 1 << 26


def maybe_in(df: DataFrame, key: str, keys: DataFrame, keys_key: str, count: int, invert: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``, and some others: a bitmap of hashes, so that no other row needs a shuffle.

    The bitmap has KEY_BITS bits for each of the ``count`` keys; some 6 % of the
    other rows pass. Beyond FILTER_BITS it no longer grows, and the share of
    other rows that pass does. inverted: the rows that do not pass. A null key
    is a key like any other. The row travels as one struct, so that its columns
    may have any names.
    """
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(12, (KEY_BITS * count).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    place = lambda c: [(slot(c) / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot(c), F.lit(64)).cast("int")).alias("bit")]
    words = keys.select(*place(F.col(keys_key))).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    placed = df.select(F.struct("*").alias("row"), *place(F.col(key)))
    hit = F.coalesce(F.col("bit").bitwiseAND(F.col("bits")) != 0, F.lit(False))
    return placed.join(F.broadcast(words), "word", "left").filter(~hit if invert else hit).select("row.*")

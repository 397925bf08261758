"""Incremental forms: new shards are mixed as they come, ids and texts seen before are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.mix import MixSpec, mix
from ..session import durable


def watch(spark: SparkSession, path: str, schema: StructType, kind: str = "json", files_per_trigger: int = 64) -> DataFrame:
    """Files of a folder as a stream; the checkpoint of the query remembers which are done."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def mix_stream(docs: DataFrame, spec: MixSpec, text_col: str = "text") -> DataFrame:
    """A mix is row by row, so that it runs on a stream as it is."""
    return mix(docs, spec, text_col)


def first_seen(docs: DataFrame, text_col: str = "text", time_col: str | None = None, delay: str = "1 day") -> DataFrame:
    """Documents whose text is new: for ever, or within the delay of the event time. State holds hashes, no texts."""
    keyed = docs.withColumn("_digest", F.sha2(F.col(text_col).cast("binary"), 256))
    if time_col:
        return keyed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")
    return keyed.dropDuplicates(["_digest"]).drop("_digest")


def size_by_window(docs: DataFrame, time_col: str, by: str, width: str = "1 hour", delay: str = "1 hour", text_col: str = "text") -> DataFrame:
    """Documents and characters by window of the event time and key."""
    windowed = docs.withWatermark(time_col, delay).groupBy(F.window(time_col, width), by)
    return windowed.agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length(text_col)).alias("characters"))


#: Parts of the ids that a target keeps; a batch reads only those that its own ids fall into.
ID_BUCKETS = 256


def merge_new(docs: DataFrame, target: str, checkpoint: str, id_col: str = "id") -> StreamingQuery:
    """Add the rows whose id the target does not have yet, each once, in a folder for each batch.

    The target keeps the ids it has beside its rows, by a hash, so that a batch
    reads the ids of its own buckets and never the rows. A batch that is done
    again after a failure replaces what it had written.
    """
    ids = f"{target}/_ids"

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(F.col(id_col)), F.lit(ID_BUCKETS)).cast("int").alias("bucket")
        fresh = durable(batch.dropDuplicates([id_col]))
        where = spark._jvm.org.apache.hadoop.fs.Path(ids)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            own = [r["bucket"] for r in fresh.select(bucket).distinct().collect()]  # ID_BUCKETS at most
            held = spark.read.parquet(ids).filter(F.col("bucket").isin(own) & (F.col("batch") != number))
            fresh = fresh.join(held.select(id_col), id_col, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")
        fresh.select(id_col, bucket).write.mode("overwrite").partitionBy("bucket").parquet(f"{ids}/batch={number}")

    return docs.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_stream(docs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return docs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()

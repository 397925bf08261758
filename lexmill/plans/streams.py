"""The documents as a stream of files, run to its end, and what is then in the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .corpus import WORDS
from .. import streaming
from ..operators.mix import Replacement, recipe
from ..session import scratch
from ..streaming.ngrams import buckets_for, ngram_overlap_stream


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    return streaming.watch(spark, f"{sf_dir}/documents.parque[t]", schema, "parquet")  # a pattern, as the table may be a file or a folder


def written(docs: DataFrame, spark: SparkSession) -> DataFrame:
    """What the stream leaves behind as a table."""
    path, schema = scratch(spark, "stream"), docs.schema
    streaming.write_stream(docs, path, scratch(spark, "state")).awaitTermination()
    return spark.read.schema(schema).parquet(path)


@query("SELECT doc_id, regexp_replace(text, '  ', ' ', 'g') AS text FROM documents WHERE length(text) > 700")
def stream_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = streaming.mix_stream(stream(spark, sf_dir), recipe("q", chars=700, duplicate=False, edits=(Replacement("double_space", " ", 0.1),)))
    return written(kept.select("doc_id", "text"), spark)


@query("SELECT DISTINCT text FROM documents")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(streaming.first_seen(stream(spark, sf_dir)).select("text"), spark)


@query("SELECT DISTINCT source AS id FROM documents")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one target: ids that it has come in once."""
    target = scratch(spark, "merged")
    rows = stream(spark, sf_dir).select(F.col("source").alias("id"), "lang")
    for part in (rows.filter("lang = 'en'"), rows):
        streaming.merge_new(part, target, scratch(spark, "state")).awaitTermination()
    return spark.read.schema("id string").parquet(target).select("id")


@query("""WITH t AS (SELECT doc_id // 60 AS hour, lang, text, max(doc_id) OVER () AS last FROM documents)
  SELECT (hour * 3600)::BIGINT AS start, lang, count(*) AS documents, sum(length(text))::BIGINT AS characters FROM t WHERE (hour + 1) * 60 <= last - 60 GROUP BY hour, lang""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that the watermark has closed; a document's time is its id in minutes."""
    docs = stream(spark, sf_dir).withColumn("time", F.timestamp_seconds(F.col("doc_id") * 60))
    sizes = streaming.size_by_window(docs, "time", "lang", "1 hour", "1 hour")
    return written(sizes.select(F.unix_timestamp("window.start").alias("start"), "lang", "documents", "characters"), spark)


@query(f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents), g AS (SELECT doc_id, array_to_string(ws[k:k + 9], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 8)) AS k FROM w WHERE len(ws) >= 10)),
  f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY gram) < doc_id AS seen FROM g)
  SELECT doc_id, count(*) AS n_ngrams, round(avg(seen::INT), 9) AS overlap FROM f GROUP BY doc_id""")
def stream_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in order of their ids, in four batches; the stream is stopped after each of them and started again."""
    source, target, state = scratch(spark, "batches"), scratch(spark, "overlap"), scratch(spark, "state")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cuts = [int(x) for x in docs.agg(F.percentile("doc_id", [0.25, 0.5, 0.75])).first()[0]]
    bounds = [None, *cuts, None]
    size = spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet").agg(F.sum("length")).first()[0]
    for k in range(4):
        low, high = bounds[k], bounds[k + 1]
        part = docs.filter((F.lit(low is None) | (F.col("doc_id") > low)) & (F.lit(high is None) | (F.col("doc_id") <= high)))
        part.write.parquet(f"{source}/part={k}")
        # all files that are there are one batch, which as many tasks read
        rows = streaming.watch(spark, f"{source}/*", docs.schema, "parquet", files_per_trigger=1 << 30)
        ngram_overlap_stream(rows, target, state, 10, buckets=buckets_for(size or 0)).awaitTermination()
    found = spark.read.schema("doc_id long, n_ngrams long, overlap double").parquet(target)
    return found.select("doc_id", "n_ngrams", F.round("overlap", 9).alias("overlap"))

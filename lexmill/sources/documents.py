"""Document shards: gzipped JSON lines in <root>/documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import GIGABYTE, even_shards, shard_name

#: The row that every source becomes; metadata of any shape fits as JSON text by key.
DOCUMENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "text", "source", "added", "created")] + [T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
)


def input_path(spark: SparkSession, path: str, pattern: str | None = "*.jsonl.gz") -> str:
    """A path or glob that matches something as it is; otherwise the pattern in its documents folder."""
    if pattern is None:
        raise ValueError("a pattern is needed")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(where)
    if found and not (len(found) == 1 and found[0].isDirectory()):
        return path
    return f"{path.rstrip('/')}/documents/{pattern}"


def output_path(path: str) -> str:
    """The documents folder of a version."""
    path = path.rstrip("/")
    return path if path.rsplit("/", 1)[-1] == "documents" else f"{path}/documents"


def read_documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT, pattern: str = "*.jsonl.gz") -> DataFrame:
    """Rows of document shards, with their file. Lines that are no JSON, or null, are left out."""
    extra = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(extra).option("mode", "PERMISSIVE").json(input_path(spark, path, pattern))
    return rows.withColumn("file", F.col("_metadata.file_path")).filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def bad_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl.gz") -> DataFrame:
    """What :func:`read_documents` leaves out: file and line."""
    rows = spark.read.text(input_path(spark, path, pattern)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return rows.filter(F.try_parse_json("line").isNull() | (F.trim("line") == "null"))


def read_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl.gz") -> DataFrame:
    """Lines of files with where they come from: file, line_number (from 0) and line; bad and blank ones count as well.

    A file is read in splits. Lines are numbered within each by the order in which
    they are read, and raised by the counts of the file's splits before it: a row per
    split, joined by split.
    """
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    rows = spark.read.text(input_path(spark, path, pattern)).select(*where, F.monotonically_increasing_id().alias("read"), F.col("value").alias("line"))
    splits = rows.groupBy("file", "split").agg(F.min("read").alias("first"), F.count(F.lit(1)).alias("many"))
    before = F.coalesce(F.sum("many").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    raised = splits.select("file", "split", (before - F.col("first")).alias("raise"))
    return rows.join(raised, ["file", "split"]).select("file", (F.col("read") + F.col("raise")).alias("line_number"), "line")


def read_with_origin(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT, pattern: str = "*.jsonl.gz") -> DataFrame:
    """As :func:`read_documents`, with file and line_number of each row."""
    parsed = read_lines(spark, path, pattern).filter(F.try_parse_json("line").isNotNull() & (F.trim("line") != "null"))
    return parsed.select(F.from_json("line", schema).alias("row"), "file", "line_number").select("row.*", "file", "line_number")


def with_text(docs: DataFrame, text: Column, text_col: str = "text", out: str = "unchanged") -> DataFrame:
    """Give rows a new text, and mark those whose text it leaves as it was: a transform that changes nothing is likely not the one that was meant."""
    both = docs.withColumn(out, text.eqNullSafe(F.col(text_col))).withColumn(text_col, text)
    return both.select(*[c for c in docs.columns if c != out], out)


def write_documents(docs: DataFrame, path: str, name: str, order: str | None = None, shard_bytes: int = GIGABYTE, overwrite: bool = False) -> None:
    """Write shards of some ``shard_bytes`` of JSON as gzip, a folder for each shard's name.

    With an order the shards follow it; otherwise rows stay where they are and
    files are cut by size. Spark's committer publishes whole jobs only.
    """
    writer_mode = "overwrite" if overwrite else "ignore"
    line = F.to_json(F.struct(*[F.col(c) for c in docs.columns if c != order]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    lines = docs.select(*([order] if order else []), line.alias("value"))
    if order:
        placed = even_shards(lines, order, F.octet_length("value"), shard_bytes)
        placed = placed.withColumn("shard_file", shard_name(F.col("shard"), name))
        placed.repartition("shard_file").sortWithinPartitions("shard_file", order).select("value", "shard_file").write.mode(writer_mode).option("compression", "gzip").partitionBy("shard_file").text(output_path(path))
    else:
        lines.write.mode(writer_mode).option("compression", "gzip").text(output_path(path))


def formatted(df: DataFrame, id: Column, text: Column, source: str, added: Column, created: Column | None = None, **metadata: Column) -> DataFrame:
    """The document row of a source; metadata keeps its types."""
    return df.select(
        id.cast("string").alias("id"), text.alias("text"), F.lit(source).alias("source"), added.cast("string").alias("added"),
        (created if created is not None else F.lit(None)).cast("string").alias("created"), F.struct(*[v.alias(k) for k, v in metadata.items()]).alias("metadata"),
    )


def keep_features(df: DataFrame, keep: tuple[str, ...] = ("text",)) -> DataFrame:
    return df.select(*[c for c in df.columns if c in keep])


def id_list(docs: DataFrame, id_col: str = "id") -> DataFrame:
    return docs.select(id_col).distinct()


def without_nulls(docs: DataFrame, id_col: str = "id") -> DataFrame:
    return docs.filter(F.col(id_col).isNotNull())


def write_lines(docs: DataFrame, path: str, text_col: str = "text", token: str = "<n>") -> None:
    """A line per document, for trainers that read plain text."""
    docs.select(F.regexp_replace(F.col(text_col), "\n", token).alias("value")).write.mode("overwrite").text(path)

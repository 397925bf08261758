"""Sessions: settings that the operators rely on, and this package on the executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings for scale; a cluster's own values for memory and parallelism stay as they are.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: Rows and bytes that go to Python at once: small, as texts may be long and executors hold several workers.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
#: Spark's own values of these.
DEFAULTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": "67108864b"}
#: Files of a table that :func:`read_dealt` moves at most.
SMALL_BYTES = 32 << 20
_shipped: set[str] = set()


def session(name: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("_", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names. A private one is made only in local mode, where nobody else must read it."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lexmill-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage at a checkpoint in the cluster's shared folder."""
    sc, folder = df.sparkSession.sparkContext, shared_folder(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def read_dealt(spark: SparkSession, path: str, *columns: Column) -> DataFrame:
    """A Parquet table, or the named columns of it; one of up to SMALL_BYTES of files in fewer parts than cores is dealt over them, as it may be a single row group.

    No more than SMALL_BYTES are ever moved for that, whatever the cluster's size; larger tables stay as they lie.
    """
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return df.repartition(cores) if size <= SMALL_BYTES else df


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, so that its Python functions load there, and set the size of batches."""
    sc = spark.sparkContext
    for key, value in BATCHES.items():
        if spark.conf.get(key) == DEFAULTS[key]:  # a user's own sizes stay
            spark.conf.set(key, value)
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        target = os.path.join(tempfile.mkdtemp(prefix="lexmill-"), f"{root.name}.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted([*root.rglob("*.py"), *root.rglob("*.json")]):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(target)
        _shipped.add(sc.applicationId)
    return spark

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexmill import session
from lexmill.session import durable, read_dealt, shared_folder, ship


def test_small_tables_are_dealt_over_all_cores(spark, tmp_path, monkeypatch):
    path, cores = str(tmp_path / "t.parquet"), spark.sparkContext.defaultParallelism
    spark.range(100).coalesce(1).write.parquet(path)
    assert read_dealt(spark, path).rdd.getNumPartitions() == cores and read_dealt(spark, path).count() == 100
    spark.range(100).repartition(cores + 3).write.parquet(str(tmp_path / "many.parquet"))
    many = read_dealt(spark, str(tmp_path / "many.parquet"))
    assert "Exchange" not in many._jdf.queryExecution().toString() or many.rdd.getNumPartitions() >= cores
    monkeypatch.setattr(session, "SMALL_BYTES", 10)
    assert "Exchange" not in read_dealt(spark, path)._jdf.queryExecution().toString()


def test_no_private_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master=master)
        with pytest.raises(RuntimeError):
            shared_folder(SimpleNamespace(sparkContext=sc))


def test_a_users_batch_sizes_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "123")
    assert ship(spark).conf.get(key) == "123"
    spark.conf.set(key, before)


def test_shipping_twice_changes_nothing(spark):
    files = len(spark.sparkContext.listFiles)
    assert ship(ship(spark)) is spark and len(spark.sparkContext.listFiles) == files


def test_checkpoints_go_to_the_named_folder(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert durable(spark.range(3).withColumn("x", F.lit(1))).count() == 3
    assert (spark.sparkContext.getCheckpointDir() or "").replace("file:", "").startswith(folder)

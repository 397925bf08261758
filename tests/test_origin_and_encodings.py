"""Encodings, lines with their origin, cuts and numbers over many tasks."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.functions.encodings import detected, encoding_of
from lexmill.operators import layout
from lexmill.operators import relational as R
from lexmill.session import scratch
from lexmill.sources import documents as D

FOREIGN = {
    "windows-1251": "Привет, мир! Это обычный русский текст, который мы читаем каждый день. Москва — столица.",
    "koi8-r": "Привет, мир! Это обычный русский текст, который мы читаем каждый день.",
    "cp866": "Привет, мир! Это обычный русский текст, который мы читаем каждый день.",
    "windows-1250": "Zażółć gęślą jaźń. Příliš žluťoučký kůň úpěl ďábelské ódy. Łódź jest miastem.",
    "iso-8859-2": "Zażółć gęślą jaźń. Příliš žluťoučký kůň úpěl ďábelské ódy. Łódź jest miastem.",
    "windows-1253": "Καλημέρα κόσμε, αυτό είναι ένα ελληνικό κείμενο για δοκιμή.",
    "iso-8859-7": "Καλημέρα κόσμε, αυτό είναι ένα ελληνικό κείμενο για δοκιμή.",
    "windows-1254": "Türkçe bir metin: ışık, ağaç, şeker, İstanbul güzel bir şehir.",
    "shift_jis": "これは日本語のテキストです。東京は日本の首都です。",
    "euc_jp": "これは日本語のテキストです。東京は日本の首都です。",
    "gb18030": "这是一个中文文本，用于测试编码检测。北京是中国的首都。",
    "big5": "這是一個中文文本，用於測試編碼檢測。台北是首都。",
    "euc_kr": "이것은 한국어 텍스트입니다. 서울은 대한민국의 수도입니다.",
    "windows-1252": "“Smart quotes” — and a café… it’s €5. Größe, naïve, Ñandú",
    "mac-roman": "Le café était fermé, déjà vu à Noël",
    "utf-16-be": "Plain text in wide letters",
    "utf-32-le": "Plain text in wider letters",
}


@pytest.mark.parametrize("name", FOREIGN)
def test_texts_of_many_scripts(name):
    raw = FOREIGN[name].encode(name)
    assert raw.decode(encoding_of(raw)) == FOREIGN[name], encoding_of(raw)


@pytest.mark.parametrize("name", ["utf-8", "iso-8859-1", "windows-1252", "iso-8859-15", "utf-16", "utf-16-le", "utf-16-be", "utf-8-sig", "mac-roman"])
def test_documents_of_the_tables_return_whole(spark, sf_dir, name):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame([(k, t, t.encode(name, "ignore")) for k, t in enumerate(texts)], "k long, text string, raw binary").repartition(4)
    wrong = [r for r in df.withColumn("found", detected(F.col("raw"))).collect() if r["found"] != r["text"].encode(name, "ignore").decode(name)]
    assert len(wrong) <= (2 if name == "mac-roman" else 0)


def test_odd_bytes():
    assert encoding_of(b"") == "utf-8" and encoding_of(b"\xff\xfe") == "utf-16" and encoding_of(b"abc\0") == "utf-8"
    for raw in (b"\x81", b"\x81\x8d\x90", bytes(range(256)), b"\xff" * 9, "é".encode()[:1]):
        assert isinstance(raw.decode(encoding_of(raw)), str)
    long = "é ".encode("latin-1") * 200_000
    assert long.decode(encoding_of(long)) == "é " * 200_000


def test_columns_of_bytes(spark):
    rows = [(0, None), (1, b""), (2, b"\xef\xbb\xbfabc"), (3, b"plain"), (4, "café".encode("latin-1")), (5, "a".encode("utf-16-le") * 9)]
    got = {r["k"]: r["t"] for r in spark.createDataFrame(rows, "k int, raw binary").select("k", detected(F.col("raw")).alias("t")).collect()}
    assert got == {0: None, 1: "", 2: "abc", 3: "plain", 4: "café", 5: "aaaaaaaaa"}


# lines


def test_lines_are_numbered_across_splits(spark):
    path = scratch(spark, "lines")
    rows = [f"{k:06}" + "x" * (k % 50) if k % 7 else "" for k in range(5000)]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    spark.createDataFrame([("z",)] * 3, "value string").coalesce(1).write.mode("append").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        found = D.read_lines(spark, f"{path}/*.txt")
        assert found.rdd.getNumPartitions() > 1
        got = pd.DataFrame([r.asDict() for r in found.collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for _, own in got.groupby("file"):
        own = own.sort_values("line_number")
        assert own["line_number"].tolist() == list(range(len(own)))
        assert own["line"].tolist() == (rows if len(own) == 5000 else ["z"] * 3)


def test_bad_lines_count_and_unchanged_texts_are_marked(spark):
    path = scratch(spark, "shard")
    lines = ['{"id": "a", "text": "x 1"}', "none", "", "null", '{"id": "b", "text": "y"}', '{"id": "c"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.option("compression", "gzip").text(f"{path}/documents")
    found = D.read_with_origin(spark, path, pattern="*.gz")
    marked = D.with_text(found, F.regexp_replace("text", "1", "2")).orderBy("line_number").collect()
    assert [(r["id"], r["line_number"], r["text"], r["unchanged"]) for r in marked] == [("a", 0, "x 2", False), ("b", 4, "y", True), ("c", 5, None, True)]


# cuts and numbers


def sequential(sizes, most, held=0):
    cuts, shard = [], 0
    for k, n in enumerate(sizes):
        held += n
        if held >= most:
            shard, held = shard + 1, 0
            cuts.append(k)
    return cuts, shard, held


def test_steps_of_blocks_chain_to_those_of_all_rows():
    rng = random.Random(1)
    for _ in range(400):
        most = rng.choice([1, 2, 5, 10, 20, 100])
        blocks = [np.array([rng.choice([0, 1, 2, 3, 5, 9, 30]) for _ in range(rng.randint(1, 12))], np.int64) for _ in range(3)]
        steps = [layout.cut_steps(b, most) for b in blocks]
        chain = layout.chained(layout.chained(steps[0], steps[1], most), steps[2], most)
        for held in range(most):
            assert layout._step(steps[0], held) == sequential(blocks[0], most, held)[1:]
            assert layout.greedy_cuts(blocks[0], most, held).tolist() == sequential(blocks[0], most, held)[0]
            assert layout._step(chain, held) == sequential(np.concatenate(blocks), most, held)[1:]


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_greedy_cuts_over_many_blocks(spark, monkeypatch, broadcast):
    for name, value in (("CUT_ROWS", 25), ("WALKED", 4), ("BROADCAST_CUTS", broadcast)):
        monkeypatch.setattr(layout, name, value)
    rng = random.Random(3)
    rows = [(k, rng.choice([0, 1, 5, 10, 60, None]), "x") for k in range(400)]
    df = spark.createDataFrame(rows, "n long, size long, block string").repartition(4)
    got = layout.greedy_shards(df, "n", F.col("size"), 50, 7).orderBy("n").collect()
    shard, held, expected = 7, 0, []
    for _, size, _ in rows:
        held += size or 0
        if held >= 50:
            shard, held = shard + 1, 0
        expected.append(shard)
    assert [r["shard"] for r in got] == expected and got[0]["block"] == "x"
    assert layout.greedy_shards(df.limit(0), "n", F.col("size"), 50).collect() == []


def test_numbers_follow_the_order_over_many_tasks(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice([None, *range(50)]), "y") for _ in range(500)]
    df = spark.createDataFrame(rows, "s string, k int, range string").repartition(7)
    got = layout.numbered(df, ["s", "k"]).orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(500)) and {r["range"] for r in got} == {"y"}
    assert [(r["s"], -1 if r["k"] is None else r["k"]) for r in got] == sorted((s, -1 if k is None else k) for s, k, _ in rows)
    assert layout.numbered(df.limit(0), ["s"]).collect() == []


def test_budget_of_names_that_clash(spark):
    df = spark.createDataFrame([(k, 2, 1, 1) for k in range(10)], "b long, n long, _size long, row long")
    assert sorted(r["b"] for r in R.within_budget(df, "b", "n", 5).collect()) == [0, 1, 2] and R.within_budget(df, "b", "n", 5).columns == df.columns


def test_columns_of_any_name_pass_through(spark):
    from lexmill.operators import dedupe

    df = spark.createDataFrame([(1, "a", 3, 1), (1, "b", 2, 2), (2, "c", 1, 3)], "k int, v string, _rn int, place int")
    assert sorted(tuple(r) for r in dedupe.keep_first(df, ["k"], ["_rn"]).collect()) == [(1, "b", 2, 2), (2, "c", 1, 3)]
    assert sorted(tuple(r) for r in R.best_by_rank(df, "k", F.col("place"), "v").collect()) == [(1, "a", 3, 1), (2, "c", 1, 3)]
    index = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "k int, v string, _new int")
    assert sorted(tuple(r)[:2] for r in R.upsert(index, spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string"), "k", "v").collect()) == [(1, "a"), (2, "x"), (3, "y")]

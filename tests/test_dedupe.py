"""n-grams as numbers, their state across runs and batches, what they cut; patterns that cost the length of the text."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import dedupe, grams, taggers
from lexmill.operators.bloom import BloomSpec, BloomState, bits_of, either
from lexmill.plans import dedupes
from lexmill.session import scratch
from lexmill.streaming.ngrams import judged

WORDS = ["a", "b", "c", "é", "dd", "😀"]
SPACES = [" ", "\n", "\t ", "  ", "\x0b"]


def some_texts(seed, n=40, most=30):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(WORDS) + rng.choice(SPACES) for _ in range(rng.randint(0, most))) for _ in range(n)]
    return [None, "", " \n", *texts, texts[0], texts[1] + "x"]


def split(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]


def brute_overlap(rows, n, known=()):
    """By hand, document after document in order of the ids."""
    own = {}
    for i, text in rows:
        words = split(text)
        own.setdefault(i, []).extend(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    first = {}
    for i in sorted(own):
        for g in own[i]:
            first.setdefault(g, i)
    return {i: (len(gs), sum(first[g] < i or g in known for g in gs) / len(gs)) for i, gs in own.items() if gs}


@pytest.mark.parametrize("held", [10, 1 << 21])
def test_overlap_is_that_of_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(grams, "HELD", held)  # tasks run in other processes only where they are not forked from here
    rows = list(enumerate(some_texts(1))) + [(3, "a b c a b c")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, gram string").repartition(3)
    got = {r["doc_id"]: (r["n_ngrams"], round(r["overlap"], 12)) for r in dedupe.ngram_overlap(df, 3).collect()}
    expected = {i: (n, round(o, 12)) for i, (n, o) in brute_overlap(rows, 3).items()}
    assert got == expected
    assert got == {r["doc_id"]: (r["n_ngrams"], round(r["overlap"], 12)) for r in dedupe.ngram_overlap(df, 3, exact=True).collect()}
    assert dedupe.ngram_overlap(df.limit(0), 3).collect() == []
    names = spark.createDataFrame([(f"n{i:03}", t) for i, t in rows], "name string, body string")
    assert {r["name"]: (r["n_ngrams"], round(r["overlap"], 12)) for r in dedupe.ngram_overlap(names, 3, "name", "body").collect()} == {f"n{i:03}": v for i, v in expected.items()}


def test_tasks_send_an_ngram_once_however_many_texts_have_it(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two three "), F.col("id").cast("string")).alias("text")).coalesce(1)
    rows = grams.gram_rows(df, 3).collect()
    assert sum(r["n_ngrams"] for r in rows) == 2000 and sum(r["met"] for r in rows) == 999
    assert Counter(r["gram"] for r in rows).most_common(1)[0][1] == 1 and len(rows) == 1001


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab é\n", max_size=40), max_size=6), st.integers(1, 4), st.booleans(), st.integers(1, 64))
def test_numbers_of_ngrams_are_equal_where_their_words_are(texts, n, by_line, size):
    before, grams.SLICE = grams.SLICE, size
    try:
        text, line, number, start, end = grams.grams_of_batch(pa.array(texts, pa.string()), n, by_line)
    finally:
        grams.SLICE = before
    expected = []
    for i, t in enumerate(texts):
        for k, part in enumerate(t.split("\n") if by_line else [t]):
            words = split(part)
            expected += [(i, k, tuple(words[j : j + n])) for j in range(len(words) - n + 1)]
    assert [(i, k) for i, k, _ in expected] == list(zip(text.tolist(), line.tolist()))
    for (i, _, own), a, z in zip(expected, start, end):
        assert tuple(split(texts[i].encode()[a:z].decode())) == own
    assert len(set(number.tolist())) == len({g for *_, g in expected})


def test_paragraphs_of_repeated_documents(spark):
    text = "a b c d\nx y z\n\na b c d"
    df = spark.createDataFrame([(1, text), (2, "q\nx y z"), (3, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["paragraph"]): r["overlap"] for r in dedupe.paragraph_overlap(df, 3).collect()}
    assert got == {(1, 0): 0.0, (1, 1): 0.0, (1, 3): 1.0, (2, 1): 1.0}


# Bloom states


def test_filters_keep_their_rate_and_miss_nothing(spark):
    spec = BloomSpec(50_000, 0.02)
    assert abs(spec.expected_rate() - 0.02) < 0.0005 and spec.words * 64 < 14 * 50_000
    added = spark.range(50_000).select(F.xxhash64("id").alias("gram"))
    other = spark.range(50_000, 150_000).select(F.xxhash64("id").alias("gram"))
    bits = bits_of(added, spec)
    found = lambda rows: dedupe._seen(rows.select("gram", F.lit(1).alias("many"), F.col("gram").alias("id"), F.lit(0).alias("line")), bits=bits, spec=spec).filter("seen").count()
    assert found(added) == 50_000
    assert 0.01 < found(other) / 100_000 < 0.04
    with pytest.raises(ValueError):
        BloomSpec(10, 1.5)


@pytest.mark.parametrize("rate", [0.3, 0.01, 1e-4, 1e-6])
def test_shapes_for_any_rate(rate):
    spec = BloomSpec(1_000_000, rate)
    assert spec.expected_rate() <= rate * 1.0001 and spec.expected_rate(100) < spec.expected_rate()


def test_two_runs_make_the_state_of_one(spark):
    rows = list(enumerate(some_texts(4, 60)))
    spec = BloomSpec(5_000, 0.001)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = BloomState(spark, scratch(spark, "one"), spec), BloomState(spark, scratch(spark, "two"), spec)
    whole = {r["doc_id"]: r["overlap"] for r in dedupe.bloom_overlap(df, one, 4).collect()}
    first = {r["doc_id"]: r["overlap"] for r in dedupe.bloom_overlap(df.filter("doc_id < 30"), two, 4).collect()}
    looked = {r["doc_id"]: r["overlap"] for r in dedupe.bloom_overlap(df.filter("doc_id >= 30"), two, 4, read_only=True).collect()}
    second = {r["doc_id"]: r["overlap"] for r in dedupe.bloom_overlap(df.filter("doc_id >= 30"), two, 4).collect()}
    assert looked == second and {**first, **second} == whole
    state = lambda s: {(r["word"], r["bits"]) for r in s.bits().collect()}
    assert state(one) == state(two) and 0 < one.filled() < 0.2
    exact = brute_overlap(rows, 4)
    assert all(whole[i] >= o - 1e-12 for i, (_, o) in exact.items()) and sum(whole[i] > o + 1e-12 for i, (_, o) in exact.items()) <= 2
    with pytest.raises(ValueError):
        BloomState(spark, two.path, BloomSpec(5_000, 0.002))


def test_a_run_that_failed_leaves_the_state(spark):
    state = BloomState(spark, scratch(spark, "state"), BloomSpec(100, 0.01))
    rows = spark.range(50).select(F.xxhash64("id").alias("gram"))
    state.add(rows)
    before = state.bits().collect()
    spark.range(3).selectExpr("id AS word", "id AS bits").write.parquet(f"{state.path}/version=000001/bits")  # no spec: it did not end
    assert state.bits().collect() == before
    for _ in range(3):
        state.add(rows)
    assert {tuple(r) for r in state.bits().collect()} == {tuple(r) for r in before} and len(state._versions()) == 2
    assert either(state.bits(), state.bits()).count() == len(before)


# what is cut


def brute_spans(rows, n):
    first, own = {}, {}
    for i, text in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
        words = [m.span() for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text)]
        own[i] = [(tuple(text[a:z] for a, z in words[k : k + n]), words[k][0], words[k + n - 1][1]) for k in range(len(words) - n + 1)]
        for g, *_ in own[i]:
            first.setdefault(g, i)
    out = {}
    for i, gs in own.items():
        spans = []
        for g, a, z in gs:
            if first[g] < i:
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = z
                else:
                    spans.append([a, z])
        if spans:
            out[i] = spans
    return out


def test_overlapping_ngrams_are_joined_to_spans(spark):
    rows = list(enumerate(some_texts(6, 60, 60)))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string").repartition(4)
    got = {r["doc_id"]: [[s["start"], s["end"]] for s in r["spans"]] for r in dedupe.overlap_spans(df, 4).collect()}
    assert got == brute_spans(rows, 4) and len(got) > 5


def test_repeated_passages_go_from_the_tables(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    spans, expected = brute_spans(rows, 20), {}
    for i, text in rows:
        own = spans.get(i, [])
        if sum(z - a for a, z in own) / max(len(text), 1) < 0.9:
            for a, z in reversed(own):
                text = text[:a] + text[z:]
            expected[i] = text
    assert {r["doc_id"]: r["text"] for r in dedupes.repeated_passages_removed(spark, sf_dir).collect()} == expected and spans


def test_batches_of_a_stream_are_judged_by_state_and_order():
    rows = pd.DataFrame({"id": [5, 7, 7, 9], "gram": [1, 1, 2, 0], "held": [True, True, True, False], "many": [2, 1, 3, 0], "n_ngrams": [2, 4, 0, 6], "met": [0, 1, 0, 6]})
    got = judged(rows, np.array([2])).set_index("id")
    assert got["n_ngrams"].to_dict() == {5: 2, 7: 4, 9: 6} and got["met"].to_dict() == {5: 0, 7: 5, 9: 6}


# patterns


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b1", "@", ".", "-", "co", "x.y", "@@", "com", "_", "%", " ", "é", ".c", "1"]), max_size=14))
def test_emails_are_the_matches_of_the_pattern(parts):
    text = "".join(parts)
    assert taggers.email_spans(text) == [m.span() for m in re.finditer(taggers.PII["EMAIL_ADDRESS"], text)]


LONG = {"letters": "a" * 1_000_000, "dots": "." * 1_000_000, "labels": "a@b" + ".c" * 500_000, "ats": "a@" * 500_000, "digits": "a@b" + ".11" * 300_000, "blanks": "x" + " " * 1_000_000 + "x", "lists": "- a\n" * 250_000 + "end", "dashes": "- " * 500_000, "feeds": "\n" * 1_000_000}


def test_patterns_cost_the_length_of_a_text(spark):
    df = spark.createDataFrame(list(LONG.items()), "name string, text string")
    start = time.time()
    got = {r["name"]: r for r in df.select("name", F.size(taggers.tagger("pii_EMAIL_ADDRESS")(F.col("text"))).alias("emails"), F.length(X.strip(F.col("text"))).alias("stripped"), F.length(X.strip(F.col("text"), X.UNICODE_SPACE)).alias("unicode"), X.without_leading_list(F.col("text")).alias("rest")).collect()}
    assert time.time() - start < 60
    assert got["labels"]["emails"] == 0 and got["blanks"]["stripped"] == got["blanks"]["unicode"] == 1_000_002 and got["feeds"]["stripped"] == 0
    assert got["lists"]["rest"] == "end" and got["letters"]["rest"] == LONG["letters"]


def test_stripped_texts(spark):
    texts = ["", " ", " a b ", "\n\x0b a\t", "a", "\xa0a\xa0", None, " \x1f "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.strip(F.col("t"))).collect()] == [None if t is None else t.strip(" \t\n\x0b\f\r") for t in texts]
    assert [r[0] for r in df.select(X.strip(F.col("t"), X.UNICODE_SPACE)).collect()][:6] == ["", "", "a b", "a", "a", "a"]


def test_taggers_of_a_query_end_with_it():
    before = taggers.names()
    with taggers.registered(own_tagger=lambda t: t, pii_EMAIL_ADDRESS=lambda t: t):
        assert "own_tagger" in taggers.names()
    assert taggers.names() == before and taggers.tagger("pii_EMAIL_ADDRESS") is taggers.emails

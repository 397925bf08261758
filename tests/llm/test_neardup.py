from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import words
from lexmill.llm.components import components
from lexmill.llm.neardup import COORDINATES, LOSS, least_agreed, near_duplicates, signature_form
from lexmill.llm.stages import drop_near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(*[own[k:] for k in range(width)])) if len(own) >= width else frozenset([tuple(own)] if own else [])


def brute(rows, width, percent=80):
    sets = [(i, shingles(t, width)) for i, t in rows]
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                label[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        least[find(k)].append(i)
    return sorted((i, len(s), min([x for x in least[find(k)] if x is not None], default=i)) for k, (i, s) in enumerate(sets))


def made(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((3, 12, 60, 200)))] for _ in range(12)]
    rows = []
    for k in range(n):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, len(own) // 8)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        rows.append((k, " ".join(own)))
    return rows


ODD = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE "), (1005, "a b"), (1006, "A\tB"), (1007, "x" * 100_000), (1008, "x" * 100_000 + "  "), (1009, "é É"), (1010, "É É")]


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("seed", [1])
def test_same_as_all_pairs(spark, width, seed):
    rows = made(seed) + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("node", F.lit(None).cast("string"))
    got = near_duplicates(df, width, 80).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, width)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_large_group_and_repeated_rows(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(300):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(120)] = f"v{rng.randrange(1000)}"
        rows.append((k, " ".join(own)))
    rows += rows[:5] + [(900 + k, " ".join(base)) for k in range(100)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 2, 80)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute(rows, 2)


def test_exact_form_at_a_lower_similarity(spark):
    rows = made(2, 40) + ODD
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 40, exact=True)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute(rows, 2, 40)


def pairs_of(similarity, n, seed, size=120):
    """n pairs of texts of the given similarity in words, apart from all others."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        shared = round(2 * size * similarity / (1 + similarity))
        own = [f"p{k}x{j}" for j in range(2 * size - shared)]
        a, b = own[:size], own[:shared] + own[size:]
        rng.shuffle(a)
        rng.shuffle(b)
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    return rows


def test_thresholds_follow_the_similarity(spark):
    assert least_agreed(48, 0.512) == 9 and least_agreed(10, 1.0) == 10 and least_agreed(10, 0.0) == 0
    for percent in (40, 60, 80, 95, 100):
        minima, matches, _ = signature_form(percent)
        assert matches == least_agreed(COORDINATES, (percent / 100) ** minima, LOSS) >= 5
    with pytest.raises(ValueError):
        signature_form(10)
    rows = pairs_of(0.56, 40, 1)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 50).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_null_ids_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (None, "q r"), (None, None)], "doc_id long, text string")
    got = sorted(map(str, [(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(df, 2).collect()]))
    assert got == sorted(map(str, [(None, 5, False), (5, 5, True), (None, None, True), (None, None, True)]))
    assert near_duplicates(df.limit(0), 2).collect() == []


def test_stage_keeps_one_of_each_group(spark):
    rows = made(5)
    docs = spark.createDataFrame([(i, t, "en", 88, 6, None, -1) for i, t in rows], "doc_id long, text string, kept string, _word int, _bit int, _gone string, row long")
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({c for _, _, c in brute(rows, 5)})
    assert {tuple(r)[2:] for r in out.collect()} == {("en", 88, 6, None, -1)}


def test_hashes_of_words_do_not_depend_on_their_place():
    texts = [b"ab cd", b"cd  ab", b"abcd", b"x" * 5000 + b" ab"]
    found = {}
    for t in texts:
        data = np.frombuffer(t, np.uint8)
        for a, z, h in zip(*words.word_hashes(data, words.SPACED)):
            assert found.setdefault(t[a:z], h) == h
    assert len(set(found.values())) == len(found) == 4


def test_components_of_a_long_path(spark):
    rng = random.Random(7)
    ids = list(range(200))
    rng.shuffle(ids)
    links = [(ids[k], ids[k + 1]) for k in range(150)] + [(ids[160], ids[161]), (ids[170], ids[170])]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert {got[i] for i in ids[:151]} == {min(ids[:151])} and got[ids[160]] == min(ids[160:162]) and ids[170] not in got
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []

"""Sharding, URL rules, vectors, packing and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm.hnsw import Graph, audited_near_vectors, matrix, near_vectors, unit
from lexmill.llm.packing import Capacity, pack, plan, scores
from lexmill.llm.queries import ORACLE_SQL, QUERIES, RULES, vocabulary
from lexmill.llm.sharding import interleave
from lexmill.llm.urlrules import UrlRule, judge_urls, token_index

# sharding


def test_shards_match_the_mixture(spark):
    rng = random.Random(1)
    rows = [(k, "é" * rng.randint(0, 5) if k % 7 else None, None if k % 50 == 0 else ("hot" if k % 3 else f"s{k % 4}"), "x") for k in range(1000)]
    df = spark.createDataFrame(rows + rows[:10], "doc_id long, text string, source string, shard string")
    got = interleave(df.repartition(5), 7).collect()
    assert len(got) == 1010
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r)
        text = dict((i, t) for i, t, _, _ in rows)[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 16 and r["text_crc32"] == zlib.crc32(text.encode())
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1 and len(by_shard) == 7
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by_shard.values())
    total = Counter(r["source"] for r in got)
    for v in by_shard.values():
        for s, n in Counter(r["source"] for r in v).items():
            assert abs(n - total[s] / 7) <= 2
    again = interleave(df.repartition(2), 7)
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in again.collect()) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in got)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(None, None, None), (1, "a", "s")], "doc_id long, text string, source string")
    assert sorted(r["slot"] for r in interleave(df, 40).collect()) == [0, 0]
    assert interleave(df.limit(0), 40).collect() == []


# URL rules

URLS = ["http://a.example.org/es/x", "https://EXAMPLE.org/en/1", "https://example.org/en/12?q", "http://notexample.org/en/2", "http://x.com/de/", "http://x.com/fr/a#b", "http://org", "http://org/", "x.org/", None, "", "a://b.org/?://c.com/de/", "http://example.org/es", "http://u@h.org:80/p"]


def brute(url, rules=RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.name), r.name), default=None)
    return host, path, best.name if best else None, best.action if best else "allow"


@pytest.mark.parametrize("most", [1000, 0])
def test_verdicts(spark, most):
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(URLS + URLS[:2])], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, RULES, literal_rules=most).collect()}
    assert got == {k: brute(u) for k, u in enumerate(URLS + URLS[:2])}


@pytest.mark.parametrize("most", [1000, 0])
def test_many_rules(spark, most):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "cc", "d-d", "e"])
    rules = [UrlRule(rng.choice(["allow", "block"]), ".".join(word() for _ in range(rng.randint(1, 3))), "/" + "".join(word() + "/" for _ in range(rng.randint(0, 2))) + rng.choice(["", word()])) for _ in range(60)]
    rules = list({r.name: r for r in rules}.values())
    urls = ["http://" + ".".join(word() for _ in range(rng.randint(1, 4))) + "/" + "/".join(word() for _ in range(rng.randint(0, 4))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, rules, literal_rules=most).collect()}
    assert got == {k: brute(u, rules) for k, u in enumerate(urls)}


def test_index_uses_the_rarest_token_and_rules_may_be_patterns(spark):
    _, index = token_index(RULES)
    assert "p:es" in index and "h:example" not in index
    rules = [UrlRule("block", "x.org", "/a/", r"\d+$")]
    df = spark.createDataFrame([(1, "http://x.org/a/12"), (2, "http://x.org/a/b")], "page_id long, url string")
    assert [r["verdict"] for r in judge_urls(df, rules).orderBy("page_id").collect()] == ["block", "allow"]
    assert [r["rule"] for r in judge_urls(df, []).collect()] == [None, None]


# vectors


def vectors(seed, n=400, groups=6, size=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, size))
    x = rng.normal(size=(n, size))
    hot = rng.integers(0, groups, n)
    near = rng.random(n) < 0.6
    x[near] = centres[hot[near]] + 0.28 * rng.normal(size=(near.sum(), size))
    return x.astype(np.float32)


def links(x, ids):
    y = unit(x.astype(np.float64))
    near = (y @ y.T >= 0.9) & ~np.eye(len(y), dtype=bool)
    label = list(range(len(y)))
    changed = True
    while changed:
        new = [min([label[k], *(label[j] for j in np.flatnonzero(near[k]))]) for k in range(len(y))]
        changed, label = new != label, new
    least = {}
    for k, c in enumerate(label):
        least[c] = min(least.get(c, ids[k]), ids[k])
    return sorted((ids[k], int(near[k].sum()), least[label[k]]) for k in range(len(y)))


def test_vectors_same_as_all_pairs(spark):
    x = vectors(1)
    x = np.concatenate([x, x[:30], 2 * x[30:35]])
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x)]
    odd = [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 64, 1), (9003, [float("nan")] * 64, 1), (9004, [None] + [1.0] * 63, 1), (9005, [float("inf")] * 64, 1), (9006, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("uid", F.lit("clash"))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in near_vectors(df, shards=3).collect())
    assert got == sorted(links(x, list(range(len(x)))) + [(i, 0, i) for i, _, _ in odd])


def test_repeated_ids_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(df).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert near_vectors(df.limit(0)).collect() == []


def recall(graph, queries, threshold, width):
    q, n = graph.within(queries, threshold, width)
    true = queries @ graph.x.T >= threshold
    got = np.zeros_like(true)
    got[q, n] = True
    return (got & true).sum() / max(1, true.sum())


def test_audits_hold_true_hits_and_widen():
    rng = np.random.default_rng(3)
    x = unit(rng.normal(size=(3000, 64)))  # no vector has a partner
    g = Graph(x)
    planted = g.planted(0.9)
    cosines = planted @ g.x.T
    assert ((cosines >= 0.9).sum(axis=1) >= 1).all() and cosines.max() < 0.91
    width, mean, telling = g.audit(planted, np.full(len(planted), -1), 0.9, 2)
    assert telling == len(planted) and width > 2 and mean >= 0.999
    assert recall(g, planted, 0.9, width) >= 0.999
    own = np.arange(100)
    assert g.audit(x[:100].astype(np.float32), own, 0.9, 4)[2] == 0  # a query's own vector is no hit


def test_few_links_beside_a_hot_group():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=64)
    hot, rest = centre + 0.1 * rng.normal(size=(1000, 64)), rng.normal(size=(2000, 64))
    rest[1000:] = rest[:1000] + 0.3 * rng.normal(size=(1000, 64))
    x = unit(np.concatenate([hot, rest]))
    g = Graph(x)
    width, mean, _ = g.audit(np.concatenate([g.planted(0.9), x[::6].astype(np.float32)]), np.r_[np.full(256, -1), np.arange(0, 3000, 6)], 0.9, 8)
    assert mean >= 0.999 and recall(g, x[1000:].astype(np.float32), 0.9, width) >= 0.999


def test_dense_search_of_a_wide_group():
    x = unit(np.random.default_rng(5).normal(size=(700, 8)))
    g = Graph(x)
    q, n = g.dense(x[:20].astype(np.float32), 0.5)
    assert set(zip(q.tolist(), n.tolist())) == {(a, b) for a, b in zip(*np.nonzero(x[:20].astype(np.float32) @ g.x.T >= 0.5))}
    assert recall(g, x[:50].astype(np.float32), -1.0, 16) == 1.0


def test_every_shard_is_audited(spark):
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors(2))], "vec_id long, embedding array<float>")
    result, audits = audited_near_vectors(df, shards=3)
    rows = audits.collect()
    assert sorted(r["shard"] for r in rows) == [0, 1, 2] and all(r["recall"] >= 0.999 and r["queries"] >= 100 for r in rows)
    assert result.count() == 400


def test_matrix():
    import pyarrow as pa

    assert matrix(pa.array([[1.0, 2.0], [3.0, 4.0]]).slice(1)).tolist() == [[3.0, 4.0]]


# packing


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plans_keep_every_capacity(rule):
    rng = random.Random(5)
    for _ in range(100):
        capacity = Capacity(tokens=rng.choice([8, 16, 50]), documents=rng.choice([2, 4, 50]), cost=rng.choice([100, 3000]), rule=rule)
        most = min(capacity.tokens, int(capacity.cost**0.5))
        counts = {rng.randint(1, most): rng.randint(1, 60) for _ in range(rng.randint(0, 12))}
        runs, n = plan(counts, capacity)
        bins, seen = defaultdict(list), Counter()
        for length, rank, pieces, first, offset, copies in runs:
            for k in range(pieces):
                bins[first + k // copies].append((offset + k % copies * length, length))
                seen[length, rank + k] += 1
        assert seen == Counter({(length, k): 1 for length, c in counts.items() for k in range(c)})
        assert sorted(bins) == list(range(n))
        for v in bins.values():
            end = 0
            for at, length in sorted(v):
                assert at == end
                end += length
            assert end <= capacity.tokens and len(v) <= capacity.documents and sum(x * x for _, x in v) <= capacity.cost


def one_by_one(counts, capacity):
    """Every piece by itself: the contents of the bins."""
    tops, weights = np.array([capacity.tokens, capacity.documents, capacity.cost], np.int64), np.array(capacity.weights)
    bins = []
    for n in sorted(counts, reverse=True):
        need = np.array([n, 1, n * n], np.int64)
        for _ in range(counts[n]):
            fits = [(float(scores(left[None], need, tops, weights, capacity.rule)[0]), tuple(left), k) for k, (left, _) in enumerate(bins) if (left >= need).all()]
            if not fits:
                bins.append([tops.copy(), []])
            k = min(fits)[2] if fits else len(bins) - 1
            bins[k][0] = bins[k][0] - need
            bins[k][1].append(n)
    return sorted(sorted(x) for _, x in bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plans_place_as_piece_by_piece(rule):
    rng = random.Random(18)
    for _ in range(150):
        capacity = Capacity(tokens=rng.choice([8, 16, 50]), documents=rng.choice([2, 4, 50]), cost=rng.choice([64, 300, 3000]), rule=rule, weights=rng.choice([(1.0, 0.01, 0.01), (1.0, 1.0, 1.0), (0.2, 1.0, 0.7)]))
        most = min(capacity.tokens, int(capacity.cost**0.5))
        counts = {rng.randint(1, most): rng.randint(1, 40) for _ in range(rng.randint(0, 10))}
        bins = defaultdict(list)
        for length, _, pieces, first, _, copies in plan(counts, capacity)[0]:
            for k in range(pieces):
                bins[first + k // copies].append(length)
        assert sorted(sorted(x) for x in bins.values()) == one_by_one(counts, capacity)


def test_bounds_that_bind(spark, sf_dir):
    pytest.importorskip("public_tokenizers")
    from lexmill.llm.queries import BOUNDED, packing_bounded

    bins = defaultdict(list)
    for r in packing_bounded(spark, sf_dir).collect():
        bins[r["sequence_id"]].append(r["length"])
    full = [sum(v) == 1024 for v in bins.values()], [len(v) == BOUNDED.documents for v in bins.values()], [sum(x * x for x in v) > 0.9 * BOUNDED.cost for v in bins.values()]
    assert all(sum(v) <= 1024 and len(v) <= BOUNDED.documents and sum(x * x for x in v) <= BOUNDED.cost and max(v) <= BOUNDED.piece for v in bins.values())
    assert all(any(x) for x in full)


def test_packing_is_tight():
    rng = np.random.default_rng(6)
    counts = Counter(np.clip(rng.lognormal(5, 1, 50_000), 1, 1024).astype(int).tolist())
    _, n = plan(counts, Capacity())
    assert n <= 1.002 * -(-sum(k * c for k, c in counts.items()) // 1024)


def test_pieces_are_the_librarys_ids(spark):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [None, "", "a b c", "word " * 3000, "<|endoftext|> x", "é😀" * 700, "z" * 60_000, "a b c"]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, length string")
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in pack(df, path).collect():
        by_doc[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for k, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(by_doc[k], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 1024 for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    for v in bins.values():
        end = 0
        for r in sorted(v, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 1024
    assert pack(df.limit(0), path).collect() == []


# queries and pipeline


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names and set(ORACLE_SQL) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_sql_of_the_queries(spark, sf_dir):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "clients", "vendors"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        mine, other = QUERIES[name](spark, sf_dir), c.sql(sql)
        order = sorted(mine.columns)
        key = lambda rows, columns: sorted(repr([r[columns.index(x)] for x in order]) for r in rows)
        assert order == sorted(other.columns)
        assert key([tuple(r) for r in mine.collect()], mine.columns) == key(other.fetchall(), other.columns), name


def test_pipeline(spark, sf_dir):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "pii", "packing"]
    out = P.run(spark, sf_dir)
    kept = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < docs.count()
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as P

    rng = random.Random(21)
    calm = [f"w{k}x" for k in range(300)]
    texts = {k: " ".join(rng.choice(calm) for _ in range(30)) + (" vile nasty vile." if k % 4 == 0 else ".") for k in range(60)}
    copy = " ".join(rng.choice(calm) for _ in range(80))
    odd = [(100, None), (101, ""), (102, copy), (103, copy), (104, copy + " more"), (105, "mail a@b.org now " + " ".join(calm[:40])), (106, "z " * 5000), (None, "no id " + " ".join(calm[50:90]))]
    rows = [*texts.items(), *odd, (105, odd[5][1])]
    extra = {"_word": 88, "_bit": 6, "_gone": 1, "_own_pii": 2, "pii": 3, "toxicity": 4, "toxic_sentences": 5, "kept": 6, "row": 7, "gone": 8, "id": 9, "length": 10}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in extra.items()}).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, int(k % 4 == 0)) for k in texts], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen = docs
    for name, stage in P.STAGES[:-1]:
        seen = stage(spark, seen, str(tmp_path))
        assert seen.columns == docs.columns, name
        assert {tuple(r[k] for k in extra) for r in seen.collect()} == {tuple(extra.values())}, name
    kept = [(r["doc_id"], r["text"]) for r in seen.collect()]
    ids = Counter(i for i, _ in kept)
    assert not {k for k in texts if k % 4 == 0} & set(ids) and ids[102] == 1 and not {103, 104} & set(ids)
    assert {100, 101, 106, None} <= set(ids) and ids[105] == 2 and all("<EMAIL>" in t for i, t in kept if i == 105)
    out = P.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in out if r["piece"] == 0) == ids and [r["length"] for r in out if r["doc_id"] == 100] == [1]
    for table in ("documents", "labels"):
        spark.read.parquet(str(tmp_path / f"{table}.parquet")).limit(0).write.parquet(str(tmp_path / "none" / f"{table}.parquet"))
    assert P.run(spark, str(tmp_path / "none")).collect() == []


def test_operators_on_empty_tables(spark):
    pytest.importorskip("public_tokenizers")
    from lexmill.llm import bpe, media, pii, stages, tokens

    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert media.payload_digest(docs).collect() == [] and pii.pii_digest(docs).collect() == []
    assert bpe.bpe_digest(docs, vocabulary("word_bpe_49k.json")).collect() == [] and tokens.section_tokens(docs, vocabulary("byte_bpe_50k.json")).collect() == []
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []
    assert stages.redact_pii(docs).collect() == [] and stages.drop_near_duplicates(docs).collect() == []

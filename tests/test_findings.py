"""Cases that a review found: each test failed before its change."""

from __future__ import annotations

import gzip

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from lexmill import plans
from lexmill.operators import dedupe, models, taggers
from lexmill.operators.grams import gram_rows
from lexmill.sources import ingest


def test_every_order_is_on_the_skip_list(spark, tmp_path):
    customers = spark.range(1, 7).withColumnRenamed("id", "c_custkey")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(1, 1, "1-URGENT"), (2, 2, "5-LOW"), (3, 4, "3-MEDIUM"), (4, 4, "1-URGENT")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    found = plans.queries()["anti_join_skip_list"](spark, str(tmp_path)).collect()
    assert sorted(r["c_custkey"] for r in found) == [3, 5, 6]


def test_web_archives_of_any_length_before_a_record(spark, tmp_path):
    """Requests end in an empty line, as records do: wherever a reader's buffer ends among them, no page is lost."""

    def record(kind: str, url: str, body: bytes) -> bytes:
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    for k in range(10, 30):
        # buffers are a power of two: the request ends around one
        ask = record("request", f"http://x/{k}", b"GET / HTTP/1.1\r\n")
        lead = record("response", f"http://y/{k}", http + b"x" * 60000)
        lead = record("response", f"http://y/{k}", http + b"x" * (60000 + 65536 - len(lead) - len(ask) + k - 20))
        raw = lead + ask + record("response", f"http://x/{k}", http + b"page")
        (tmp_path / f"{k}.warc").write_bytes(raw)
        (tmp_path / f"{k}.warc.gz").write_bytes(gzip.compress(raw))
    for name in ("*.warc", "*.warc.gz"):
        found = sorted(r["url"] for r in ingest.read_web_archives(spark, str(tmp_path / name)).collect())
        assert found == [f"http://{host}/{k}" for host in "xy" for k in range(10, 30)]


def test_web_archive_records_without_a_length(spark, tmp_path):
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\na\nWARC/1.0 is a format\r\nb"
    raw = b"".join(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/%d\r\n%s\r\n%s\r\n\r\n" % (k, b"Content-Length: %d\r\n" % len(page) if k == 2 else b"", page) for k in range(1, 4))
    (tmp_path / "a.warc").write_bytes(raw)
    found = {r["url"]: r["html"].rstrip() for r in ingest.read_web_archives(spark, str(tmp_path / "a.warc")).collect()}
    assert found == {f"http://x/{k}": "a\nWARC/1.0 is a format\r\nb" for k in (1, 2, 3)}


WORDS = " ".join(["word"] * 30) + " " + "x" * 60


@pytest.mark.parametrize("name", ["mix_and_redact", "tag_filter_size", "dedupe_and_mix"])
def test_kinds_are_redacted_in_turn(name, spark, tmp_path):
    """A telephone number that starts within an address is found first, as the SQL has it."""
    texts = ["63.209.415.555 4588641552771464", "a 63.209.115.155 4588641552771464 b", "1.2.3.4.5.6.7.155 155 4588 9.9.9.9", "155-155-4588@x.org 1.2.3.4"]
    spark.createDataFrame([(k, f"{t} {WORDS}", "en", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = plans.queries()[name](spark, str(tmp_path))
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = c.sql(f"SELECT {', '.join(found.columns)} FROM ({plans.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_grams_are_made_for_a_slice_of_texts(monkeypatch):
    """What a task holds doesn't grow with the batches that it is sent."""
    from lexmill.operators import grams

    monkeypatch.setattr(grams, "TEXTS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["four", "six123", None, "a longer text than ten", ""])], names=["id", "text"])
    parts = list(grams.slices_of(batch))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2], [3], [4]]
    assert grams.HELD <= 1 << 19


def test_tokens_are_made_for_a_slice_of_texts(spark, monkeypatch):
    """A worker gives what it has of a few texts, not of a whole batch; ids and offsets are the library's."""
    from lexmill.operators import grams, tokenize

    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    texts = ["a b", None, "", "é \u4e2d c" * 5]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string").coalesce(1)
    for r in tokenize.decoded(tokenize.encoded(docs, path, bos=1, eos=2), path).collect():
        own = library.encode(r["text"] or "", add_special_tokens=False)
        size = len(r["text"] or "")
        assert r["ids"] == [1, *own.ids, 2]
        assert [tuple(x) for x in r["offsets"]] == [(0, 0), *own.offsets, (size, size)]
        assert r["decoded"] == library.decode([1, *own.ids, 2])
    assert "offsets" not in tokenize.encoded(docs, path, offsets=False).columns
    monkeypatch.setattr(grams, "TEXTS", 8)
    lists = pa.RecordBatch.from_arrays([pa.array([[1], [2, 3], None, [4]], pa.list_(pa.int32()))], names=["ids"])
    assert [len(p) for p in grams.slices_of(lists, 0)] == [1, 2, 1]


def test_a_batch_of_a_stream_is_judged_like_a_plain_loop():
    import random

    import numpy as np
    import pandas as pd

    from lexmill.streaming.ngrams import judged

    draw = random.Random(1)
    rows = pd.DataFrame([(draw.randrange(6), draw.randrange(9), draw.random() < 0.8, draw.randrange(1, 4), draw.randrange(3), draw.randrange(2)) for _ in range(200)], columns=["id", "gram", "held", "many", "n_ngrams", "met"])
    known = {2, 5}
    least = {g: min(r.id for r in rows.itertuples() if r.held and r.gram == g) for g in set(rows[rows.held].gram)}
    want = {i: [0, 0] for i in rows.id}
    for r in rows.itertuples():
        want[r.id][0] += r.n_ngrams
        want[r.id][1] += r.met + (r.many if r.held and (r.gram in known or r.id > least[r.gram]) else 0)
    got = judged(rows, np.array(sorted(known)))
    assert {r.id: [r.n_ngrams, r.met] for r in got.itertuples()} == want


def test_articles_are_put_together_by_the_batch(spark):
    """No frame of its own for every article."""
    from lexmill.sources import files

    rows = [(f"a{k}", m, t) for k in range(30) for m, t in (("main.tex", "\\begin{document}\\input{part} \\input{none}\\end{document}"), ("part.tex", f"p{k}"))]
    found = files.interpolated(spark.createDataFrame([*rows, ("b", "x.tex", None)], "article string, member string, text string"))
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["article"], r["text"]) for r in found.collect()) == sorted((f"a{k}", f"\\begin{{document}}p{k} \\input{{none}}\\end{{document}}") for k in range(30))


def test_xml_files_are_more_where_there_is_more(spark, tmp_path, monkeypatch):
    from lexmill.plans import inputs

    monkeypatch.setattr(inputs, "XML_BYTES", 1000)
    rows = spark.range(400).selectExpr("concat('<row Id=\"', id, '\" Source=\"', repeat('x', 80), '\"/>') AS value", "id AS k")
    inputs._xml_files(rows, f"{tmp_path}/rows", "posts")
    sizes = [f.stat().st_size for f in (tmp_path / "rows").rglob("*.txt")]
    assert len(sizes) > 30 and max(sizes) < 4000
    assert inputs.files.read_attribute_rows(spark, f"{tmp_path}/rows", ["Id"]).count() == 400


def test_repeated_shares_of_many_texts_are_those_of_a_plain_loop():
    import random
    import re
    from collections import Counter

    from lexmill.operators import taggers

    def plain(text: str) -> list[float]:
        own = re.findall(r"[^ \t\n\x0b\f\r]+", text)
        total, out = sum(map(len, own)) or 1, []
        for n in range(2, 5):
            grams = Counter(zip(*[own[k:] for k in range(n)]))
            best = max(((c, sum(map(len, g))) for g, c in grams.items()), default=(0, 0))
            out.append(best[0] * best[1] / total if best[0] > 1 else 0.0)
        for n in range(5, 11):
            grams = Counter(zip(*[own[k:] for k in range(n)]))
            inside = {j for k in range(len(own) - n + 1) if grams[tuple(own[k : k + n])] > 1 for j in range(k, k + n)}
            out.append(sum(len(own[j]) for j in inside) / total)
        return out

    draw = random.Random(2)
    texts = ["", "a", "a a", *(" ".join(draw.choice(("a", "bb", "ccc", "d\u00e9")[: draw.randrange(1, 5)]) for _ in range(draw.randrange(60))) for _ in range(300))]
    texts += [" ".join(f"w{draw.randrange(400)}" for _ in range(50)) + " " + " ".join(["one two three four five six seven eight nine ten eleven"] * draw.randrange(3)) for _ in range(50)]
    assert [s[:-1] for s in taggers.shares_of(texts)] == [plain(t) for t in texts]
    assert taggers.shares_of([]) == []


def test_the_first_run_only_adds_to_the_filter(spark, sf_dir, monkeypatch):
    """Its overlap is not asked for, so that its n-grams are shuffled once, as bits."""
    from lexmill.operators import dedupe

    asked, plain = [], dedupe.bloom_overlap
    monkeypatch.setattr(dedupe, "bloom_overlap", lambda *a, **k: asked.append(k) or plain(*a, **k))
    assert plans.queries()["bloom_dedupe"](spark, sf_dir).count() > 0
    assert asked == [{"read_only": True}]


def test_training_blocks_are_the_features_in_few_bytes():
    """What each step of a model's training reads: the features of the texts, in under four bytes each."""
    texts = ["a b a b a b", "", None, "Der Garten und der Garten", "le jardin " * 50] + [f"text {k} of many words, {k * k}" for k in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array([k % 3 for k in range(len(texts))]), pa.array(texts)], names=["label", "text"])
    text, slot, weight = models.features(batch.column(1))
    wide = np.zeros((len(texts), models.SLOTS))
    wide[text, slot] = weight.astype(np.float32)
    blocks = list(models._blocks(iter([batch, batch]), {0: 0, 1: 1, 2: 2}))
    assert len(blocks) == 1 and blocks[0].num_rows == 1
    assert len(blocks[0].column("texts")[0].as_buffer()) + len(blocks[0].column("weights")[0].as_buffer()) < 4 * 2 * len(text)
    rows = models._Rows(tuple(c[0].as_py() for c in blocks[0].columns))
    by_slot, by_text = np.random.default_rng(1).normal(size=(2, models.SLOTS)), np.random.default_rng(2).normal(size=(2, 2 * len(texts)))
    both = np.r_[wide, wide]
    sums, squares = rows.times(list(by_slot), by_slot[0])
    assert np.allclose(sums, by_slot @ both.T) and np.allclose(squares, both**2 @ by_slot[0])
    out = np.zeros((2, models.SLOTS))
    rows.back(list(by_text), out)
    assert np.allclose(out, by_text @ both) and np.array_equal(rows.met(), np.r_[(both > 0).sum(axis=0), len(both)])


def test_likelihoods_by_a_table_that_is_broadcast_in_part(spark, monkeypatch):
    """Of a large table the likeliest words are broadcast; every word counts as it does with the whole table, and only the others are shuffled."""
    texts = ["", None, "a a b rare new", "b  c\nA", " ", "rare rare new new c", "a", "new"] + ["a b c d"] * 30
    docs = spark.createDataFrame([(k if k != 7 else 6, t) for k, t in enumerate(texts)] + [(None, "a rare")], "doc_id long, text string")
    table = taggers.unigram_table(spark.createDataFrame([("a", "64"), ("b", "32"), ("c", "16"), ("d", "8"), ("rare", "3"), ("other", "3")], "word string, count string"))
    whole = {r["doc_id"]: r["logprob"] for r in taggers.mean_log_probability(docs, table).collect()}
    for most in (0, 1, 3, 5):
        monkeypatch.setattr(taggers, "BROADCAST_WORDS", most)
        found = taggers.mean_log_probability(docs, table)
        assert {r["doc_id"]: r["logprob"] for r in found.collect()} == pytest.approx(whole)
        assert "strategy=broadcast" in found._jdf.queryExecution().toString()


def test_met_ngrams_leave_a_task_as_lists(spark):
    """Shuffled are an id and a number for each n-gram, and one row for all that a text has met in its task."""
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(50))) for k in (3, 1, 2)] + [(4, "w1 w2 w3 w4 x"), (None, "w8 w9 w10 w11"), (5, "a b")], "doc_id long, text string").coalesce(1)
    rows = gram_rows(docs, 4, all_rows=True)
    assert rows.columns == ["id", "gram", "met"]
    found = rows.collect()
    assert sorted(len(r["met"]) for r in found if r["met"] is not None) == [1, 1, 47, 47] and sum(r["met"] is None for r in found) == 48
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in dedupe.overlap_spans(docs, 4).collect()}
    whole = (0, len(" ".join(f"w{j}" for j in range(50))))
    assert spans == {1: [(24, 37)], 2: [whole], 3: [whole], 4: [(0, 11)]}


@pytest.mark.parametrize("name", ["code_filter", "code_line_stats"])
def test_code_statistics_of_odd_texts_are_those_of_the_sql(name, spark, tmp_path):
    """Shares of an empty text are not a number, which is below no threshold; a null text has none, and goes."""
    texts = ["", None, " ", "\n\n", "a", "1", "é", "a b", "ab cd", "--- a", "a" * 1000, "a" * 1001, "\n".join(["a" * 100] * 3), "\n".join(["a" * 101] * 3)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in plans.queries()[name](spark, str(tmp_path)).collect()]
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        wanted = c.execute(plans.oracle_sql()[name]).fetchall()
    assert sorted(map(str, found)) == sorted(map(str, wanted))


def test_a_narrow_beam_finds_vectors_among_many_without_neighbours():
    """Layers are joined by links downwards, so that the beam needn't widen as the shard grows."""
    from lexmill.llm.hnsw import Graph, unit

    x = unit(np.random.default_rng(6).normal(size=(8000, 64)))
    graph = Graph(x)
    planted = graph.planted(0.9)
    width, mean, telling = graph.audit(planted, np.full(len(planted), -1), 0.9, 16)
    assert width == 16 and mean >= 0.999 and telling == len(planted)


def test_tasks_share_the_queries_of_a_shard(spark, monkeypatch):
    from lexmill.llm import hnsw

    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 32))
    x[300:] = x[:300] + 0.05 * rng.normal(size=(300, 32))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    seen = []
    whole = hnsw._search
    monkeypatch.setattr(hnsw, "PART", 100)
    monkeypatch.setattr(hnsw, "_search", lambda *a: seen.append(a[-1]) or whole(*a))
    result, audits = hnsw.audited_near_vectors(df, shards=2)
    assert seen == [2] and sorted(r["shard"] for r in audits.collect()) == [0, 1]
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in result.collect()) == [(k, 1, k % 300) for k in range(600)]


def test_rows_of_a_bucket_leave_a_task_packed(monkeypatch):
    """A row for each bucket, whatever its n-grams; what is unpacked are all rows, totals without an n-gram too."""
    from lexmill.streaming import ngrams

    rng = np.random.default_rng(3)
    n = 5000
    gram = rng.integers(-(1 << 63), (1 << 63) - 1, n)
    rows = pa.table({"id": [f"d{k % 70}" for k in range(n)], "line": pa.array([0] * n, pa.int32()), "gram": pa.array(gram, mask=np.arange(n) % 50 == 0), **{c: rng.integers(0, 9, n) for c in ("many", "n_ngrams", "met")}, "is_met": [False] * n})
    schema = rows.select(list(ngrams.PACKED)).schema
    monkeypatch.setattr(ngrams, "SENT", 3000)
    sent = pa.Table.from_batches(ngrams.packed(iter([*rows.to_batches(max_chunksize=1000), rows.to_batches()[0].slice(0, 0)]), 16))
    assert sent.num_rows == 32
    found = []
    for bucket in range(16):
        part = ngrams.unpacked(sent.filter(pa.compute.equal(sent["bucket"], bucket))["rows"].to_pylist(), schema)
        held = part["gram"][part["held"]].to_numpy()
        assert (held.view(np.uint64) % np.uint64(16) == bucket).all() and (part["gram"][~part["held"]] == 0).all()
        found += [(r.id, r.gram if r.held else None, r.many, r.n_ngrams, r.met) for r in part.itertuples()]
    assert sorted(map(str, found)) == sorted(str(tuple(r.values())) for r in rows.select(list(ngrams.PACKED)).to_pylist())
    assert list(ngrams.packed(iter([]), 16)) == []


@pytest.mark.parametrize("run", [1, 30, 1 << 18])
def test_runs_of_a_state_are_added_merged_and_forgotten(run, monkeypatch):
    """A batch writes its own n-grams only; met is what was met last within the time to live."""
    import random

    import pandas as pd

    from lexmill.streaming import ngrams

    class State(dict):
        def getValue(self, key):
            return self[key]

        def updateValue(self, key, value):
            writes.append(len(value[0]) // 8)
            self[key] = value

        def removeKey(self, key):
            del self[key]

    monkeypatch.setattr(ngrams, "RUN", run)
    monkeypatch.setattr(ngrams, "RUNS", 4)
    state, writes, last, draw = State(), [], {}, random.Random(4)
    schema = pa.schema([("id", pa.int64()), *((c, pa.int64()) for c in ngrams.PACKED[1:])])
    of = ngrams.MetGrams(100, schema)
    of.init(type("Handle", (), {"getMapState": lambda self, *_: state})())
    for number in range(60):
        now = 10 * number + 5
        grams = sorted({draw.randrange(-40, 40) for _ in range(draw.randrange(12))})
        rows = [(number, g, 1, 1, 0) for g in grams] + [(1000, None, 0, 7, 7)]
        payload = pa.RecordBatch.from_pylist([dict(zip(ngrams.PACKED, r)) for r in rows], schema=schema).serialize().to_pybytes()
        writes.clear()
        (found,) = of.handleInputRows((0,), iter([pd.DataFrame({"bucket": [0], "rows": [payload], "now": [now]})]), None)
        met = sum(g in last and last[g] > now - 100 for g in grams)
        want = {1000: (7, 7)} | ({number: (len(grams), met)} if grams else {})
        assert {r.id: (r.n_ngrams, r.met) for r in found.itertuples()} == want
        last |= dict.fromkeys(grams, now)
        assert len(writes) == bool(grams) and (run > 1 or writes in ([], [len(grams)]))
        assert len(state) <= 11


def test_buckets_follow_the_size_of_a_stream():
    from lexmill.streaming import ngrams

    assert ngrams.buckets_for(0) == ngrams.buckets_for(100 << 20) == 256
    assert 6e9 / ngrams.buckets_for(6_000_000_000) <= ngrams.BUCKET_BYTES

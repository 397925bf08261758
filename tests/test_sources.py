from __future__ import annotations

import gzip
import io
import json
import tarfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill import logs, streaming
from lexmill.operators import models, taggers
from lexmill.operators.mix import MixSpec, Replacement, recipe
from lexmill.sources import documents as D
from lexmill.sources import files, ingest


def test_document_shards(spark, tmp_path):
    folder = tmp_path / "v0" / "documents"
    folder.mkdir(parents=True)
    with gzip.open(folder / "00000_a.jsonl.gz", "wt") as f:
        f.write('{"id": 1, "text": "x", "metadata": {"license": "L"}}\nnull\nno json\n{"id": "2", "text": null}\n')
    docs = D.read_documents(spark, str(tmp_path / "v0"))
    assert sorted((r["id"], r["text"]) for r in docs.collect()) == [("1", "x"), ("2", None)]
    assert D.bad_lines(spark, str(tmp_path / "v0")).count() == 2
    assert D.input_path(spark, str(folder / "*.gz")).endswith("*.gz")
    with pytest.raises(ValueError):
        D.input_path(spark, "x", None)


def test_output_path():
    assert D.output_path("a/") == "a/documents" and D.output_path("a/documents/") == "a/documents"


def test_write_in_shards(spark, tmp_path):
    docs = spark.range(10).select("id", F.lit("x" * 50).alias("text"))
    D.write_documents(docs, str(tmp_path / "v1"), "a.jsonl", order="id", shard_bytes=200)
    shards = sorted((tmp_path / "v1" / "documents").glob("shard_file=*"))
    assert len(shards) > 1 and shards[0].name == "shard_file=00000_a.jsonl"
    lines = [line for s in shards for p in s.glob("*.gz") for line in gzip.open(p, "rt")]
    assert len(lines) == 10 and json.loads(lines[0])["text"] == "x" * 50


def test_xml(spark, tmp_path):
    (tmp_path / "Users.xml").write_text('<?xml version="1.0"?><users><row Id="1" DisplayName="Ann"/><row Id="2"/></users>')
    rows = files.read_attribute_rows(spark, str(tmp_path / "Users.xml"), ["Id", "DisplayName"])
    assert sorted(map(tuple, rows.collect())) == [("1", "Ann"), ("2", None)]


def test_texts_and_paths(spark, tmp_path):
    folder = tmp_path / "2004" / "07" / "05"
    folder.mkdir(parents=True)
    (folder / "chat.txt").write_text("a\nb")
    pattern, names = files.CHAT_PATH
    row = files.read_texts(spark, f"{tmp_path}/*/*/*/*.txt").select("text", *files.path_parts(F.col("file"), pattern, names)).first()
    assert tuple(row) == ("a\nb", "2004", "07", "05", "chat")


def test_encodings(spark):
    df = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"\xe9"),), (bytearray(b"\x93q\x94"),)], "b binary")
    assert [r[0] for r in df.select(files.decoded(F.col("b"), "iso-8859-1")).collect()][:2] == ["é", "é"]
    assert [r[0] for r in df.select(files.detected(F.col("b"))).collect()] == ["é", "é", "“q”"]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,t\n1,"a\nb ""c"""\n')
    assert tuple(files.read_table(spark, str(tmp_path / "a.csv")).first()) == ("1", 'a\nb "c"')


def test_nested_pages(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"results": [{"a": 1}, {"a": 2}]}')
    assert [r["a"] for r in files.read_nested_pages(spark, str(tmp_path / "p.json")).collect()] == [1, 2]


def archive(members: dict[str, str]) -> bytearray:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    return bytearray(out.getvalue())


def test_archives_and_interpolation(spark):
    main = r"\begin{document}a \input{part} b\end{document}"
    df = spark.createDataFrame([("x", archive({"main.tex": main, "part.tex": "P", "n.txt": "t"})), ("bad", bytearray(b"zz"))], "file string, content binary")
    members = files.archive_members(df, ".tex")
    assert members.count() == 2
    assert files.archive_members(df, ".txt", only=2).count() == 0
    docs = files.interpolated(members.select(F.col("file").alias("article"), "member", F.col("content").cast("string").alias("text")))
    assert [(r["member"], r["text"]) for r in docs.select("member", files.tex_body(F.col("text")).alias("text")).collect()] == [("main", "a P b")]


def test_fetch(spark):
    def get(url):
        if url == "b":
            raise OSError("gone")
        return url.encode()

    rows = files.fetch_pages(spark.createDataFrame([("a",), ("b",)], "url string"), get, tries=3, wait=0.001).collect()
    assert [(r["content"], r["error"], r["tries"]) for r in rows] == [(bytearray(b"a"), None, 1), (None, "OSError: gone", 3)]


def test_fetch_waits_longer_every_time_and_succeeds_late():
    calls, waits = [], []

    def get(url):
        calls.append(url)
        if len(calls) < 4:
            raise ConnectionError("busy")
        return b"x"

    assert files.fetched(get, "u", 5, 1.0, 2.5, waits.append) == (b"x", None, 4)
    assert len(waits) == 3 and all(0 <= w <= top for w, top in zip(waits, (1, 2, 2.5)))
    with pytest.raises(KeyError):
        files.fetched(lambda u: {}[u], "u", 5, 0, 0)


def test_streams(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    row = lambda k, t: json.dumps({"id": k, "text": t, "ts": "2024-01-01T00:00:00"}) + "\n"
    (source / "1.json").write_text(row("1", "a  b is long") + row("2", "a  b is long") + row("3", "x"))
    schema = spark.createDataFrame([], "id string, text string, ts timestamp").schema

    def run():
        docs = streaming.watch(spark, str(source), schema)
        kept = streaming.mix_stream(docs, MixSpec("q", recipe("q", chars=5, duplicate=False).exclude, replace=(Replacement("double_space", " ", 0.1),)))
        streaming.merge_new(streaming.first_seen(kept), str(out), str(tmp_path / "state")).awaitTermination(60)
        return sorted((r["id"], r["text"]) for r in spark.read.parquet(str(out)).collect())

    assert [t for _, t in run()] == ["a b is long"]
    (source / "2.json").write_text(row("4", "a  b is long") + row("5", "new and long"))
    assert [t for _, t in run()] == ["a b is long", "new and long"]


def test_stream_windows(spark, tmp_path):
    source = tmp_path / "w"
    source.mkdir()
    (source / "1.json").write_text("".join(json.dumps({"ts": f"2024-01-01T0{h}:10:00", "k": "a", "text": "xy"}) + "\n" for h in (0, 0, 5)))
    docs = streaming.watch(spark, str(source), spark.createDataFrame([], "ts timestamp, k string, text string").schema)
    query = streaming.write_stream(streaming.size_by_window(docs, "ts", "k"), str(tmp_path / "wo"), str(tmp_path / "ws"))
    query.awaitTermination(60)
    assert [(r["documents"], r["characters"]) for r in spark.read.parquet(str(tmp_path / "wo")).collect()] in ([(2, 4)], [])


def test_web_archives(spark):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<a href='http://creativecommons.org/licenses/by/4.0'>x</a>"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    other = b"WARC/1.0\r\nWARC-Type: request\r\nContent-Length: 2\r\n\r\nxx\r\n\r\n"
    df = spark.createDataFrame([("f", bytearray(gzip.compress(other) + gzip.compress(record) + gzip.compress(record))), ("g", bytearray(other + record))], "file string, content binary")
    pages = ingest.archive_pages(df)
    assert [r["url"] for r in pages.collect()] == ["http://a/"] * 3
    assert sorted((r["file"], r["license"]) for r in ingest.licensed_pages(pages).collect()) == [("f", "creativecommons.org/licenses/by/4.0"), ("g", "creativecommons.org/licenses/by/4.0")]


def test_unknown_data_set(spark):
    sets = spark.createDataFrame([("a", [("L", "u")], ["en"], "d")], "dataset_id string, licenses array<struct<name:string,url:string>>, languages array<string>, url string")
    with pytest.raises(Exception, match="no such data set"):
        ingest.with_dimensions(spark.createDataFrame([("b",)], "dataset_id string"), sets).collect()


def test_document_formats(spark):
    added = F.lit("2024-01-01")
    page = spark.createDataFrame([("1", "2", "3", "t", "L")], "item_id string, page_id string, page_num string, text string, license string")
    assert ingest.format_pages(page, added).first().asDict(True) == {"id": "2", "text": "t", "source": "scans", "added": "2024-01-01", "created": None, "metadata": {"license": "L", "url": "page/2", "item_id": "1", "page_num": "3"}, "item_id": "1", "page_num": 3}
    proposals = spark.createDataFrame([("1", "a :pep:`8`"), ("2", "Copyright\n=========\nOpen Publication License\n")], "number string, text string")
    assert [(r["id"], r["text"]) for r in ingest.format_proposals(proposals, added).collect()] == [("1", "a PEP 8")]
    code = spark.createDataFrame([("1", "x", ["MIT"], "Python", "p"), ("2", "y", ["GPL"], "C", "q"), ("3", "z", None, "C", "r")], "blob_id string, content string, detected_licenses array<string>, language string, path string")
    assert [r["id"] for r in ingest.format_code(code, added, ["MIT"]).collect()] == ["1"]


def test_models_as_taggers(spark):
    taggers.register_document_model("test-model", len)
    taggers.register_sentence_model("test_sentences", lambda s: float("bad" in s))
    df = spark.createDataFrame([("a bad one. fine",), (None,)], "text string")
    tagged = taggers.tag(df, ["test_model", "test_sentences"]).collect()
    assert [tuple(s) for s in tagged[0]["attributes"]["test_sentences"]] == [(0, 10, 1.0), (10, 15, 0.0)]
    assert tagged[0]["attributes"]["test_model"][0]["score"] == 15 and tagged[1]["attributes"]["test_sentences"] == []


def test_crawl_follows_links_to_the_end(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(24)] + [(24, 3), (90, 91)], "page long, to long")
    start = spark.createDataFrame([(0,)], "page long")
    assert sorted(r["page"] for r in files.crawl(start, chain).collect()) == list(range(25))
    assert files.crawl(start, chain, most=24).count() == 25
    with pytest.raises(RuntimeError):
        files.crawl(start, chain, most=5)


def test_merge_after_a_failure_adds_nothing_twice(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    schema = spark.createDataFrame([], "id string, text string").schema

    def run(number, state):
        (source / f"{number}.json").write_text("".join(json.dumps({"id": str(k), "text": f"t{number}"}) + "\n" for k in range(number, number + 5)))
        streaming.merge_new(streaming.watch(spark, str(source), schema), str(out), str(tmp_path / state)).awaitTermination(60)
        return sorted((int(r["id"]), r["text"]) for r in spark.read.parquet(str(out)).collect())

    first = [(k, "t0") for k in range(5)]
    assert run(0, "a") == first
    assert run(3, "a") == first + [(k, "t3") for k in range(5, 8)]
    assert {p.name for p in (out / "_ids").iterdir()} >= {"batch=0", "batch=1"}


def test_models_tell_languages(spark):
    parts = {"en": "the house and the garden were sleeping", "de": "das haus und der garten schliefen noch", "fr": "la maison et le jardin dormaient encore"}
    rows = [(k, lang, " ".join(text.split()[j:] + text.split()[:j])) for k, (lang, text) in enumerate(parts.items()) for j in range(6)] + [(9, None, "zz")]
    docs = spark.createDataFrame(rows, "k int, lang string, text string")
    model = models.train(docs, "lang")
    assert model.classes == ("de", "en", "fr") and model.weights.shape == (3, models.SLOTS)
    got = models.predicted(spark.createDataFrame([("the sleeping garden",), ("der garten und das haus",), ("le jardin",), (None,), ("",)], "text string"), model).collect()
    assert [r["predicted"] for r in got[:3]] == ["en", "de", "fr"] and got[3]["predicted_score"] == got[4]["predicted_score"] == pytest.approx(1 / 3, abs=0.05)
    models.register_class("english_test", model, "en")
    models.register_sentences("english_sentence_test", model, "en")
    tagged = taggers.tag(spark.createDataFrame([("the house. das haus.",)], "text string"), ["english_test", "english_sentence_test"]).first()["attributes"]
    assert [s["score"] > 0.5 for s in tagged["english_sentence_test"]] == [True, False]
    with pytest.raises(ValueError):
        models.train(docs.limit(0), "lang")


def test_logs_are_json_with_their_context(spark):
    out = io.StringIO()
    log = logs.configure("lexmill.test", stream=out)
    with logs.context(shard="a"), logs.context(step=1):
        log.info("done %d", 3, extra={"rows": 5})
    try:
        raise KeyError("x")
    except KeyError:
        log.exception("failed")
    first, second = (json.loads(x) for x in out.getvalue().splitlines())
    assert first["message"] == "done 3" and (first["shard"], first["step"], first["rows"], first["level"]) == ("a", 1, 5, "INFO")
    assert "shard" not in second and "KeyError" in second["error"]
    docs, seen = logs.counted(spark.createDataFrame([("ab", "f"), (None, "g")], "text string, file string"), "read", "file")
    assert docs.count() == 2 and seen.get == {"documents": 2, "characters": 2, "files": 2}


def warc(url, page, kind="response", http=b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n", version=b"0"):
    body = http + page
    return b"WARC/1." + version + b"\r\nWARC-Type: " + kind.encode() + b"\r\nWARC-Target-URI: <" + url.encode() + b">\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_web_archives_are_read_record_by_record(spark, tmp_path):
    inner = b"<p>the form is:\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n</p>"
    pages = [(f"http://x/{k}", b"<p>" + b"y" * (k * 37 % 5000) + "é".encode() + b"\r\n\r\nz") for k in range(300)]
    pages[7] = ("http://x/7", inner)
    pages[9] = ("http://x/9", b"\xff<p>")
    raw = [warc(u, p, version=b"1" if k % 2 else b"0") + warc(u, b"", "request") for k, (u, p) in enumerate(pages)]
    (tmp_path / "plain.warc").write_bytes(b"".join(raw))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in raw))
    (tmp_path / "cut.warc").write_bytes(warc("http://x/pdf", b"", http=b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf\r\n\r\n") + raw[1][:-40])
    expected = {(u, p.decode("utf-8", "replace")) for u, p in pages}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        for name in ("plain.warc", "members.warc.gz"):
            found = ingest.read_web_archives(spark, str(tmp_path / name))
            assert name.endswith("gz") or found.rdd.getNumPartitions() > 3
            rows = [(r["url"], r["html"]) for r in found.collect()]
            assert len(rows) == 300 and set(rows) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["url"] for r in ingest.read_web_archives(spark, str(tmp_path / "cut.warc")).collect()] == ["http://x/1"]


def test_records_larger_than_a_batch_of_an_archive_larger_than_a_worker_may_hold(spark, tmp_path):
    """60 MB in records of 100 kB; a worker that held them all would need several times that."""
    import resource

    record = warc("http://x/", b"<p>" + b"y" * 100_000)
    with gzip.open(tmp_path / "large.warc.gz", "wb", compresslevel=1) as f:
        for _ in range(600):
            f.write(record)
    found = ingest.read_web_archives(spark, str(tmp_path / "large.warc.gz"))

    def peak(batches):
        n = sum(len(b) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024])], names=["n", "mb"])

    row = found.mapInArrow(peak, "n long, mb long").first()
    assert row["n"] == 600 and row["mb"] < 600


def test_main_content_is_the_dense_part_of_a_page():
    from lexmill.functions.markup import _main_text

    text = "Many words are in each of the paragraphs of a page that has something to say to its readers about a matter."
    menu = "".join(f"<li><a href=/{k}>Item {k}</a></li>" for k in range(30))
    page = f"<body><ul>{menu}</ul><div>Log in</div><h1>The title of it</h1><p>{text}</p><p>Short one.</p><p>{text} <a href=x>more</a></p><div><a href=a>Read</a> <a href=b>also</a></div><p>{text}</p><footer>{text}</footer><ul>{menu}</ul>"
    assert _main_text(page) == f"The title of it\n{text}\nShort one.\n{text} more\n{text}"
    assert _main_text("") == "" and _main_text("<div>" * 5000 + "deep words are here") == "deep words are here"

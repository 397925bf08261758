from __future__ import annotations

import itertools
import random
import re
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from lexmill.operators import chunks, dedupe, layout, mix as M, relational as R, spans as S, taggers, threads, tokenize


def texts(spark, *values):
    return spark.createDataFrame([(k, t) for k, t in enumerate(values)], "doc_id long, text string")


def test_line_tagger(spark):
    df = texts(spark, "  [Notices] \nrest", "x", None, "").select(taggers.tagger("line_usgpo")(F.col("text")).alias("s"))
    assert [[tuple(x) for x in r["s"]] for r in df.collect()] == [[(0, 13, 1.0)], [], [], []]


def test_page_lines(spark):
    df = texts(spark, "  12 \na", "12 a\n", "[[Page 3]]").select(S.of_line_pattern(F.col("text"), list(taggers.PAGE_LINES.values())).alias("s"))
    assert [len(r["s"]) for r in df.collect()] == [1, 0, 1]


def test_pattern_spans_and_replace(spark):
    rng = random.Random(2)
    values = ["".join(rng.choice("a  b\n\n😀") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = texts(spark, *values).withColumn("s", S.of_pattern(F.col("text"), "  "))
    df = S.rewritten(df.withColumn("r", F.col("text")), "r", S.edits(F.col("s"), " ", 0.1))
    for r in df.collect():
        assert all(r["text"][s["start"] : s["end"]] == "  " for s in r["s"])
        assert r["r"] == r["text"].replace("  ", " ")


def test_overlapping_edits(spark):
    edit = lambda *e: F.array(*[F.struct(F.lit(a).alias("start"), F.lit(z).alias("end"), F.lit(t).alias("text")) for a, z, t in e])
    df = S.rewritten(texts(spark, "abcdef", None), "text", edit((2, 4, "X"), (1, 3, "Y"), (1, 2, "Z"), (5, 6, "")))
    assert [r["text"] for r in df.collect()] == ["aYde", None]


def test_coverage(spark):
    df = texts(spark, "aaaa", "").withColumn("s", S.whole(F.col("text"), F.lit(0.5)))
    assert [r[0] for r in df.select(S.coverage(F.col("s"), F.col("text"))).collect()] == [0.5, None]


def test_conditions():
    read = M.parse_condition
    assert read("$.attributes[?(@.a__b[0][2] <= 0.5)]") == M.Condition("attributes", "a__b", "<=", 0.5)
    assert read("$@.attributes[?(@.d && @.d[0] && @.d[0][2] >= 0.9)]") == M.Condition("attributes", "d", ">=", 0.9)
    assert read('.metadata.title | startswith("User talk")') == M.Condition("metadata", "title", "startswith", "User talk")
    assert read(".attributes.x != null and .attributes.x[0][2] > 1").op == ">"
    with pytest.raises(M.SpecError):
        read("$.whatever")


def test_bad_specs():
    with pytest.raises(M.SpecError, match="line 1"):
        M.load_specs('{"streams": [{} {}]}')
    with pytest.raises(M.SpecError, match="twice"):
        M.load_specs('{"streams": [], "streams": []}')


def test_spec_from_json(spark):
    spec = M.load_specs(
        '{"streams": [{"name": "n", "documents": ["d"], "output": {"path": "p", "max_size_in_bytes": 5}, "filter": {"exclude": ["$.attributes[?(@.char_length[0][2] <= 3)]"]},'
        ' "span_replacement": [{"span": "$.attributes.double_space", "min_score": 0.1, "replacement": " "}]}]}'
    )[0]
    assert spec.max_size == 5 and spec.needed() == ["char_length", "double_space"]
    assert [r["text"] for r in M.mix(texts(spark, "abc", "a  bc", None), spec).collect()] == ["a bc"]


def test_missing_attribute_keeps_the_row(spark):
    docs = spark.createDataFrame([(1, "t", {})], "doc_id int, text string, attributes map<string,array<struct<start:int,end:int,score:double>>>")
    assert M.mix(docs, M.RECIPES["article_papers"]).count() == 1


def test_recipes_name_known_taggers():
    outside = {M.ENGLISH, M.QUALITY, M.DUPLICATE, M.LOGPROB, "duplicate_documents", "duplicate_paragraphs", "toxic_sentence", "nsfw_sentence"}
    assert len(M.RECIPES) == 33
    for spec in M.RECIPES.values():
        assert set(spec.needed()) - outside <= set(taggers.names())


def common(a, b):
    """Length of the longest common subsequence."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def brute_chunks(text):
    """The rule line by line, each question asked of the whole page."""
    rows = text.split("\n")
    sizes, n = [len(r.strip()) for r in rows], len(rows)
    block, k = set(), 0
    while k < n:
        run = next((j for j in range(k, n) if sizes[j] <= 30), n)
        if run - k >= min(3, n - k) and run > k:
            block |= {*range(k, run)} | ({run} if run < n and sizes[run] else set())
            k = max(block)
        k += 1
    out, at, seen = [], 0, []
    for k, r in enumerate(rows):
        end = min(at + len(r) + 1, len(text))
        if k in block:
            out.append(("paragraph_chunk", at, end, 1.0))
            if k + 1 in block:
                bare = len(r.rstrip())
                out.append(("terminal_newline", at + bare - 1, end, 1.0) if r.rstrip().endswith("-") else ("terminal_newline_with_space", at + bare, end, 1.0))
            elif k + 1 < n:
                out.append(("paragraph_terminal_newline", end - 1, end, 1.0))
        elif end > at:
            name, after = r.strip().lower(), [j for j in range(k + 1, n) if sizes[j]]
            plain = len(name) > 5 and re.fullmatch(r"[0-9a-z\s.,:]+", name) and after and after[0] in block
            new = bool(plain) and not any(200 * common(name, x) >= 70 * (len(name) + len(x)) for x in seen)
            seen += [name] if new else []
            out.append(("paragraph_chunk", at, end, float(new)))
        at += len(r) + 1
    return out


def test_chunks(spark):
    rng, long = random.Random(3), "x" * 40
    parts = [long, long + "-", "  " + long + " \t", long + "!", "", " ", "end", "Chapter 1", "Chapter 2", "CHAPTER 11: on", "Of whales.", "Of Snails", "7", "a title: of some 31 letters, long", "A title of forty letters, " + "y" * 50, "é" * 35, "Wörter und", "  Spaced out  "]
    pages = [f"7\nA Title\n\n{long}-\n{long} \n{long}\nend\n\nnoise", "", "\n", long, f"{long}\n{long}", f"{long}\n{long}\nend", f"{long}\n{long}\n"]
    pages += ["\n".join(rng.choice(parts[:3] if rng.random() < 0.5 else parts) for _ in range(rng.randint(1, 25))) for _ in range(300)]
    got = {r["doc_id"]: r["s"] for r in texts(spark, *pages, None).select("doc_id", chunks.paragraph_chunks(F.col("text")).alias("s")).collect()}
    for k, page in enumerate(pages):
        assert [tuple(x) for x in got[k]] == brute_chunks(page), page
    assert got[len(pages)] is None


def test_headings_are_compared_at_once():
    rng = random.Random(4)
    names = ["".join(rng.choice("abc de") for _ in range(rng.choice((6, 20, 64, 65, 90)))) for _ in range(60)]
    seen, want = [], []
    for x in names:
        want.append(not any(200 * common(x, y) >= 70 * (len(x) + len(y)) for y in seen))
        seen += [x] if want[-1] else []
    assert chunks.new_headings(names) == want
    many = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40)) for _ in range(3000)]
    start = time.perf_counter()
    chunks.new_headings(many)
    assert time.perf_counter() - start < 30


def test_many_edits_and_lines_take_time_in_proportion(spark):
    page, n = "a  b\n", 200_000
    df = texts(spark, page * n).withColumn("s", S.of_pattern(F.col("text"), "  "))
    df = S.rewritten(df.withColumn("l", S.of_lines(F.col("text"), ["a  b"])), "text", S.edits(F.col("s"), " ", 0.1))
    start = time.perf_counter()
    row = df.select(F.size("s").alias("n"), (F.col("text") == F.repeat(F.lit("a b\n"), n)).alias("same"), F.size("l").alias("lines"), F.element_at("l", -1).alias("last")).first()
    assert (row["n"], row["same"], row["lines"], tuple(row["last"])) == (n, True, n, (5 * (n - 1), 5 * n, 1.0))
    assert time.perf_counter() - start < 60


def test_running_sums(spark):
    rng = random.Random(5)
    values = [[rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 2, 63, 64, 65, 128, 1000, 4096, 4097, 9000)]
    df = spark.createDataFrame([(v,) for v in values], "v array<int>").select("v", S.running(F.col("v")).alias("s"))
    assert all(list(itertools.accumulate(r["v"])) == r["s"] for r in df.collect())


def test_repetition():
    assert taggers.longest_repetition("a b " * 10) >= 18
    assert taggers.longest_repetition("a b c d e f") == 0


def test_gopher_repeats(spark):
    rows = taggers.gopher_repeats(texts(spark, "a b a b a b", None, "q")).collect()
    assert rows[0]["repeats"]["top_2gram_fraction"] == 1.0 and rows[1]["repeats"]["top_2gram_fraction"] == 0.0


def test_log_probability_of_empty_text(spark):
    table = taggers.unigram_table(spark.createDataFrame([("a", "3"), ("b", "1"), ("c", "x")], "word string, count string"))
    got = {r["doc_id"]: r["logprob"] for r in taggers.mean_log_probability(texts(spark, "", "A a b", None), table).collect()}
    assert got[0] == 0.0 and got[2] == 0.0
    assert abs(got[1] - (2 * -0.41503749927884376 - 2) / 3) < 1e-9


def test_ngram_overlap_counts_earlier_documents_only(spark):
    a = " ".join(f"w{k}" for k in range(25))
    got = {r["doc_id"]: r["overlap"] for r in dedupe.ngram_overlap(texts(spark, a, a, "short text", a + " " + " ".join(f"v{k}" for k in range(30))), 20).collect()}
    assert got[0] == 0 and got[1] == 1 and 2 not in got and 0 < got[3] < 0.5


def test_results_do_not_depend_on_partitions(spark):
    docs = texts(spark, *[" ".join(f"w{(k * j) % 7}" for j in range(40)) for k in range(12)])
    read = lambda d: sorted(map(tuple, dedupe.ngram_overlap(d).collect()))
    assert read(docs.repartition(1)) == read(docs.repartition(7))


def test_keep_first_with_null_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "id int, k string")
    assert sorted(r["id"] for r in dedupe.keep_first(df, ["k"], ["id"]).collect()) == [1, 3]


@pytest.mark.parametrize("rows, first", [([(100, True), (1000, False)], 100), ([(100, False), (1000, True)], 1000), ([(5, False), (9, None)], 9)])
def test_vote_sort(spark, rows, first):
    df = spark.createDataFrame([([{"score": s, "accepted": a} for s, a in rows],)], "a array<struct<score:int,accepted:boolean>>")
    assert df.select(threads.vote_sorted(F.col("a")).alias("a")).first()["a"][0]["score"] == first


def test_threads(spark):
    posts = spark.createDataFrame(
        [(1, 1, None, 3, "T", "q", 1, "L"), (2, 2, 1, None, None, "low", 9, "L"), (3, 2, 1, None, None, "acc", 1, "M"), (4, 2, 99, None, None, "orphan", 1, "L")],
        "id long, kind int, parent_id long, accepted_id long, title string, body string, score int, license string",
    ).withColumn("date", F.timestamp_seconds("id"))
    comments = spark.createDataFrame([(3, 8, "u", "later"), (3, 7, "u", "sooner")], "post_id long, id long, author string, text string").withColumn("date", F.timestamp_seconds("id")).withColumn("license", F.lit("L"))
    users = spark.createDataFrame([(5, "Ann"), (-1, "Robot")], "id long, name string")
    authors = threads.post_authors(spark.createDataFrame([(1, 5), (2, -1), (3, None)], "post_id long, user_id long"), users, "s.com")
    r = threads.assemble(posts, comments, authors, "s.com").collect()
    assert len(r) == 1 and r[0]["text"] == "T\nq\nacc\nsooner\nlater\nlow"
    assert r[0]["metadata"]["authors"] == ["Ann", "Unknown", "https://s.com/users/5", "u"] and r[0]["metadata"]["all_licenses"] == ["L", "M"]


def test_greedy_and_even_shards(spark):
    df = spark.createDataFrame([(1, 6), (2, 6), (3, 6)], "n int, size int")
    assert [r["shard"] for r in layout.greedy_shards(df, "n", F.col("size"), 10).orderBy("n").collect()] == [0, 1, 1]
    assert [r["shard"] for r in layout.even_shards(df, "n", F.col("size"), 10).orderBy("n").collect()] == [0, 0, 1]


def test_shard_names(spark):
    assert [r[0] for r in spark.range(123455, 123457).select(layout.shard_name(F.col("id") % 123456, "x")).collect()] == ["123455_x", "00000_x"]


def test_item_keys(spark):
    df = spark.createDataFrame([("a/b/12",), ("x/1234567",)], "u string")
    assert [r[0] for r in df.select(R.item_key(F.col("u"))).collect()] == ["000012", "1234567"]


def test_size_of_null_text(spark):
    assert R.size_stats(texts(spark, None, "a b")).first().asDict() == {"documents": 2, "tokens": 2, "characters": 3, "bytes": 3}


def test_as_of_before_the_first(spark):
    ids = spark.createDataFrame([(1,), (5,), (500,)], "id long")
    starts = spark.createDataFrame([(5, "a"), (100, "b")], "start long, shard string")
    assert {r["id"]: r["shard"] for r in R.as_of(ids, starts).collect()} == {1: None, 5: "a", 500: "b"}


def test_slices_are_a_partition(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("n"))
    parts = [{r["n"] for r in df.filter(R.slice_of(F.col("n"), 3, k)).collect()} for k in range(3)]
    assert sum(map(len, parts)) == 50 and len(set().union(*parts)) == 50


def test_special_ids_and_ranks(tmp_path):
    import json

    spec = {"added_tokens": [{"content": "<e>", "id": 2, "special": True}], "model": {"vocab": {"a": 0, "Ġ": 1, "<e>": 2}}, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "x"}}]}}
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    assert tokenize.special_ids(str(path)) == {"<e>": 2}
    assert tokenize.mergeable_ranks(str(path)) == {b"a": 0, b" ": 1}
    assert tokenize.split_pattern(spec) == "x"


def test_latest_revision(spark):
    df = spark.createDataFrame([([{"text": "a", "date": "1", "author": "x"}, {"text": "b", "date": "2", "author": "w"}],), ([],)], "r array<struct<text:string,date:string,author:string>>")
    every, last = (df.select(R.latest_revision(F.col("r"), e).alias("v")).collect() for e in (True, False))
    assert every[0]["v"]["text"] == "b" and every[0]["v"]["authors"] == ["w", "x"] and last[0]["v"]["authors"] == ["w"] and every[1]["v"]["text"] is None


def test_pairs_and_pages(spark):
    entries = spark.createDataFrame([([{"kind": "license", "value": "L"}, {"kind": "uri", "value": "U"}, {"kind": "uri", "value": "V"}],), ([],)], "e array<struct<kind:string,value:string>>")
    assert [tuple(r["p"]) for r in entries.select(R.first_pair(F.col("e")).alias("p")).collect()] == [("U", "L"), (None, None)]
    pages = spark.createDataFrame([("ok", "t"), ("ok", ""), ("User:BeywheelzLetItRip/fonts.css", "t"), (None, "t")], "title string, text string")
    assert pages.filter(R.parseable(F.col("title"), F.col("text"))).count() == 2


def test_rows_of_workers(spark):
    df = spark.createDataFrame([(k,) for k in range(10)], "k int")
    parts = [[r["k"] for r in R.rows_of(df, w, 3, "k").orderBy("k").collect()] for w in range(3)]
    assert parts == [[0, 3, 6, 9], [1, 4, 7], [2, 5, 8]]


def test_budget_emits_the_batch_that_passes_it(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "b int, n int")
    assert [r["b"] for r in R.within_budget(df, "b", "n", 5).collect()] == [1, 2]


def test_replayed_shards_follow_the_ids(spark):
    rows = [(k, f"id{k:02}", 10, f"f{k // 4}") for k in range(12)]
    old = spark.createDataFrame(rows, "at long, id string, n int, file string")
    moved, shards = layout.compacted(old, "at", F.col("n"), 50, "file", "id")
    other = old.filter("at % 5 <> 2")
    first = {r["id"]: r["shard"] for r in moved.collect()}
    assert {r["id"]: r["shard"] for r in layout.replay(other, shards, "at", "file", "id").collect()} == {i: first[i] for i in (r["id"] for r in other.collect())}


@pytest.mark.parametrize("lacks", ["false", "at % 3 = 1", "at in (4, 5)", "at in (0, 9, 10, 11)", "at is null"])
def test_replay_gives_every_row_one_shard(spark, lacks):
    rows = [(k, f"id{k:02}", 10, f"f{k // 4}") for k in range(12)] + [(None, None, 10, None)]
    old = spark.createDataFrame(rows, "at long, id string, n int, file string")
    moved, shards = layout.compacted(old, "at", F.col("n"), 50, "file", "id")
    first = {r["at"]: r["shard"] for r in moved.collect()}
    assert first == {k: k // 5 for k in range(12)} | {None: 2}
    other = old.filter(f"NOT coalesce({lacks}, false)")
    left = [r["at"] for r in other.collect()]
    found = [(r["at"], r["shard"]) for r in layout.replay(other, shards, "at", "file", "id").collect()]
    assert sorted(found, key=str) == sorted(((k, first[k]) for k in left), key=str)


def test_replay_of_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars", F.concat(F.lit("f"), F.expr("cast(doc_id div 100 as string)")).alias("file"))
    shards = layout.compacted(docs, "doc_id", F.col("n_chars"), 100_000, "file", "doc_id")[1]
    sql = f"SELECT doc_id, ((coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) // 100000)::INT AS shard FROM '{sf_dir}/documents.parquet'"
    for lacks in (-1, 1):  # all rows, then without a third of the ids
        found = layout.replay(docs.filter(F.col("doc_id") % 3 != lacks), shards, "doc_id", "file", "doc_id").select("doc_id", "shard")
        assert sorted(map(tuple, found.collect())) == sorted(r for r in duckdb.sql(sql).fetchall() if r[0] % 3 != lacks)


def test_upsert_holds_every_key(spark):
    index = spark.createDataFrame([(k, f"f{k}") for k in range(12) if k % 4 != 3], "id long, file string")
    new = spark.createDataFrame([(k, "new") for k in range(12) if k % 2], "id long, file string")
    found = {r["id"]: r["file"] for r in R.upsert(index, new, "id", "file").collect()}
    assert found == {k: "new" if k % 2 else f"f{k}" for k in range(12)}

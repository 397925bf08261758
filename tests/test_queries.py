"""Every registered query against its SQL in DuckDB, on the same tables."""

from __future__ import annotations

import datetime
import html
import math
import re
import statistics
import zlib
from collections import Counter

import duckdb
import pytest
from test_operators import brute_chunks

from lexmill import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clients".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
        return [plain(v) for v in x]
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return x


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([plain(r[k]) for k in order]) for r in found)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_as_sql(name, spark, sf_dir, duck):
    mine = plans.queries()[name](spark, sf_dir)
    other = duck.sql(plans.oracle_sql()[name])
    assert sorted(mine.columns) == sorted(other.columns)
    got = rows(mine.columns, [tuple(r) for r in mine.collect()])
    assert got == rows(other.columns, other.fetchall())


# queries that SQL can't express, against plain statements of their rules

WITHOUT_SQL = {"language_model", "gopher_filter", "longest_repetition", "paragraph_chunk", "paragraph_reflow", "html_text", "html_fields", "encode_decode", "repeated_passages_removed", "language_model_filter", "toxic_model_sentences"}


def test_every_query_has_sql_or_a_test_here():
    assert set(plans.queries()) - set(plans.oracle_sql()) == WITHOUT_SQL


def table(duck, name, key, *columns):
    return {r[0]: r[1] if len(columns) == 1 else r[1:] for r in duck.sql(f"SELECT {key}, {', '.join(columns)} FROM {name}").fetchall()}


def split(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]


def test_language_model(spark, sf_dir):
    held = [r for r in plans.queries()["language_model"](spark, sf_dir).collect() if r["held_out"]]
    assert len(held) > 20 and sum(r["predicted"] == r["lang"] for r in held) >= 0.95 * len(held)


def test_filters_by_a_model(spark, sf_dir, duck):
    kept = plans.queries()["language_model_filter"](spark, sf_dir).collect()
    lang = table(duck, "documents", "doc_id", "lang")
    held = {i for i in lang if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r["doc_id"] for r in kept}
    assert sum((i in got) == (lang[i] == "en") for i in held) >= 0.95 * len(held)
    from lexmill.operators import taggers

    assert "english" not in taggers.names()


def test_toxic_sentences_by_a_model(spark, sf_dir, duck):
    texts, toxic = table(duck, "documents", "doc_id", "text"), table(duck, "labels", "doc_id", "toxic")
    rows = {r["doc_id"]: r for r in plans.queries()["toxic_model_sentences"](spark, sf_dir).collect()}
    assert set(rows) == set(texts) and all(len(texts[i]) - len(r["kept"]) == r["removed"] for i, r in rows.items())
    share = lambda kind: statistics.mean(rows[i]["removed"] / max(1, len(texts[i])) for i, t in toxic.items() if t == kind)
    assert share(1) > 0.2 > 0.05 > share(0)


def covered(own, n):
    """Characters of the words that are in an n-gram that occurs twice."""
    grams = Counter(tuple(own[k : k + n]) for k in range(len(own) - n + 1))
    marked = {j for k in range(len(own) - n + 1) if grams[tuple(own[k : k + n])] > 1 for j in range(k, k + n)}
    return sum(len(own[j]) for j in marked)


def keeps(text):
    own, lines = split(text), [x for x in text.split("\n") if x.strip(" \t\r\x0b\f")]
    if not 50 <= len(own) <= 100_000 or not 3 <= statistics.median(map(len, own)) <= 10:
        return False
    chars, share = sum(map(len, own)), lambda test, of: sum(map(test, of)) / len(of)
    if share(lambda w: "#" in w or "..." in w or "…" in w, own) > 0.1 or share(lambda w: bool(re.search("[A-Za-z]", w)), own) < 0.8:
        return False
    if len({"the", "be", "to", "of", "and", "that", "have", "with"} & set(own)) < 2 or len(set(lines)) / len(lines) < 0.7:
        return False
    if share(lambda x: x.strip()[0] in "*-•", lines) > 0.9 or share(lambda x: x.strip().endswith(("...", "…")), lines) > 0.3:
        return False
    for n, most in ((2, 0.2), (3, 0.18), (4, 0.16)):
        grams = Counter(tuple(own[k : k + n]) for k in range(len(own) - n + 1))
        top = max(grams.values())
        if top > 1 and max(top * sum(map(len, g)) for g, c in grams.items() if c == top) / chars > most:
            return False
    if any(covered(own, n) / chars > most for n, most in zip(range(5, 11), (0.15, 0.14, 0.13, 0.12, 0.11, 0.1))):
        return False
    return sum(len(x) * (c - 1) for x, c in Counter(lines).items()) / sum(map(len, lines)) <= 0.3


def test_gopher_filter(spark, sf_dir, duck):
    got = {r["doc_id"] for r in plans.queries()["gopher_filter"](spark, sf_dir).collect()}
    assert got == {i for i, t in table(duck, "documents", "doc_id", "text").items() if keeps(t)}


def test_longest_repetition(spark, sf_dir, duck):
    def brute(text):
        own, best = split(text), 0
        for n in range(2, 14):
            for k in range(len(own) - n):
                end = k + n
                while end < len(own) and own[end] == own[end - n]:
                    end += 1
                best = max(best, end - k if end - k > 3 * n else 0)
        return best

    got = {r["doc_id"]: r["words"] for r in plans.queries()["longest_repetition"](spark, sf_dir).collect()}
    assert got == {i: brute(t) for i, t in table(duck, "documents", "doc_id", "text").items()}


def test_chunks_and_reflow(spark, sf_dir, duck):
    texts, found = table(duck, "documents", "doc_id", "text"), {}
    for r in plans.queries()["paragraph_chunk"](spark, sf_dir).collect():
        found.setdefault(r["doc_id"], set()).add(tuple(r[c] for c in ("kind", "start", "end", "score")))
    flowed = {r["doc_id"]: r["text"] for r in plans.queries()["paragraph_reflow"](spark, sf_dir).collect()}
    put = {"terminal_newline": "", "terminal_newline_with_space": " ", "paragraph_terminal_newline": "\n\n"}
    for i, text in texts.items():
        want = brute_chunks(text)
        assert found.get(i, set()) == set(want)
        gone = [(a, z, "") for k, a, z, s in want if k == "paragraph_chunk" and s <= 0.1]
        out = text
        for a, z, new in sorted(gone + [(a, z, put[k]) for k, a, z, _ in want if k in put], reverse=True):
            out = out[:a] + new + out[z:]
        assert flowed[i] == out


def test_html_text_and_fields(spark, sf_dir, duck):
    pages = table(duck, "pages", "page_id", "html")
    plain = lambda x: re.sub(r"\s+", "", x)
    for r in plans.queries()["html_text"](spark, sf_dir).collect():
        page = re.sub(r"(?is)<!--.*?-->|<(script|style|template|noscript)\b.*?</\1>", "", pages[r["page_id"]])
        whole = plain(html.unescape(re.sub(r"(?s)<[^>]*>", "", page)))
        assert plain(r["text"]) == whole
        assert r["main"] and all(plain(x) in whole for x in r["main"].split("\n"))
    for r in plans.queries()["html_fields"](spark, sf_dir).collect():
        page = pages[r["page_id"]]
        title = re.search(r"(?is)<title[^>]*>(.*?)</title>", page)
        assert r["title"] == (html.unescape(title[1]).strip() if title else None)
        assert 0 < r["paragraphs"] <= len(re.findall("(?i)<p[ >]", page))


def test_encode_decode(spark, sf_dir, duck):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    texts = table(duck, "documents", "doc_id", "text")
    for r in plans.queries()["encode_decode"](spark, sf_dir).collect():
        assert r["same"] and r["n_tokens"] == len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)


def test_flagship(spark, sf_dir):
    assert plans.flagship(spark, sf_dir).count() > 0

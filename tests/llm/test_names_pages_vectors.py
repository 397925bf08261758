"""Joins of misspelt names, main text of pages, whitening."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm.namejoin import distance, misspelt, name_digest, plain_name, shifts, similar_names
from lexmill.llm.pagetree import main_text, outline, tree
from lexmill.llm.queries import op13_whitening
from lexmill.llm.templates import article_texts, host_of, site_templates
from lexmill.llm.whitening import Grid, merged, moments, whiten

# names


def edited(name: str, alphabet: str) -> set[str]:
    """All names one edit away."""
    out = set()
    for k in range(len(name) + 1):
        out |= {name[:k] + c + name[k:] for c in alphabet}
        if k < len(name):
            out.add(name[:k] + name[k + 1 :])
            out |= {name[:k] + c + name[k + 1 :] for c in alphabet}
        if k + 1 < len(name):
            out.add(name[:k] + name[k + 1] + name[k] + name[k + 2 :])
    return out


def brute_distance(a: str, b: str, most: int, alphabet: str) -> int | None:
    """By edits one after another: the definition itself."""
    reached = {a}
    for d in range(most + 1):
        if b in reached:
            return d
        reached = set().union(*(edited(x, alphabet) for x in reached))
    return None


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=5), st.text("ab", max_size=5))
def test_distance_is_the_least_number_of_edits(a, b):
    assert distance(a, b, 2) == brute_distance(a, b, 2, "ab")


def test_what_an_exchange_has_moved_may_be_edited_again():
    assert distance("ca", "abc", 2) == 2 and distance("ca", "abc", 1) is None
    assert distance("é😀", "😀é", 1) == 1 and distance("", "ab", 2) == 2


def pieces_meet(own: str, other: str, most: int) -> list[int]:
    """Places of shifts by which two names meet."""
    pieces, n = 2 * most + 1, len(own)
    cut = [own[n * i // pieces : n * (i + 1) // pieces] for i in range(pieces)]
    found = []
    for k, (longer, i, s) in enumerate(shifts(most)):
        start, end = n * i // pieces + s, n * (i + 1) // pieces + s
        if len(other) - n == longer and start >= 0 and end <= len(other) and other[start:end] == cut[i]:
            found.append(k)
    return found


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=3, max_size=12), st.integers(1, 3), st.randoms(use_true_random=False))
def test_some_piece_is_left_whole(own, most, rng):
    if len(own) < 2 * most + 1:
        return
    other = own
    for _ in range(rng.randint(0, most)):
        other = rng.choice(sorted(edited(other, "abc")))
    assert pieces_meet(own, other, most)


def test_seven_substrings_for_one_error():
    assert len(shifts(1)) == 7


@pytest.mark.parametrize("most", [1, 2])
def test_pairs_are_those_of_brute_force(spark, most):
    rng = random.Random(most)
    letters = "abé😀"
    own = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(90)}
    others = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 10))) for _ in range(120)}
    others |= {rng.choice(sorted(edited(x, letters))) for x in own if len(x) > 1} | set(list(own)[:20])
    others.discard("")
    got = similar_names(spark.createDataFrame([(x,) for x in own], "x string"), spark.createDataFrame([(x,) for x in others], "distance string"), most).collect()
    expected = {(a, b, d) for a in own for b in others if (d := distance(a, b, most)) is not None}
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def brute_digest(clients, vendors):
    plain = lambda x: "".join(c.lower() if c.isascii() else c for c in x if c not in " \t\n\x0b\x0c\r") if x is not None else None
    out: dict = defaultdict(lambda: [0, None, 0])
    for vendor, name in vendors:
        h = zlib.crc32(str(vendor).encode()) if vendor is not None else 1
        if name and h % 2 == 0 and len(name) >= 2:
            at = h % (len(name) - 1)
            name = name[:at] + name[at + 1] + name[at] + name[at + 2 :]
        for client, other in clients:
            if plain(name) and plain(other) and (d := distance(plain(name), plain(other), 1)) is not None:
                row = out[vendor, d]
                row[0] += 1
                row[1] = client if row[1] is None else min(row[1], client)
                row[2] += zlib.crc32(str(client).encode())
    return {(*k, *v) for k, v in out.items()}


def test_digest_of_odd_rows_hot_names_and_short_ones(spark):
    rng = random.Random(5)
    names = ["Ann Lee", "ann  LEE", "anlnee", "Ånn Lee", "Bo", "B", "b ", "", None, " \t", "xy", "yx", "Straße", "STRASSE", "😀a", "a😀", "Jo\x0bJo", "abcdefghij", "abcdefghji"]
    vendors = [(k, rng.choice(names)) for k in range(60)] + [(5, "Ann Lee"), (5, "Ann Lee"), (None, "Ann Lee"), (None, "zz")]
    clients = [(k, rng.choice(names)) for k in range(80)] + [(1000 + k, "Ann Lee") for k in range(200)]
    c = spark.createDataFrame([(*r, "x", 1) for r in clients], "client_id long, name string, own string, distance int").repartition(5)
    v = spark.createDataFrame([(*r, "x") for r in vendors], "vendor_id long, name string, other string").repartition(3)
    got = name_digest(c, v).collect()
    assert {tuple(r) for r in got} == brute_digest(clients, vendors) and len(got) == len({(r[0], r[1]) for r in got})
    assert name_digest(c.limit(0), v).collect() == [] and name_digest(c, v.limit(0)).collect() == []
    assert [n for n, _ in name_digest(c, v).dtypes] == ["vendor_id", "distance", "n_clients", "first_client_id", "clients_crc"]


def test_names_as_stored_are_misspelt_before_they_are_made_plain(spark):
    rows = [(k, n) for k, n in enumerate(["Ab Cd", "Q", "", "éa", "A B"] * 20)]
    df = spark.createDataFrame(rows, "k long, n string")
    for r in df.select("k", "n", misspelt(F.col("n"), F.col("k")).alias("m"), plain_name(F.col("n")).alias("p")).collect():
        h, n = zlib.crc32(str(r["k"]).encode()), r["n"]
        at = h % (len(n) - 1) if len(n) > 1 else 0
        assert r["m"] == (n[:at] + n[at + 1] + n[at] + n[at + 2 :] if h % 2 == 0 and len(n) > 1 else n)
    assert df.filter("n = ''").select(plain_name(F.col("n"))).first()[0] is None


def test_names_are_joined_without_broadcasts_and_single_tasks(spark):
    df = spark.createDataFrame([("abcdef",)], "n string")
    plan = similar_names(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SinglePartition" not in plan and "Cartesian" not in plan


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><div>Site &amp; more</div></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="wrap"><article><header><h1>Title {k}</h1><p>By someone</p></header><p>First &lt;b&gt; caf&eacute; {k}<p>Second
  <b>bold</b>text<br>after <i>it</i><script>if (a<b) {{ "</p>" }}</script><div class="x81">Read our other pages</div>
<div>A division</div><ul><li>one<li>two</ul><p>Shared passage</p><aside>Aside</aside><form><label>Mail</label><input></form>
<div class="ad-slot">Buy</div><section id="comments"><article><p>A comment</p></article></section></article><div class="y2">Most read</div></div>
<footer>Footer</footer></body></html>"""
TEXT = "Title {k}\n\nFirst <b> café {k}\n\nSecond boldtext after it\n\nA division\n\none\n\ntwo\n\nShared passage"


def test_article_without_what_stands_beside_it():
    assert main_text(PAGE.format(k=1)) == TEXT.format(k=1).replace("A division", "Read our other pages\n\nA division")


def page_rows(n=12):
    rows = [(k, f"http://A.example.org/{k}", PAGE.format(k=k)) for k in range(n)]
    # equal pages are no template; nor is a page of another host
    rows += [(100 + k, "http://b.example.org/", "<body><div>Whole text of a page.</div><div><p>of it</div>") for k in range(9)]
    rows += [(200, "http://c.example.org/", PAGE.format(k=200)), (201, None, "<p>a&amp;b"), (202, "x", None), (203, "http://a.example.org/z", ""), (None, "http:///", "plain  <!-- no --> text")]
    return rows


@pytest.mark.parametrize("most", [None, 0])
def test_elements_that_recur_on_a_host_go(spark, monkeypatch, most):
    from lexmill.llm import templates

    if most is not None:
        monkeypatch.setattr(templates, "BROADCAST_DIGESTS", most)
    rows = page_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, host long, digests string").repartition(4)
    got = {r["page_id"]: r for r in article_texts(df).collect()}
    assert len(got) == len(rows)
    for k in range(12):
        assert got[k]["text"] == TEXT.format(k=k) and got[k]["n_chars"] == len(TEXT.format(k=k)) and got[k]["url"] == f"http://A.example.org/{k}"
    assert all(got[100 + k]["text"] == "Whole text of a page.\n\nof it" for k in range(9))
    assert "Read our other pages" in got[200]["text"]
    assert [got[k]["text"] for k in (201, 202, 203, None)] == ["a&b", "", "", "plain text"]
    assert article_texts(df.limit(0)).collect() == []


def test_paragraphs_that_many_pages_share_stay(spark):
    rows = [(k, "http://a.b/", f"<main><div class=t>Own {k}.</div><p>The same passage on every page.</p><h2>And heading</h2></main><div>Template of the site</div>") for k in range(20)]
    got = article_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {f"Own {k}.\n\nThe same passage on every page.\n\nAnd heading" for k in range(20)}


def test_templates_without_a_declared_article(spark):
    rows = [(k, "http://a.b/", f"<body><div class=q>Menu of the site</div><div><p>Text of page {k}, which is long enough to be most of it.</p><p>Shared line</p></div><div>Imprint and so on</div>") for k in range(20)]
    rows += [(50 + k, "http://few.b/", f"<body><div class=q>Menu of the site</div><p>Text {k} is here") for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in article_texts(df).collect()}
    assert all(got[k] == f"Text of page {k}, which is long enough to be most of it.\n\nShared line" for k in range(20))
    assert all(got[50 + k] == f"Menu of the site\n\nText {k} is here" for k in range(3))
    counted = {r["host"]: r for r in site_templates(df.select(host_of(F.col("url")).alias("host"), "html")).collect()}
    assert counted["a.b"]["n_pages"] == 20 and len(counted["a.b"]["digests"]) == 2 and counted["few.b"]["digests"] == []


def brute_templates(rows, share, least):
    pages = defaultdict(dict)
    for _, url, html in rows:
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else ""
        if host and html is not None:
            page, digests = outline(html)
            pages[host][page] = digests
    return {h: (len(p), {d for d, n in Counter(x for ds in p.values() for x in ds).items() if n >= least and n >= share * len(p)}) for h, p in pages.items()}


def test_counts_of_elements_are_those_of_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()] + page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["host"]: (r["n_pages"], set(r["digests"])) for r in site_templates(df.select(host_of(F.col("url")).alias("host"), "html"), 0.2, 3).collect()}
    assert got == brute_templates(rows, 0.2, 3)


def test_references_and_optional_tags():
    assert main_text("<p>&#x41;&#66;&amp;lt; &nbsp;x&unknown; &copy 1<p>a<p>") == "AB&lt; x&unknown; © 1\n\na"
    assert main_text("<ul><li>a<ul><li>b</ul>c<li>d</ul>") == "a\n\nb\n\nc\n\nd"
    assert main_text("<table><tr><td>a<td>b<tr><td>c</table>d") == "a\n\nb\n\nc\n\nd"
    assert main_text("<p>a <b>b<p>c</b> d</p></div>e") == "a b\n\nc d\n\ne"
    assert main_text("a < b > c <3 <!doctype x> d <!-- <p> --> e<!--->f") == "a < b > c <3 d ef"
    assert main_text("<p title='a>b' data-x=\"<p>\">x</p ><P CLASS=Lead>y") == "x\n\ny"
    assert main_text("<textarea><p>a</textarea><svg><path/><text>z</text></svg><iframe><p>b</iframe>x<p>cut <a href='") == "x\n\ncut"
    assert main_text("<form><p>all of the page</form>") == "all of the page"
    talk = "<p>a long comment, longer than the text</p>" * 3
    assert main_text(f"<article><p>short text of a page, in one line</p><section id=comments>{talk}</section></article>") == "short text of a page, in one line"
    assert main_text(f"<div><p>short text of a page, in one line</p></div><div id=comments>{talk}</div>") == "short text of a page, in one line"
    assert main_text("<article><div class='post-widget'><p>whole</p><p>text</p></div></article>") == "whole\n\ntext"
    assert main_text("<article class=comment>c</article><article><p>the article is this one</article>") == "the article is this one"


@pytest.mark.parametrize("part", ["<div>", "<p>", "<b>", "<i></b>", "<", "<a href=\"", "<!--", "&", "<script>", "<li><p><ul>", "</p>", "<table><tr><td>", "<svg/>", "<p ", "<a b='", "x y ", "<div class=ad>", "<article>"])
def test_long_and_deep_pages_cost_their_length(part):
    start = time.process_time()
    main_text("<article>x" + part * (600_000 // len(part)), frozenset({1}))
    assert time.process_time() - start < 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<table>", "<tr>", "<td>", "</table>", "</td>", "<li>", "<ul>", "</ul>", "<br>", "a", "b", "<h1>", "</h1>", "<article>", "</article>", "<svg/>", "<svg>", "</svg>"]), max_size=30))
def test_trees_are_trees(parts):
    t = tree("".join(parts))
    assert all(0 <= t.parent[i] < i for i in range(1, len(t.tag)))
    whole = sum(len(x) for _, x in t.events if x and not x.isspace())
    svg = sum(t.size[i] for i in range(1, len(t.tag)) if t.tag[i] == "svg")
    # what no text is in counts for itself alone
    assert t.size[0] == whole - svg


# whitening


def brute_whitening(x: np.ndarray, components: int):
    """x: whole numbers. Deviations, explained shares and coordinates up to their signs."""
    n, total = len(x), [sum(int(v) for v in column) for column in x.T]
    deviations = [sum((n * int(v) - t) ** 2 for v, t in zip(row, total, strict=True)) for row in x]
    centred = x - np.array([t / n for t in total])
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    return deviations, values[order] / np.trace(covariance), centred @ directions[:, order] / np.sqrt(values[order])


def check_whitening(rows, got, components, size):
    good = [(i, v) for i, v in rows if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)]
    x = Grid().whole(np.array([v for _, v in good]))
    deviations, explained, coordinates = brute_whitening(x, components)
    by_id = defaultdict(dict)
    for r in got:
        by_id[r["vec_id"]][r["component"]] = r
    assert len(got) == len(good) * components and set(by_id) == {i for i, _ in good}
    signs = np.sign([by_id[good[0][0]][k + 1]["whitened"] * coordinates[0][k] for k in range(components)])
    for (i, _), deviation, own in zip(good, deviations, coordinates, strict=True):
        for k in range(components):
            r = by_id[i][k + 1]
            assert r["n"] == len(good) and int(r["deviation"]) == deviation and r["identity_error"] < 1e-9
            assert abs(r["whitened"] * signs[k] - own[k]) < 1e-6 and abs(r["explained"] - explained[k]) < 1e-9


def test_whitened_vectors_are_those_of_brute_force(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(3, 0.5, 12)
    rows = [(k, (rng.normal(size=12) * scale + 5).astype(np.float32).tolist()) for k in range(500)]
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [1.0]), (905, []), (906, [1.0] * 11 + [None])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, n int, component string").repartition(7)
    check_whitening(rows + odd, whiten(df).collect(), 8, 12)
    again = {(r["vec_id"], r["component"]): r["deviation"] for r in whiten(df.repartition(2)).collect()}
    assert again == {(r["vec_id"], r["component"]): r["deviation"] for r in whiten(df).collect()}


def test_whitening_of_the_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitening(rows, op13_whitening(spark, sf_dir).collect(), 8, 64)


def test_vectors_that_span_little_and_none(spark):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert whiten(frame([])).collect() == [] and whiten(frame([("a", [1.0, 2.0])])).collect() == []
    assert whiten(frame([("a", [1.0, 2.0])] * 5)).collect() == [] and whiten(frame([("a", None), (None, [])])).collect() == []
    line = whiten(frame([("a", [0.0, 0.0]), (None, [1.0, 1.0]), ("a", [2.0, 2.0]), ("b", [1e30, 0.0])])).collect()
    assert len(line) == 3 and all(r["component"] == 1 and abs(r["explained"] - 1) < 1e-12 for r in line)
    assert sorted(r["whitened"] for r in line) == pytest.approx([-(1.5**0.5), 0, 1.5**0.5])


def test_deviations_beyond_a_long_are_exact(spark):
    rows = [(k, [float((k % 5) << 36), float(k)]) for k in range(50)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("component = 1").collect()}
    x = Grid().whole(np.array([v for _, v in rows]))
    assert [int(got[k]) for k, _ in rows] == brute_whitening(x, 1)[0] and max(got.values()) > 1 << 63


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 6), st.integers(1, 40), st.integers(0, 10_000))
def test_merged_moments_are_those_of_all_rows(parts, rows, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(99_000, 101_000, size=(rows * parts, 4))
    whole, found = moments(x), None
    for piece in np.array_split(x, parts):
        found = merged(found, moments(piece))
    assert found.n == whole.n and found.total == whole.total
    assert np.allclose(found.mean, whole.mean, rtol=1e-13) and np.allclose(found.scatter, np.cov(x.T, ddof=0).reshape(4, 4) * len(x) if len(x) > 1 else 0, rtol=1e-9, atol=1e-6)

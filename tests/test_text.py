from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import dates, licenses, markup, text as X, urls


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(f(F.col("t")).alias("r")).first()["r"]


def test_counts_of_unicode(spark):
    t = "a b 😀\n"
    assert one(spark, t, F.length) == 6
    assert one(spark, t, X.word_count) == 2
    assert one(spark, t, lambda c: X.word_count(c, X.UNICODE_SPACE)) == 3


def test_strip_and_affixes(spark):
    assert one(spark, " \n a b\t", X.strip) == "a b"
    assert one(spark, "abc", lambda c: X.remove_prefix(c, "ab")) == "c"
    assert one(spark, "abc", lambda c: X.remove_suffix(c, "")) == "abc"
    assert one(spark, "abc", lambda c: X.remove_suffix(c, "bc")) == "a"


def test_paragraphs_join_to_the_text(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n\r😀") for _ in range(rng.randint(0, 20))) for _ in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.paragraphs(F.col("t")).alias("p"))
    for r in df.collect():
        assert "".join(r["p"]) == r["t"]
        assert all("\n" not in p[:-1] for p in r["p"])


@pytest.mark.parametrize("before, after", [("x\n\ny\nz", "x\n\ny z"), ("a\nb", "a b"), ("", "")])
def test_reflow(spark, before, after):
    assert one(spark, before, X.reflow) == after


def test_first_match_only(spark):
    assert one(spark, "a - 1 b - 2", lambda c: X.without_first(c, r"- \d+\s*")) == "a b - 2"


@pytest.mark.parametrize("t, n", [("a b", 1), ("- x\n- y\nz", 1), ("-- x", 1)])
def test_leading_list(spark, t, n):
    assert one(spark, t, X.without_leading_list) == re.sub(r"^(- [^\n]*(\n|$))+", "", t)


def test_indents(spark):
    assert one(spark, ":a\n:b\nc", X.spaced_indents) == ":a\n:b\n\nc"


def test_tag_map(spark):
    assert one(spark, ["a:b", "c:d:e", "f", "a:z"], X.tag_map, "array<string>") == {"a": "z", "c": "d"}


def test_license_rules(spark):
    assert one(spark, "https://creativecommons.org/licenses/by-sa/2.0/", licenses.parse_license) == "CC_BY_2"
    assert one(spark, "http://x/licenses/by/9.9/", licenses.parse_license) is None
    with pytest.raises(Exception, match="no such license"):
        one(spark, "nope", lambda c: licenses.parse_license(c, strict=True))
    assert one(spark, "x creativecommons.org/licenses/by-sa/3.0/ y", licenses.contained_license) == "CC_BY_SA_3"
    assert one(spark, "CC0", lambda c: licenses.license_name(licenses.catalogue_license(c, "medical"))).startswith("Creative Commons Zero")


def test_license_statement_in_the_ends_only(spark):
    middle = "\n".join(["x"] * 400 + ["CC BY 4.0"] + ["x"] * 400)
    assert one(spark, middle, licenses.states_license) is False
    assert one(spark, "CC BY 4.0\n" + middle, licenses.states_license) is True


def test_urls(spark):
    assert one(spark, "http://u:p@h:8/a/b?x#y", urls.netloc) == "u:p@h:8"
    assert one(spark, "http://u:p@h:8/a/b?x#y", urls.path) == "/a/b"
    assert one(spark, "http://a/static/x", urls.is_static) is True
    assert one(spark, "https://www.a.org/b?c=d e", urls.file_name) == "a.org_b_c_d_e"
    assert one(spark, "http://a.org/b", urls.short_file_name) == "http:__a.org_b"
    assert one(spark, "https://s/a b*~é", urls.quote) == "https://s/a%20b%2A~%C3%A9"
    assert [one(spark, x, urls.maybe_english) for x in (None, "", "en", "Unknown", "fr")] == [True, True, True, True, False]


def test_dates(spark):
    assert one(spark, "2020-01-02T03:04:05.67", dates.truncated_iso).isoformat() == "2020-01-02T03:04:05"
    assert one(spark, "a2020-01-02.xml", dates.from_name) == "2020-01-02"
    assert one(spark, "a.xml", dates.from_name) == "9999-01-01"
    row = [{"kind": "ppub", "year": 2001, "month": 2, "day": None}, {"kind": "epub", "year": 2000, "month": None, "day": None}]
    kind = "array<struct<kind:string,year:int,month:int,day:int>>"
    assert str(one(spark, row, dates.partial_date, kind)) == "2000-01-01"


def test_markup(spark):
    assert one(spark, "1 < 2 <b>x</b>", markup.strip_tags) == "1 < 2 x"
    assert one(spark, "<p>a &amp; b<script>x</script></p>", markup.page_text) == "a & b"
    assert one(spark, None, markup.page_text) is None
    assert one(spark, "a<pre>x &lt; y</pre>", markup.preformatted) == "x < y"
    assert one(spark, '<math>x</math><math display=inline>y</math>z <math display="block">u<math>v</math></math> <math>w', markup.math_to_tex) == "$$x$$$y$ z $$u<math>v</math>$$ <math>w"
    assert one(spark, "a{{b|{{c}}}}d", markup.strip_templates) == "ad"
    assert one(spark, "{{sqrt|{{frac|1|2}}}} ×", markup.wiki_math) == r"\sqrt{\frac{1}{2}} \times"
    assert one(spark, "<b>x</b>" * 20, lambda c: markup.strip_wiki_tags(c)) == "x" * 20
    assert one(spark, "<dl><dt>A:</dt><dd>b</dd></dl>", markup.definitions) == {"A": "b"}
    assert one(spark, "<d><major-heading>H</major-heading><speech speakername='S'><p>hi</p></speech><speech><table/></speech></d>", markup.debate_text) == "H\nS: hi"


def test_sections_and_leads(spark):
    assert [s["text"] for s in one(spark, "a\n# b\n# c", X.sections, "string")] == ["a", "b", "c"]
    assert one(spark, "x " * 40 + "\n# References y\n# " + "z " * 30, lambda c: F.size(X.useful_sections(X.sections(c)))) == 2
    assert one(spark, "a\n1 . One 2 . Two", X.numbered_claims) == "a\n1 . One\n2. Two"


def test_comments_and_books(spark):
    from lexmill.sources import ingest

    df = spark.createDataFrame([("[...] a",), ("a [...]",), ("a",)], "text string")
    assert [r["text"] for r in ingest.full_comments(df).collect()] == ["a"]
    books = spark.createDataFrame([("http://creativecommons.org/licenses/by/4.0", "English; French", "u"), ("x", "English", "u"), ("http://creativecommons.org/licenses/by-sa/3.0", "English", None)], "license string, language string, url string")
    assert ingest.open_books(books).count() == 1

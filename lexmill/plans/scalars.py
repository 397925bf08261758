"""Scalar functions over the tables, and over a few literal rows where the tables have no such values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .corpus import read
from ..functions import dates, licenses as L, markup, text as X, urls as U
from ..operators import relational as R
from ..sources import ingest as I

WS = r"[ \t\n\x0B\f\r]"


def literal(spark: SparkSession, sf_dir: str, rows: list, schema: str) -> DataFrame:
    """Every document with one of the rows, in turn by its id; the id is in k, the first column."""
    n = len(rows)
    kinds = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"case_of long, {schema}")
    docs = read(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(F.broadcast(kinds), F.pmod("doc_id", F.lit(n)) == F.col("case_of"))
    return joined.withColumn(kinds.columns[1], F.col("doc_id")).select(kinds.columns[1:])


def cases(rows: list, sql: str):
    """A query over :func:`literal` rows, with the SQL for the rows alone by their k."""
    return query(f"SELECT d.doc_id AS k, r.* EXCLUDE (k) FROM documents d JOIN ({sql}) r ON r.k = d.doc_id % {len(rows)} + {rows[0][0]}")


def sql_text(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(sql_text(x) if x is None or isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


URLS = [(k, u) for k, u in enumerate((
    "https://creativecommons.org/licenses/by-sa/3.0/", "http://creativecommons.org/licenses/by/4.0/", "https://creativecommons.org/licenses/by-sa/2.0/", "https://creativecommons.org/licenses/by/2.1/",
    "https://creativecommons.org/licenses/by-nc/4.0/", "https://creativecommons.org/publicdomain/zero/1.0", "https://creativecommons.org/publicdomain/foo", " HTTPS://CREATIVECOMMONS.ORG/publicdomain/mark/1.0/ ", "gfdl", "x gnu_free_documentation_license", "MIT", None,
))]


@cases(URLS, f"""WITH t(k, u) AS (VALUES {values(URLS)}), s AS (SELECT k, lower(regexp_replace(u, '^{WS}+|{WS}+$', '', 'g')) AS s FROM t), m AS (SELECT k, s, regexp_extract(s, '(?:/licenses/)?by(-sa)?/(\\d.\\d)/?', 1) AS sa, regexp_extract(s, '(?:/licenses/)?by(-sa)?/(\\d.\\d)/?', 2) AS v FROM s)
  SELECT k, CASE WHEN regexp_matches(s, '^.*/publicdomain/zero/1.0/?$') THEN 'CC0' WHEN regexp_matches(s, '^.*/publicdomain/mark/1.0/?$') THEN 'CC_PDM' WHEN regexp_matches(s, '/publicdomain/') THEN 'PD'
  WHEN v = '4.0' AND sa = '' THEN 'CC_BY' WHEN v = '4.0' THEN 'CC_BY_SA' WHEN v = '3.0' AND sa = '' THEN 'CC_BY_3' WHEN v = '3.0' THEN 'CC_BY_SA_3' WHEN v = '2.5' AND sa = '' THEN 'CC_BY_2_5' WHEN v = '2.5' THEN 'CC_BY_SA_2_5'
  WHEN v = '2.1' AND sa <> '' THEN 'CC_BY_SA_2_1' WHEN v = '2.0' THEN 'CC_BY_2' WHEN v = '1.0' AND sa <> '' THEN 'CC_BY_SA_1' WHEN s = 'gfdl' OR contains(s, 'gnu_free_documentation_license') THEN 'GFDL' END AS license FROM m""")
def license_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal(spark, sf_dir, URLS, "k long, u string").select("k", L.parse_license(F.col("u")).alias("license"))


LINKS = ("by/4.0", "by-sa/3.0", "by-nc/4.0", "none")


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a license link of every kind at their end, by id."""
    link = F.element_at(F.lit(list(LINKS)), (F.col("page_id") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "pages").withColumn("html", F.concat("html", F.lit('<a href="HTTPS://CreativeCommons.org/licenses/'), link, F.lit('">')))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'creativecommons.org/licenses/by/4.0' WHEN 1 THEN 'creativecommons.org/licenses/by-sa/3.0' WHEN 2 THEN 'creativecommons.org/licenses/by-nc/4.0' END AS license FROM pages")
def license_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_pages(spark, sf_dir).select("page_id", L.html_license(F.col("html")).alias("license"))


_STATEMENTS = ", ".join("'" + x.replace("'", "''") + "'" for x in L.STATEMENTS)


@query(f"""WITH r AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), e AS (SELECT doc_id, ls, greatest(len(ls) // 20, 150) AS n FROM r)
  SELECT doc_id, len(list_filter([{_STATEMENTS}], lambda s: contains(array_to_string(ls[:n], chr(10)) || chr(10) || array_to_string(ls[greatest(len(ls) - n + 1, 1):], chr(10)), s))) > 0 AS stated FROM e""")
def license_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", L.states_license(F.col("text")).alias("stated"))


APPROVED = [(1, []), (2, ["MIT"]), (3, ["MIT", "X"]), (4, None), (5, ["Apache-2.0", "MIT"]), (6, ["MIT", None])]


@cases(APPROVED, "SELECT * FROM (VALUES (1, true), (2, true), (3, false), (4, false), (5, true), (6, false)) t(k, kept)")
def licenses_approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal(spark, sf_dir, APPROVED, "k long, ids array<string>").select("k", L.all_approved(F.col("ids"), ["MIT", "Apache-2.0"]).alias("kept"))


MARKS = [(1, "a CC BY-NC b"), (2, "CC BY-NCX"), (3, "CC BY"), (4, "NO-CC CODE"), (5, "xCC BY-ND"), (6, "CC BY-NC-SA;")]


@cases(MARKS, f"SELECT k, regexp_matches(t, '(^|[^A-Za-z0-9_])({'|'.join(L.NOT_PERMISSIVE)})($|[^A-Za-z0-9_])') AS restrictive FROM (VALUES {values(MARKS)}) v(k, t)")
def restrictive_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal(spark, sf_dir, MARKS, "k long, t string").select("k", L.has_restrictive_mark(F.col("t")).alias("restrictive"))


KEYS = [(1, "ccby", "30"), (2, "ccby", "40"), (3, "ccbysa", "25"), (4, "ccbysa", None), (5, "gnufdl", "12"), (6, "publicdomain", None), (7, "arr", None)]


@cases(KEYS, "SELECT * FROM (VALUES (1, 'CC_BY_3'), (2, 'CC_BY'), (3, 'CC_BY_SA_2_5'), (4, 'CC_BY_SA'), (5, 'GFDL'), (6, 'PD'), (7, NULL)) t(k, license)")
def catalogue_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal(spark, sf_dir, KEYS, "k long, name string, version string").select("k", L.library_license(F.col("name"), F.col("version")).alias("license"))


@query(r"SELECT page_id, regexp_replace(html, '<[^ >][^>]*?>', '', 'g') AS text FROM pages")
def html_strip_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", markup.strip_tags(F.col("html")).alias("text"))


@query()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", markup.page_text(F.col("html")).alias("text"), markup.main_content(F.col("html")).alias("main"))


@query()
def html_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", markup.NEWS_PAGE(F.col("html")).alias("f")).select("page_id", "f.title", F.size(markup.valid_paragraphs(F.col("f.paragraphs"))).alias("paragraphs"))


def _unescaped(x: str) -> str:
    """The entities that the pages hold, in one pass: what an ampersand's own entity yields is none."""
    return f"replace(replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&'), '&amp', '&')"


@query(f"SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title, {_unescaped("nullif(regexp_extract(html, '(?is)<pre[^>]*>(.*?)</pre>', 1), '')")} AS pre FROM pages")
def html_preformatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", F.nullif(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit("")).alias("title"), markup.preformatted(F.col("html")).alias("pre"))


@query(f"SELECT page_id, {_unescaped("html")} AS html FROM pages")
def html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", markup.unescape(F.col("html")).alias("html"))


@query(r"""SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) AS netloc, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path,
  substr(regexp_replace(regexp_replace(regexp_replace(url, 'https?://(?:www\.)?', '', 'g'), '[?,=/]', '_', 'g'), '\s+', '_', 'g'), 1, 255) AS file, string_split(url, '/')[-1] AS base FROM pages""")
def url_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", U.netloc(u).alias("netloc"), U.path(u).alias("path"), U.file_name(u).alias("file"), U.base_name(u).alias("base"))


@query("""WITH h AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS n FROM pages), p AS (SELECT page_id, n, CASE WHEN page_id % 2 = 0 THEN 'wiki-' ELSE '' END AS lead FROM h)
  SELECT page_id, lead || substr(n, 1, 2) || '/' || substr(n, 3, 2) || '/' || lead || n AS folder FROM p""")
def nested_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the pages' hosts, every second one as a wiki's name."""
    name = F.concat(F.when(F.col("page_id") % 2 == 0, "wiki-").otherwise(""), U.netloc(F.col("url")))
    return read(spark, sf_dir, "pages").select("page_id", U.nested_folder(name).alias("folder"))


@query("""WITH h AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages)
  SELECT page_id, CASE WHEN ends_with(host, '.com') THEN 'fandom' WHEN ends_with(host, '.org') THEN 'wikimedia' ELSE 'archive' END AS route FROM h""")
def crawl_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of the pages' urls, with hosts of one domain taken for a farm and of another for a wiki with dumps."""
    url = F.replace(F.replace("url", F.lit("example.com"), F.lit("fandom.com")), F.lit("example.org"), F.lit("Wikipedia.org"))
    return read(spark, sf_dir, "pages").select("page_id", U.crawl_route(url).alias("route"))


DUMPS = ("a%s-history.xml.7z", "a%s.zip", "wiki-b%s-20200101-wikidump.7z", "b%s-20190101-wikidump.7z", "notes%s.txt", "d%s.xml.gz", "d%s-pages.xml")
IDENTS = ("a", "a", "b", "b", "c", "d", "d")


@query("SELECT i || doc_id AS ident, replace(f, '%s', doc_id::VARCHAR) AS name FROM documents, (VALUES ('a', 'a%s-history.xml.7z'), ('b', 'wiki-b%s-20200101-wikidump.7z'), ('d', 'd%s-pages.xml')) v(i, f)")
def best_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of seven files of four wikis for every document's id."""
    number = F.col("doc_id").cast("string")
    files = F.array(*[F.struct(F.concat(F.lit(i), number).alias("ident"), F.format_string(n, number).alias("name"), F.lit(k).alias("n")) for k, (i, n) in enumerate(zip(IDENTS, DUMPS))])
    rows = read(spark, sf_dir, "documents").select(F.explode(files).alias("x")).select("x.*")
    return R.best_by_rank(rows, "ident", R.dump_rank(F.col("name"), F.col("ident")), F.desc_nulls_last(dates.from_identifier(F.col("name"))), "n").select("ident", "name")


DATES = [(1, "05-Jan-2001"), (2, "2020-03-04"), (3, "n/a"), (4, "March 5, 2011")]


@cases(DATES, "SELECT * FROM (VALUES (1, '2001-01-05', '05-Jan-2001'), (2, NULL, '2020-03-04T00:00:00'), (3, NULL, 'n/a'), (4, NULL, '2011-03-05T00:00:00')) t(k, day, iso)")
def date_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return literal(spark, sf_dir, DATES, "k long, t string").select("k", dates.day_month_year(t).cast("string").alias("day"), dates.parse_any(t, ["yyyy-MM-dd", "MMMM d, yyyy"]).alias("iso"))


NAMES = [(1, "wiki-20200101-x", "1.2.3"), (2, "x20191231", "v1.10"), (3, "x-2018-02-03", "none"), (4, "nothing", "2.0.1-rc1")]


@cases(NAMES, "SELECT * FROM (VALUES (1, '2020-01-01', 1, 2, 3), (2, '2019-12-31', 1, 10, 0), (3, '2018-02-03', 0, 0, 0), (4, NULL, 2, 0, 1)) t(k, day, major, minor, patch)")
def identifier_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = literal(spark, sf_dir, NAMES, "k long, n string, v string")
    return rows.select("k", dates.from_identifier(F.col("n")).cast("string").alias("day"), dates.version_parts(F.col("v")).alias("p")).select("k", "day", "p.*")


@query("""SELECT conv_id, turn, '[10:01] <' || role || '> ' || trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS text, [role] AS authors FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL""")
def chat_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of the conversations as it would stand in a chat's log, between announcements, bots and relays."""
    said = F.trim(F.regexp_replace("text", X.SPACE + "+", " "))
    line = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("[10:01] <"), "role", F.lit("> "), said)).otherwise(F.concat(F.lit("[10:01] <tg> [telegram] <"), "role", F.lit(">: "), said))
    log = F.concat(F.lit("=== joined\n[10:00] <ubottu> hi\n"), line, F.lit("\n[10:02] <kubot> bye"))
    rows = read(spark, sf_dir, "conversations").filter("text IS NOT NULL AND role IS NOT NULL").select("conv_id", "turn", X.clean_chat(log).alias("text"))
    return rows.select("conv_id", "turn", "text", X.chat_authors(F.col("text")).alias("authors"))


@query(f"""SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x = '' OR starts_with(x, '\\') OR len(list_filter(string_split_regex(x, '{WS}+'), lambda w: w <> '')) > 1), chr(10)) AS text FROM documents""")
def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", X.prose_lines(F.col("text")).alias("text"))


@query("SELECT doc_id, replace(text, chr(10), ' ') AS flat, regexp_replace(replace(text, chr(10), chr(10) || chr(10) || chr(10)), '\\n\\n+', chr(10) || chr(10), 'g') AS loose FROM documents")
def reflow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.replace("text", F.lit("\n"), F.lit("\n\n\n"))
    return read(spark, sf_dir, "documents").select("doc_id", X.reflow(F.col("text")).alias("flat"), X.collapse_blank_lines(wide).alias("loose"))


@query("SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS section, unnest(string_split(text, chr(10))) AS text FROM documents")
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(X.sections(F.col("text"), "\n")).alias("s")).select("doc_id", "s.section", "s.text")


@query("""WITH p AS (SELECT doc_id, source AS title, CASE WHEN lang = 'en' THEN text END AS abstract, CASE WHEN source < 'src10' THEN text END AS description, CASE WHEN lang = 'fr' THEN upper(source) END AS claims FROM documents)
  SELECT doc_id, title || chr(10) || chr(10) || coalesce('ABSTRACT' || chr(10) || chr(10) || abstract, '') || chr(10) || chr(10) || coalesce(description, '') || chr(10) || chr(10) || coalesce(claims, '') AS text FROM p WHERE coalesce(abstract, description, claims) IS NOT NULL""")
def patent_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as patents, of which some lack parts and some all."""
    part = lambda when, what: F.when(when, what)
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("title"), part(F.col("lang") == "en", F.col("text")).alias("abstract"), part(F.col("source") < "src10", F.col("text")).alias("description"), part(F.col("lang") == "fr", F.upper("source")).alias("claims")
    )
    return R.patent_text(docs).select("doc_id", "text")


@query("SELECT doc_id, regexp_replace('<p>' || text || '</p>', '<.+?>', '', 'g') AS text FROM documents WHERE doc_id % 2 = 0 OR lang = 'en'")
def opinion_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit("<p>"), "text", F.lit("</p>"))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, wrapped).alias("html"), F.when(F.col("lang") == "en", wrapped).alias("plain_text"))
    return R.opinion_text(docs).select("doc_id", "text")


RECORDS = [("0", "Rule", "2020", "T", "a,b", "x/1.pdf,y.txt"), ("1", "Notice", "2021", "U", "c", None), ("2", "Other", "2022", "V", None, None)]


@query("SELECT doc_id::VARCHAR AS document_id, CASE doc_id % 3 WHEN 0 THEN 'T' ELSE 'U' END AS title, CASE doc_id % 3 WHEN 0 THEN ['a', 'b'] ELSE []::VARCHAR[] END AS topics, CASE doc_id % 3 WHEN 0 THEN ['.pdf', '.txt'] ELSE []::VARCHAR[] END AS exts FROM documents WHERE doc_id % 3 < 2")
def kept_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = literal(spark, sf_dir, RECORDS, "`Document ID` string, `Document Type` string, `Posted Date` string, Title string, Topics string, `Content Files` string")
    rows = rows.withColumn("Document ID", F.col("Document ID").cast("string"))
    return R.kept_record(rows).select("document_id", "title", "topics", F.col("files.ext").alias("exts"))


PAGES = [(1, "http://a/lyrics", None, "t", "s"), (2, "http://ideas.fandom.com/lyric", None, "t", "s"), (3, "u", None, "Lyrical poetry", "s"), (4, "u", None, "Lyrical", "thpatch"), (5, None, None, "Transcript of x", "naruto"), (6, "http://familysearch.org/transcript", None, "t", "s"), (7, None, None, "transcription seal", "wiki-naruto")]


@cases(PAGES, "SELECT * FROM (VALUES (1, false, true), (2, true, true), (3, true, true), (4, false, true), (5, true, false), (6, true, true), (7, true, true)) t(k, song, transcript)")
def wiki_page_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = [F.col(x) for x in ("url", "dump", "title", "source")]
    return literal(spark, sf_dir, PAGES, "k long, url string, dump string, title string, source string").select("k", R.without_lyrics(*c).alias("song"), R.without_transcripts(*c).alias("transcript"))


@query("SELECT doc_id FROM documents WHERE ('0x' || substr(sha256(doc_id::VARCHAR), 61, 4))::INT % 4 = 1")
def hash_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").filter(R.slice_of(F.col("doc_id").cast("string"), 4, 1)).select("doc_id")


WIKI = [(1, "lead\n== One ==\na b\n== References ==\nr\n"), (2, "only"), (3, ":x y\nz")]


@cases(WIKI, "SELECT * FROM (VALUES (1, 'T' || repeat(chr(10), 2) || 'lead' || chr(10) || repeat(chr(10), 2) || 'One' || repeat(chr(10), 2) || 'a b' || chr(10)), (2, 'T' || repeat(chr(10), 2) || 'only'), (3, 'T' || repeat(chr(10), 2) || ':x y' || chr(10) || 'z')) t(k, text)")
def wiki_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal(spark, sf_dir, WIKI, "k long, t string").select("k", X.format_sections(F.lit("T"), markup.wiki_sections(F.col("t"))).alias("text"))


TEMPLATES = [(1, "a {{math|x}} b {{ Sqrt |2}}"), (2, "{{math|y}} {{cite\n|u}}"), (3, None)]


@query("SELECT template, count(*) AS n FROM documents d JOIN (VALUES (1, 'math'), (1, 'sqrt'), (2, 'math'), (2, 'cite')) v(k, template) ON v.k = d.doc_id % 3 + 1 GROUP BY template")
def template_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = literal(spark, sf_dir, TEMPLATES, "k long, t string")
    return rows.select(F.explode(markup.template_names(F.col("t"))).alias("template")).groupBy("template").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT client_id, CASE client_id % 4 WHEN 3 THEN trim(regexp_replace(name, '\\s+', ' ', 'g')) || ', ' || upper(city) ELSE trim(regexp_replace(name, '\\s+', ' ', 'g')) END AS author FROM clients WHERE name IS NOT NULL AND city IS NOT NULL""")
def author_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients' names as bylines: with a lead-in and a role, with a title below, or as scholars of two universities."""
    name, city = F.col("name"), F.col("city")
    kinds = [F.concat(F.lit("By "), name), F.concat(F.lit("Written by  "), name, F.lit(" Contributor")), F.concat(F.lit("Authors "), name, F.lit("\nEditor\tof "), city), F.concat(name, F.lit(", Foo University; "), F.upper(city), F.lit(", Bar University"))]
    clients = read(spark, sf_dir, "clients").filter("name IS NOT NULL AND city IS NOT NULL")
    return clients.select("client_id", X.clean_author(F.element_at(F.array(*kinds), (F.col("client_id") % 4 + 1).cast("int"))).alias("author"))


@query(f"SELECT doc_id, regexp_replace(text, '^{WS}+|{WS}+$', '', 'g') AS text FROM documents")
def book_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as e-books between the lines that start and end them; every third is bare."""
    framed = F.concat(F.lit("junk\n*** START OF THE PROJECT GUTENBERG EBOOK "), "source", F.lit(" ***\n\n"), "text", F.lit("\n*** END OF THE PROJECT GUTENBERG EBOOK ***\nmore"))
    return read(spark, sf_dir, "documents").select("doc_id", X.strip_book(F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(framed)).alias("text"))


@query("""SELECT doc_id, list_sort([source || ' Wu', lang]) AS authors, CASE WHEN doc_id % 5 > 0 THEN '2001-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') END AS created, 'see PEP 8' || chr(10) || text AS body FROM documents""")
def proposal_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as proposals with a head; every fifth without a date."""
    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    created = F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("Created: "), day, F.lit("-Jan-2001\n"))).otherwise("")
    head = F.concat(F.lit("PEP: 1\nAuthor: "), "source", F.lit(" Wu <b@x>,\n        "), "lang", F.lit("\nStatus: Final\n"), created, F.lit("\n"))
    t = F.col("t")
    rows = read(spark, sf_dir, "documents").select("doc_id", F.concat(head, F.lit("see :pep:`8`\n"), "text").alias("t"))
    body = F.substr(X.proposal_links(t), F.instr(X.proposal_links(t), "see PEP"))
    return rows.select("doc_id", X.proposal_authors(t).alias("authors"), dates.day_month_year(X.proposal_created(t)).cast("string").alias("created"), body.alias("body"))


#: In RE2, without looking ahead: words as they are, and of white space a run of two or more, one whose last is no space, and one at the end.
@query(r"""SELECT doc_id, (len(regexp_extract_all(text, '\x27(?:s|t|re|ve|m|ll|d)| ?\pL+| ?\pN+| ?[^\s\pL\pN]+')) + len(regexp_extract_all(text, '\s\s+[^\s]')) + len(regexp_extract_all(text, '[\t\n\f\r][^\s]')) + regexp_matches(text, '\s$')::INT)::BIGINT AS n FROM documents""")
def pretokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.size(X.pretokens(F.col("text"), "gpt2")).cast("long").alias("n"))


RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:p="http://p/" xmlns:d="http://d/"><p:ebook rdf:about="ebooks/{k}"><d:title>T{k}</d:title><d:rights>{r}</d:rights><d:language><v>en</v></d:language>
<p:file rdf:about="f{k}.zip"><d:format><v>text/plain</v></d:format></p:file><p:file rdf:about="f{k}-0.txt"><d:format><v>text/plain; charset=utf-8</v></d:format></p:file><p:file rdf:about="f{k}.txt"><d:format><v>text/plain; charset=us-ascii</v></d:format></p:file></p:ebook></rdf:RDF>"""


@query("SELECT doc_id::VARCHAR AS id, 'T' || doc_id AS title, 'f' || doc_id || '-0.txt' AS file FROM documents WHERE lang = 'en'")
def book_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A description for every document: in the public domain where it is English, broken where it is French."""
    rights = F.when(F.col("lang") == "en", "Public domain in the USA.").otherwise("Copyrighted.")
    made = F.replace(F.replace(F.lit(RDF), F.lit("{k}"), F.col("doc_id").cast("string")), F.lit("{r}"), rights)
    return I.public_books(I.catalogue_rows(read(spark, sf_dir, "documents").select(F.when(F.col("lang") == "fr", "<broken").otherwise(made).alias("text")))).select("id", "title", "file")


@query("SELECT doc_id, lang AS language FROM documents WHERE lang = 'en' AND n_chars >= 1500")
def catalogue_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", "English").otherwise(F.col("lang")).alias("language"), F.col("n_chars").alias("year"))
    return I.old_english_books(books).select("doc_id", F.lit("en").alias("language"))


@query("SELECT d.doc_id, [n.r, 'x'] AS license, 'u2' AS license_url FROM documents d JOIN (SELECT DISTINCT source, 'L-' || source AS r FROM documents) n USING (source)")
def dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("dataset_id"))
    entry = lambda name, url: F.struct(name.alias("name"), F.lit(url).alias("url"))
    sets = docs.select("dataset_id").distinct().select("dataset_id", F.array(entry(F.concat(F.lit("L-"), "dataset_id"), "u1"), entry(F.lit("x"), "u2")).alias("licenses"), F.array(F.lit("en")).alias("languages"), F.lit("d").alias("url"))
    return I.with_dimensions(docs, sets).select("doc_id", "license", "license_url")


@query("SELECT doc_id, quality = 1 AS good, quality IS NOT NULL AS tagged FROM documents LEFT JOIN labels USING (doc_id)")
def attribute_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import spans as S

    side = read(spark, sf_dir, "labels").select("doc_id", F.create_map(F.lit("quality"), F.array(S.span(F.lit(0), F.lit(1), F.col("quality").cast("double")))).alias("attributes"))
    joined = I.with_attributes(read(spark, sf_dir, "documents"), [side], "doc_id")
    score = S.first_score(F.try_element_at("attributes", F.lit("quality")))
    return joined.select("doc_id", (score == 1).alias("good"), score.isNotNull().alias("tagged"))


@query("SELECT url FROM pages WHERE page_id % 4 < 2 GROUP BY url")
def licensed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.licensed_pages(linked_pages(spark, sf_dir)).select("url")


@query("SELECT doc_id::VARCHAR AS id, 'chats' AS source FROM documents")
def chat_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("text", *[F.lit(None).cast("string").alias(c) for c in ("year", "month", "day")], F.col("doc_id").cast("string").alias("channel"))
    return I.format_chats(rows, F.lit("2024-01-01")).select(F.replace("id", F.lit("#"), F.lit("")).alias("id"), "source")

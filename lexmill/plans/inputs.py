"""Sources and sinks on the tables: what is written in a format is read back; and page, record and revision rules over every document."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import query
from .corpus import WORDS, documents, read
from ..functions import markup, text as X, urls as U
from ..operators import chunks, dedupe, relational as R, spans as S, taggers
from ..operators.mix import Condition, MixSpec, mix, recipe
from ..session import scratch
from ..sources import documents as D
from ..sources import files
from ..sources import ingest as I

# files


@query("SELECT doc_id::VARCHAR AS id, text, source FROM documents")
def jsonl_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document shards of some 100 kB, in order, written and read."""
    path = scratch(spark, "shards")
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), "text", "source")
    D.write_documents(docs, path, "a.jsonl", order="doc_id", shard_bytes=100_000)
    return D.read_documents(spark, path, pattern="*/*.gz").select("id", "text", "source")


def _mixed_lines(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a line for every document: JSON, or a text that is none."""
    path = scratch(spark, "lines")
    line = F.when(F.col("doc_id") % 2 == 0, F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text"))).otherwise(F.concat(F.lit("{"), F.replace("text", F.lit("\n"), F.lit(" "))))
    read(spark, sf_dir, "documents").select(line.alias("value")).write.option("compression", "gzip").text(D.output_path(path))
    return path


@query("SELECT doc_id::VARCHAR AS id, text FROM documents WHERE doc_id % 2 = 0")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.read_documents(spark, _mixed_lines(spark, sf_dir), pattern="*.gz").select("id", "text")


@query("SELECT '{' || replace(text, chr(10), ' ') AS line FROM documents WHERE doc_id % 2 = 1")
def bad_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.bad_lines(spark, _mixed_lines(spark, sf_dir), "*.gz").select("line")


@query("SELECT doc_id::VARCHAR AS doc_id, text, lang FROM documents")
def csv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "table")
    read(spark, sf_dir, "documents").select("doc_id", "text", "lang").write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)
    return files.read_table(spark, path)


@query("SELECT url, html FROM pages WHERE url IS NOT NULL AND html IS NOT NULL")
def web_archive_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web archives of all pages, compressed and not, each with records of requests between, read back record by record."""
    path = scratch(spark, "archives")
    record = lambda kind, body: F.concat(F.lit(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: "), "url", F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)
    page = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), "html")
    both = F.concat(record("request", F.lit("GET / HTTP/1.1\r\n")), F.lit("\r\n\r\n"), record("response", page))
    rows = read(spark, sf_dir, "pages").filter("url IS NOT NULL AND html IS NOT NULL").select("page_id", both.alias("value"))
    for kind, half in (("gzip", 0), ("none", 1)):
        part = rows.filter(F.pmod("page_id", F.lit(2)) == half).select("value")
        part.write.option("lineSep", "\r\n\r\n").option("compression", kind).text(f"{path}/{kind}")
    return I.read_web_archives(spark, f"{path}/*/part-*").select("url", "html")


#: Bytes of markup in a file, on average.
XML_BYTES = 8 << 20


def _xml_files(rows: DataFrame, path: str, root: str) -> None:
    """Files with a root each, around rows of markup (value, k): eight, or as many as keep them at some XML_BYTES."""
    size = rows.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    whole = F.concat(F.lit(f"<{root}>"), F.array_join(F.collect_list("value"), ""), F.lit(f"</{root.split(' ')[0]}>"))
    file = F.pmod(F.xxhash64("k"), F.lit(max(8, -(-size // XML_BYTES))))
    rows.groupBy(file.alias("file")).agg(whole.alias("value")).write.partitionBy("file").text(path)


def _markup(value: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;")):
        value = F.replace(value, F.lit(plain), F.lit(entity))
    return value


@query("SELECT doc_id::VARCHAR AS Id, source AS Source, text AS Body FROM documents")
def xml_attribute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "rows")
    row = F.concat(F.lit('<row Id="'), F.col("doc_id").cast("string"), F.lit('" Source="'), _markup(F.col("source")), F.lit('" Body="'), _markup(F.col("text")), F.lit('"/>'))
    _xml_files(read(spark, sf_dir, "documents").select(row.alias("value"), F.col("doc_id").alias("k")), path, "posts")
    return files.read_attribute_rows(spark, path, ["Id", "Source", "Body"])


@query("SELECT doc_id AS id, lang, len(string_split(text, chr(10))) AS n FROM documents")
def xml_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with a namespace, from several files at once."""
    paths = [scratch(spark, "elements") for _ in range(2)]
    lines = F.transform(X.lines(F.col("text")), lambda x: F.concat(F.lit("<x:line>"), _markup(x), F.lit("</x:line>")))
    docs = read(spark, sf_dir, "documents").withColumn("value", F.concat(F.lit("<x:doc><x:id>"), F.col("doc_id").cast("string"), F.lit("</x:id><x:lang>"), "lang", F.lit("</x:lang>"), F.array_join(lines, ""), F.lit("</x:doc>")))
    for k, path in enumerate(paths):
        _xml_files(docs.filter(F.pmod("doc_id", F.lit(2)) == k).select("value", F.col("doc_id").alias("k")), path, 'x:all xmlns:x="http://x/"')
    return files.read_xml(spark, [f"{path}/*" for path in paths], "doc", "id long, lang string, line array<string>").select("id", "lang", F.size("line").cast("long").alias("n"))


@query("SELECT n_nationkey::VARCHAR AS number, n_name AS text FROM nation")
def texts_with_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "texts")
    read(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("n")).write.partitionBy("n").text(path)
    return files.read_texts(spark, f"{path}/*/*.txt").select(*files.path_parts(F.col("file"), r"/n=(\d+)/[^/]+\.txt$", ["number"]), X.strip(F.col("text")).alias("text"))


@query("SELECT doc_id, text, text AS found FROM documents")
def decoded_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in UTF-8, or in Latin-1 where the id is odd, by fallback; and in one of four encodings, by detection."""
    raw = F.when(F.col("doc_id") % 2 == 1, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    other = F.element_at(F.array(F.encode("text", "UTF-8"), F.encode("text", "ISO-8859-1"), F.encode("text", "UTF-16"), F.encode("text", "UTF-16LE")), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    docs = read(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"), other.alias("other"))
    return docs.select("doc_id", files.decoded(F.col("raw"), "ISO-8859-1").alias("text"), files.detected(F.col("other")).alias("found"))


@query("""SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS line_number, doc_id::VARCHAR AS id, regexp_replace(text, '[0-9]', '#', 'g') AS text, NOT regexp_matches(text, '[0-9]') AS unchanged FROM documents""")
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of each source, read back with the file and line that every row came from; digits are masked, and texts without any marked."""
    path = scratch(spark, "origin")
    line = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text", "source"))
    rows = read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("folder"), line.alias("value"))
    rows.repartition("folder").sortWithinPartitions("folder", "doc_id").select("value", "folder").write.partitionBy("folder").option("compression", "gzip").text(path)
    found = D.read_with_origin(spark, f"{path}/*/*.gz")
    masked = D.with_text(found, F.regexp_replace("text", "[0-9]", "#"))
    return masked.select(F.regexp_extract("file", "folder=([^/]+)/", 1).alias("source"), "line_number", "id", "text", "unchanged")


@query("SELECT n_nationkey, n_name FROM nation")
def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document for every region, which lists its nations."""
    path = scratch(spark, "pages")
    pages = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("results"))
    pages.select(F.to_json(F.struct("results")).alias("value"), "n_regionkey").write.partitionBy("n_regionkey").text(path)
    return files.read_nested_pages(spark, f"{path}/*", schema="results array<struct<n_nationkey: int, n_name: string>>").select("n_nationkey", "n_name")


def _archive(members: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as tar:
        for name, text in members.items():
            raw = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
    return out.getvalue()


def _packed(rows: DataFrame) -> DataFrame:
    """An archive for every row (file, main, part) with two TeX files and another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"file": pdf["file"], "content": [_archive({"main.tex": m, "part.tex": p, "readme": "x"}) for m, p in zip(pdf["main"], pdf["part"])]})

    return rows.mapInPandas(run, "file string, content binary")


@query(r"SELECT doc_id::VARCHAR AS article, 'a ' || text || ' b' AS text FROM documents")
def interpolated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of TeX files, unpacked, and put together."""
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), F.lit("\\begin{document}a \\input{part} b\\end{document}").alias("main"), F.col("text").alias("part"))
    members = files.archive_members(_packed(rows), ".tex", only=2)
    docs = files.interpolated(members.select(F.col("file").alias("article"), "member", F.col("content").cast("string").alias("text")))
    return docs.select("article", files.tex_body(F.col("text")).alias("text"))


@query("SELECT replace(text, chr(10), '<n>') AS line FROM documents")
def trainer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "lines")
    D.write_lines(read(spark, sf_dir, "documents"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT DISTINCT doc_id FROM conversations JOIN documents ON conv_id = doc_id")
def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id")), "doc_id")
    return D.id_list(docs, "doc_id")


@query("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def rows_without_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return D.without_nulls(docs, "quality").select("doc_id", "quality")


@query("SELECT doc_id, CASE WHEN starts_with(source, 'src1') THEN substr(source, 5) ELSE source END AS head, CASE WHEN ends_with(source, '0') THEN left(source, length(source) - 1) ELSE source END AS tail, source AS whole FROM documents")
def affixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("source")
    return read(spark, sf_dir, "documents").select("doc_id", X.remove_prefix(s, "src1").alias("head"), X.remove_suffix(s, "0").alias("tail"), X.remove_suffix(s, "").alias("whole"))


@query("SELECT doc_id, source AS origin, 'PD' AS license, TRY_CAST(substr(source, 4) AS INT) AS number FROM documents")
def renamed_and_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumnRenamed("source", "origin").withColumn("license", F.lit("PD"))
    return docs.select("doc_id", "origin", "license", F.substr("origin", F.lit(4)).try_cast("int").alias("number"))


@query("SELECT doc_id FROM documents ORDER BY md5('seed' || doc_id), doc_id LIMIT 50")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty documents of a seeded shuffle: the limit is the feature."""
    return read(spark, sf_dir, "documents").orderBy(F.md5(F.concat(F.lit("seed"), F.col("doc_id").cast("string"))), "doc_id").limit(50).select("doc_id")


# pages and records


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 1")
def open_publication_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals with a copyright section of either kind behind the text."""
    section = F.concat("text", F.lit("\n\nCopyright\n=========\n\n"), F.when(F.col("doc_id") % 2 == 1, "Under the Open Publication License.").otherwise("In the public domain."), F.lit("\n"))
    return read(spark, sf_dir, "documents").filter(X.has_open_publication_license(section)).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 3 <> 0")
def parseable_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without the titles that are too large, without redirects, and without revisions or their text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, R.SKIP_TITLES[0]).otherwise(F.col("source")).alias("title"), F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("text"), F.when(F.col("doc_id") % 3 == 0, "Elsewhere").alias("redirect"))
    return docs.filter(R.parseable(F.col("title"), F.col("text"), F.col("redirect"))).select("doc_id")


@query("SELECT doc_id, lang IN ('en', 'xx') AS kept FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'xx' ELSE lang END AS lang FROM documents)")
def maybe_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of English stay, and those that say nothing."""
    silent = F.when(F.col("doc_id") % 8 == 0, F.lit(None)).otherwise("Unknown")
    docs = read(spark, sf_dir, "documents").withColumn("code", F.when(F.col("doc_id") % 4 == 0, silent).when(F.col("lang") == "en", "en-gb").otherwise(F.col("lang")))
    return docs.select("doc_id", U.maybe_english(F.col("code")).alias("kept"))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 < 2 AND lang = 'en' AND doc_id % 4 <> 0")
def open_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    license = F.when(F.col("doc_id") % 3 == 0, "https://creativecommons.org/licenses/by/4.0/").when(F.col("doc_id") % 3 == 1, "CreativeCommons.org/licenses/by-sa/3.0").otherwise("https://creativecommons.org/licenses/by-nc/4.0/")
    rows = read(spark, sf_dir, "documents").select("doc_id", license.alias("license"), F.when(F.col("lang") == "en", "German; English").otherwise("French").alias("language"), F.when(F.col("doc_id") % 4 != 0, F.lit("u")).alias("url"))
    return I.open_books(rows).select("doc_id")


@query("""WITH s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS section FROM documents)
  SELECT doc_id, section, text FROM s WHERE length(text) >= 50 AND NOT regexp_matches(text, '^#*\\s*\\**Th')""")
def useful_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = X.useful_sections(X.sections(F.col("text"), "\n"), 50, r"^#*\s*\**Th")
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(parts).alias("s")).select("doc_id", "s.section", "s.text")


@query("SELECT page_id, page_id % 3 = 0 AS static FROM pages")
def static_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lead = F.when(F.col("page_id") % 3 == 0, "http://h.org/static/").otherwise("http://h.org/en/static/")
    return read(spark, sf_dir, "pages").select("page_id", U.is_static(F.concat(lead, U.base_name(F.col("url")))).alias("static"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'u1' WHEN 1 THEN 'u2' ELSE 'u1' END AS uri, CASE doc_id % 3 WHEN 2 THEN NULL ELSE source END AS license FROM documents")
def first_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries are read until there is a uri and a license."""
    entry = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    one, two, own = entry("uri", F.lit("u1")), entry("uri", F.lit("u2")), entry("license", F.col("source"))
    entries = F.when(F.col("doc_id") % 3 == 0, F.array(one, own, two)).when(F.col("doc_id") % 3 == 1, F.array(one, two, own, one)).otherwise(F.array(entry("other", F.lit("x")), one))
    return read(spark, sf_dir, "documents").select("doc_id", R.first_pair(entries).alias("p")).select("doc_id", "p.uri", "p.license")


@query("SELECT conv_id, max_by(text, turn) AS text, max(turn)::BIGINT AS date, list_sort(list(DISTINCT role)) AS authors, [max_by(role, turn)] AS last_author FROM conversations GROUP BY conv_id")
def latest_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    revision = F.struct(F.col("turn").cast("long").alias("date"), "text", F.col("role").alias("author"))
    pages = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(revision)).alias("r"))
    every, last = R.latest_revision(F.col("r")), R.latest_revision(F.col("r"), every_author=False)
    return pages.select("conv_id", every["text"].alias("text"), every["date"].alias("date"), every["authors"].alias("authors"), last["authors"].alias("last_author"))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def full_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("[...] "), "text")).when(F.col("doc_id") % 3 == 2, F.concat("text", F.lit(" [...]"))).otherwise(F.col("text"))
    return I.full_comments(read(spark, sf_dir, "documents").withColumn("text", cut)).select("doc_id")


@query("SELECT doc_id, source AS a, lang AS b, NULL AS c FROM documents")
def tag_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array(F.lit("a:old"), F.concat(F.lit("b:"), "lang", F.lit(":more")), F.lit("none"), F.concat(F.lit("a:"), "source"))
    of = lambda k: F.try_element_at("m", F.lit(k)).alias(k)
    return read(spark, sf_dir, "documents").select("doc_id", X.tag_map(tags).alias("m")).select("doc_id", of("a"), of("b"), of("c"))


@query("SELECT doc_id, 'On ' || source || chr(10) || 'Ann: ' || replace(replace(text, chr(10), ' '), '    ', '') || chr(10) || 'Hear, hear' AS text FROM documents")
def debates(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = _markup(F.replace("text", F.lit("\n"), F.lit(" ")))
    xml = F.concat(F.lit("<x><major-heading>On "), "source", F.lit('</major-heading><speech speakername="Ann"><p>'), said, F.lit("</p></speech><speech><table><tr><td>1</td></tr></table></speech><speech><p>Hear, hear</p></speech></x>"))
    return read(spark, sf_dir, "documents").select("doc_id", markup.debate_text(xml).alias("text"))


@query("SELECT doc_id, trim(source || ' ' || lang, ' ') AS text FROM documents")
def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", I.instruction_text(F.concat(F.lit(" \n"), "source"), F.concat(F.lit(" "), "lang", F.lit("\t"))).alias("text"))


@query(r"SELECT doc_id, regexp_replace('Page ID 12' || chr(10) || text || ' - 7 - 8', ' - \d+\s*', '') AS text FROM documents")
def first_mark_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(F.lit("Page ID 12\n"), "text", F.lit(" - 7 - 8"))
    return read(spark, sf_dir, "documents").select("doc_id", X.without_first(marked, r" - \d+\s*").alias("text"))


# wikitext


@query("SELECT doc_id, '$$' || source || '$$ $' || lang || '$  <math>' || text AS text FROM documents")
def wiki_math_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    wiki = F.concat(F.lit("<math>"), "source", F.lit('</math> <math display="inline">'), "lang", F.lit("</math> <math>"), "text")
    return read(spark, sf_dir, "documents").select("doc_id", markup.math_to_tex(wiki).alias("text"))


@query(r"""SELECT doc_id, '\sqrt{' || source || '^{2}}+\overline{\mathbb{R}}_{' || lang || '} \frac{1}{\pi} f((x+1)) |y| {{cite|' || source || '}} ' || trim(replace(text, chr(10), ' '), ' ') AS text FROM documents""")
def wiki_math_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates within templates; brackets of the text's own stay."""
    wiki = F.concat(F.lit("{{radic|"), "source", F.lit("<sup>2</sup>}}+{{overline|{{mathbb|{{nowrap|R}}}}}}<sub>"), "lang", F.lit("</sub> {{sfrac|1|{{Pi}}}} f((x+1)) {{abs|y}} {{cite|"), "source", F.lit("}} "), F.trim(F.replace("text", F.lit("\n"), F.lit(" "))))
    return read(spark, sf_dir, "documents").select("doc_id", markup.wiki_math(wiki).alias("text"))


@query("SELECT doc_id, source || text AS text FROM documents")
def wiki_templates_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wiki = F.concat("source", F.lit("{{box|{{a|b}}|c}}"), "text", F.lit("{{end}}"))
    return read(spark, sf_dir, "documents").select("doc_id", markup.strip_templates(wiki).alias("text"))


@query("SELECT doc_id, ':a' || chr(10) || '::b' || chr(10) || chr(10) || text AS text FROM documents")
def wiki_indents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", X.spaced_indents(F.concat(F.lit(":a\n::b\n"), "text")).alias("text"))


@query("SELECT doc_id, source || chr(10) || chr(10) || 'lead $$x$$' || chr(10) || chr(10) || 'Body' || chr(10) || chr(10) || replace(text, chr(10), ' ') AS text FROM documents")
def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Math, templates and sections together, as a page is prepared."""
    wiki = F.concat(F.lit("lead <math>x</math>{{cite|1}}\n== Body ==\n"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("\n== References ==\nr"))
    pages = read(spark, sf_dir, "documents").withColumn("wiki", markup.strip_templates(markup.math_to_tex(wiki)))
    parts = F.transform(markup.wiki_sections(F.col("wiki")), lambda s: F.struct(s.title.alias("title"), X.strip(s.text).alias("text")))
    return pages.select("doc_id", X.format_sections(F.col("source"), parts).alias("text"))


@query(r"SELECT page_id, regexp_replace(html, '<(?:[a-zA-Z/]|\?xml|\?php|!--)[^>]{0,500}>', '', 'g') AS text FROM pages")
def wiki_tags_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", markup.strip_wiki_tags(F.col("html")).alias("text"))


# filters and rewriting


def _kept(docs: DataFrame, **rules) -> DataFrame:
    return mix(docs, recipe("q", **({"duplicate": False} | rules))).select("doc_id")


@query("SELECT doc_id FROM documents QUALIFY NOT doc_id > min(doc_id) OVER (PARTITION BY text)")
def duplicate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose duplicate score is 0.9 or more go; so do exact ones by the rule of their own."""
    docs = read(spark, sf_dir, "documents")
    score = F.array(S.span(F.lit(0), F.lit(1), F.col("score")))
    scored = docs.join(dedupe.exact_duplicates(docs), "doc_id").withColumns({"duplicate_ngrams": score, "duplicate_documents": score})
    return _kept(scored, duplicate=True, exact=True)


@query(f"""WITH w AS (SELECT doc_id, unnest({WORDS.replace("text", "lower(text)")}) AS word FROM documents), c AS (SELECT word, count(*)::DOUBLE AS n FROM w GROUP BY word), t AS (SELECT sum(n) AS total FROM c),
  s AS (SELECT doc_id, avg(log2(c.n) - log2(total)) AS p FROM w JOIN c USING (word) CROSS JOIN t GROUP BY doc_id) SELECT d.doc_id FROM documents d LEFT JOIN s USING (doc_id) WHERE coalesce(s.p, 0) > -13""")
def log_probability_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    counts = docs.select(F.explode(X.words(F.lower("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    scored = docs.join(taggers.mean_log_probability(docs, taggers.unigram_table(counts)), "doc_id").withColumn("logprob", S.whole(F.col("text"), F.col("logprob")))
    return mix(scored, MixSpec("q", (Condition("attributes", "logprob", "<=", -13),))).select("doc_id")


@query("""WITH s AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents) SELECT doc_id FROM s WHERE list_max(list_transform(ls, lambda x: length(x))) <= 1000 AND (length(text) - len(ls) + 1) / len(ls) <= 100
  AND length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) / length(text) >= 0.25 AND length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / len(list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) >= 1.5""")
def code_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(read(spark, sf_dir, "documents"), code=True)


@query("SELECT doc_id FROM documents WHERE source NOT IN ('src01', 'src02') AND NOT starts_with(lang, 'f')")
def metadata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("metadata", F.struct(F.col("source").alias("language"), F.concat(F.when(F.col("lang").startswith("f"), "User talk:").otherwise("Page "), "lang").alias("title")))
    return _kept(docs, more=(Condition("metadata", "language", "in", ("src01", "src02")), Condition("metadata", "title", "startswith", "User talk")))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def restricted_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages go whose attributes name a license without commerce or derivatives."""
    name = F.when(F.col("doc_id") % 3 == 1, "cc_re__by_nc_4__x").when(F.col("doc_id") % 3 == 2, "cc_re__by_nd_4__x").otherwise("cc_re__by_4__x")
    docs = read(spark, sf_dir, "documents").withColumn("attributes", F.create_map(name, S.no_spans()))
    return docs.filter(~I.restricted_attributes(F.col("attributes"))).select("doc_id")


SENTENCE = r"[^.!?\n]+[.!?\n]*"


@query("SELECT doc_id, coalesce(array_to_string(list_filter(regexp_extract_all(text, '^[.!?\\n]+|[^.!?\\n]+[.!?\\n]*'), lambda x: NOT contains(x, 'the')), ''), '') AS text FROM documents")
def toxic_sentences_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that a model scores are cut; this one's word is common, so that most texts lose some."""
    word, none = taggers.sentence_model(lambda s: float("the" in s), SENTENCE), taggers.sentence_model(lambda s: 0.0, SENTENCE)
    with taggers.registered(toxic_sentence=word, nsfw_sentence=none):
        return mix(read(spark, sf_dir, "documents"), recipe("q", duplicate=False, toxic=True)).select("doc_id", "text")


@query("""WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '([^\\n]*\\n|[^\\n]+)')) AS line, generate_subscripts(regexp_extract_all(text, '([^\\n]*\\n|[^\\n]+)'), 1) AS k FROM documents)
  SELECT d.doc_id, coalesce(string_agg(line, '' ORDER BY k) FILTER (WHERE len(list_filter(string_split_regex(line, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')) >= 3), '') AS text FROM documents d LEFT JOIN p USING (doc_id) GROUP BY d.doc_id""")
def short_lines_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), recipe("q", duplicate=False, lines=("lines_with_too_few_words",))).select("doc_id", "text")


@query("""WITH l AS (SELECT doc_id, text, list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS ls FROM documents),
  w AS (SELECT doc_id, text, array_to_string(list_transform(ls, lambda x: CASE WHEN x = '' THEN 'e' WHEN length(x) > 30 THEN 'L' ELSE 's' END), '') AS shape FROM l)
  SELECT doc_id, len(regexp_extract_all(shape, '(?:LLL+s?)+(?:LL?$)?|LL?$'))::BIGINT AS blocks, coalesce(list_sum(list_transform(regexp_extract_all(shape, 'LLL+s?|LL?$'), lambda x: length(x))), 0)::BIGINT AS lines FROM w""")
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of prose of every page and their lines, from the ends that the chunks name."""
    found = read(spark, sf_dir, "documents").select("doc_id", chunks.paragraph_chunks(F.col("text")).alias("c"), F.length("text").alias("size"))
    inner = F.size(F.filter("c", lambda x: x.kind.startswith("terminal_newline")))
    closed = F.size(F.filter("c", lambda x: x.kind == "paragraph_terminal_newline"))
    # a block that ends the text has no end of its own: the last chunk is a line of it
    last = F.try_element_at("c", F.lit(-1))
    open_end = F.coalesce(((last["kind"] == "paragraph_chunk") & (last["score"] == 1.0) & (last["end"] == F.col("size"))).cast("int"), F.lit(0))
    return found.select("doc_id", (closed + open_end).cast("long").alias("blocks"), (inner + closed + open_end).cast("long").alias("lines"))


@query(f"""WITH w AS (SELECT doc_id, lang, {WORDS} AS ws FROM documents), g AS (SELECT doc_id, lang, array_to_string(ws[k:k + 4], ' ') AS gram FROM (SELECT doc_id, lang, ws, unnest(range(1, len(ws) - 3)) AS k FROM w WHERE len(ws) >= 5)),
  f AS (SELECT doc_id, lang, bool_or(lang = 'en') OVER (PARTITION BY gram) OR min(CASE WHEN lang <> 'en' THEN doc_id END) OVER (PARTITION BY gram) < doc_id AS seen FROM g)
  SELECT doc_id, count(*) AS n_ngrams, round(avg(seen::INT), 9) AS overlap FROM f WHERE lang <> 'en' GROUP BY doc_id""")
def ngram_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run that knows the n-grams of the first: other languages after English."""
    docs = read(spark, sf_dir, "documents")
    before = dedupe.grams_of(docs.filter("lang = 'en'"), 5)
    return dedupe.ngram_overlap(docs.filter("lang <> 'en'"), 5, before=before).withColumn("overlap", F.round("overlap", 9))


@query("SELECT doc_id, regexp_replace(text, '([^\\n]{1,60})(?: |(\\n)|$)', '\\1' || chr(10), 'g') AS old, lower(source) AS new FROM documents")
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions with their texts wrapped to a width, as they are shown beside each other."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    other = read(spark, sf_dir, "documents").select("doc_id", F.lower("source").alias("text"))
    both = R.version_join(docs, other, "doc_id")
    return both.select("doc_id", X.wrapped(F.col("old_text"), 60).alias("old"), X.strip(X.wrapped(F.col("new_text"), 60)).alias("new"))


@query("SELECT doc_id, lang = 'en' AS kept FROM documents")
def language_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language score that filters read, as one span over the text."""
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", (S.first_score(F.col("english")) > 0.5).alias("kept"))


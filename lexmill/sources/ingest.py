"""Ingest of single collections: catalogues, web archives, and the document rows that each becomes."""

from __future__ import annotations

import gzip
import io
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import licenses as L
from ..functions import text as X
from ..functions import urls as U
from ..operators import relational as R
from .documents import formatted

_ABOUT = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}about"


def _book(xml: str) -> list[tuple]:
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    local = lambda n: n.tag.rsplit("}", 1)[-1]
    rows = []
    for book in (n for n in root.iter() if local(n) == "ebook"):
        text = lambda name: next(("".join(n.itertext()).strip() for n in book.iter() if local(n) == name), None)  # noqa: E731, B023
        for file in (n for n in book.iter() if local(n) == "file"):
            kinds = ["".join(n.itertext()).strip() for n in file.iter() if local(n) == "format"]
            rows += [(book.get(_ABOUT, "").rsplit("/", 1)[-1], text("title"), text("language"), text("rights"), file.get(_ABOUT), k) for k in kinds]
    return rows


def catalogue_rows(files: DataFrame) -> DataFrame:
    """A row per book, file and format of RDF descriptions: id, title, language, rights, file, format. files: text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [r for t in pdf["text"] if t is not None for r in _book(t)]
            yield pd.DataFrame(rows, columns=["id", "title", "language", "rights", "file", "format"], dtype=object)

    return files.select("text").mapInPandas(run, "id string, title string, language string, rights string, file string, format string")


def public_books(rows: DataFrame, skip: tuple[str, ...] = (), language: str | None = "en") -> DataFrame:
    """The best text file of every book in the public domain; archives and notes are no texts. Ids are compared as texts."""
    kept = rows.filter(F.col("rights").rlike("(?i)^Public domain") & F.col("format").isin(*R.TEXT_TYPES) & ~F.col("file").rlike(r"\.zip$") & ~F.upper("file").contains("README") & ~F.col("id").isin(*skip or [""]))
    if language:
        kept = kept.filter(F.col("language") == language)
    return R.best_by_rank(kept, "id", R.text_type_rank(F.col("format")), "file")


def old_english_books(books: DataFrame, first_year: int = 1500) -> DataFrame:
    """Catalogue rows without nulls, in English, from the year on."""
    return books.dropna().filter((F.lower("language") == "english") & (F.col("year") >= first_year))


def open_books(rows: DataFrame) -> DataFrame:
    """Open-access books with a license by name, in English, with a URL."""
    return rows.filter(F.col("license").rlike(r"(?i)creativecommons\.org/licenses/by(-sa)?/") & F.col("language").rlike("(?i)english") & F.col("url").isNotNull())


def full_comments(comments: DataFrame, text_col: str = "text") -> DataFrame:
    """Comments that are no snippets."""
    text = F.col(text_col)
    return comments.filter(~text.startswith("[...]") & ~text.endswith("[...]"))


def with_dimensions(rows: DataFrame, sets: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Rows with the licenses, languages and URL of their data set; of several license entries the last URL holds. Rows of an unknown set are an error."""
    dims = sets.select(key, F.transform("licenses", lambda x: x["name"]).alias("license"), F.try_element_at(F.transform("licenses", lambda x: x["url"]), F.lit(-1)).alias("license_url"), F.col("languages").alias("language"), F.col("url").alias("dataset_url"), F.lit(True).alias("_known"))
    joined = rows.join(dims, key, "left")
    checked = F.when(F.col("_known"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no such data set: "), F.col(key).cast("string"))))
    return joined.withColumn(key, checked).drop("_known")


def instruction_text(source: Column, target: Column) -> Column:
    return X.strip(F.concat(source, target))


def with_attributes(docs: DataFrame, sidecars: list[DataFrame], id_col: str = "id") -> DataFrame:
    """Documents with the attribute maps of several sidecar tables (id, attributes) in one; of equal names the later table's holds."""
    kind = "map<string,array<struct<start:int,end:int,score:double>>>"
    out = docs.withColumn("attributes", F.create_map().cast(kind))
    for side in sidecars:
        out = out.join(side.select(id_col, F.col("attributes").alias("_more")), id_col, "left")
        more = F.coalesce("_more", F.create_map().cast(kind))
        out = out.withColumn("attributes", F.map_concat(F.map_filter("attributes", lambda k, _: ~F.map_contains_key(more, k)), more)).drop("_more")
    return out


def restricted_attributes(attributes: Column) -> Column:
    """Whether an attribute's name marks a non-commercial or no-derivatives license."""
    return F.exists(F.map_keys(attributes), lambda k: k.rlike("_nc_|_nd_"))


def _records(raw: bytes) -> Iterator[tuple[str, str, bytes]]:
    """Type, URL and body of the records of a web archive, compressed or not."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw))) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        head: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("latin-1").partition(":")
            head[name.strip().lower()] = value.strip()
        yield head.get("warc-type", ""), head.get("warc-target-uri", "").strip("<>"), stream.read(int(head.get("content-length", 0)))


def archive_pages(files: DataFrame) -> DataFrame:
    """HTML responses of web archives: file, url, html. files: file, content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for file, content in zip(pdf["file"], pdf["content"]):
                for kind, url, body in _records(bytes(content)):
                    head, _, page = body.partition(b"\r\n\r\n")
                    if kind == "response" and re.search(rb"(?i)^content-type:\s*(text/html|application/xhtml)", head, re.M):
                        rows.append((file, url, page.decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["file", "url", "html"], dtype=object)

    return files.select("file", "content").mapInPandas(run, "file string, url string, html string")


#: The end of what is between two records of a web archive, but for the last digit of the version, and what stands before it.
#: No character of it is its first: Hadoop's reader misses ends that overlap with what looks like their start where its buffer ends.
_BETWEEN, _BLANK = "\nWARC/1.", b"\r\n\r"


def read_web_archives(spark: SparkSession, path: str) -> DataFrame:
    """HTML responses of web archives of any size, compressed or not: file, url, html.

    Spark reads the records as lines that end where the next one starts, plain files
    by byte ranges and compressed ones as streams, so that no more than a record is
    held. Where a page holds such an end itself, records tell by their length that
    they go on, and those without one end at an empty line. Records that are cut short
    are given as far as they came.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parts, need = None, [], 0

        def record() -> list[tuple[str, str, str]]:
            head, _, body = b"".join(parts).partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n"))}
            if fields.get("warc-type") != "response":
                return []
            size = fields.get("content-length", "")
            http, _, page = (body[: int(size)] if size.isdigit() else body.removesuffix(_BLANK)).partition(b"\r\n\r\n")
            if not re.search(rb"(?im)^content-type:\s*(text/html|application/xhtml)", http):
                return []
            return [(file, fields.get("warc-target-uri", "").strip("<>"), page.decode("utf-8", "replace"))]

        for batch in batches:
            rows = []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blank = len(_BLANK) if parts and parts[-1].endswith(_BLANK) else 0
                if parts and name == file and (need + blank > 0 if need is not None else not blank):
                    parts += [_BETWEEN.encode(), raw]
                    need = None if need is None else need - len(_BETWEEN) - len(raw)
                    continue
                rows += record() if parts else []
                head, _, body = raw.partition(b"\r\n\r\n")
                size = re.search(rb"(?im)^content-length:\s*(\d+)", head)
                file, parts, need = name, [raw], int(size[1]) - len(body) if size else None
            yield _page_batch(rows)
        if parts:
            yield _page_batch(record())

    rows = spark.read.option("lineSep", _BETWEEN).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("record"))
    return rows.mapInArrow(run, "file string, url string, html string")


def _page_batch(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], names=["file", "url", "html"])


def licensed_pages(pages: DataFrame) -> DataFrame:
    """The first page of each file and URL that links an open license, with that link."""
    from ..operators.dedupe import keep_first

    found = pages.withColumn("license", L.html_license(F.col("html"))).filter(F.col("license").isNotNull() & ~F.col("license").rlike("-n[cd]"))
    return keep_first(found, ["file", "url"], ["html"]) if "file" in pages.columns else keep_first(found, ["url"], ["html"])


#: How the rows of each collection become documents: (rows, added) to documents.
Format = Callable[[DataFrame, Column], DataFrame]


def _pd() -> Column:
    return F.lit(L.PERMISSIVE["PD"])


def format_chats(df: DataFrame, added: Column) -> DataFrame:
    """file, text, year, month, day, channel."""
    ident = F.concat_ws("-", "year", "month", "day", F.concat(F.lit("#"), F.col("channel")))
    return formatted(df, ident, F.col("text"), "chats", added, F.concat_ws("-", "year", "month", "day"), license=_pd(), channel=F.col("channel"), authors=X.chat_authors(F.col("text")))


def format_books(df: DataFrame, added: Column) -> DataFrame:
    """id, title, language, text, file."""
    return formatted(df, F.col("id"), F.col("text"), "ebooks", added, license=_pd(), title=F.col("title"), language=F.col("language"), url=F.col("file"))


def format_pages(df: DataFrame, added: Column) -> DataFrame:
    """item_id, page_id, page_num, text, license; the page's place goes on top."""
    out = formatted(df, F.col("page_id"), F.col("text"), "scans", added, license=F.col("license"), url=F.concat(F.lit("page/"), F.col("page_id")), item_id=F.col("item_id"), page_num=F.col("page_num"))
    return out.withColumn("item_id", F.col("metadata.item_id")).withColumn("page_num", F.col("metadata.page_num").cast("int"))


def format_proposals(df: DataFrame, added: Column) -> DataFrame:
    """number, text; those under another license go."""
    kept = df.filter(~X.has_open_publication_license(F.col("text")))
    return formatted(kept, F.col("number"), X.proposal_links(F.col("text")), "proposals", added, X.proposal_created(F.col("text")), license=_pd(), authors=X.proposal_authors(F.col("text")))


def format_articles(df: DataFrame, added: Column) -> DataFrame:
    """url, title, byline, text, license."""
    kept = df.filter(U.is_article(F.col("url")))
    return formatted(kept, F.col("url"), F.concat_ws("\n", "title", "text"), "news", added, license=F.col("license"), url=F.col("url"), author=X.clean_author(F.col("byline")))


def format_patents(df: DataFrame, added: Column) -> DataFrame:
    """id, title, abstract, description, claims, language, publication_date."""
    return formatted(R.patent_text(df), F.col("id"), F.col("text"), "patents", added, F.col("publication_date"), license=_pd(), language=F.col("language"), publication_date=F.col("publication_date"))


def format_opinions(df: DataFrame, added: Column) -> DataFrame:
    """id and the text columns of court opinions."""
    return formatted(R.opinion_text(df), F.col("id"), F.col("text"), "opinions", added, license=_pd())


def format_textbooks(df: DataFrame, added: Column) -> DataFrame:
    """title, book_url, page_url, license, content: the largest edition of each title under a known license."""
    known = df.withColumn("_license", L.catalogue_license(F.col("license"), "textbooks")).filter(F.col("_license").isNotNull())
    best = R.largest_edition(known, "title", "book_url", "content", "page_url_order") if "page_url_order" in df.columns else known
    return formatted(best, F.col("page_url"), F.col("content"), "textbooks", added, license=L.license_name(F.col("_license")), title=F.col("title"), url=F.col("page_url"))


def format_code(df: DataFrame, added: Column, approved: list[str]) -> DataFrame:
    """blob_id, content, detected_licenses, language, path: files whose licenses are all approved; all else goes to the metadata."""
    kept = df.filter(L.all_approved(F.col("detected_licenses"), approved))
    return formatted(kept, F.col("blob_id"), F.col("content"), "code", added, license=F.array_join("detected_licenses", ","), language=F.col("language"), path=F.col("path"))


FORMATS: dict[str, Format] = {
    "chats": format_chats, "ebooks": format_books, "scans": format_pages, "proposals": format_proposals, "news": format_articles, "patents": format_patents, "opinions": format_opinions, "textbooks": format_textbooks,
}

"""Main text of pages: what recurs across the pages of a host is its template.

Every page is read into a tree (:mod:`.pagetree`), and each element that may be
part of a template is hashed with all that is in it. Spark counts the hashes per
host, over pages that differ; those on many pages of the host are its template.
A second reading of the pages drops the template's elements, and those that say
by tag, role or class that they stand beside the article, and returns the blocks
of text that are left of it.

Plain paragraphs, headings and inline elements are text wherever they recur, and
so is an element that holds most of a page: passages and articles that many pages
share are no template. Pages that are equal count once.

A host's template has at most (elements of a page on average) / ``share``
elements, however many pages it has. Pages of a frequent host meet theirs by a
broadcast, of a checked size, and stay where they are; only pages of rare hosts
are shuffled.

Defined cases: a null page is empty, and has an empty text; without ``://`` or a
host in its url a page has no template but is read like any other; hosts of few
pages have none; pages are read whole, however long or deep; repeated rows each
have their text; an empty table gives an empty one; other columns are not looked
at and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pagetree import main_text, outline
from .staging import HOT, staged
from .urlrules import LOWER, UPPER

#: Template elements of frequent hosts that are broadcast at most, 8 bytes each; beyond it these pages are shuffled too, and skewed hosts split.
BROADCAST_DIGESTS = 2_000_000


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, in lower case; null if there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return F.nullif(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def site_templates(pages: DataFrame, share: float = 0.1, least: int = 4) -> DataFrame:
    """host, n_pages (that differ) and digests: elements on at least ``share`` of the pages of a host, and on ``least``. pages: host and html."""

    def outlined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [outline(html) for html in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["host", "page", "digests"])

    read = pages.select("host", "html").filter("host IS NOT NULL AND html IS NOT NULL").mapInArrow(outlined, "host string, page long, digests array<long>")
    # pages of one digest are equal, whichever is taken; used twice, and a page is dear to read
    differing = staged(read.groupBy("host", "page").agg(F.first("digests").alias("digests")), "outlines")
    per_host = differing.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    on_many = differing.select("host", F.explode("digests").alias("digest")).groupBy("host", "digest").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") >= least)
    kept = on_many.join(per_host, "host").filter(F.col("many") >= F.col("n_pages") * share)
    listed = kept.groupBy("host").agg(F.collect_list("digest").alias("digests"))
    return per_host.join(listed, "host", "left").select("host", "n_pages", F.coalesce("digests", F.array().cast("array<bigint>")).alias("digests"))


def with_templates(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """pages with the digests of their host's template, null without one. A host with more than one in HOT pages is joined where its pages are."""
    total = templates.agg(F.sum("n_pages")).first()[0] or 0
    frequent, rare = templates.filter(F.col("n_pages") * HOT > total).select("host", "digests"), templates.filter(F.col("n_pages") * HOT <= total).select("host", "digests")
    size = frequent.agg(F.sum(F.size("digests") + 16)).first()[0] or 0
    if size > BROADCAST_DIGESTS:
        return pages.join(templates.select("host", "digests").hint("merge"), "host", "left")
    at_once = pages.join(F.broadcast(frequent), "host")
    # null hosts are spread: they meet nothing
    rest = pages.join(F.broadcast(frequent.select("host")), "host", "left_anti")
    met = rest.filter("host IS NOT NULL").join(rare.hint("merge"), "host", "left")
    alone = rest.filter("host IS NULL").withColumn("digests", F.lit(None).cast("array<bigint>"))
    return at_once.unionByName(met).unionByName(alone)


def article_texts(pages: DataFrame, share: float = 0.1, least: int = 4, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page its id, url, text and n_chars."""
    id_type, url_type = pages.schema[id_col].dataType, pages.schema[url_col].dataType
    url = F.col(url_col)
    own = pages.select(url.alias("url"), F.col(id_col).alias("id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(url.cast("string")).alias("host"))
    templates = staged(site_templates(own.select("host", "html"), share, least), "templates")
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField(url_col, url_type), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, frozenset(digests or ())) for html, digests in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=schema.names)

    return with_templates(own, templates).select("id", "url", "html", "digests").mapInArrow(extracted, schema)

"""Files of other kinds: XML, whole texts, tables, nested pages, archives."""

from __future__ import annotations

import io
import random
import tarfile
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.encodings import detected  # noqa: F401  beside the fallbacks of decoded
from ..operators.layout import numbered
from ..session import durable


def read_xml(spark: SparkSession, paths: str | list[str], tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A row per element of a name, whatever its namespace prefix; attributes are columns with a leading underscore."""
    reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).load(paths)


def read_attribute_rows(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Dumps whose rows are <row .../> elements with all values in attributes, by the names of the attributes."""
    schema = T.StructType([T.StructField(f"_{f}", T.StringType()) for f in fields])
    return read_xml(spark, path, "row", schema).select(*[F.col(f"_{f}").alias(f) for f in fields])


def read_texts(spark: SparkSession, glob: str) -> DataFrame:
    """A row per file: file and text."""
    return spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def path_parts(file: Column, pattern: str, names: list[str]) -> list[Column]:
    """Groups of a pattern in a path as columns."""
    return [F.regexp_extract(file, pattern, k).alias(n) for k, n in enumerate(names, 1)]


#: Patterns of paths that carry columns.
CHAT_PATH = (r"/(\d{4})/(\d{2})/(\d{2})/([^/]+)\.txt$", ["year", "month", "day", "channel"])
PAGE_PATH = (r"/([^/]+?)-([^/-]+)-(\d+)\.txt$", ["item_id", "page_id", "page_num"])
PROPOSAL_PATH = (r"/pep-(\d{4})\.rst$", ["number"])


def decoded(content: Column, *fallbacks: str) -> Column:
    """Bytes as text: UTF-8 where valid, else the first fallback that Spark knows; null without one."""
    texts = [F.try_validate_utf8(content.cast("string"))] + [F.decode(content, f) for f in fallbacks]
    return F.coalesce(*texts)


def read_binary(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").load(glob).select(F.col("path").alias("file"), "content")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header, quoted line breaks and fields of any length."""
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').option("maxCharsPerColumn", "-1")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_nested_pages(spark: SparkSession, path: str, rows: str = "results", schema: T.StructType | str | None = None) -> DataFrame:
    """JSON documents that each hold a list of rows."""
    reader = spark.read.option("multiLine", "true")
    pages = (reader.schema(schema) if schema is not None else reader).json(path)
    return pages.select(F.explode(rows).alias("_row")).select("_row.*")


#: Bytes of unpacked members that are given at once.
MEMBERS = 4 << 20


def archive_members(files: DataFrame, suffix: str = "", only: int | None = None) -> DataFrame:
    """A row per regular member of tar archives (of any compression): file, member, content. only: archives with another number of matching members give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found, size = [], 0
            for file, content in zip(pdf["file"], pdf["content"]):
                rows = []
                try:
                    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                        for m in tar:
                            if m.isfile() and m.name.endswith(suffix):
                                rows.append((file, m.name, tar.extractfile(m).read()))
                except tarfile.ReadError:
                    continue
                if only is None or len(rows) == only:
                    found += rows
                    size += sum(len(r[2]) for r in rows)
                if size > MEMBERS:
                    yield pd.DataFrame(found, columns=["file", "member", "content"])
                    found, size = [], 0
            yield pd.DataFrame(found, columns=["file", "member", "content"])

    return files.select("file", "content").mapInPandas(run, "file string, member string, content binary")


def interpolated(members: DataFrame) -> DataFrame:
    r"""A TeX document per article: members (article, member, text) that hold \begin{document}, with the files that they input put in.

    A file that was put in is no document of its own. Members of an article meet
    in one group; articles are bounded by their archive.
    """
    import re

    call = re.compile(r"\\(?:input|include)\s*\{([^}]+)\}")

    def whole(members: list) -> list[tuple[str, str]]:
        texts = {m["member"].rsplit("/", 1)[-1].removesuffix(".tex"): m["text"] or "" for m in members}
        used: set[str] = set()

        def fill(text: str, above: tuple[str, ...]) -> str:
            def put(m: re.Match) -> str:
                name = m[1].strip().rsplit("/", 1)[-1].removesuffix(".tex")
                if name not in texts or name in above:
                    return m[0]
                used.add(name)
                return fill(texts[name], (*above, name))

            return call.sub(put, text)

        done = {n: fill(t, (n,)) for n, t in sorted(texts.items()) if r"\begin{document}" in t}
        return [(n, t) for n, t in done.items() if n not in used]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(article, n, t) for article, own in zip(pdf["article"], pdf["members"]) for n, t in whole(own)]
            yield pd.DataFrame(rows, columns=["article", "member", "text"])

    groups = members.groupBy("article").agg(F.collect_list(F.struct("member", "text")).alias("members"))
    return groups.mapInPandas(run, "article string, member string, text string")


def tex_body(text: Column) -> Column:
    r"""What stands between the first \begin{document} and \end{document} or the next \begin{document}."""
    return F.regexp_extract(text, r"(?s)\\begin\{document\}(.*?)(?:\\end\{document\}|\\begin\{document\}|$)", 1)


def page_list(urls: DataFrame, url_col: str = "url", skip: int = 0) -> DataFrame:
    """Distinct pages of a site map in order, numbered from 0 after those to skip."""
    listed = numbered(urls.select(url_col).distinct(), [url_col], "idx").withColumn("idx", (F.col("idx") - skip).cast("int"))
    return listed.filter(F.col("idx") >= 0)


def crawl(frontier: DataFrame, links: DataFrame, most: int | None = None) -> DataFrame:
    """Pages reachable from the frontier (page) over links (page, to), by rounds that leave out what was seen, until a round finds none.

    most: rounds after which pages still to follow are an error.
    """
    seen = edge = durable(frontier.select("page").distinct())
    rounds = 0
    while True:
        edge = durable(edge.join(links, "page").select(F.col("to").alias("page")).distinct().join(seen, "page", "left_anti"))
        if edge.isEmpty():
            return seen
        if rounds == most:
            raise RuntimeError(f"pages are left to follow after {most} rounds")
        rounds += 1
        seen = durable(seen.union(edge))


def fetched(fetch: Callable[[str], bytes], url: str, tries: int, wait: float, most: float, sleep: Callable[[float], None] = time.sleep) -> tuple[bytes | None, str | None, int]:
    """Content, the last error and the number of tries. Between tries it waits a random time below a limit that doubles, from ``wait`` up to ``most`` seconds."""
    error = None
    for k in range(tries):
        try:
            return fetch(url), None, k + 1
        except OSError as failure:
            error = f"{type(failure).__name__}: {failure}"
        if k + 1 < tries:
            sleep(random.uniform(0, min(most, wait * 2**k)))
    return None, error, tries


def fetch_pages(pages: DataFrame, fetch: Callable[[str], bytes], url_col: str = "url", tries: int = 5, wait: float = 1.0, most: float = 60.0) -> DataFrame:
    """Add content, error and tries with a function of a URL that the caller brings; an OSError is tried again, and after the last try content is null."""
    rest = pages.drop("content", "error", "tries")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [fetched(fetch, u, tries, wait, most) for u in pdf[url_col]]
            yield pdf.assign(content=[x[0] for x in got], error=[x[1] for x in got], tries=[x[2] for x in got])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInPandas(run, f"{fields}, content binary, error string, tries int")

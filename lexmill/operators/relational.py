"""Joins, aggregations and choices over tables of documents and their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE, word_count
from .layout import cell_of, even_bounds, numbered, running_size


def size_stats(docs: DataFrame, by: list[str] | None = None, text_col: str = "text", file_col: str | None = None, space: str = SPACE) -> DataFrame:
    """Documents, white-space tokens, characters and UTF-8 bytes, with the number of shards where there is a file column. A null text is a document of no size."""
    text = F.col(text_col)
    sums = [
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum(word_count(text, space)), F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0)).cast("long").alias("characters"),
        F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0)).cast("long").alias("bytes"),
    ]
    if file_col:
        sums.append(F.countDistinct(file_col).alias("shards"))
    return docs.groupBy(*(by or [])).agg(*sums)


def version_join(old: DataFrame, new: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Id and both texts of the documents in both versions."""
    return old.select(id_col, F.col(text_col).alias("old_text")).join(new.select(id_col, F.col(text_col).alias("new_text")), id_col)


def missing_from(old: DataFrame, new: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of the old version whose id the new one lacks."""
    return old.join(new.select(id_col).distinct(), id_col, "left_anti")


def merged(old: DataFrame, new: DataFrame, id_col: str = "id") -> DataFrame:
    """The new version, and the rows of the old that it lacks."""
    return new.unionByName(missing_from(old, new, id_col), allowMissingColumns=True)


def on_list(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return df.join(listed.select(key).distinct(), key, "left_semi")


def not_on_list(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return df.join(listed.select(key).distinct(), key, "left_anti")


def item_key(uri: Column, digits: int = 6) -> Column:
    """Last part of a path, padded with zeros; longer ones stay whole."""
    last = F.element_at(F.split(uri, "/"), -1)
    return F.when(F.length(last) < digits, F.lpad(last, digits, "0")).otherwise(last)


def licensed_items(index: DataFrame, licenses: list[str]) -> DataFrame:
    """Keys of the items under the given licenses. index: license and uri, a row each, or uris as lists where it is read so."""
    kept = index.filter(F.col("license").isin(licenses))
    uris = kept.select(F.explode("uris").alias("uri")) if "uris" in index.columns else kept.select("uri")
    return uris.select(item_key(F.col("uri")).alias("item")).distinct()


def upsert(index: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Index rows with the value replaced by the new one, and the new keys."""
    old, fresh = index.select(F.col(key).alias("at"), F.struct("*").alias("row")), new.select(F.col(key).alias("at"), F.col(value).alias("new"))
    both = old.join(fresh, "at", "full")
    columns = {key: F.col("at"), value: F.coalesce(F.col("new"), F.col("row")[value])}
    return both.select(*[columns.get(c, F.col("row")[c]).alias(c) for c in index.columns])


def missing_by(split: DataFrame, index: DataFrame, id_col: str, by: str) -> DataFrame:
    """How many ids of each split the index lacks."""
    return not_on_list(split, index, id_col).groupBy(by).agg(F.count(F.lit(1)).alias("missing"))


def range_lookup(ids: DataFrame, shards: DataFrame, id_col: str = "id", width: int | None = None) -> DataFrame:
    """The shard whose range of ids holds each id. shards: shard, start, end.

    Ranges are cut into cells of a width (the mean length of a range), so that
    the join is on equal cells, however long either side is.
    """
    if width is None:
        mean = shards.agg(F.avg(F.col("end") - F.col("start") + 1)).first()[0]
        width = max(1, int(mean or 1))
    cell = lambda c: F.floor(F.col(c) / width)
    cut = shards.withColumn("_cell", F.explode(F.sequence(cell("start"), cell("end"))))
    held = ids.withColumn("_cell", cell(id_col)).join(cut, "_cell").filter(F.col(id_col).between(F.col("start"), F.col("end")))
    return held.drop("_cell", "start", "end")


#: Rows to a range that :func:`as_of` sorts, and ranges at most.
RANGE_ROWS, RANGES = 50_000, 4096


def as_of(ids: DataFrame, starts: DataFrame, id_col: str = "id", shard_col: str = "shard", start_col: str = "start") -> DataFrame:
    """The shard with the greatest start that is not above the id; null before the first.

    Both sides are sorted together within ranges of the id that hold about as
    many rows each, by quantiles, and the starts that open a range are carried
    over from the ranges before it: a table of RANGES rows at most.
    """
    asked = ids.select(F.col(id_col).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(starts.schema[shard_col].dataType).alias("_shard"), F.struct(*ids.columns).alias("_row"))
    known = starts.select(F.col(start_col).alias("_at"), F.lit(0).alias("_side"), F.col(shard_col).alias("_shard"))
    both = asked.unionByName(known, allowMissingColumns=True)
    bounds = even_bounds(both.select("_at"), "_at", RANGE_ROWS, RANGES)
    cut = lambda df: cell_of(df, "_at", bounds, "_cell")
    last = cut(known).groupBy("_cell").agg(F.max(F.struct("_at", "_shard")).alias("_last"))
    grid = starts.sparkSession.range(0, len(bounds) + 2).select(F.col("id").cast("int").alias("_cell"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(F.broadcast(last), "_cell", "left").select("_cell", F.last("_last", ignorenulls=True).over(before)["_shard"].alias("_carried"))
    own = Window.partitionBy("_cell").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = cut(both).withColumn("_found", F.last("_shard", ignorenulls=True).over(own)).filter("_side = 1").join(F.broadcast(carried), "_cell", "left")
    return found.select("_row.*", F.when(F.col("_at").isNotNull(), F.coalesce("_found", "_carried")).alias(shard_col))


def histogram(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def listed_by(df: DataFrame, by: str, value: str) -> DataFrame:
    """Sorted values of each key. Meant for keys with few values."""
    return df.groupBy(by).agg(F.sort_array(F.collect_list(value)).alias(f"{value}s"))


def first_pair(entries: Column) -> Column:
    """Of entries (kind, value) read until there are a uri and a license: the last uri so far, and that license (the last one, where it came first)."""
    place = lambda kind: F.array_position(F.transform(entries, lambda e: e.kind), F.lit(kind))
    there = (place("uri") > 0) & (place("license") > 0)
    read = F.when(there, F.slice(entries, F.lit(1), F.greatest(place("uri"), place("license")).cast("int"))).otherwise(entries)
    last = lambda kind: F.try_element_at(F.filter(read, lambda e: e.kind == kind), F.lit(-1))["value"]
    return F.struct(last("uri").alias("uri"), last("license").alias("license"))


def largest_edition(pages: DataFrame, title: str, edition: str, content: str, order: str) -> DataFrame:
    """Pages of the edition of each title that has most content; the first of equal ones; titles without content go. Only sums are ranked."""
    sums = pages.groupBy(title, edition).agg(F.sum(F.length(content)).alias("_size"), F.min(order).alias("_first"))
    best = sums.filter("_size > 0").groupBy(title).agg(F.max_by(edition, F.struct("_size", -F.col("_first"))).alias(edition))
    return pages.join(best, [title, edition], "left_semi")


def within_budget(batches: DataFrame, order: str, size: str, budget: int) -> DataFrame:
    """Batches up to and with the one that passes the budget, in the order of a number. Running sizes are made in blocks, no task sees all batches."""
    return running_size(batches, order, F.col(size), "size_before_this").filter(F.col("size_before_this") <= budget).select(*batches.columns)


def latest_revision(revisions: Column, every_author: bool = True) -> Column:
    """Last of the revisions (structs with text, date, author), and the sorted authors of all, or of the last."""
    last = F.try_element_at(revisions, F.lit(-1))
    people = F.sort_array(F.array_distinct(F.filter(F.transform(revisions, lambda r: r.author), lambda a: a.isNotNull()))) if every_author else F.array(last["author"])
    return F.struct(last["text"].alias("text"), last["date"].alias("date"), people.alias("authors"))


def best_by_rank(files: DataFrame, key: str, rank: Column, *ties) -> DataFrame:
    """The file of least rank for each key; files without a rank are no choice."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(rank, *ties))
    return files.filter(rank.isNotNull()).select(F.struct("*").alias("row"), place.alias("place")).filter("place = 1").select("row.*")


#: Text types in order of preference.
TEXT_TYPES = ("text/plain", "text/plain; charset=utf-8", "text/plain; charset=us-ascii", "text/plain; charset=iso-8859-1")


def text_type_rank(kind: Column) -> Column:
    return F.nullif(F.array_position(F.lit(list(TEXT_TYPES)), kind), F.lit(0))


def dump_rank(name: Column, ident: Column) -> Column:
    """Which kind of dump a file name says it is, the best first; null for other files. The names are fixed values."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    bare = F.regexp_replace(ident, "^[wW]iki-", "")
    kinds = [
        name.contains("history.xml"), name == F.concat(bare, F.lit(".zip")), name == F.concat(bare, F.lit(".7z")), name == F.concat(bare, F.lit(".gz")), stem.endswith("-wikidump"), stem.endswith("-history"),
        stem.endswith("_pages_full.xml"), name.contains("pages.xml"), name == bare, F.lower(name).startswith(F.lower(bare)) & F.substr(name, F.length(bare) + 1).rlike(r"^-?\d+?\."), stem.rlike("-complete(7z)?$"),
        stem.endswith("-wikidump.XMLONLY"), name.contains("dumped_using_wikidumper"), name.endswith(".xml.gz"), name.contains("-current"),
    ]
    rank = F.lit(None).cast("int")
    for k in range(len(kinds) - 1, -1, -1):
        rank = F.when(kinds[k], k).otherwise(rank)
    return rank


def _mentions(col: Column, word: str) -> Column:
    return F.lower(F.coalesce(col, F.lit(""))).contains(word)


def mentions_lyrics(url: Column, dump_url: Column, title: Column, source: Column, word: str = "lyric") -> Column:
    return _mentions(url, word) | _mentions(dump_url, word) | _mentions(title, word) | _mentions(source, word)


def keeps_despite_lyrics(url: Column, dump_url: Column, title: Column, source: Column) -> Column:
    """Pages that mention lyrics and stay: ideas for stories, and what is merely lyrical; two collections of songs never do."""
    src = F.coalesce(source, F.lit(""))
    idea = src.contains("wiki-ideasfandomcom") | _mentions(url, "ideas.fandom.com")
    songs = src.contains("thpatch") | src.contains("vocaloidlyrics")
    return idea | (~songs & mentions_lyrics(url, dump_url, title, source, "lyrica"))


def without_lyrics(url: Column, dump_url: Column, title: Column, source: Column) -> Column:
    return ~mentions_lyrics(url, dump_url, title, source) | keeps_despite_lyrics(url, dump_url, title, source)


#: Collections whose transcripts are no transcripts of recordings.
TRANSCRIPT_SOURCES = ("proteopedia", "wiki-ideasfandomcom", "calvinandhobbesfanon", "differenthistory", "cartoonnetworkfanfiction", "christians_grade_12_chemistry", "wiki-piratepartyca")


def without_transcripts(url: Column, dump_url: Column, title: Column, source: Column) -> Column:
    """False for pages that mention a transcript and are none of the known exceptions."""
    src = F.coalesce(source, F.lit(""))
    named = mentions_lyrics(url, dump_url, title, source, "transcript")
    known = _mentions(source, "openitware") | _mentions(url, "familysearch.org") | _mentions(title, "irc meeting") | _mentions(url, "ideas.fandom.com") | (src == "wiki-bushlawyerconz_w")
    known = known | (src.contains("naruto") & _mentions(title, "transcription seal"))
    for part in TRANSCRIPT_SOURCES:
        known = known | src.contains(part)
    return ~named | known


#: Pages too large to parse.
SKIP_TITLES = (
    "Template:Attached KML/U.S. Route 62 in Kentucky", "Template:Attached KML/U.S. Route 277", "User:BeywheelzLetItRip/fonts.css", "User:BeywheelzLetItRip/fonts2.cs", "Template:Graph:Map/Inner/USA-json",
)


def parseable(title: Column, text: Column, redirect: Column | None = None) -> Column:
    """Pages with a text, under a title that is not on the list, that don't send elsewhere."""
    kept = ~F.coalesce(title, F.lit("")).isin(*SKIP_TITLES) & (F.coalesce(F.length(text), F.lit(0)) > 0)
    return kept if redirect is None else kept & redirect.isNull()


def slice_of(name: Column, n: int, k: int) -> Column:
    """Whether the SHA-256 of a name, as one number, is k modulo n: digit by digit, without a wide integer."""
    digits = F.split(F.sha2(name.cast("binary"), 256), "")
    rest = F.aggregate(F.filter(digits, lambda d: d != ""), F.lit(0).cast("long"), lambda a, d: (a * 16 + F.conv(d, 16, 10).cast("long")) % n)
    return rest == k


#: Fields that each type of record keeps.
RECORD_FIELDS = {
    "Notice": ("Document ID", "Document Type", "Posted Date", "Title", "Content Files"),
    "Rule": ("Document ID", "Document Type", "Posted Date", "Title", "Topics", "Content Files"),
    "Proposed Rule": ("Document ID", "Document Type", "Posted Date", "Title", "Content Files"),
    "Supporting & Related Material": ("Document ID", "Document Type", "Posted Date", "Content Files"),
}


def kept_record(df: DataFrame) -> DataFrame:
    """Records of the known types; fields that a type does not keep are null; files as (url, ext), topics as lists."""
    kind = F.col("Document Type")
    kept = df.filter(kind.isin(*RECORD_FIELDS))
    of = lambda name: F.when(kind.isin(*[k for k, fields in RECORD_FIELDS.items() if name in fields]), F.col(f"`{name}`"))
    files = F.transform(F.split(of("Content Files"), ","), lambda u: F.struct(u.alias("url"), F.regexp_extract(u, r"(\.[^./]*)$", 1).alias("ext")))
    return kept.select(
        F.col("`Document ID`").alias("document_id"), kind.alias("document_type"), F.col("`Posted Date`").alias("posted"), of("Title").alias("title"),
        F.coalesce(F.split(of("Topics"), ","), F.array().cast("array<string>")).alias("topics"), F.coalesce(files, F.array().cast("array<struct<url:string,ext:string>>")).alias("files"),
    )


#: Columns of court opinions in order of preference.
OPINION_COLUMNS = ("html_with_citations", "html_columbia", "html_lawbox", "xml_harvard", "html_anon_2020", "html")


def opinion_text(df: DataFrame, plain_too: bool = True) -> DataFrame:
    """The first opinion text there is, without tags; the plain one counts last, or not at all."""
    columns = [F.col(c) for c in (*OPINION_COLUMNS, *(("plain_text",) if plain_too else ())) if c in df.columns]
    text = F.coalesce(*columns)
    return df.withColumn("text", F.regexp_replace(text, "<.+?>", "")).filter(F.col("text").isNotNull())


def patent_text(df: DataFrame) -> DataFrame:
    """Title, abstract, description and claims with blank lines between; what is null is left out, its blank lines stay. Patents without any body go."""
    body = ("abstract", "description", "claims")
    headed = F.concat(F.lit("ABSTRACT\n\n"), F.col("abstract"))
    gap = F.lit("\n\n")
    return df.filter(F.coalesce(*body).isNotNull()).withColumn("text", F.concat_ws("", "title", gap, headed, gap, "description", gap, "claims"))


def rows_of(df: DataFrame, worker: int, workers: int, order: str) -> DataFrame:
    """Every ``workers``-th row in an order, for a fetcher that shares the work."""
    return numbered(df, [order], "place_of_row").filter(F.pmod("place_of_row", F.lit(workers)) == worker).select(*df.columns)

"""URLs and the names made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import remove_prefix


def netloc(url: Column) -> Column:
    """Host with user and port, empty where there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def on_hosts(df: DataFrame, hosts: DataFrame, url_col: str = "url") -> DataFrame:
    """Rows whose host is on the list, with or without www. ``hosts``: one column."""
    name = F.col(hosts.columns[0])
    twin = F.when(name.startswith("www."), remove_prefix(name, "www.")).otherwise(F.concat(F.lit("www."), name))
    both = hosts.select(F.explode(F.array(name, twin)).alias("_host")).distinct()
    return df.join(both, netloc(F.col(url_col)) == F.col("_host"), "left_semi")


#: Paths of pages that hold no article, and hosts of videos.
BLOCKED_PATHS = (
    "/tags?/", "/specialreports/", "/person/", "/institution/", "/home/", "/feature/", "/category/", "/about-us/", "/visuals?_tags/", "/visuals?_location/",
    "/visuals/", "/author/", "/applications/", "/staff/", "/job/", "^/about(?:-us)?$", "^/contact", "/promises/", "/promise_topic/", "/promise_status/",
    "^/img_", "/investigations/", "^/screenshot-", "/topics/", "/archives/", "/cart/", "/checkout/", "/my-account/",
)
VIDEO_HOSTS = ("youtu.be", "youtube.com", "www.youtube.com")


def is_article(url: Column, blocked: tuple[str, ...] = BLOCKED_PATHS) -> Column:
    return ~netloc(url).isin(*VIDEO_HOSTS) & (path(url) != "/") & ~path(url).rlike("|".join(blocked))


def is_static(url: Column) -> Column:
    return path(url).startswith("/static/")


def file_name(url: Column, longest: int = 255) -> Column:
    """A URL as a file name, cut to ``longest`` characters."""
    out = F.regexp_replace(url, r"https?://(?:www\.)?", "")
    return F.substring(F.regexp_replace(F.regexp_replace(out, r"[?,=/]", "_"), r"\s+", "_"), 1, longest)


def short_file_name(url: Column) -> Column:
    """The variant that leaves http:// in place and cuts nothing."""
    out = F.translate(url, "?,=", "___")
    for lead in ("https://www.", "http://www.", "https://"):
        out = F.replace(out, F.lit(lead), F.lit(""))
    return F.regexp_replace(F.translate(out, "/", "_"), r"\s+", "_")


def nested_folder(name: Column, chars: int = 2, levels: int = 2, prefix: str = "wiki-") -> Column:
    """A name below folders of its first characters."""
    lead = F.when(name.startswith(prefix), prefix).otherwise("")
    bare = remove_prefix(name, prefix)
    steps = [F.substring(bare, 1 + k * chars, chars) for k in range(levels)]
    return F.concat_ws("/", F.concat(lead, steps[0]), *steps[1:], F.concat(lead, bare))


def base_name(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def quote(text: Column) -> Column:
    """Percent-encoding that leaves : and / alone."""
    out = F.url_encode(text)
    for plain, coded in ((" ", r"\+"), (":", "%3A"), ("/", "%2F"), ("~", "%7E")):
        out = F.regexp_replace(out, coded, plain if plain != " " else "%20")
    return F.regexp_replace(out, r"\*", "%2A")


def site_page(site: Column, ident: Column, collection: str = "questions") -> Column:
    return quote(F.concat(F.lit("https://"), site, F.lit(f"/{collection}/"), ident.cast("string")))


def crawl_route(original: Column) -> Column:
    """Where a wiki's dump comes from: its farm, the public dumps, or the archive."""
    # fixed values: the sites whose dumps are public
    farms = r"(?i)(wikipedia|wikisource|wiktionary|wikibooks|wikiversity|wikimedia|wikispecies|wikiquote|wikinews|wikidata|wikivoyage)\.org"
    return F.when(original.isNull(), "archive").when(netloc(original).endswith("fandom.com"), "fandom").when(original.rlike(farms), "wikimedia").otherwise("archive")


#: Codes for English.
ENGLISH = ("en", "en-ca", "eng", "en-gb", "English", "en_hj")


def maybe_english(code: Column) -> Column:
    """English, unknown, or not said."""
    return F.coalesce(code, F.lit("")).isin("", "Unknown", *ENGLISH)

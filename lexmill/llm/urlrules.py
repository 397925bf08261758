"""URL pattern rules, each indexed by its rarest literal token.

A rule is an action for a host with its subdomains and a path prefix, and may
add a regular expression that the rest of the path must match. Its literal
tokens are the host's labels and the whole segments of its path. The index
holds every rule under the one token that the fewest rules share. A url's own
tokens fetch the candidates, and only those run their regular expressions; the
longest rule that matches wins.

Defined cases: a null url, or one without ``://``, has an empty host and path
and no rule; the default action holds without a rule; equal rules count once,
rules of the same length are decided by their text; repeated rows each get
their verdict; long urls are read whole; an empty table gives an empty one;
other columns are kept out of the way and dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many rules the index is a literal of the plan; beyond it, a table that is joined.
LITERAL_RULES = 1000
#: Up to so many rules (some 40 MB) that table is broadcast, so that urls with a frequent token stay where they are.
BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class UrlRule:
    action: str
    host: str
    path: str = "/"
    rest: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path + self.rest

    @property
    def pattern(self) -> str:
        quoted = "".join(c if c.isalnum() else "\\" + c for c in f"{self.host}{self.path}")
        return rf"(?s)^(?:[^/]*\.)?{quoted}{self.rest}"

    def tokens(self) -> list[str]:
        segments = self.path.split("/")[1:-1] if not self.rest.startswith("/") else self.path.split("/")[1:]
        return [f"h:{x}" for x in self.host.split(".") if x] + [f"p:{x}" for x in segments if x]


def parts(df: DataFrame, url_col: str) -> DataFrame:
    """Add _host and _path of the url."""
    rest = F.when(F.instr(F.col("_url"), "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    return (
        df.withColumn("_url", F.col(url_col).cast("string"))
        .withColumn("_host", F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER))
        .withColumn("_path", F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")))
    )


def token_index(rules: Iterable[UrlRule]) -> tuple[list[UrlRule], dict[str, list[int]]]:
    """The rules in order of preference, and for each token the places of the rules listed there."""
    ranked = sorted(set(rules), key=lambda r: (-len(r.name), r.name, r.action))
    common = Counter(t for r in ranked for t in set(r.tokens()))
    index: dict[str, list[int]] = {}
    for place, rule in enumerate(ranked):
        own = rule.tokens() or ["*"]
        index.setdefault(min(own, key=lambda t: (common[t], -len(t), t)), []).append(place)
    return ranked, index


def url_tokens() -> Column:
    hosts = F.transform(F.split("_host", r"\."), lambda x: F.concat(F.lit("h:"), x))
    paths = F.transform(F.split("_path", "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(hosts, paths, F.array(F.lit("*"))))


def judge_urls(pages: DataFrame, rules: Iterable[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", literal_rules: int = LITERAL_RULES) -> DataFrame:
    """Return id, url, host, path, rule (its text, null if none) and verdict of every row."""
    ranked, index = token_index(rules)
    rows = parts(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_given")), "_given")
    whole = F.concat("_host", "_path")
    if not ranked:
        best = rows.withColumn("_best", F.lit(None).cast("int"))
    elif len(ranked) <= literal_rules:
        places = F.map_from_arrays(F.lit(list(index)), F.array(*[F.lit(v) for v in index.values()]))
        patterns = F.lit([r.pattern for r in ranked])
        found = F.flatten(F.transform(F.filter(url_tokens(), lambda t: F.map_contains_key(places, t)), lambda t: F.element_at(places, t)))
        fits = F.filter(found, lambda k: F.rlike(whole, F.element_at(patterns, k + 1)))
        best = rows.withColumn("_best", F.array_min(fits))
    else:
        spark = pages.sparkSession
        table = spark.createDataFrame([(t, k, ranked[k].pattern) for t, places in index.items() for k in places], "token string, place int, pattern string")
        table = F.broadcast(table) if len(ranked) <= BROADCAST_RULES else table
        texts = rows.select("_host", "_path").distinct()
        hits = texts.withColumn("token", F.explode(url_tokens())).join(table, "token").filter(F.rlike(whole, F.col("pattern")))
        best = rows.join(hits.groupBy("_host", "_path").agg(F.min("place").alias("_best")), ["_host", "_path"], "left")
    if not ranked:
        name = action = F.lit(None).cast("string")
    elif len(ranked) <= literal_rules:
        name, action = (F.get(F.lit([getattr(r, k) for r in ranked]), F.coalesce("_best", F.lit(-1))) for k in ("name", "action"))
    else:
        named = pages.sparkSession.createDataFrame([(k, r.name, r.action) for k, r in enumerate(ranked)], "_best int, _name string, _action string")
        best, name, action = best.join(named, "_best", "left"), F.col("_name"), F.col("_action")
    return best.select(
        F.col("_id").alias(id_col), F.col("_given").alias(url_col), F.col("_host").alias("host"), F.col("_path").alias("path"), name.alias("rule"), F.coalesce(action, F.lit(default)).alias("verdict")
    )

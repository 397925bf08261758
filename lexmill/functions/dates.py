"""Dates from free text, identifiers and parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_any(text: Column, formats: list[str]) -> Column:
    """ISO form by the first format that fits; otherwise the text as it is."""
    fits = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*[F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss") for x in fits], text)


def day_month_year(text: Column) -> Column:
    """Dates like 05-Jan-2001."""
    return F.to_date(F.try_to_timestamp(text, F.lit("dd-MMM-yyyy")))


def truncated_iso(text: Column) -> Column:
    """ISO time without what follows the first full stop."""
    return F.try_to_timestamp(F.split_part(text, F.lit("."), F.lit(1)), F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def from_name(name: Column, missing: str = "9999-01-01") -> Column:
    """The date in a file name, or the missing one."""
    return F.coalesce(F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), F.lit(missing))


def from_identifier(name: Column) -> Column:
    """The first of -YYYYMMDD-, YYYYMMDD and -YYYY-MM-DD that is a real date."""
    found = [F.regexp_replace(F.regexp_extract(name, p, 1), "-", "") for p in (r"-(\d{8})-", r"(\d{8})", r"-(\d{4}-\d{2}-\d{2})")]
    return F.coalesce(*[F.to_date(F.try_to_timestamp(F.nullif(x, F.lit("")), F.lit("yyyyMMdd"))) for x in found])


def version_parts(text: Column) -> Column:
    """Major, minor and patch of the first version number; zeros without one."""
    p = r"(0|[1-9]\d*)\.(0|[1-9]\d*)(?:\.(0|[1-9]\d*))?"
    return F.struct(*[F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(text, p, k), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0)).alias(n) for k, n in ((1, "major"), (2, "minor"), (3, "patch"))])


def partial_date(dates: Column, kinds: tuple[str, ...] = ("pub", "epub", "pmc-release", "ppub")) -> Column:
    """Of structs (kind, year, month, day) the first kind in order that has a year; months and days default to 1."""
    of = lambda kind: F.get(F.filter(dates, lambda d: (d.kind == kind) & d.year.isNotNull()), F.lit(0))
    best = F.coalesce(*[of(k) for k in kinds])
    return F.make_date(best["year"].cast("int"), F.coalesce(best["month"].cast("int"), F.lit(1)), F.coalesce(best["day"].cast("int"), F.lit(1)))

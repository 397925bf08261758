"""Licenses: fixed names, and the rules that read them from URLs and lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, let, strip

#: Names of the licenses that documents may have.
PERMISSIVE = {
    "PD": "Public Domain",
    "CC0": "Creative Commons Zero - Public Domain - https://creativecommons.org/publicdomain/zero/1.0/",
    "CC_PDM": "Creative Commons Public Domain Mark - https://creativecommons.org/publicdomain/mark/1.0/",
    "CC_BY": "Creative Commons - Attribution - https://creativecommons.org/licenses/by/4.0/",
    "CC_BY_3": "Creative Commons - Attribution - https://creativecommons.org/licenses/by/3.0/",
    "CC_BY_2_5": "Creative Commons - Attribution - https://creativecommons.org/licenses/by/2.5/",
    "CC_BY_2": "Creative Commons - Attribution - https://creativecommons.org/licenses/by/2.0/",
    "CC_BY_SA": "Creative Commons - Attribution Share-Alike - https://creativecommons.org/licenses/by-sa/4.0/",
    "CC_BY_SA_3": "Creative Commons - Attribution Share-Alike - https://creativecommons.org/licenses/by-sa/3.0/",
    "CC_BY_SA_2_5": "Creative Commons - Attribution Share-Alike - https://creativecommons.org/licenses/by-sa/2.5/",
    "CC_BY_SA_2_1": "Creative Commons - Attribution Share-Alike - https://creativecommons.org/licenses/by-sa/2.1/",
    "CC_BY_SA_1": "Creative Commons - Attribution Share-Alike - https://creativecommons.org/licenses/by-sa/1.0/",
    "GFDL": "GNU Free Documentation License",
    "APACHE_2": "Apache 2 License - https://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "MIT License",
    "BSD_2": "BSD 2-Clause",
    "BSD_3": "BSD 3-Clause",
    "ISC": "ISC License",
    "ARTISTIC_2": "Artistic License 2.0",
    "CDLA_P": "Community Data License Agreement - Permissive 1.0 - https://cdla.dev/",
    "OPL": "Open Parliament Licence - https://www.parliament.uk/site-information/copyright-parliament/open-parliament-licence/",
}
RESTRICTIVE = {
    "CC_BY_NC": "Creative Commons - Attribution Non-Commercial",
    "CC_BY_NC_SA": "Creative Commons - Attribution Non-Commercial Share-Alike",
    "CC_BY_ND": "Creative Commons - Attribution No Derivatives",
    "CC_BY_NC_ND": "Creative Commons - Attribution Non-Commercial No Derivatives",
    "GPL": "GNU General Public License",
}
#: License by version, without and with share-alike. Version 2.0 has one for both.
BY_VERSION = {"4.0": ("CC_BY", "CC_BY_SA"), "3.0": ("CC_BY_3", "CC_BY_SA_3"), "2.5": ("CC_BY_2_5", "CC_BY_SA_2_5"), "2.1": (None, "CC_BY_SA_2_1"), "2.0": ("CC_BY_2", "CC_BY_2"), "1.0": (None, "CC_BY_SA_1")}


def parse_license(text: Column, strict: bool = False) -> Column:
    """Short name of the license that a string means; null, or with ``strict`` an error, where none is known. The patterns are fixed values."""
    s = F.lower(strip(text))
    found = r"(?:/licenses/)?by(-sa)?/(\d.\d)/?"
    share, version = F.regexp_extract(s, found, 1) != "", F.regexp_extract(s, found, 2)
    rules = F.when(s.rlike(r"^.*/publicdomain/zero/1.0/?$"), "CC0").when(s.rlike(r"^.*/publicdomain/mark/1.0/?$"), "CC_PDM").when(s.rlike(r"^.*/publicdomain/"), "PD")
    for number, names in BY_VERSION.items():
        for shared, name in zip((False, True), names):
            if name:
                rules = rules.when((version == number) & (share == shared), name)
    rules = rules.when((s == "gfdl") | s.contains("gnu_free_documentation_license"), "GFDL")
    return F.coalesce(rules, F.raise_error(F.concat(F.lit("no such license: "), s))) if strict else rules


def license_name(short: Column) -> Column:
    """Full name of a permissive license."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in PERMISSIVE.items() for x in kv]), short)


#: Exact keys of several catalogues.
CATALOGUE = {
    "articles": {
        "http://creativecommons.org/licenses/by-sa/4.0/": "CC_BY_SA",
        "http://creativecommons.org/licenses/by/3.0/": "CC_BY_3",
        "http://creativecommons.org/licenses/by/4.0/": "CC_BY",
        "http://creativecommons.org/licenses/publicdomain/": "PD",
        "http://creativecommons.org/publicdomain/zero/1.0/": "CC0",
    },
    "textbooks": {"CC BY": "CC_BY", "CC BY-SA": "CC_BY_SA", "CC0": "CC0", "Public Domain": "PD"},
    "medical": {"CC0": "CC0", "CC BY": "CC_BY", "CC BY-SA": "CC_BY_SA"},
    "courses": {"Public Domain": "PD", "CC BY": "CC_BY", "CC BY-SA": "CC_BY_SA"},
    "libraries": {"ccby": "CC_BY", "ccby 30": "CC_BY_3", "ccbysa": "CC_BY_SA", "ccbysa 30": "CC_BY_SA_3", "ccbysa 25": "CC_BY_SA_2_5", "gnufdl": "GFDL", "publicdomain": "PD"},
}
#: Fixed values, in order: the first part that a license text contains decides.
CONTAINED = (
    ("creativecommons.org/licenses/by/4.0", "CC_BY"),
    ("creativecommons.org/licenses/by/3.0", "CC_BY_3"),
    ("creativecommons.org/licenses/by-sa/4.0", "CC_BY_SA"),
    ("creativecommons.org/licenses/by-sa/3.0", "CC_BY_SA_3"),
)


def catalogue_license(key: Column, catalogue: str) -> Column:
    """License by exact key; null if the catalogue doesn't have it."""
    table = CATALOGUE[catalogue]
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def library_license(name: Column, version: Column) -> Column:
    """By name and version, or by the name alone where the version makes no difference."""
    return F.coalesce(catalogue_license(F.concat_ws(" ", name, version), "libraries"), catalogue_license(name, "libraries"))


def contained_license(text: Column) -> Column:
    rule = F.lit(None).cast("string")
    for part, name in reversed(CONTAINED):
        rule = F.when(text.contains(part), name).otherwise(rule)
    return rule


def all_approved(ids: Column, approved: list[str]) -> Column:
    """Whether every license id is approved: an empty list passes, a null list doesn't."""
    return F.coalesce(F.forall(ids, lambda x: F.coalesce(x.isin(approved), F.lit(False))), F.lit(False))


#: Markers of licenses that are not permissive, as whole words.
NOT_PERMISSIVE = ("NO-CC CODE", "CC BY-NC", "CC BY-ND", "CC BY-NC-ND", "CC BY-NC-NA", "CC BY-NC-SA")


def has_restrictive_mark(text: Column) -> Column:
    return text.rlike(r"(?<!\w)(?:" + "|".join(NOT_PERMISSIVE) + r")(?!\w)")


#: Statements that grant an open license.
STATEMENTS = (
    "http://creativecommons.org/licenses/by/4.0",
    "Creative Commons Attribution 3.0",
    "Creative Commons Attribution 4.0",
    "CC BY 4.0",
    "CC BY-SA 4.0",
    "Creative Commons Attribution CC-BY 4.0",
    "Creative Commons By Attribution Share Alike",
    "http://creativecommons.org/licenses/ by/3.0",
    "http://creativecommons.org/licenses/by/3.0",
    "https://creativecommons.org/licenses/by-sa/4.0",
    "Creative Commons Attribution-ShareAlike 4.0",
    "Creative Commons CC BY license",
    "Creative Commons Attribution (CC-BY)",
    "Creative Commons License CC-BY 4.0",
    "available under a CC-BY license",
    "https://creativecommons.org/licenses/by/4.0",
    "Creative Commons Namensnennung - Weitergabe unter gleichen Bedingungen 4.0",
    "Creative Commons Attribution – ShareAlike 4.0",
    "https://creativecommons.org/licenses/by/3.0/pl",
    "published under the most recent version of the Creative Commons CC-BY licence",
    "distributed under the Creative Commons Attribution (CC BY) license",
    "Individual articles may be downloaded and reproduced in accordance with the principles of the CC-BY licence",
    "distributed under the Creative Commons Attribution License (CC BY)",
)


def states_license(text: Column, statements: tuple[str, ...] = STATEMENTS, share: int = 20, least: int = 150) -> Column:
    """Whether the first or last lines (one in ``share``, ``least`` at least) hold a statement."""
    rows = F.split(text, "\n")
    n = F.greatest(F.floor(F.size(rows) / share).cast("int"), F.lit(least))
    ends = F.concat_ws("\n", F.array_join(F.slice(rows, F.lit(1), n), "\n"), F.array_join(F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), n), "\n"))
    return let(ends, lambda e: F.exists(F.lit(list(statements)), lambda s: F.contains(e, s)))


#: The expression that finds license marks in raw HTML.
IN_HTML = rf"(?i)creativecommons\.org/(?:licenses/(by(?:-sa|-nc|-nd)*)|publicdomain/(zero|mark))/(\d\.\d)|\bcc{SPACE}by(-sa|-nc|-nd)*\b"


def html_license(html: Column) -> Column:
    """URL of the first license link in a page; null without one."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)(creativecommons\.org/(?:licenses/by(?:-sa|-nc|-nd)*|publicdomain/(?:zero|mark))/\d\.\d)", 1)), F.lit(""))

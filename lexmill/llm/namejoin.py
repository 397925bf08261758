"""Join of names that differ by a few typing errors, by pieces that no error touches.

The distance of two names is the least number of insertions, deletions and
substitutions of one code point and exchanges of two adjacent ones, where what an
exchange has moved may be edited again (unrestricted Damerau-Levenshtein).

A name of the one side is split into 2 * most + 1 pieces of nearly equal length.
An error touches one piece, an exchange two at most, so that of ``most`` errors
one piece is left whole, and the other name holds it, shifted by what was inserted
or deleted before it. Names of that side are therefore searched for by the length
of the first name, the number of a piece and the substring that would be it. The
first piece left whole is enough, which leaves few shifts:

* pieces before it are all touched, so that for piece i at least half of i errors
  lie before it, and the lengths differ after it by the others at most;
* before piece 0 nothing is touched, so that it isn't shifted;
* an insertion or deletion touches one piece only, so that lengths that differ by
  d leave one of the first 2 * most - d + 1 pieces whole.

For one error this makes seven substrings a name. A pair that meets by several of
them is kept by the first, so that no pair has to be made distinct. What meets is
compared by Spark's Levenshtein distance, of which an exchange costs two, and what
that leaves by the distance above. Names too short for pieces are joined by
what is left of both after up to ``most`` deletions.

Both sides are made distinct first, so that a name that many rows have is compared
once. Everything is joined by shuffles, sorted and spilt by Spark; nothing is
broadcast, as both sides may be large.

Defined cases: names that are null, or empty once white space is gone, take no
part; an empty side gives an empty result; rows that repeat count as often as
they are there; other columns are not looked at and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

#: A substring that may be a piece: by how much the searched name is longer, the piece's number, its shift.
Shift = tuple[int, int, int]


def plain_name(name: Column) -> Column:
    """A to Z in lower case, without white space; null if nothing is left."""
    return F.nullif(F.translate(F.regexp_replace(name, r"[\x20\x09-\x0D]", ""), ascii_uppercase, ascii_lowercase), F.lit(""))


def misspelt(name: Column, key: Column) -> Column:
    """The name with two adjacent code points exchanged, where the checksum h of ``key`` is even: those at h mod (length - 1) and the next."""
    h = F.crc32(key.cast("string").cast("binary"))
    long_enough = F.char_length(name) >= 2
    at = (h % F.greatest(F.char_length(name) - 1, F.lit(1))).cast("int")
    swapped = F.concat(F.substr(name, F.lit(1), at), F.substr(name, at + 2, F.lit(1)), F.substr(name, at + 1, F.lit(1)), F.substr(name, at + 3))
    return F.when((h % 2 == 0) & long_enough, swapped).otherwise(name)


def distance(a: str, b: str, most: int) -> int | None:
    """Unrestricted Damerau-Levenshtein distance, or None beyond ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return None
    far = len(a) + len(b)
    # rows and columns -1 and 0 come first; an exchange goes back to the last place at which the two characters stood
    table = [[far] * (len(b) + 2), [far, *range(len(b) + 1)]]
    last_row: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        row, last_column = [far, i], 0
        for j, y in enumerate(b, 1):
            k, m = last_row.get(y, 0), last_column
            if x == y:
                last_column = j
            row.append(min(table[i][j] + (x != y), row[j] + 1, table[i][j + 1] + 1, table[k][m] + (i - k - 1) + 1 + (j - m - 1)))
        table.append(row)
        last_row[x] = i
    found = table[-1][-1]
    return found if found <= most else None


def shifts(most: int) -> list[Shift]:
    """Substrings of a name that may be the first whole piece of another, in the order in which they are tried."""
    return [
        (longer, i, s)
        for longer in range(-most, most + 1)
        for i in range(2 * most - abs(longer) + 1)
        for s in range(-most, most + 1)
        if abs(s) + abs(longer - s) <= most and abs(longer - s) <= most - (i + 1) // 2 and (i or not s)
    ]


def _start(length: Column, piece: int, pieces: int) -> Column:
    return F.floor(length * piece / pieces).cast("int")


def _piece(name: Column, length: Column, piece: int, pieces: int, shift: int = 0) -> Column:
    """A substring of ``name``: where a name of ``length`` has its piece, shifted; null where it would leave the name."""
    start, end = _start(length, piece, pieces) + shift, _start(length, piece + 1, pieces) + shift
    return F.when((length >= pieces) & (start >= 0) & (end <= F.char_length(name)), F.substr(name, start + 1, end - start))


def _key(length: Column, piece: int, text: Column) -> Column:
    return F.when(text.isNotNull(), F.xxhash64(length, F.lit(piece), text))


def _after_deletions(name: Column, most: int, longest: int) -> Column:
    """What is left of a name of up to ``longest`` code points after up to ``most`` deletions, each once."""
    points = F.split(name, "")
    left = []
    for kept in range(longest + 1):
        for places in combinations(range(longest), kept):
            fits = (F.char_length(name) - kept <= most) & (F.char_length(name) >= kept) & (F.char_length(name) > (places[-1] if places else -1))
            left.append(F.when(fits, F.concat(F.lit(""), *(F.get(points, F.lit(p)) for p in places))))
    return F.array_distinct(F.filter(F.array(*left), lambda x: x.isNotNull()))


def similar_names(own: DataFrame, others: DataFrame, most: int = 1) -> DataFrame:
    """Pairs of names within a distance of ``most``: own, other, distance. Each side is one column of distinct names, none null or empty."""
    pieces, tried = 2 * most + 1, shifts(most)
    own, others = own.toDF("own"), others.toDF("other")
    size, other_size = F.char_length("own"), F.char_length("other")
    cut = own.filter(size >= pieces).select("own", F.explode(F.array(*(_key(size, i, _piece(F.col("own"), size, i, pieces)) for i in range(pieces)))).alias("own_key"))
    keys = [_key(other_size - longer, i, _piece(F.col("other"), other_size - longer, i, pieces, s)) for longer, i, s in tried]
    searched = others.select("other", F.explode(F.filter(F.array(*(F.struct(F.lit(k).alias("place"), key.alias("key")) for k, key in enumerate(keys))), lambda x: x["key"].isNotNull())).alias("at"))
    searched = searched.select("other", F.col("at.place").alias("place"), F.col("at.key").alias("other_key"))
    # of the substrings by which a pair meets the first one counts
    first = F.coalesce(
        *(
            F.when((other_size - size == longer) & (_piece(F.col("own"), size, i, pieces) == _piece(F.col("other"), size, i, pieces, s)), F.lit(k))
            for k, (longer, i, s) in enumerate(tried)
        )
    )
    near = F.levenshtein(F.col("own"), F.col("other"), 2 * most) >= 0
    met = cut.join(searched.hint("merge"), (F.col("own_key") == F.col("other_key")) & near & (first == F.col("place"))).select("own", "other")
    short, longest = own.filter(size < pieces), 3 * most
    short = short.select("own", F.explode(_after_deletions(F.col("own"), most, 2 * most)).alias("own_left"))
    brief = others.filter(other_size <= longest).select("other", F.explode(_after_deletions(F.col("other"), most, longest)).alias("other_left"))
    short_met = short.join(brief.hint("merge"), F.col("own_left") == F.col("other_left")).select("own", "other").distinct()
    return verified(met.unionByName(short_met), most)


def verified(pairs: DataFrame, most: int) -> DataFrame:
    """Pairs (own, other) within the distance, with it."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["distance"] = [distance(a, b, most) for a, b in zip(batch["own"], batch["other"], strict=True)]
            found = batch.dropna(subset=["distance"])
            yield found.astype({"distance": "int32"})

    return pairs.mapInPandas(measure, "own string, other string, distance int")


def name_digest(clients: DataFrame, vendors: DataFrame, most: int = 1) -> DataFrame:
    """Per vendor id and distance: how many client rows have a name at that distance from the misspelt one, their least id and the sum of their ids' checksums.

    A vendor without an id keeps its name. Every pair of rows counts, of rows that repeat too.
    """
    named = vendors.select("vendor_id", plain_name(misspelt(F.col("name"), F.col("vendor_id"))).alias("own")).filter("own IS NOT NULL")
    by_name = clients.select("client_id", plain_name(F.col("name")).alias("other")).filter("other IS NOT NULL").groupBy("other")
    checksum = F.crc32(F.col("client_id").cast("string").cast("binary"))
    counted = staged(by_name.agg(F.count(F.lit(1)).alias("n_clients"), F.min("client_id").alias("first_client_id"), F.sum(checksum).alias("clients_crc")), "names")
    pairs = similar_names(named.select("own").distinct(), counted.select("other"), most)
    found = pairs.join(counted.hint("merge"), "other")
    totals = lambda df, *by: df.groupBy(*by).agg(F.sum("n_clients").alias("n_clients"), F.min("first_client_id").alias("first_client_id"), F.sum("clients_crc").alias("clients_crc"))
    return totals(named.join(totals(found, "own", "distance").hint("merge"), "own"), "vendor_id", "distance")

"""A Bloom filter as a table: n-grams seen before, in a size that is set beforehand.

The filter is an array of 64-bit words. An n-gram sets a few bits of one word, both
chosen by its number, so that a row (word, bits) is all that it needs: the table is
built by one aggregation, ``bit_or`` by word, and asked by one join on the word. It
holds the words that are not zero, is partitioned by ranges of words, and may be
larger than any machine. How many words and bits it takes to keep the rate of false
positives for a number of items follows from the distribution of items over words.

A state on disk is a folder of versions. A run reads the latest whole one; adding
writes the next, so that a run that fails leaves the old one as it was.

Defined cases: a state that is not there yet is empty; null n-grams are left out;
n-grams that repeat set the same bits; an n-gram that was added is always found.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import asdict, dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Salts of the two hashes of an n-gram's number.
_WORD, _BITS = 11, 12


@dataclass(frozen=True)
class BloomSpec:
    """items: as many n-grams as the filter is made for; rate: of n-grams never added that it takes for seen, once it holds them."""

    items: int
    rate: float = 0.01

    def __post_init__(self) -> None:
        if self.items < 1 or not 0 < self.rate < 1:
            raise ValueError(f"no such filter: {self}")

    @property
    def shape(self) -> tuple[int, int]:
        """Words, and bits an item sets."""
        return _shape(self.items, self.rate)

    @property
    def words(self) -> int:
        return self.shape[0]

    def expected_rate(self, items: int | None = None) -> float:
        """Of false positives once ``items`` have been added."""
        words, bits = self.shape
        return _rate((items if items is not None else self.items) / words, bits)


def _rate(load: float, bits: int) -> float:
    """False positives where a word holds ``load`` items on average: a Poisson mean over the share of bits that are set."""
    total, chance = 0.0, math.exp(-load)
    for k in range(int(load + 12 * math.sqrt(load) + 20)):
        if k:
            chance *= load / k
        total += chance * (1 - (1 - 1 / 64) ** (bits * k)) ** bits
    return total


@lru_cache(maxsize=64)
def _shape(items: int, rate: float) -> tuple[int, int]:
    """The fewest words that keep the rate, over the numbers of bits."""
    best = None
    for bits in range(1, 17):
        low, high = 1e-6, 64.0
        if _rate(low, bits) > rate:
            continue
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if _rate(middle, bits) <= rate else (low, middle)
        words = math.ceil(items / low)
        if best is None or words < best[0]:
            best = words, bits
    return best


def place(gram: Column, spec: BloomSpec) -> tuple[Column, Column]:
    """The word of an n-gram and the bits it sets there; bits may coincide."""
    words, bits = spec.shape
    word = F.pmod(F.xxhash64(F.lit(_WORD), gram), F.lit(words))
    spread = F.xxhash64(F.lit(_BITS), gram)
    if bits > 10:
        more = F.xxhash64(F.lit(_BITS + 1), gram)
    mask = F.lit(0).cast("long")
    for k in range(bits):
        own = F.shiftrightunsigned(spread if k < 10 else more, 6 * (k % 10)).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), own))
    return word, mask


def bits_of(grams: DataFrame, spec: BloomSpec, gram_col: str = "gram") -> DataFrame:
    """The filter (word, bits) of a column of n-grams."""
    word, mask = place(F.col(gram_col), spec)
    placed = grams.filter(F.col(gram_col).isNotNull()).select(word.alias("word"), mask.alias("mask"))
    return placed.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter of what is in one or the other."""
    return a.unionByName(b).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "word long, bits long")


class BloomState:
    """A filter on disk, read and added to run by run. A second maker of the folder must give the same spec."""

    def __init__(self, spark: SparkSession, path: str, spec: BloomSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found = self._versions()
        if found:
            known = json.loads(spark.read.text(f"{self._at(found[-1])}/spec").first()["value"])
            if known != asdict(spec):
                raise ValueError(f"the state was made for {known}")

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version:06d}"

    def _versions(self) -> list[int]:
        """Whole ones, in order: their bits and then their spec were written to the end."""
        if not self._files.exists(self._folder):
            return []
        numbers = [int(m[1]) for x in self._files.listStatus(self._folder) if (m := re.fullmatch(r"version=(\d+)", x.getPath().getName()))]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(n for n in numbers if self._files.exists(done(f"{self._at(n)}/spec/_SUCCESS")))

    def bits(self) -> DataFrame:
        found = self._versions()
        return self.spark.read.schema("word long, bits long").parquet(f"{self._at(found[-1])}/bits") if found else none(self.spark)

    def add(self, grams: DataFrame, gram_col: str = "gram") -> None:
        """Add n-grams as the next version, and drop the one before the last: it may still be read."""
        found = self._versions()
        number = found[-1] + 1 if found else 0
        bits = either(self.bits(), bits_of(grams, self.spec, gram_col))
        bits.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(f"{self._at(number)}/bits")
        self.spark.createDataFrame([(json.dumps(asdict(self.spec)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self._at(number)}/spec")
        for old in found[:-1]:
            self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._at(old)), True)

    def filled(self) -> float:
        """Share of all bits that are set."""
        return (self.bits().agg(F.sum(F.bit_count("bits"))).first()[0] or 0) / (64 * self.spec.words)

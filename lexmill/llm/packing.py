"""Vector best-fit packing of documents into sequences of bounded tokens.

A bin has three capacities: tokens, documents, and attention cost (the sum of
squared lengths). Pieces are taken by falling length; each goes to the open bin
that the rule prefers among those with room in every dimension: the least
weighted norm of what would be left (``norm``), or the largest weighted
dot-product of need and residual (``dot``); of equal scores, the bin with the
least tokens left, then documents, then cost.

Pieces of equal length are equal needs, and bins with equal residuals are
equal choices, so the packing is planned over the counts of the lengths: a
table of at most ``tokens`` rows, whatever the corpus. The plan is a list of
runs (so many pieces of a length into so many neighbouring bins). Each piece
then finds its run by its rank among the pieces of its length.

Under ``norm`` the bin that took a piece is preferred by the next piece of its
length for as long as it fits, so that a run fills a bin. Under ``dot`` each
piece makes its bin less preferred, so that a run puts one into each of the
equal bins and the choice is made anew.

Defined cases: null is an empty text, and an empty text has its end token
alone; only documents longer than a sequence (or than the piece that is named)
are cut, the shorter piece first, however long; repeated rows are packed each on
its own; an empty table has no piece; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import exact_rank, rank_buckets, staged
from .tokens import byte_bpe

TOKENS, END_ID = 1024, 2
#: Runs that may be broadcast: 40 bytes each.
BROADCAST_RUNS = 50_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, the weight of each dimension in the choice of a bin, and the longest piece (0: as long as a sequence)."""

    tokens: int = TOKENS
    documents: int = TOKENS
    cost: int = TOKENS * TOKENS
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"
    piece: int = 0


def scores(left: np.ndarray, need: np.ndarray, tops: np.ndarray, weights: np.ndarray, rule: str) -> np.ndarray:
    """Of bins by what is left in them: the lower, the better for the need."""
    if rule == "norm":
        over = (left - need) / tops * weights
        return (over * over).sum(axis=1)
    return -(left / tops * (need / tops) * weights).sum(axis=1)


def plan(counts: dict[int, int], capacity: Capacity) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs and the number of bins.

    A run (length, first rank, pieces, first bin, first offset, copies) puts
    piece r of the length at bin first + r // copies, the copies one after the other.
    """
    tops = np.array([capacity.tokens, capacity.documents, capacity.cost], np.int64)
    weights = np.array(capacity.weights)
    runs: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    first, size = np.empty(0, np.int64), np.empty(0, np.int64)
    left = np.empty((0, 3), np.int64)
    lengths = sorted((n for n, c in counts.items() if c), reverse=True)
    least = lengths[-1] if lengths else 0
    for n in lengths:
        need = np.array([n, 1, n * n], np.int64)
        if (need > tops).any():
            raise ValueError(f"a piece of {n} tokens fits no sequence")
        rank, rest = 0, counts[n]
        while rest:
            fits = np.flatnonzero((left >= need).all(axis=1))
            if len(fits):
                score = scores(left[fits], need, tops, weights, capacity.rule)
                best = fits[score == score.min()]
                k = best[np.lexsort(left[best].T[::-1])[0]]
            else:  # bins that are not there yet: as many as the rest can need
                k = len(first)
                first, size, left = np.r_[first, bins], np.r_[size, rest], np.vstack([left, tops])
                bins += rest
            copies = int(min(rest, (left[k] // need).min())) if capacity.rule == "norm" or not len(fits) else 1
            own = min(int(size[k]), rest // copies)
            used = own * copies
            runs.append((n, rank, used, int(first[k]), int(capacity.tokens - left[k][0]), copies))
            rank, rest = rank + used, rest - used
            new = (left[k] == tops).all()
            after = left[k] - copies * need
            if own < size[k]:
                if new:  # take back what is not needed; a last part bin opens on the next turn
                    bins -= int(size[k]) - own
                    size[k] = own
                    left[k] = after
                else:
                    first, size, left = np.r_[first, first[k] + own], np.r_[size, size[k] - own], np.vstack([left, left[k]])
                    size[k], left[k] = own, after
            else:
                left[k] = after
            keep = (left[:, 0] >= least) & (left[:, 1] >= 1) & (left[:, 2] >= least * least)
            first, size, left = first[keep], size[keep], left[keep]
    return runs, bins


def pieces_of(docs: DataFrame, path: str, tokens: int = TOKENS, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text once: piece from 0, start, length and checksum of its ids; the ids stay in the worker."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            own: list[tuple[int, int, int, int, int]] = []
            for k, text in enumerate(batch.column(1)):
                ids = np.append(bpe.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                raw = memoryview(ids.tobytes())
                start, end, piece = 0, (len(ids) - 1) % tokens + 1, 0
                while start < len(ids):
                    own.append((k, piece, start, end - start, zlib.crc32(raw[4 * start : 4 * end])))
                    start, end, piece = end, end + tokens, piece + 1
            flat = np.array(own, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(flat[:, 0])), pa.array(flat[:, 1].astype(np.int32)), pa.array(flat[:, 2]), pa.array(flat[:, 3]), pa.array(flat[:, 4])],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, capacity: Capacity = Capacity(), end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id and offset."""
    spark = docs.sparkSession
    pieces = staged(pieces_of(docs, path, capacity.piece or capacity.tokens, end_id, id_col, text_col), "packing")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    buckets = rank_buckets(sum(counts.values()))
    keyed = pieces.withColumn("_key", F.xxhash64("id", "piece", "ids_crc32"))
    bucket = F.floor((F.shiftrightunsigned(F.col("_key").bitwiseXOR(F.lit(-(1 << 63))), 32)) * buckets / F.lit(float(1 << 32))).cast("int")
    ranked = exact_rank(keyed, ["length"], bucket, ["_key", "id", "piece", "ids_crc32"], "_rank")
    table = spark.createDataFrame([(n, r, r + c, b, o, q) for n, r, c, b, o, q in runs], "length long, _from long, _to long, _bin long, _offset long, _copies long")
    table = F.broadcast(table) if len(runs) <= BROADCAST_RUNS else table
    at = F.col("_rank") - F.col("_from")
    return ranked.join(table, (ranked["length"] == table["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("_bin") + F.expr("(_rank - _from) div _copies")).alias("sequence_id"),
        (F.col("_offset") + (at % F.col("_copies")) * ranked["length"]).alias("offset"),
    )

"""Models of texts and sentences: hashed words and runs of bytes, a softmax over classes, fitted by gradients that tasks sum up.

Features are words and runs of 3 and of 5 bytes of the text in lower case, hashed
into a number of slots that is set beforehand: none is dropped for being rare, and
a model has one size whatever the corpus. They are made for whole batches in numpy.
Training keeps every text's slots and weights in blocks on the executors' disks; each
step is one pass over it, in which a task adds up its blocks' gradients and a tree
adds up the tasks', so that the driver gets one matrix of classes times slots.

Defined cases: rows without a label are left out, without any there is no model
(ValueError); null and empty texts have no features, and get the classes' shares;
texts are read whole; rows that repeat count as often as they are there.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .grams import mixed, texts_of, word_numbers, words_of
from .taggers import Tagger, register

#: Slots that features are hashed into, lengths of the runs of bytes, bytes of a text that are read at once, and of several texts.
SLOTS, RUNS, AT_ONCE, TOGETHER = 1 << 16, (3, 5), 1 << 20, 1 << 18
#: Steps of the fit, their length for rows of length one, and what keeps weights small.
STEPS, RATE, SHRINK = 40, 2.0, 1e-6
#: Classes that a model may tell apart.
CLASSES = 1000


def _keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Text and slot of every feature as one number, text * SLOTS + slot."""
    starts, ends = words_of(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint32), np.diff(offsets))
    last = np.uint64(SLOTS - 1)
    found = [owner[starts] * np.uint32(SLOTS) + (word_numbers(data, starts, ends) & last).astype(np.uint32)]
    wide, prime = data.astype(np.uint64), 0x100000001B3
    run = np.zeros(len(data), np.uint64)
    for k in range(max(RUNS)):
        many = len(data) - k
        if many <= 0:
            break
        run = run[:many]
        run *= np.uint64(prime)
        run += wide[k:]
        if k + 1 in RUNS:
            slot = mixed(run + np.uint64((k + 1) * prime ** (k + 1) & 0xFFFFFFFFFFFFFFFF)) & last
            own = owner[:many] * np.uint32(SLOTS) + slot.astype(np.uint32)
            found.append(own[owner[:many] == owner[k:]])
    return np.concatenate(found)


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some TOGETHER bytes, and of as many as _keys can number."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + TOGETHER, "right")))
        high = min(high, low + (1 << 32) // SLOTS)
        yield low, high
        low = high


def counted(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """By ranges of a column of strings: the range, and text (from its start), slot and count of its features, in order."""
    data, offsets = texts_of(pc.utf8_lower(column.cast(pa.string())))
    for low, high in _parts(np.diff(offsets)):
        if high == low + 1 and offsets[high] - offsets[low] > AT_ONCE:
            # a long text in pieces, which share the bytes that runs need
            counts = np.zeros(SLOTS, np.int64)
            for a in range(offsets[low], offsets[high], AT_ONCE):
                piece = data[a : min(a + AT_ONCE + max(RUNS) - 1, offsets[high])]
                counts += np.bincount(_keys(piece, np.array([0, len(piece)])), minlength=SLOTS)
            slot = np.flatnonzero(counts)
            yield low, high, np.zeros(len(slot), np.int64), slot, counts[slot]
        else:
            key = np.sort(_keys(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]))
            at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            own = key[at].astype(np.int64)
            yield low, high, own // SLOTS, own & (SLOTS - 1), np.diff(np.r_[at, len(key)])


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, slot and weight, 1 + log of the count, of the features of a column of strings, in order."""
    out = [(text + low, slot, counts) for low, _, text, slot, counts in counted(column)]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    text, slot, counts = (np.concatenate([o[k] for o in out]) for k in range(3))
    return text, slot, 1 + np.log(counts)


def _unit(text: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Weights of rows of length one."""
    length = np.sqrt(np.bincount(text, weight * weight, rows))
    return weight / np.maximum(length, 1e-12)[text]


@dataclass(frozen=True)
class Model:
    """Weights of each class by slot, with what every slot's weight is multiplied by, and the classes' own."""

    classes: tuple
    weights: np.ndarray
    rarity: np.ndarray
    own: np.ndarray

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        """A row per text, a column per class."""
        scores = np.zeros((len(texts), len(self.weights))) + self.own
        for low, high, text, slot, counts in counted(texts):
            value = _unit(text, (1 + np.log(counts)) * self.rarity[slot], high - low)
            for k, w in enumerate(self.weights):
                scores[low:high, k] += np.bincount(text, value * w[slot], high - low)
        return _softmax(scores)


def _softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def _summed(rows: RDD, partial, size: int) -> np.ndarray:
    """Sum of arrays that partial makes of the blocks of rows, over all tasks and in a tree."""

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros(size)
        for block in blocks:
            total += partial(_Rows(block))
        yield total

    depth = max(2, math.ceil(math.log(max(2, rows.getNumPartitions()), 8)))
    return rows.mapPartitions(run).treeAggregate(np.zeros(size), lambda a, b: a + b, lambda a, b: a + b, depth)


#: Texts as training keeps them, by slot: label of each; slots of features met once in their text, then of the others; how many texts
#: each of them has, and how many are of the first kind; the texts; the weights of the others.
BLOCK = "labels binary, slots binary, sizes binary, first long, texts binary, weights binary"
#: Features and texts of a block, and features that are worked on at once.
BLOCK_FEATURES, BLOCK_TEXTS, STRIDE = 1 << 22, 1 << 16, 1 << 14


def _block(labels: list[np.ndarray], found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    text, slot, counts = (np.concatenate([own[k] for own in found]) for k in range(3))
    once = counts == 1
    single = np.sort((slot[once] * BLOCK_TEXTS + text[once]).astype(np.uint32))
    # sorted by slot and text, with the count in the lower half
    other = np.sort((slot[~once] * BLOCK_TEXTS + text[~once] << 31) + counts[~once])
    slots, sizes, texts = [], [], []
    for key in (single, other >> 31):
        here = key >> 16
        at = np.flatnonzero(np.r_[True, here[1:] != here[:-1]]) if len(key) else np.zeros(0, np.int64)
        slots.append(here[at])
        sizes.append(np.diff(np.r_[at, len(key)]))
        texts.append((key & 0xFFFF).astype(np.uint16))
    weights = (1 + np.log(other & 0x7FFFFFFF)).astype(np.float32)
    columns = [np.concatenate(labels).astype(np.int32), np.concatenate(slots).astype(np.uint16), np.concatenate(sizes).astype(np.int32), np.concatenate(texts), weights]
    made = [pa.array([x.tobytes()], pa.binary()) for x in columns]
    return pa.RecordBatch.from_arrays([*made[:3], pa.array([len(slots[0])]), *made[3:]], names=[c.split()[0] for c in BLOCK.split(", ")])


def _blocks(batches: Iterator[pa.RecordBatch], at: dict) -> Iterator[pa.RecordBatch]:
    """Blocks of rows of label and text."""
    labels: list[np.ndarray] = []
    found: list[tuple[np.ndarray, ...]] = []
    texts = features = 0
    for batch in batches:
        label = np.array([at[x] for x in batch.column(0).to_pylist()], np.int32)
        for low, high, text, slot, counts in counted(batch.column(1)):
            for a in range(low, high, BLOCK_TEXTS):
                # one part, but for very many empty texts
                z = min(a + BLOCK_TEXTS, high)
                p, q = np.searchsorted(text, [a - low, z - low])
                if found and (texts + z - a > BLOCK_TEXTS or features + q - p > BLOCK_FEATURES):
                    yield _block(labels, found)
                    labels, found, texts, features = [], [], 0, 0
                labels.append(label[a:z])
                found.append((text[p:q] - (a - low) + texts, slot[p:q], counts[p:q]))
                texts, features = texts + z - a, features + int(q - p)
    if found:
        yield _block(labels, found)


class _Rows:
    """A block as a matrix of texts by slots, worked on in strides that stay in a processor's cache."""

    def __init__(self, block: tuple):
        labels, slots, sizes, first, texts, weights = block
        self.label, self.slots, self.sizes = np.frombuffer(labels, np.int32), np.frombuffer(slots, np.uint16).astype(np.intp), np.frombuffer(sizes, np.int32)
        self.texts, self.weights = np.frombuffer(texts, np.uint16), np.frombuffer(weights, np.float32)
        self.ends = np.r_[0, np.cumsum(self.sizes, dtype=np.int64)]
        self.single = len(self.texts) - len(self.weights)
        # no stride has features of both kinds
        marks = np.searchsorted(self.ends, np.arange(0, len(self.texts), STRIDE), "right") - 1
        self.marks = np.unique(np.r_[marks, first, len(self.sizes)])

    def strides(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray | None]]:
        """Range of slots, the texts of their features, and the weights unless all are one."""
        for low, high in zip(self.marks[:-1], self.marks[1:]):
            a, z = self.ends[low], self.ends[high]
            yield slice(low, high), self.texts[a:z].astype(np.intp), self.weights[a - self.single : z - self.single].astype(float) if a >= self.single else None

    def times(self, by_slot: list[np.ndarray], square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the sums of numbers by slot times its weights, and of square times those squared."""
        sums, squares = np.zeros((len(by_slot), len(self.label))), np.zeros(len(self.label))
        for own, texts, weights in self.strides():
            slots, sizes = self.slots[own], self.sizes[own]
            for k, numbers in enumerate([*by_slot, square]):
                values = np.repeat(numbers[slots], sizes)
                if weights is not None:
                    values *= weights
                    if k == len(by_slot):
                        values *= weights
                out = squares if k == len(by_slot) else sums[k]
                out += np.bincount(texts, values, len(out))
        return sums, squares

    def back(self, by_text: list[np.ndarray], out: np.ndarray) -> None:
        """Add to each slot the sums of numbers by text times its weights."""
        for own, texts, weights in self.strides():
            slots, starts = self.slots[own], self.ends[own] - self.ends[own.start]
            for k, numbers in enumerate(by_text):
                values = numbers[texts]
                if weights is not None:
                    values *= weights
                out[k][slots] += np.add.reduceat(values, starts)

    def met(self) -> np.ndarray:
        """Texts with each slot, and texts."""
        return np.r_[np.bincount(self.slots, self.sizes, SLOTS), len(self.label)]


def train(docs: DataFrame, label_col: str, text_col: str = "text", steps: int = STEPS, balanced: bool = False) -> Model:
    """Fit a model of the labelled rows; the classes are the labels in order. balanced: all classes weigh the same, however many rows they have.

    Texts are kept as blocks of two bytes a feature. What all classes have in common
    changes no probability and stays zero, so that the last class is what the others sum up to, negated.
    """
    known = docs.filter(F.col(label_col).isNotNull()).select(F.col(label_col).alias("label"), F.col(text_col).cast("string").alias("text"))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("label").cast("string")).limit(CLASSES + 1).collect()
    classes = tuple(r["label"] for r in sizes)
    if not classes:
        raise ValueError("no labelled rows")
    if len(classes) > CLASSES:
        raise ValueError(f"more than {CLASSES} classes")
    at = {c: k for k, c in enumerate(classes)}

    rows = known.mapInArrow(lambda batches: _blocks(batches, at), BLOCK).rdd.map(tuple).persist(StorageLevel.DISK_ONLY)
    try:
        return _fitted(rows, classes, [r["n"] for r in sizes], steps, balanced)
    finally:
        rows.unpersist()


def _fitted(rows: RDD, classes: tuple, rows_of: list[int], steps: int, balanced: bool) -> Model:
    found = _summed(rows, _Rows.met, SLOTS + 1)
    n = found[-1]
    rarity = np.log((1 + n) / (1 + found[:-1])) + 1
    many = len(classes)
    share = np.array([n / (many * own) if balanced else 1.0 for own in rows_of])

    def gradient(now: np.ndarray):
        weights, own, square = now[:, :SLOTS] * rarity, now[:, SLOTS], rarity**2

        def of(block: _Rows) -> np.ndarray:
            total = np.zeros((many - 1, SLOTS + 1))
            sums, squares = block.times(list(weights), square)
            unit = 1 / np.maximum(np.sqrt(squares), 1e-12)
            scores = sums * unit + own[:, None]
            wrong = _softmax(np.r_[scores, -scores.sum(axis=0, keepdims=True)].T).T
            wrong[block.label, np.arange(len(unit))] -= 1
            wrong = wrong[:-1] * share[block.label]
            block.back(list(wrong * unit), total[:, :SLOTS])
            total[:, SLOTS] = wrong.sum(axis=1)
            return total.ravel()

        return of

    # accelerated steps: each from a point beyond the last two
    now, last = np.zeros((many - 1, SLOTS + 1)), np.zeros((many - 1, SLOTS + 1))
    for k in range(steps if many > 1 else 0):
        ahead = now + (k - 1) / (k + 2) * (now - last)
        slope = _summed(rows, gradient(ahead), (many - 1) * (SLOTS + 1)).reshape(many - 1, -1) / n
        slope[:, :SLOTS] *= rarity
        last, now = now, ahead - RATE * (slope + SHRINK * ahead)
    now = np.r_[now, -now.sum(axis=0, keepdims=True)]
    return Model(classes, now[:, :SLOTS].astype(np.float32), rarity.astype(np.float32), now[:, SLOTS])


def predicted(docs: DataFrame, model: Model, text_col: str = "text", out: str = "predicted") -> DataFrame:
    """Add the likeliest class as text, the first of equals, and ``<out>_score``, its probability."""
    names = np.array([str(c) for c in model.classes], dtype=object)

    @F.pandas_udf("label string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = model.probabilities(pa.array(texts, pa.string()))
        return pd.DataFrame({"label": names[found.argmax(axis=1)] if len(found) else [], "score": found.max(axis=1, initial=0)})

    own = run(F.col(text_col))
    return docs.withColumn(out, own["label"]).withColumn(f"{out}_score", own["score"])


def class_tagger(model: Model, label) -> Tagger:
    """The probability of a class as a tagger of whole texts: ``english``, ``quality``."""
    at = model.classes.index(label)

    def run(text: Column) -> Column:
        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series(model.probabilities(pa.array(texts, pa.string()))[:, at])

        return S.whole(text, score(F.coalesce(text, F.lit(""))))

    return run


#: A sentence ends at its marks or its line.
SENTENCE = r"[^.!?\n]+[.!?\n]*"


def sentence_tagger(model: Model, label) -> Tagger:
    """The probability of a class as a tagger of sentences: ``toxic_sentence``, ``nsfw_sentence``."""
    at, sentence = model.classes.index(label), re.compile(SENTENCE)

    def run(text: Column) -> Column:
        @F.pandas_udf(S.SPANS)
        def scored(texts: pd.Series) -> pd.Series:
            found = [[(m.start(), m.end(), m[0]) for m in sentence.finditer(t or "")] for t in texts]
            scores = iter(model.probabilities(pa.array([x[2] for own in found for x in own], pa.string()))[:, at].tolist())
            return pd.Series([[{"start": a, "end": z, "score": next(scores)} for a, z, _ in own] for own in found], index=texts.index)

        return scored(text)

    return run


def register_class(name: str, model: Model, label) -> None:
    """For good; :func:`~.taggers.registered` holds for one query."""
    register(name, class_tagger(model, label))


def register_sentences(name: str, model: Model, label) -> None:
    register(name, sentence_tagger(model, label))

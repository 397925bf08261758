"""Toxicity by multiple-instance learning: labels are of documents, scores of sentences.

A document is a bag of sentences, which end at a full stop, exclamation mark,
question mark or line feed. A sentence has the probability p = sigmoid(b + sum
of the weights of its words and of their prefixes of 3 to 8 bytes); the
document has the noisy-or 1 - prod(1 - p). Weights are fitted to the document
labels by the gradient of that likelihood, so that blame falls on the sentences
that tell toxic documents from others; those are then located. Only features
that toxic documents have significantly more often than others take part.
Where those miss most of the toxic documents, as on small labelled tables, less
significant and rarer features do, by steps down to a z-score of 2 and two
documents.

The model is fitted on a sample of labelled documents of some ``sample`` rows
(a hash of the id below a rate). In how many documents each of the 2^20 feature
slots occurs is counted by every task for itself and then summed by slot; only
the places of the chosen features go to the one task that fits, as all other
sentences of a document are alike and count as a number. Scoring reads every text
whole, however long.

Defined cases: a null or empty text, or one without words, has score 0; without
labelled rows of both classes, or with too few for any feature to pass the last
step (one row of each, say), every score is 0; the fewer the labelled rows, the
more features are there by chance and the less scores can be relied on; of several labels for an id the
highest holds, null labels and ids are none; repeated rows score alike; an empty
table gives an empty one; extra columns are passed through, the result's names
win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged
from .words import ALNUM, LOWER, grouped, word_prefixes

BITS = 20
PREFIXES = (3, 4, 5, 6, 7, 8)
ENDS = np.array([chr(b) in ".!?\n" for b in range(256)])
#: Labelled rows of the sample; documents that a feature must be in, and its z-score, by steps; share of the toxic documents that features must reach, or else the next step is taken; passes, step and decay of the fit.
SAMPLE, LEAST, REACHED = 8000, ((5, 5.0), (4, 4.0), (3, 3.0), (2, 2.0)), 0.5
PASSES, STEP, DECAY = 200, 0.1, 2e-5


@dataclass
class Model:
    """Weights by feature slot, in rising order of the slots."""

    bias: float
    slots: np.ndarray
    weights: np.ndarray

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[self.slots] = self.weights
        return out


NONE = Model(-np.inf, np.empty(0, np.int32), np.empty(0))


def features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Starts and ends of the words, the words that have each kind of feature with its slot, and every word's sentence."""
    starts, ends, found = word_prefixes(data, ALNUM, PREFIXES)
    slots = [(words, (hashes >> np.uint64(64 - BITS)).astype(np.int32)) for words, hashes in found]
    return starts, ends, slots, np.cumsum(ENDS[data])[starts]


def featured(labelled: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """Label, feature slots in the order of their sentences, and how many each sentence has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, sizes = [], []
            for text in batch.column(0):
                _, _, found, sentences = features(np.frombuffer((text.as_py() or "").encode().translate(LOWER), np.uint8))
                at = np.concatenate([sentences[w] for w, _ in found])
                own.append(np.concatenate([s for _, s in found])[np.argsort(at, kind="stable")])
                sizes.append(np.unique(at, return_counts=True)[1].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))], names=["label", "slots", "sizes"])

    return labelled.select(F.col(text_col).cast("string"), F.col(label_col).cast("double")).mapInArrow(run, "label double, slots array<int>, sizes array<int>")


def significance(seen: np.ndarray, toxic: np.ndarray, documents: int, hot: int) -> np.ndarray:
    """z-score of the number of toxic documents among those that have a feature."""
    share = hot / documents
    return (toxic - seen * share) / np.sqrt(seen * share * (1 - share) + 1e-9)


def counted(bags: DataFrame) -> DataFrame:
    """Slot, seen and toxic: in how many documents, and toxic ones, a feature is. Slot -1 stands for all documents with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = np.zeros(1 + (1 << BITS), np.int64), np.zeros(1 + (1 << BITS), np.int64)
        for batch in batches:
            for y, own in zip(batch.column(0).to_numpy() > 0.5, arrays(batch.column(1))):
                if len(own):
                    own = np.r_[np.unique(own), -1]
                    seen[own] += 1
                    toxic[own] += y
        used = np.flatnonzero(seen)
        slots = np.where(used == 1 << BITS, -1, used).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(seen[used]), pa.array(toxic[used])], names=["slot", "seen", "toxic"])

    return bags.mapInArrow(run, "slot int, seen long, toxic long").groupBy("slot").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic"))


def arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values) for x in column]


def telling(bags: DataFrame) -> np.ndarray:
    """Slots of the features that are in enough documents and in toxic ones significantly more often, at the first step where they reach enough toxic ones."""
    counts = staged(counted(bags), "toxicity")
    total = counts.filter("slot = -1").first()
    if total is None or not 0 < total["toxic"] < total["seen"]:
        return np.empty(0, np.int32)
    least, score = LEAST[-1]
    share = total["toxic"] / total["seen"]
    z = (F.col("toxic") - F.col("seen") * share) / F.sqrt(F.col("seen") * share * (1 - share) + 1e-9)
    # features that pass the last step: a slot each of 2^20 at most
    some = counts.filter((F.col("slot") >= 0) & (F.col("seen") >= least) & (z >= score - 1e-6)).toArrow()
    slots, seen, toxic = (some.column(k).to_numpy() for k in range(3))
    order = np.argsort(slots)
    slots, seen, toxic = slots[order], seen[order], toxic[order]
    z = significance(seen, toxic, total["seen"], total["toxic"])
    steps = [np.sort(slots[(seen >= n) & (z >= s)]) for n, s in LEAST]

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.zeros((len(steps), 1 << BITS), bool)
        for k, told in enumerate(steps):
            marks[k, told] = True
        hits = np.zeros(len(steps), np.int64)
        for batch in batches:
            for own in arrays(batch.column(1)):
                if len(own):
                    hits += marks[:, own].any(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(steps))), pa.array(hits)], names=["step", "hits"])

    hits = {r["step"]: r["hits"] for r in bags.filter("label > 0.5").mapInArrow(reached, "step long, hits long").groupBy("step").agg(F.sum("hits").alias("hits")).collect()}
    enough = [k for k in range(len(steps)) if hits.get(k, 0) >= REACHED * total["toxic"]]
    return steps[enough[0] if enough else -1].astype(np.int32)


def fit(y: np.ndarray, kinds: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray, int, int]], passes: int = PASSES) -> Model:
    """Adam over all bags at once. bags: places of the features among ``kinds``, the sentence of each, the number of sentences with a feature, and that of all others."""
    if not y.any() or y.all():
        return NONE
    sizes, plain = np.array([n for _, _, n, _ in bags]), np.array([n for _, _, _, n in bags])
    ends = np.r_[0, np.cumsum(sizes)]
    which = np.concatenate([w for w, _, _, _ in bags])
    where = np.concatenate([s + first for (_, s, _, _), first in zip(bags, ends)])
    owner = np.repeat(np.arange(len(bags)), sizes)
    w, b = np.zeros(len(kinds)), -6.0
    mean, var, mean_b, var_b = np.zeros(len(kinds)), np.zeros(len(kinds)), 0.0, 0.0
    for t in range(1, passes + 1):
        gw, gb = gradient(w, b, y, which, where, owner, plain)
        gw += DECAY * w
        mean, var = 0.9 * mean + 0.1 * gw, 0.99 * var + 0.01 * gw * gw
        mean_b, var_b = 0.9 * mean_b + 0.1 * gb, 0.99 * var_b + 0.01 * gb * gb
        one, two = 1 - 0.9**t, 1 - 0.99**t
        w -= STEP * (mean / one) / (np.sqrt(var / two) + 1e-6)
        b -= STEP * (mean_b / one) / (np.sqrt(var_b / two) + 1e-6)
    return Model(float(b), kinds.astype(np.int32), w)


def gradient(w: np.ndarray, b: float, y: np.ndarray, which: np.ndarray, where: np.ndarray, owner: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, float]:
    """Of the mean loss -log P(label) of noisy-or bags, by the weights and the bias.

    which, where: features and their sentences. owner: the bag of each sentence
    with a feature. plain: the sentences of each bag that have none.
    """
    z = b + np.bincount(where, w[which], len(owner))
    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    p_plain = 1 / (1 + np.exp(-np.clip(b, -40, 40)))
    total = np.bincount(owner, np.logaddexp(0, z), len(y)) + plain * np.logaddexp(0, b)  # -log of the chance that no sentence is toxic
    pull = np.where(y, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-9), 1.0) / len(y)
    g = p * pull[owner]
    return np.bincount(which, g[where], len(w)), float(g.sum() + (pull * plain).sum() * p_plain)


def held_out(id_col: str) -> Column:
    """Rows that training must not see: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on the labelled documents that are not held out."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label")).dropna().filter(~held_out("_id"))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    rate = sample / max(1, known.count())
    if rate < 1:  # the lowest part of the 64-bit hashes
        known = known.filter(F.xxhash64("_id", F.lit(4)) < int(rate * 2**64) - 2**63)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    bags = staged(featured(rows, "_text", "_label"), "toxicity")
    kinds = telling(bags)
    if not len(kinds):
        return NONE

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, np.int32)
        place[kinds] = np.arange(len(kinds))
        for b in batches:
            which, where, sizes, plain = [], [], [], []
            for slots, inside in zip(arrays(b.column(1)), arrays(b.column(2))):
                own = place[slots]
                of = np.repeat(np.arange(len(inside)), inside)[own >= 0]
                used, at = np.unique(of, return_inverse=True)
                which.append(own[own >= 0])
                where.append(at.astype(np.int32))
                sizes.append(len(used))
                plain.append(len(inside) - len(used))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(which, pa.list_(pa.int32())), pa.array(where, pa.list_(pa.int32())), pa.array(sizes, pa.int32()), pa.array(plain, pa.int32())], names=["label", "which", "where", "n", "plain"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[tuple] = []
        for b in batches:
            own += [x for x in zip(b.column(0).to_pylist(), arrays(b.column(1)), arrays(b.column(2)), b.column(3).to_pylist(), b.column(4).to_pylist()) if x[3] + x[4]]
        own.sort(key=lambda x: (x[0], x[3], x[4], x[1].tobytes(), x[2].tobytes()))  # sums don't depend on the order of arrival
        model = fit(np.array([x[0] for x in own]) > 0.5, kinds, [x[1:] for x in own])
        yield pa.RecordBatch.from_arrays([pa.array([model.bias]), pa.array([model.weights.tobytes()], pa.binary())], names=["bias", "weights"])

    small = bags.mapInArrow(reduce, "label double, which array<int>, where array<int>, n int, plain int")
    fitted = small.repartition(1).mapInArrow(learn, "bias double, weights binary").first()
    weights = np.frombuffer(fitted["weights"], np.float64)
    return Model(fitted["bias"], kinds, weights) if len(weights) else NONE


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Add toxicity (the document's score) and toxic_sentences: start and end in code points, and score, where it is ``least`` or more."""
    out = docs.drop("toxicity", "toxic_sentences")
    kept = [c for c in out.columns if keep is None or c in keep]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema if f.name in kept)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, table = sent.value.bias, sent.value.table()
        for batch in batches:
            scores, found = [], []
            for _, _, data, offsets in grouped([(t or "").encode().translate(LOWER) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]):
                starts, ends, slots, sentences = features(data)
                weight = np.zeros(len(starts))
                for words, own in slots:
                    weight[words] += table[own]
                heads = np.flatnonzero(np.diff(sentences, prepend=-1))  # texts end with a line feed here, and so do their sentences
                z = bias + np.add.reduceat(weight, heads) if len(heads) else weight
                tails = np.r_[heads[1:], len(starts)] - 1
                of = np.searchsorted(heads, np.searchsorted(starts, offsets))
                hot = np.flatnonzero(z >= np.log(least / (1 - least)))
                for k, (a, y) in enumerate(zip(of[:-1], of[1:])):
                    scores.append(float(-np.expm1(-np.logaddexp(0, z[a:y]).sum())) if y > a else 0.0)
                    lead = lambda x: int(((data[offsets[k] : x] & 0xC0) != 0x80).sum())
                    found.append([{"start": lead(starts[heads[h]]), "end": lead(ends[tails[h]]), "score": float(1 / (1 + np.exp(-z[h])))} for h in hot[np.searchsorted(hot, a) : np.searchsorted(hot, y)]])
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64()), pa.array(found, span)], names=[*[n for n in batch.schema.names if n in kept], "toxicity", "toxic_sentences"])

    return out.mapInArrow(run, (fields + ", " if fields else "") + "toxicity double, toxic_sentences array<struct<start:long,end:long,score:double>>")


def toxicity_digest(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, held_out, score, predicted, and the number and place of offending sentences."""
    model = train(docs, labels, id_col, text_col)
    rows = score_toxicity(docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)), model, text_col, keep=[id_col])
    spans = F.transform("toxic_sentences", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string")))
    return rows.select(
        id_col, held_out(id_col).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), F.size("toxic_sentences").cast("long").alias("n_offending"), F.array_join(spans, ",").alias("offending")
    )

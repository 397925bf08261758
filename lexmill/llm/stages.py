"""Operators as filters and rewriters of a documents table, for pipelines.

Every stage but a packing returns the columns of its input, whatever they are;
``doc_id`` and ``text`` are needed. Rows are documents by their id: rows that
repeat a kept id stay, and rows without an id, which nothing tells apart, stay
if one of them does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neardup import near_duplicates
from .pii import find_pii
from .staging import maybe_in, staged
from .toxicity import score_toxicity, train


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list]:
    """The table with columns of the given names under names that no column has, and the columns that bring it back."""
    taken = {c.lower() for c in docs.columns}
    back = []
    for c in docs.columns:
        if c.lower() not in names:
            back.append(F.col(f"`{c}`"))
            continue
        free = next(x for x in (f"own{k}_{c}" for k in range(len(taken) + 1)) if x.lower() not in taken)
        taken.add(free.lower())
        docs = docs.withColumnRenamed(c, free)
        back.append(F.col(f"`{free}`").alias(c))
    return docs, back


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows with a toxicity below the threshold, by a model trained on the labelled ones among them.

    Null and empty texts have no toxicity and stay, as all rows do where nothing
    can be learnt (see :func:`~.toxicity.train`); repeated rows stay or go alike.
    """
    model = train(docs, labels)
    rows, back = _aside(docs, ("toxicity", "toxic_sentences"))
    return score_toxicity(rows, model, "text").filter(F.col("toxicity") < threshold).select(back)


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group: the one with the least id. Null and empty texts are in no group and stay."""
    judged = near_duplicates(docs.select("doc_id", "text"), width, percent).select(F.col("doc_id").alias("gone"), "kept")
    gone = staged(judged.groupBy("gone").agg(F.max("kept").alias("kept")).filter(~F.col("kept")).select("gone"), "removed")
    n = gone.count()
    # most rows are seen to stay without a shuffle of their texts
    stay = maybe_in(docs, "doc_id", gone, "gone", n, invert=True)
    rows = maybe_in(docs, "doc_id", gone, "gone", n).select(F.struct("*").alias("row"), F.col("doc_id").alias("id"))
    rest = rows.join(gone, F.col("id").eqNullSafe(F.col("gone")), "left_anti").select("row.*")
    return stay.unionByName(rest)


def redact_pii(docs: DataFrame) -> DataFrame:
    """Personal data in the text gives way to <KIND>; n_chars follows, where there is one. Null stays null; no row goes."""
    rows, back = _aside(docs, ("pii",))
    out = find_pii(rows, "text", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(back)

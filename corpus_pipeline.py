"""From documents to training sequences: drop toxic ones and near copies, redact personal data, pack.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. The last returns the pieces of the documents with their place in the
sequences.

Defined cases, for every stage: an empty table gives an empty one; null and
empty texts are documents, are never toxic, near copies or personal, and end as
a piece of one token; texts are read whole, however long; rows that repeat an id
share its fate, rows without an id stay if one of them does; columns beyond
doc_id and text are passed through under any names until the packing, which
returns its own. A stage's docstring says what is special to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import stages
from lexmill.llm.packing import Capacity, pack
from lexmill.llm.queries import table, vocabulary
from lexmill.llm.staging import staged
from lexmill.session import ship


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below a toxicity of 0.5, by a model of the labelled ones among them; all, where no label can be learnt from."""
    return stages.drop_toxic(docs, table(ship(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 in shingles of five words, directly or through others, the one with the least id."""
    ship(spark)
    return stages.drop_near_duplicates(docs, width=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, with personal data and secrets in their texts replaced by <KIND>; n_chars follows the text."""
    ship(spark)
    return stages.redact_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of every document, with its sequence and place in it; repeated rows are packed each on its own."""
    ship(spark)
    return pack(docs, vocabulary("byte_bpe_50k.json"), Capacity())


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("pii", pii), ("packing", packing)]

#: Trained scores and a tokenizer's ids can't be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

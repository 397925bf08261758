"""Tokenizer plumbing: word counts, encoding with a given vocabulary, conversion between formats. Vocabularies are given, never trained here."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pretokens
from .grams import slices_of

#: Special tokens and their ids.
SPECIAL = {"<pad>": 0, "<unk>": 1, "<|begin_of_text|>": 2, "<|end_of_text|>": 3}


def word_counts(docs: DataFrame, pattern: str = "tiktoken", text_col: str = "text", least: int = 1) -> DataFrame:
    """Word and count of the pre-tokens, partial counts before the shuffle."""
    return docs.select(F.explode(pretokens(F.col(text_col), pattern)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoded(docs: DataFrame, path: str, bos: int | None = None, eos: int | None = None, text_col: str = "text", offsets: bool = True) -> DataFrame:
    """Add ids and, unless they aren't wanted, offsets (start and end of each token in code points), with the given first and last ids. Texts are encoded in slices of a batch."""
    rest = docs.drop("ids", "offsets")
    at = rest.columns.index(text_col)
    lead, tail = ([bos] if bos is not None else []), ([eos] if eos is not None else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for part in slices_of(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                found = tokenizer.encode_batch(texts, add_special_tokens=False)
                ends = pa.array(np.cumsum([0, *(len(e) + len(lead) + len(tail) for e in found)]), pa.int32())
                ids = np.concatenate([np.array([*lead, *e.ids, *tail], np.int32) for e in found])
                out = [pa.ListArray.from_arrays(ends, pa.array(ids))]
                if offsets:
                    places = np.concatenate([np.array([*((0, 0) for _ in lead), *e.offsets, *((len(t), len(t)) for _ in tail)], np.int32).reshape(-1, 2) for e, t in zip(found, texts)])
                    out.append(pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(places[:, 0]), pa.array(places[:, 1])], names=["start", "end"])))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*part.schema.names, "ids", *(["offsets"] if offsets else [])])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(run, f"{fields}, ids array<int>" + (", offsets array<struct<start:int,end:int>>" if offsets else ""))


def decoded(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add decoded, the text of the ids, special tokens left out."""
    rest = rows.drop("decoded")
    at = rest.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            for part in slices_of(batch, at):
                texts = tokenizer.decode_batch([x or [] for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(run, f"{fields}, decoded string")


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def special_ids(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"] if t.get("special")}


def split_pattern(spec: dict) -> str | None:
    """The pattern of the first splitting step of a vocabulary file."""
    steps = spec.get("pre_tokenizer") or {}
    for step in steps.get("pretokenizers", [steps]):
        if step.get("type") == "Split":
            return step["pattern"].get("Regex")
    return None


def mergeable_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level vocabulary file: the other format's ranks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte, special = byte_characters(), {t["content"] for t in spec["added_tokens"]}
    return {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def same_ids(path: str, encode, texts: list[str]) -> list[str]:
    """Texts that another encoder gives other ids."""
    tokenizer = _tokenizer(path)
    return [t for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)) if list(encode(t)) != e.ids]

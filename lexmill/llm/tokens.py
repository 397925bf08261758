"""Byte-level BPE ids of whole texts, and token counts of their sections.

Every id stands for a fixed byte string, so the running sum of the lengths
gives each token's span without asking the tokenizer for offsets. A document
is encoded once; its token spans are joined to the section intervals by binary
search. A token that crosses a boundary goes, by the rule that is named, to
the section of its first byte (``first``), to that of its last (``last``), or
to the one that holds most of its bytes, the earlier of equals (``most``).

Defined cases: null is an empty text; an empty text has no token and one empty
section; a section ends after its line feed, the last at the end of the text;
text in a special token's form is encoded as that token; long texts are encoded
whole; repeated rows give equal results; an empty table gives an empty one; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet

#: Fixed value: the pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "last", "most")
#: White space from so many characters on is encoded on its own: the pattern backtracks over it, on a stack of bounded size. Unicode's white space.
_LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


class ByteBpe:
    """The vocabulary of a tokenizers JSON file, run by tiktoken: ids rank the merges."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bytes_of = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(bytes_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.one_piece = tiktoken.Encoding(f"{path}:piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.special = tuple(special)
        self.lengths = np.zeros(1 + max([*ranks.values(), *special.values()]), np.int64)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.lengths[i] = len(token)

    def ids(self, text: str) -> np.ndarray:
        """Of the whole text. Long white space is one piece of the pattern, but for its last character where a word follows."""
        parts, done = [], 0
        for run in _LONG_SPACE.finditer(text):
            last = run.end() == len(text) or text.startswith(self.special, run.end())
            end = run.end() if last else run.end() - 1
            parts += [self._short(text[done : run.start()]), self.one_piece.encode_to_numpy(text[run.start() : end], disallowed_special=())]
            done = end
        parts.append(self._short(text[done:]))
        return np.concatenate(parts).astype(np.uint32, copy=False)

    def _short(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One for each worker process."""
    return ByteBpe(path)


def attribute(lengths: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross a boundary.

    lengths: bytes of each token. starts: where the sections start, rising from 0.
    """
    end = np.cumsum(lengths)
    begin = end - lengths
    first = np.searchsorted(starts, begin, "right") - 1
    last = np.searchsorted(starts, end - 1, "right") - 1
    owner = {"first": first, "last": last}.get(rule)
    if owner is None:
        owner = first.copy()
        for k in np.flatnonzero(first != last):
            edges = np.clip(np.r_[starts[first[k] : last[k] + 1], end[k]], begin[k], end[k])
            owner[k] = first[k] + int(np.argmax(np.diff(edges)))
    return np.bincount(owner, minlength=len(starts)), np.bincount(owner[first != last], minlength=len(starts))


def lines(raw: bytes) -> np.ndarray:
    """Starts of the lines."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return np.r_[0, ends[ends < len(raw)]]


def char_offsets(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Code points before each byte offset."""
    lead = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.where(starts > 0, lead[np.maximum(starts, 1) - 1], 0) if len(raw) else np.zeros(len(starts), np.int64)


def section_tokens(docs: DataFrame, path: str, rule: str = "most", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per line of each text: section from 0, start and end in code points, n_tokens, n_crossing."""
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule}")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            own: list[list[np.ndarray]] = [[] for _ in range(6)]
            for k, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                raw = text.encode()
                starts = lines(raw)
                counts, crossing = attribute(bpe.lengths[bpe.ids(text)], starts, rule)
                chars = char_offsets(raw, starts)
                for part, x in zip(own, (np.full(len(starts), k), np.arange(len(starts)), chars, np.r_[chars[1:], len(text)], counts, crossing)):
                    part.append(x)
            flat = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(flat[0])), pa.array(flat[1].astype(np.int32)), *[pa.array(x) for x in flat[2:]]], names=[id_col, "section", "start", "end", "n_tokens", "n_crossing"]
            )

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, section int, start long, end long, n_tokens long, n_crossing long")


def field_tokens(rows: DataFrame, path: str, fields: list[str], separator: str = "\n", rule: str = "most", id_col: str = "doc_id") -> DataFrame:
    """A row per named field of each row, as if the fields were one text with separators; the separator counts to the field before it."""
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule}")
    kind = rows.schema[id_col].dataType.simpleString()
    gap = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            own, names, counts, crossings = [], [], [], []
            for k in range(batch.num_rows):
                raw = [(batch.column(1 + i)[k].as_py() or "").encode() for i in range(len(fields))]
                sizes = np.array([len(b) + len(gap) * (i < len(raw) - 1) for i, b in enumerate(raw)])
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                filled = np.flatnonzero(sizes > 0)
                n, crossing = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
                if len(filled):
                    n[filled], crossing[filled] = attribute(bpe.lengths[bpe.ids(gap.join(raw).decode())], starts[filled], rule)
                own += [k] * len(fields)
                names += fields
                counts += n.tolist()
                crossings += crossing.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own, pa.int64())), pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(crossings, pa.int64())], names=[id_col, "field", "n_tokens", "n_crossing"]
            )

    return rows.select(F.col(id_col), *[F.col(f).cast("string").alias(f"_f{k}") for k, f in enumerate(fields)]).mapInArrow(run, f"`{id_col}` {kind}, field string, n_tokens long, n_crossing long")

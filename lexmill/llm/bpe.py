"""Word-level byte BPE, encoded and decoded by batched numpy merge rounds.

The symbols of many words stand in one flat array. Each round looks every
neighbouring pair up by binary search over the sorted pair keys, takes the
lowest rank of each word and merges all its places at once; words without a
mergeable pair leave the array. Merging every place of a word's lowest pair is
the same as one place at a time, as a pair with the new symbol always ranks
later. A long word would need a round for each of its ranks, each over all its
symbols: its places wait under their rank instead, and a round looks only at
the lowest rank's places and their neighbours, so that its time grows with its length
and not with the square. Distinct words are encoded once and kept in a bounded cache.

The vocabulary file (tokenizers' JSON, with an end-of-word suffix, a
normaliser of NFC, white space and lower case, and special tokens that are
recognised in the text) is a parameter that every executor can open.

Defined cases: null is an empty text; an empty text has no ids and decodes to
an empty text; repeated rows give equal results; words may be as long as the
text; of places that overlap the leftmost is merged; an empty table gives an
empty one; other columns are passed through, but for one of the result's name.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

#: White space of the Unicode property, as the vocabulary's own pattern takes it.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NO_RANK = np.iinfo(np.int64).max
#: Words and their characters that the cache holds, and characters of text encoded together.
CACHE_WORDS, CACHE_CHARS, CHUNK_CHARS = 400_000, 20_000_000, 2_000_000
#: Bytes from which on a word is merged on its own.
LONG = 1024


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def newer_characters() -> tuple[str, dict[int, str]]:
    """Of the characters that Python's tables don't have: those that the tokenizers library takes for no letter or number, and its lower case."""
    unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    known = "".join(regex.findall(r"[\p{L}\p{N}]+", unknown))
    taken = {c for piece, _ in pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]+"), "removed", invert=True).pre_tokenize_str(known) for c in piece}
    lower = {ord(c): low for c in known if (low := normalizers.Lowercase().normalize_str(c)) != c}
    return "".join(c for c in known if c not in taken), lower | {0x3A3: "\u03c3"}  # a final sigma is lower-cased like any other


def _ranges(codes: Iterable[int]) -> str:
    """Characters as the inside of a class."""
    codes = sorted(codes)
    edges = [k for k in range(len(codes)) if k == 0 or codes[k] != codes[k - 1] + 1]
    return "".join(f"\\U{codes[a]:08x}-\\U{codes[z - 1]:08x}" for a, z in zip(edges, [*edges[1:], len(codes)]))


#: Fixed value: the pattern of the vocabulary, for texts without newer characters.
PLAIN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")


@lru_cache(maxsize=1)
def special_characters() -> re.Pattern:
    """Finds what needs :func:`word_pattern` or its own lower case."""
    odd, lower = newer_characters()
    return re.compile(f"[{_ranges({*map(ord, odd), *lower})}]")


@lru_cache(maxsize=1)
def word_pattern() -> regex.Pattern:
    """Fixed value: the pattern of the vocabulary, on the library's edition of Unicode."""
    spans = _ranges(map(ord, newer_characters()[0]))
    letter, number = (rf"[\p{{{x}}}--[{spans}]]" if spans else rf"\p{{{x}}}" for x in "LN")
    return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|[^{SPACE}{letter}{number}]+")


class WordBpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = np.empty(1 + max([*vocab.values(), *self.special.values()]), object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in alphabet], np.int64)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs))
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.word = word_pattern()
        self.lower, self.odd = newer_characters()[1], special_characters()
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.held = 0
        self.forget()

    def forget(self) -> None:
        self.ids = {s: np.uint32(i).tobytes() for s, i in self.special.items()}
        self.texts = {s: s for s in self.special}
        self.held = 0

    def words(self, text: str) -> list[str]:
        """Words of the normalised text; special tokens stand for themselves."""
        pieces = self.split_special.split(text) if self.split_special else [text]
        out: list[str] = []
        for k, piece in enumerate(pieces):
            if k & 1:
                out.append(piece)
            elif piece:
                pattern = PLAIN
                if not piece.isascii():
                    piece = unicodedata.normalize("NFC", piece)
                    if self.odd.search(piece):
                        piece, pattern = piece.translate(self.lower), self.word
                out += pattern.findall(piece.lower())
        return out

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair (NO_RANK: none) and its place among the keys."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK), at

    def merged_long(self, raw: bytes) -> np.ndarray:
        """The ids of one long word: rounds by rank, from a heap of the ranks that wait."""
        flat = np.frombuffer(raw, np.uint8)
        n = len(flat)
        symbols = self.inner[flat]
        symbols[-1] = self.last[flat[-1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        rank = np.full(n, NO_RANK)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(places: np.ndarray) -> None:
            """Rank the pairs that start at the places, and put them under their ranks."""
            places = places[after[places] < n]
            own, _ = self.ranked(symbols[places], symbols[after[places]])
            rank[places] = own
            places, own = places[own != NO_RANK], own[own != NO_RANK]
            order = np.argsort(own, kind="stable")
            places, own = places[order], own[order]
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            for a, z in zip(cuts, [*cuts[1:], len(own)]):
                r = int(own[a])
                if r not in waiting:
                    heapq.heappush(heap, r)
                    waiting[r] = []
                waiting[r].append(places[a:z])

        wait(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[alive[places] & (rank[places] == r)]
            # of a run of places that overlap, as in "aaa", every other one from the left
            count = np.arange(len(places))
            first = np.r_[True, after[places[:-1]] != places[1:]] if len(places) else np.empty(0, bool)
            places = places[(count - np.maximum.accumulate(np.where(first, count, 0))) % 2 == 0]
            if not len(places):
                continue
            gone = after[places]
            _, at = self.ranked(symbols[places], symbols[gone])
            symbols[places] = self.made[at]
            alive[gone] = False
            rank[gone] = rank[places] = NO_RANK
            after[places] = after[gone]
            inside = after[places] < n
            before[after[places][inside]] = places[inside]
            lead = before[places]
            wait(np.unique(np.r_[places, lead[lead >= 0]]))
        return symbols[alive]

    def merged(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        raw = [w.encode() for w in words]
        long = {k: self.merged_long(b) for k, b in enumerate(raw) if len(b) >= LONG}
        if long:
            short = [k for k in range(len(raw)) if k not in long]
            rest = self.merged([words[k] for k in short]) if short else []
            return [x for _, x in sorted([*long.items(), *zip(short, rest)], key=lambda x: x[0])]
        lengths = np.array([len(b) for b in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        while len(symbols):
            ranks = np.full(len(symbols), NO_RANK)
            own, at = self.ranked(symbols[:-1], symbols[1:])
            ranks[:-1] = np.where(owner[:-1] == owner[1:], own, NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            least = np.minimum.reduceat(ranks, starts)
            over = least == NO_RANK
            for k in np.flatnonzero(over):
                out[owner[starts[k]]] = symbols[starts[k] : starts[k] + sizes[k]]
            places = np.flatnonzero((ranks == np.repeat(least, sizes)) & (ranks != NO_RANK))
            # of places that overlap, as in "aaa", every other one from the left
            first = np.r_[True, np.diff(places) != 1] if len(places) else np.empty(0, bool)
            run = np.arange(len(places)) - np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
            places = places[run % 2 == 0]
            symbols[places] = self.made[at[places]]
            keep = np.repeat(~over, sizes)
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return out

    def learn(self, words: set[str]) -> None:
        """Put words into the cache."""
        new = [w for w in words if w not in self.ids]
        for start in range(0, len(new), 50_000):
            part = new[start : start + 50_000]
            for word, ids in zip(part, self.merged(part)):
                self.ids[word] = ids.astype("<u4").tobytes()
                self.texts[word] = " ".join(self.tokens[ids])
                self.held += len(word)

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """The ids of each text as little-endian 32-bit integers, and the decoded text."""
        for start, end in chunks([len(t) for t in texts], CHUNK_CHARS):
            if len(self.ids) > CACHE_WORDS or self.held > CACHE_CHARS:
                self.forget()
            split = [self.words(t) for t in texts[start:end]]
            self.learn(set().union(*split))
            for words in split:
                yield b"".join(map(self.ids.__getitem__, words)), " ".join(map(self.texts.__getitem__, words))

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.tokens[ids])


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours with a total of some ``most``, one at least."""
    start = total = 0
    for k, n in enumerate(sizes):
        total += n
        if total >= most or k == len(sizes) - 1:
            yield start, k + 1
            start, total = k + 1, 0


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One for each worker process."""
    return WordBpe(path)


def encode_words(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add ids, an array of the text's token ids."""
    out = docs.drop("ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            ids = pa.array([np.frombuffer(raw, "<u4").astype(np.int32) for raw, _ in bpe.encode(texts)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return out.mapInArrow(run, f"{fields}, ids array<int>")


def decode_words(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Add decoded, the text of the ids."""
    out = encoded.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            texts = pa.array([bpe.decode(np.array(x or [], np.int64)) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return out.mapInArrow(run, f"{fields}, decoded string")


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count and digests of every text's ids and of their decoded text; neither leaves the worker."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for ids, text in bpe.encode([t or "" for t in batch.column(1).to_pylist()]):
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Word n-grams as 64-bit numbers, computed for whole batches at once.

Words part at ASCII white space. A word's number is the sum, over its bytes, of a
mixed number of byte and place; an n-gram's is a polynomial in its words' numbers,
mixed again. All of it runs in numpy on the buffers of Arrow batches, in slices, so
that a long text or a long word needs no more room than its bytes and words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that are hashed at once, bytes of texts whose n-grams are made at once, and n-grams that a task holds before it combines and sends them.
SLICE, TEXTS, HELD = 1 << 20, 1 << 20, 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number from all of its bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings, and where each one starts, with the end of the last; nulls are empty."""
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    data = np.frombuffer(wide.buffers()[2], np.uint8) if wide.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end; none crosses from one text to the next."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.r_[False, inside[:-1]] & ~edge[:-1] if len(data) else inside
    after = np.r_[inside[1:], False] & ~edge[1:] if len(data) else inside
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(starts), np.uint64)
    for low in range(0, len(data), SLICE):
        high = min(low + SLICE, len(data))
        first, last = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        if first >= last:
            continue
        begin = np.maximum(starts[first:last], low)
        part = data[begin[0] : high].astype(np.uint64)
        place = np.arange(begin[0], high) - np.repeat(starts[first:last], np.diff(np.r_[begin, high]))
        part = mixed(part + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1))
        part[_SPACE[data[begin[0] : high]]] = 0
        sums[first:last] += np.add.reduceat(part, begin - begin[0])
    return mixed(sums + (ends - starts).astype(np.uint64))


def gram_numbers(words: np.ndarray, n: int) -> np.ndarray:
    """Of every run of n words."""
    many = max(len(words) - n + 1, 0)
    found = words[:many].copy()
    for k in range(1, n):
        found *= _BASE
        found += words[k : many + k]
    return mixed(found)


def slices_of(batch: pa.RecordBatch, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows of some TEXTS bytes of a column of strings, or of numbers of four bytes in lists, and at least one."""
    own = batch.column(column)
    sizes = pc.multiply(pc.list_value_length(own), 4) if pa.types.is_list(own.type) else pc.binary_length(own)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(batch):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + TEXTS, "right")))
        yield batch.slice(low, high - low)
        low = high


def grams_of_batch(column: pa.Array, n: int, by_line: bool) -> tuple[np.ndarray, ...]:
    """n-grams in the order of the texts: text, line (0 unless by_line), number, and the first byte and the end of each within its text."""
    data, offsets = texts_of(column)
    starts, ends = words_of(data, offsets)
    numbers = gram_numbers(word_numbers(data, starts, ends), n)
    text = np.searchsorted(offsets, starts, "right") - 1
    line = np.zeros(len(starts), np.int64)
    if by_line and len(starts):
        breaks = np.flatnonzero(data == 10)
        line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[text]
    many = len(numbers)
    whole = (text[:many] == text[n - 1 :][:many]) & (line[:many] == line[n - 1 :][:many])
    kept = np.flatnonzero(whole)
    own = text[kept]
    return own, line[kept], numbers[kept], starts[kept] - offsets[own], ends[kept + n - 1] - offsets[own]


def _combined(ids: pa.Array, text: np.ndarray, line: np.ndarray, gram: np.ndarray) -> list[pa.Array]:
    """What a task knows of some texts: see :func:`gram_rows`."""
    rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    unit = rank[text] * (int(line.max(initial=0)) + 1) + line
    order = np.lexsort((text, unit, gram))
    g, u, t, k = gram[order], unit[order], text[order], line[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (u[1:] != u[:-1]) | (t[1:] != t[:-1])] if len(g) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    many = np.diff(np.r_[at, len(g)])
    g, u, t, k = g[at], u[at], t[at], k[at]
    head = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    least = np.repeat(u[head], np.diff(np.r_[np.flatnonzero(head), len(g)]))
    met = u > least
    # a text's line is a unit, whatever other rows have its id
    place = t * (int(k.max(initial=0)) + 1) + k
    units, first, back = np.unique(place, return_index=True, return_inverse=True)
    total = np.bincount(back, many, len(units)).astype(np.int64)
    seen = np.bincount(back, many * met, len(units)).astype(np.int64)
    sent = ~met
    # totals travel with the first n-gram of the unit that is sent, or on their own
    carrier = np.full(len(units), len(g))
    np.minimum.at(carrier, back[sent], np.flatnonzero(sent))
    alone = np.flatnonzero(carrier == len(g))
    own_total, own_seen = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64)
    with_gram = np.flatnonzero(carrier < len(g))
    own_total[carrier[with_gram]], own_seen[carrier[with_gram]] = total[with_gram], seen[with_gram]
    rows = np.flatnonzero(sent)
    texts = np.r_[t[rows], t[first[alone]]]
    number = np.r_[g[rows].view(np.int64), np.zeros(len(alone), np.int64)]
    none = np.r_[np.zeros(len(rows), bool), np.ones(len(alone), bool)]
    return [
        ids.take(pa.array(texts)),
        pa.array(np.r_[k[rows], k[first[alone]]].astype(np.int32)),
        pa.array(number, mask=none),
        pa.array(np.r_[many[rows], np.zeros(len(alone), np.int64)]),
        pa.array(np.r_[own_total[rows], total[alone]]),
        pa.array(np.r_[own_seen[rows], seen[alone]]),
        pa.array(np.r_[met[rows], np.zeros(len(alone), bool)]),
    ]


def _parted(ids: pa.Array, text: np.ndarray, line: np.ndarray, gram: np.ndarray) -> list[pa.Array]:
    """What a task knows of some texts, with all that they have met: see :func:`gram_rows`."""
    unit = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)[text]
    order = np.lexsort((text, unit, gram))
    g, u, t = gram[order], unit[order], text[order]
    at = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (t[1:] != t[:-1])])
    g, u, t = g[at], u[at], t[at]
    head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    met = u > np.repeat(u[head], np.diff(np.r_[head, len(g)]))
    own = np.flatnonzero(met)[np.argsort(t[met], kind="stable")]
    first = np.flatnonzero(np.r_[True, t[own][1:] != t[own][:-1]]) if len(own) else own
    place = mixed(np.add.reduceat(g[own], first) + t[own][first].astype(np.uint64)) if len(own) else g[:0]
    sent = np.flatnonzero(~met)[np.argsort(t[~met], kind="stable")]  # by text, so that ids compress
    ends = pa.array([*([None] * len(sent)), *first.tolist(), len(own)], pa.int32())
    lists = pa.ListArray.from_arrays(ends, pa.array(g[own].view(np.int64)))
    return [ids.take(pa.array(np.r_[t[sent], t[own][first]])), pa.array(np.r_[g[sent], place].view(np.int64)), lists]


def gram_rows(docs: DataFrame, n: int, by_line: bool = False, id_col: str = "doc_id", text_col: str = "text", all_rows: bool = False, then: tuple[Callable, str] | None = None) -> DataFrame:
    """n-grams of each text, or of each of its lines, combined in the tasks.

    Columns: id, line, gram, many (how often the unit has it), n_ngrams, met and
    is_met. Of the units of a task that have an n-gram only the least is sent, for
    the others have surely met it before; how often they have is in ``met``, with the
    unit's number of n-grams in ``n_ngrams``, both once for each unit (0 elsewhere; a
    row of their own, without a gram, if need be). An n-gram that many units have thus
    leaves a task once for some HELD n-grams. all_rows: no totals, but id, gram and
    met, which is null; what a text has met in the task is one more row, the n-grams
    as ``met``, with any number for ``gram``. then: what the tasks make of these batches
    before they leave Python, and its schema.
    """
    names = ["id", "gram", "met"] if all_rows else ["id", "line", "gram", "many", "n_ngrams", "met", "is_met"]
    made = _parted if all_rows else _combined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, tuple[np.ndarray, ...]]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if size:
                ids = pa.concat_arrays([x for x, _ in held])
                shift = np.cumsum([0, *(len(x) for x, _ in held[:-1])])
                text = np.concatenate([own[0] + s for (_, own), s in zip(held, shift, strict=True)])
                line, gram = (np.concatenate([own[c] for _, own in held]) for c in (1, 2))
                yield from pa.Table.from_arrays(made(ids, text, line, gram), names=names).to_batches(max_chunksize=100_000)
            held.clear()
            size = 0

        for batch in batches:
            if not len(batch):
                continue
            for part in slices_of(batch):
                found = grams_of_batch(part.column(1), n, by_line)[:3]
                held.append((part.column(0), found))
                size += len(found[0])
                if size >= HELD:
                    yield from flush()
        yield from flush()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = f"id {kind}, gram long, met array<long>" if all_rows else f"id {kind}, line int, gram long, many long, n_ngrams long, met long, is_met boolean"
    if then:
        last, schema = then
        return rows.mapInArrow(lambda batches: last(run(batches)), schema)
    return rows.mapInArrow(run, own)

"""Hashes of words and of word shingles, computed for many texts at once with numpy.

Texts are joined into one byte array. A word's hash is the sum of a random
64-bit value for each byte times a power of an odd number, which running sums
give for all words together, mixed with the word's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**64, 256, np.uint64, endpoint=False) | np.uint64(1)
_STEP, _JOIN = (int(x) | 1 for x in _RNG.integers(2**62, 2**63, 2))
_STEP_INVERSE = pow(_STEP, -1, 2**64)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: ASCII white space parts words; all else, bytes of other characters too, is in them.
SPACED = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
#: Letters and digits of ASCII, and all bytes of other characters.
ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
CHUNK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base & (2**64 - 1)
        np.multiply.accumulate(out, out=out)
    return out


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = powers(base, max(n, CHUNK_BYTES + 65536) if n <= 2 * CHUNK_BYTES else n)
    return _POWERS[base][:n]


def word_hashes(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the maximal runs of bytes that ``inside`` marks."""
    starts, ends, hashes = word_prefixes(data, inside, ())
    return starts, ends, hashes[0][1]


def word_prefixes(data: np.ndarray, inside: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Starts and ends of the words, and for the whole words and then each length of prefix in bytes the words that have one, with its hash."""
    is_word = inside[data]
    edge = np.diff(is_word.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    inverse = np.empty(0, np.uint64)
    if len(starts):
        np.cumsum(_BYTE[data] * _powers(_STEP, len(data)), out=sums[1:])
        inverse = _powers(_STEP_INVERSE, len(data))[starts]
    if len(data) > 2 * CHUNK_BYTES:
        _POWERS.clear()
    found = [(np.arange(len(starts)), mix((sums[ends] - sums[starts]) * inverse + (ends - starts).astype(np.uint64)))]
    for n in lengths:
        long = np.flatnonzero(ends - starts >= n)
        found.append((long, mix((sums[starts[long] + n] - sums[starts[long]]) * inverse[long] + np.uint64((1 << 40) + n))))
    return starts, ends, found


def grouped(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their joined bytes (a line feed after each) and the offset of each text."""
    start = total = 0
    for k, raw in enumerate(texts):
        total += len(raw) + 1
        if total >= most or k == len(texts) - 1:
            part = texts[start : k + 1]
            data = np.frombuffer(b"\n".join([*part, b""]), np.uint8)
            offsets = np.cumsum([0, *[len(x) + 1 for x in part]])
            yield start, k + 1, data, offsets
            start, total = k + 1, 0


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``width`` words.

    A-Z count as a-z. A text of fewer words has them all as its one shingle;
    a text without words has none.
    """
    for _, _, data, offsets in grouped([t.translate(LOWER) for t in texts]):
        starts, _, words = word_hashes(data, SPACED)
        first = np.searchsorted(starts, offsets)
        joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            joined = joined * np.uint64(_JOIN) + words[k : k + len(joined)]
        joined = mix(joined)
        for a, z in zip(first[:-1], first[1:]):
            if z - a >= width:
                yield np.unique(joined[a : z - width + 1])
            elif z > a:
                whole = np.uint64(z - a)
                for w in words[a:z]:
                    whole = np.uint64((int(whole) * _JOIN + int(w)) & (2**64 - 1))
                yield mix(np.array([whole]))
            else:
                yield np.empty(0, np.uint64)

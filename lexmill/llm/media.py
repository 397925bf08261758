"""Media columns: signature sniffing with Aho-Corasick and structural validators.

One automaton finds the magic bytes of every known format in a payload. A
format's validator then walks its structure (chunks, boxes, segments, blocks)
from there and gives the true length, or rejects the place. A hit at offset 0
corrects the declared type; hits behind it are embedded media, which can be
carved out. Spans inside a longer accepted one are its own parts and dropped.

Validators look terminators up in lists that are made once per payload, and
remember the places from which a walk has failed, or where it leads, so that walks
that meet cost no more than one. What is still read again from each header is a
compressed stream (gzip) and a PNG chunk whose header lies on no other's way: their
checksums tell only at their end.

Defined cases: null content has no type and nothing embedded; empty content
likewise, and both keep the declared type; a declared type is kept where the
start is not recognised; long content is read whole; of two formats at one
offset the first of the list that is valid holds; equal content gives equal
results on every row; an empty table gives an empty one; extra columns are
passed through, the result's names win.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAD = 64
WAV_RATE = 8000


class Payload(bytes):
    """Bytes with what validators have learnt about them."""

    def __init__(self, *_) -> None:
        self.places: dict[bytes, list[int]] = {}
        self.failed: dict[str, set[int]] = {}
        self.found: dict[str, object] = {}

    def all(self, mark: bytes) -> list[int]:
        """The offsets of a mark that can't overlap itself, in order; found once."""
        if mark not in self.places:
            self.places[mark] = [m.start() for m in re.finditer(re.escape(mark), self)]
        return self.places[mark]

    def walked(self, kind: str) -> set[int]:
        """Places from which a walk of this kind has failed."""
        return self.failed.setdefault(kind, set())


def _u(fmt: str, data: bytes, at: int) -> int:
    return struct.unpack_from(fmt, data, at)[0]


def _png(d: Payload, at: int) -> int:
    """Chunks with right checksums, from the header to the end."""
    i, first, bad, path = at + 8, True, d.walked("png"), []
    while i + 12 <= len(d) and i not in bad:
        n, kind = _u(">I", d, i), d[i + 4 : i + 8]
        end = i + 12 + n
        if not first:
            path.append(i)
        if end > len(d) or (first and (kind != b"IHDR" or n != 13)) or zlib.crc32(memoryview(d)[i + 4 : end - 4]) != _u(">I", d, end - 4):
            break
        if kind == b"IEND":
            return end - at
        i, first = end, False
    bad.update(path)
    return 0


def _gif(d: Payload, at: int) -> int:
    """Blocks from the colour table to the trailer, an image among them at least."""
    i, image = at + 13, False
    if i > len(d) or not (_u("<H", d, at + 6) and _u("<H", d, at + 8)):
        return 0
    if d[at + 10] & 0x80:
        i += 3 << ((d[at + 10] & 7) + 1)
    bad, path = d.walked("gif"), []
    while i < len(d) and i not in bad:
        path.append(i)
        kind = d[i]
        if kind == 0x3B:
            return i + 1 - at if image else 0
        if kind == 0x21:
            i += 2
        elif kind == 0x2C and i + 10 <= len(d):
            image = True
            i += 11 + ((3 << ((d[i + 9] & 7) + 1)) if d[i + 9] & 0x80 else 0)
        else:
            break
        while i < len(d) and d[i] and i not in bad:
            path.append(i)
            i += d[i] + 1
        if i < len(d) and d[i]:
            break
        i += 1
    bad.update(path)
    return 0


def _jpeg(d: Payload, at: int) -> int:
    """Segments by their lengths, and scans up to the next marker, to the end mark."""
    bad, path, i = d.walked("jpeg"), [], at + 2
    while i + 4 <= len(d) and d[i] == 0xFF and i not in bad:
        path.append(i)
        kind = d[i + 1]
        if kind == 0xFF:
            i += 1
            continue
        if not 0xC0 <= kind <= 0xFE or 0xD0 <= kind <= 0xD8:
            break
        n = _u(">H", d, i + 2)
        if n < 2:
            break
        i += 2 + n
        if kind == 0xDA:
            end, i = _scan_end(d, i)
            if end:
                return end - at
    bad.update(path)
    return 0


def _scan_end(d: Payload, i: int) -> tuple[int, int]:
    """From within a scan: the end of the file, or 0 and the next marker, or 0 and the payload's end."""
    if "jpeg marks" not in d.found:
        # marks in scans are those that no stuffing or restart follows
        d.found["jpeg marks"] = [m.start() for m in re.finditer(rb"\xff(?=[\x01-\xcf\xd8-\xff])", d)]
    marks = d.found["jpeg marks"]
    k = bisect_left(marks, i)
    if k == len(marks):
        return 0, len(d)
    return (marks[k] + 2, marks[k]) if d[marks[k] + 1] == 0xD9 else (0, marks[k])


def _bmp(d: bytes, at: int) -> int:
    if at + 30 > len(d):
        return 0
    size, pixels, header = _u("<I", d, at + 2), _u("<I", d, at + 10), _u("<I", d, at + 14)
    if d[at + 6 : at + 10] != b"\0\0\0\0" or header not in (12, 40, 52, 56, 64, 108, 124) or not 14 + header <= pixels <= size or at + size > len(d):
        return 0
    if header >= 40:
        width, height, bits, packed = _u("<i", d, at + 18), abs(_u("<i", d, at + 22)), _u("<H", d, at + 28), _u("<I", d, at + 30)
        if bits not in (1, 4, 8, 16, 24, 32) or width <= 0 or (packed == 0 and pixels + (width * bits + 31) // 32 * 4 * height > size):
            return 0
    return size


def _chunks(d: bytes, at: int) -> Iterator[tuple[bytes, int, int]]:
    """Chunks of a RIFF form: kind, start and length of the data."""
    end, i = at + 8 + _u("<I", d, at + 4), at + 12
    while i + 8 <= end:
        n = _u("<I", d, i + 4)
        if i + 8 + n > end:
            return
        yield d[i : i + 4], i + 8, n
        i += 8 + n + (n & 1)


def _riff(d: bytes, at: int) -> int:
    if at + 12 > len(d):
        return 0
    size = 8 + _u("<I", d, at + 4)
    if at + size > len(d) or size < 12:
        return 0
    need = {b"WAVE": {b"fmt ", b"data"}, b"AVI ": {b"LIST"}, b"WEBP": set()}.get(d[at + 8 : at + 12])
    kinds = {k for k, _, _ in _chunks(d, at)}
    if need is None or not need <= kinds or not kinds:
        return 0
    if d[at + 8 : at + 12] == b"WEBP" and not kinds & {b"VP8 ", b"VP8L", b"VP8X"}:
        return 0
    return size


def _pdf(d: Payload, at: int) -> int:
    """To the last end mark before the next file's header, with a cross-reference before it."""
    heads, ends, refs = d.all(b"%PDF-"), d.all(b"%%EOF"), d.all(b"startxref")
    k = bisect_right(heads, at)
    limit = heads[k] if k < len(heads) else len(d)
    last = bisect_left(ends, limit) - 1
    if last < 0 or ends[last] < at or not d[at + 5 : at + 6].isdigit():
        return 0
    ref = bisect_left(refs, at)
    return ends[last] + 5 - at if ref < len(refs) and refs[ref] < ends[last] else 0


def _zip_ends(d: Payload) -> dict[int, list[int]]:
    """For each start that an end record speaks of, the ends of the files, in order."""
    found: dict[int, list[int]] = {}
    for i in d.all(b"PK\5\6"):
        if i + 22 <= len(d):
            size, start, end = _u("<I", d, i + 12), _u("<I", d, i + 16), i + 22 + _u("<H", d, i + 20)
            if end <= len(d) and (size == 0 or d[i - size : i - size + 4] == b"PK\1\2"):
                found.setdefault(i - size - start, []).append(end)
    return found


def _zip(d: Payload, at: int) -> int:
    if b"zip" not in d.places:
        d.places[b"zip"] = _zip_ends(d)
    ends = [x for x in d.places[b"zip"].get(at, ())[:1]]
    return ends[0] - at if ends and ends[0] > at else 0


def _gzip(d: Payload, at: int) -> int:
    if at + 18 > len(d) or d[at + 3] & 0xE0 or d[at + 8] not in (0, 2, 4) or 13 < d[at + 9] < 255:
        return 0
    machine, view, i = zlib.decompressobj(31), memoryview(d), at
    try:
        while i < len(d) and not machine.eof:
            machine.decompress(view[i : i + 65536])
            i += 65536
    except zlib.error:
        return 0
    return min(i, len(d)) - len(machine.unused_data) - at if machine.eof else 0


def _ogg(d: Payload, at: int) -> int:
    """Pages up to one that is marked as the last."""
    i, bad, path = at, d.walked("ogg"), []
    while d[i : i + 5] == b"OggS\0" and i + 27 <= len(d) and i not in bad:
        path.append(i)
        n = d[i + 26]
        end = i + 27 + n + sum(d[i + 27 : i + 27 + n])
        if end > len(d):
            break
        if d[i + 5] & 4:
            return end - at
        i = end
    bad.update(path)
    return 0


def _flac(d: Payload, at: int) -> int:
    """Metadata blocks; the frames after them run to the end."""
    i, first, bad, path = at + 4, True, d.walked("flac"), []
    while i + 4 <= len(d) and i not in bad:
        kind, n = d[i] & 0x7F, int.from_bytes(d[i + 1 : i + 4], "big")
        if not first:
            path.append(i)
        if (first and (kind, n) != (0, 34)) or i + 4 + n > len(d):
            break
        if d[i] & 0x80:
            if i + 4 + n == len(d) or d[i + 4 + n] == 0xFF:
                return len(d) - at
            break
        i, first = i + 4 + n, False
    bad.update(path)
    return 0


def _box(d: Payload, i: int) -> tuple[int, bytes]:
    """Length and kind of a box; no length where there is none."""
    if i + 8 > len(d):
        return 0, b""
    n, kind = _u(">I", d, i), d[i + 4 : i + 8]
    if n == 1 and i + 16 <= len(d):
        n = _u(">Q", d, i + 8)
    return (n, kind) if n >= 8 and i + n <= len(d) and kind.isalnum() else (0, b"")


_MEDIA_BOXES = frozenset((b"moov", b"moof", b"mdat", b"meta"))


def _boxes(d: Payload, at: int) -> int:
    """ISO boxes from the one whose kind is at at + 4, up to the next file's first."""
    known: dict[int, tuple[int, bool]] = d.found.setdefault("boxes", {})
    n, kind = _box(d, at)
    if not n:
        return 0
    # where the boxes behind it end, and whether there is a media box among them
    path, i = [], at + n
    while i not in known:
        more, own = _box(d, i)
        if not more or own == b"ftyp":
            known[i] = (i, False)
            break
        path.append((i, own in _MEDIA_BOXES))
        i += more
    end, media = known[i]
    for i, own in reversed(path):
        media = media or own
        known[i] = (end, media)
    return end - at if end > at + n and (media or kind in _MEDIA_BOXES) else 0


def _pnm(d: bytes, at: int) -> int:
    """Binary grey or colour map: the header gives the length."""
    values, i = [], at + 2
    while len(values) < 3:
        j = i
        while j < len(d) and d[j] in b" \t\r\n":
            j += 1
        k = j
        while k < len(d) and 48 <= d[k] <= 57 and k - j < 10:
            k += 1
        if j == i or k == j:
            return 0
        values.append(int(d[j:k]))
        i = k
    width, height, top = values
    size = i + 1 - at + width * height * (3 if d[at + 1] == 0x36 else 1) * (2 if top > 255 else 1)
    return size if width and height and 0 < top < 65536 and i < len(d) and d[i] in b" \t\r\n" and at + size <= len(d) else 0


def _tiff(d: bytes, at: int) -> int:
    """The first directory must be in order; its images run to the end."""
    e = "<" if d[at : at + 1] == b"I" else ">"
    if at + 8 > len(d):
        return 0
    i = at + _u(f"{e}I", d, at + 4)
    if i < at + 8 or i + 2 > len(d):
        return 0
    n = _u(f"{e}H", d, i)
    if not n or i + 6 + 12 * n > len(d):
        return 0
    tags = [_u(f"{e}H", d, i + 2 + 12 * k) for k in range(n)]
    kinds = [_u(f"{e}H", d, i + 4 + 12 * k) for k in range(n)]
    return len(d) - at if tags == sorted(tags) and all(1 <= k <= 18 for k in kinds) and 256 in tags else 0


#: Fixed values of the formats: magic bytes, their offset in the file, media type, validator.
SIGNATURES: tuple[tuple[bytes, int, str, Callable[[Payload, int], int]], ...] = (
    (b"\x89PNG\r\n\x1a\n", 0, "image/png", _png),
    (b"GIF87a", 0, "image/gif", _gif),
    (b"GIF89a", 0, "image/gif", _gif),
    (b"\xff\xd8\xff", 0, "image/jpeg", _jpeg),
    (b"BM", 0, "image/bmp", _bmp),
    (b"RIFF", 0, "riff", _riff),
    (b"%PDF-", 0, "application/pdf", _pdf),
    (b"PK\3\4", 0, "application/zip", _zip),
    (b"\x1f\x8b\x08", 0, "application/gzip", _gzip),
    (b"OggS\0\2", 0, "application/ogg", _ogg),
    (b"fLaC", 0, "audio/flac", _flac),
    (b"ftyp", 4, "video/mp4", _boxes),
    (b"P5", 0, "image/x-portable-graymap", _pnm),
    (b"P6", 0, "image/x-portable-pixmap", _pnm),
    (b"II*\0", 0, "image/tiff", _tiff),
    (b"MM\0*", 0, "image/tiff", _tiff),
)
RIFF_TYPES = {b"WAVE": "audio/wav", b"AVI ": "video/x-msvideo", b"WEBP": "image/webp"}


def automaton() -> ahocorasick.Automaton:
    """Over Latin-1 text, one character per byte."""
    found = ahocorasick.Automaton()
    for k, (magic, _, _, _) in enumerate(SIGNATURES):
        found.add_word(magic.decode("latin-1"), (k, len(magic)))
    found.make_automaton()
    return found


def proposals(data: bytes, machine: ahocorasick.Automaton) -> list[tuple[int, int]]:
    """Where a file may start, and which signature says so, in order."""
    return sorted((end + 1 - n - SIGNATURES[k][1], k) for end, (k, n) in machine.iter(data.decode("latin-1")))


def sniff(data: bytes, machine: ahocorasick.Automaton, hits: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int]]:
    """The outermost media in ``data``: type, offset, length, by offset. hits: the proposals, where they are known."""
    found: list[tuple[str, int, int]] = []
    inside, payload = 0, Payload(data)
    for at, k in proposals(data, machine) if hits is None else hits:
        if at < inside or at < 0:
            continue
        try:
            n = SIGNATURES[k][3](payload, at)
        except (struct.error, IndexError):  # cut short
            n = 0
        if n:
            kind = SIGNATURES[k][2]
            found.append((RIFF_TYPES[data[at + 8 : at + 12]] if kind == "riff" else kind, at, n))
            inside = at + n
    return found


def wav_of(payload: bytes) -> bytes:
    """Mono 8-bit PCM; the samples are the payload's bytes."""
    n = len(payload)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n + (n & 1), b"WAVE", b"fmt ", 16, 1, 1, WAV_RATE, WAV_RATE, 1, 8, b"data", n)
    return head + payload + b"\0" * (n & 1)


def wav_samples(data: bytes, at: int = 0) -> bytes:
    """The sample bytes of the WAV at ``at``."""
    for kind, start, n in _chunks(data, at):
        if kind == b"data":
            return data[start : start + n]
    return b""


def padded(data: bytes) -> bytes:
    """Zeros up to a positive multiple of 64."""
    return data + b"\0" * ((-len(data)) % PAD if data else PAD)


MEDIA = "array<struct<media_type:string,offset:long,length:long>>"


def sniff_media(df: DataFrame, content_col: str, declared_col: str | None = None) -> DataFrame:
    """Add media_type (the corrected one), media_length, corrected and embedded, the media behind the start."""
    out = df.drop("media_type", "media_length", "corrected", "embedded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    declared = declared_col if declared_col in out.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            contents = batch.column(batch.schema.get_field_index(content_col))
            said = batch.column(batch.schema.get_field_index(declared)).to_pylist() if declared else [None] * batch.num_rows
            kinds, lengths, fixed, rest = [], [], [], []
            for k in range(batch.num_rows):
                data = contents[k].as_py() or b""
                spans = sniff(data, machine)
                top = spans[0] if spans and spans[0][1] == 0 else None
                kinds.append(top[0] if top else said[k])
                lengths.append(top[2] if top else None)
                fixed.append(bool(top) and top[0] != said[k])
                rest.append([{"media_type": t, "offset": a, "length": n} for t, a, n in spans if a])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(kinds, pa.string()), pa.array(lengths, pa.int64()), pa.array(fixed, pa.bool_()), pa.array(rest, pa.list_(pa.struct([("media_type", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])))],
                names=[*batch.schema.names, "media_type", "media_length", "corrected", "embedded"],
            )

    return out.mapInArrow(run, f"{fields}, media_type string, media_length long, corrected boolean, embedded {MEDIA}")


def carve_media(sniffed: DataFrame, content_col: str) -> DataFrame:
    """One row per embedded medium of :func:`sniff_media`'s result, with its bytes in ``carved``."""
    rows = sniffed.withColumn("_m", F.explode("embedded"))
    return rows.select(
        *[c for c in sniffed.columns if c not in ("embedded", "carved", "offset", "length", "media_type", "media_length", "corrected")],
        F.col("_m.media_type").alias("media_type"),
        F.col("_m.offset").alias("offset"),
        F.col("_m.length").alias("length"),
        F.substring(F.col(content_col), F.col("_m.offset").cast("int") + 1, F.col("_m.length").cast("int")).alias("carved"),
    )


def _feature(samples: bytes) -> str:
    """Number, sum, peak and kinds of the samples."""
    counts = np.bincount(np.frombuffer(samples, np.uint8), minlength=256)
    used = np.flatnonzero(counts)
    return f"samples={len(samples)};sum={int(np.dot(np.arange(256), counts))};max={int(used[-1])};kinds={len(used)}"


#: What a text's stored form is declared as.
DECLARED = "text/plain"


def payload_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: str = DECLARED) -> DataFrame:
    """Store every text as a WAV under its declared type, sniff it, read the samples back from where the sniffer found them and digest them.

    media_type and corrected come from the comparison of the declared type with
    what was found. n_magic counts the places in the payload where a magic
    number proposes a file, n_embedded the media that validators confirm there,
    and embedded names them (type:offset:length); carved has the SHA-256 of each,
    cut from the payload.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, media_type string, corrected boolean, n_magic long, n_embedded long, embedded string, carved string, feature string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                raw = (text.as_py() or "").encode()
                stored = wav_of(padded(raw))
                spans = sniff(stored, machine)
                if not spans or spans[0][:2] != ("audio/wav", 0):
                    raise ValueError("the stored form is not recognised")
                kind, at, length = spans[0]
                payload = wav_samples(stored[at : at + length])
                hits = proposals(payload, machine)
                inner = sniff(payload, machine, hits)
                named = ",".join(f"{t}:{a}:{n}" for t, a, n in inner)
                carved = ",".join(hashlib.sha256(payload[a : a + n]).hexdigest() for _, a, n in inner)
                rows.append((len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PAD:]), len(stored), hashlib.sha256(stored).hexdigest(), kind, kind != declared, len(hits), len(inner), named, carved, _feature(payload)))
            columns = list(zip(*rows)) if rows else [()] * 13
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                names=[id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "media_type", "corrected", "n_magic", "n_embedded", "embedded", "carved", "feature"],
            )

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)

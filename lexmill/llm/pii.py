"""Personal data and secrets: patterns propose spans, checksums confirm them, context words weigh them.

Proposals are read in one pass each, linear in the text: emails grow outwards
from every @, addresses come from whole dotted runs of numbers, cards from
whole digit chains, phones from a plus sign, secrets from whole runs of their
characters. Cards must pass Luhn, IBANs mod 97 and may end at every word's end
within their candidate, first of all at their country's length, then longest
first; the search goes on behind a confirmed end and else behind the start, so
words and codes that follow cost nothing. Addresses have parts of at most 255.
Tokens of code hosts carry a CRC-32 in base 62, signed web tokens a header that
must decode, other secrets must look drawn at random.

Each confirmed span starts with the score of its kind and gains where one of
the kind's context words stands within a window before or after it. The base
kinds are always kept; kinds that the method adds need a minimum score, which
IBANs of no known country and its length, social security numbers and random strings
reach by context alone.

Defined cases: null and empty texts have no spans; long texts are read whole;
spans of one kind don't overlap, spans of different kinds may; of equal starts
the longer span names a redacted stretch; repeated rows give equal results; an
empty table gives an empty one; offsets are code points, the end exclusive;
columns are passed through, but for one of the result's name.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn", "secret")
KINDS = (*BASE, *EXTRA)
#: Score of a confirmed span, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3, "secret": 0.3}
#: Scores of an IBAN that has not its country's length, and of a secret whose form or checksum confirms it.
FOREIGN, FORMED = 0.4, 0.9
BOOST, WINDOW, LEAST = 0.3, 40, 0.5
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "dirección", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "teléfono", "telefon", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "api_key", "apikey", "api-key", "access_key", "secret_key", "auth", "authorization", "bearer", "credential", "credentials", "contraseña", "passwort", "clé"),
}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country; other countries and lengths pass by mod 97 alone.
_IBAN_LENGTHS = {
    country: int(length)
    for length, countries in (x.split(":") for x in (
        "15:NO 16:BE 18:DK.FI.FK.FO.GL.NL.SD 19:MK.SI 20:AT.BA.EE.KZ.LT.LU.MN.XK 21:CH.HR.LI.LV 22:BG.BH.CR.DE.GB.GE.IE.ME.RS.VA 23:AE.GI.IL.IQ.OM.SO.TL "
        "24:AD.CZ.ES.MD.PK.RO.SA.SE.SK.TN.VG 25:LY.PT.ST 26:IS.TR 27:BI.DJ.FR.GR.IT.MC.MR.SM 28:AL.AZ.BY.CY.DO.GT.HN.HU.LB.NI.PL.SV 29:BR.EG.PS.QA.UA 30:JO.KW.MU.YE 31:MT.SC 32:LC 33:RU"
    ).split())
    for country in countries.split(".")
}
#: Runs of characters that keys are written in, 20 at least, and PEM blocks. A run starts after any other character, as in KEY=value and key:"value"; = is part of it at its end only.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]++\.){0,2}[A-Za-z0-9+/_-]{16,}+={0,2}")
_PEM = re.compile(r"-----BEGIN ([A-Z ]{0,30}PRIVATE KEY)-----")
#: Fixed values of the formats.
_HOSTED = re.compile(r"(?:gh[opsur]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})")
_CLOUD = re.compile(r"(?:AKIA|ASIA)[A-Z2-7]{16}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Characters of a secret, and the entropy in bits a character of hexadecimal ones and of others.
SECRET_SIZES, HEX_BITS, OTHER_BITS = (20, 200), 2.8, 3.6
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_WORDS = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, v)) + r")(?!\w)", re.I) for k, v in CONTEXT.items()}
#: Names of variables are words with _ between them.
_WORDS["secret"] = re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, CONTEXT["secret"])) + r")(?![^\W_])", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """IBAN check: the first four characters go last, letters count from 10."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """A dotted run holds one proposal for every four whole parts, from its left."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts, at = run[0].split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int, float]]:
    at = 0
    while m := _IBAN.search(text, at):
        start, at = m.start(), m.start() + 1
        known = _IBAN_LENGTHS.get(m[0][:2])
        ends = [m.end(), *(k for k in range(m.end() - 1, start, -1) if text[k] == " ")]
        codes = [(end, text[start:end].replace(" ", "")) for end in ends]
        for end, code in sorted(codes, key=lambda x: len(x[1]) != known):
            if 15 <= len(code) <= 34 and mod97(code):
                yield start, end, SCORES["iban"] if len(code) == known else FOREIGN
                at = end
                break


def entropy(run: str) -> float:
    """Bits a character, from the run's own counts."""
    return -sum(n / len(run) * log2(n / len(run)) for n in Counter(run).values())


def hosted(run: str) -> bool:
    """Whether the last six characters are the CRC-32 of the thirty before them in base 62."""
    m = _HOSTED.fullmatch(run)
    if not m:
        return False
    value = 0
    for c in m[2]:
        value = 62 * value + BASE62.index(c)
    return value == zlib.crc32(m[1].encode())


def signed(run: str) -> bool:
    """Whether the run is a signed web token: three parts, of which the first decodes to a header with an algorithm."""
    parts = run.split(".")
    if len(parts) != 3 or not all(parts):
        return False
    try:
        head = json.loads(base64.urlsafe_b64decode(parts[0] + "=" * (-len(parts[0]) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and "alg" in head


def random_looking(run: str) -> bool:
    """Letters and digits in a mixture that words and numbers don't have."""
    if not SECRET_SIZES[0] <= len(run) <= SECRET_SIZES[1] or not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)):
        return False
    return entropy(run) >= (HEX_BITS if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run) else OTHER_BITS)


def secrets(text: str) -> Iterator[tuple[int, int, float]]:
    """Runs with a form of their own, random ones, and private keys from head to foot (or to the text's end)."""
    done = 0
    for m in _PEM.finditer(text):
        if m.start() >= done:
            foot = f"-----END {m[1]}-----"
            end = text.find(foot, m.end())
            done = end + len(foot) if end >= 0 else len(text)
            yield m.start(), done, FORMED
    blocks = iter([*((m.start(), m.end()) for m in _RUN.finditer(text))])
    for start, end in blocks:
        run = text[start:end]
        if end < len(text) and text[end] == "@":  # the local part of an address
            continue
        if hosted(run) or _CLOUD.fullmatch(run) or signed(run):
            yield start, end, FORMED
            continue
        start, run = start + run.rfind(".") + 1, run[run.rfind(".") + 1 :]
        if hosted(run) or _CLOUD.fullmatch(run):
            yield start, end, FORMED
        elif random_looking(run):
            yield start, end, SCORES["secret"]


def ssns(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _SSN.finditer(text))


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns, "secret": secrets}
_DIGIT = re.compile(r"[0-9]")


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score, by kind as listed and then start."""
    found: list[tuple[str, int, int, float]] = []
    if not text:
        return found
    digits = bool(_DIGIT.search(text))
    for kind in KINDS:
        if kind not in ("email", "secret") and not digits:
            continue
        own, done = [], 0
        for start, end, *scored in sorted(FINDERS[kind](text)):
            if start < done:  # inside a private key
                continue
            near = _WORDS[kind].search(text, max(0, start - WINDOW), start) or _WORDS[kind].search(text, end, end + WINDOW)
            score = min(1.0, round((scored[0] if scored else SCORES[kind]) + (BOOST if near else 0.0), 3))
            if kind in BASE or score >= LEAST:
                own.append((kind, start, end, score))
                done = end
        found += own
    return found


def joined(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z, _ in spans)


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Replace every span by <KIND>; where spans overlap, the earliest and then longest one names the whole stretch."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_pii(docs: DataFrame, text_col: str = "text", redacted_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add pii, the spans with their scores, and the redacted text where a column is named for it. keep: the columns to pass on, all without it."""
    out = docs.drop("pii")
    kept = [c for c in out.columns if keep is None or c in keep]
    given = [f for f in out.schema if f.name != redacted_col or redacted_col == text_col]
    replaced = redacted_col is not None and redacted_col != text_col
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given if f.name in kept] + [f"pii {SPANS}"] + ([f"`{redacted_col}` string"] if replaced else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            texts = batch.column(place).to_pylist()
            spans = [find_spans(t) for t in texts]
            columns, names = list(batch.columns), list(batch.schema.names)
            if redacted_col is not None:
                new = pa.array([redact(t, s) if s else t for t, s in zip(texts, spans)], pa.string())
                if redacted_col == text_col:
                    columns[place] = new
            columns, names = [list(x) for x in zip(*[(c, n) for c, n in zip(columns, names) if n in kept])] or [[], []]
            columns.append(pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in x] for x in spans], _SPAN))
            names.append("pii")
            if replaced:
                columns.append(new)
                names.append(redacted_col)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return out.select([f.name for f in given]).mapInArrow(run, fields)


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, the digest of the base spans, all spans as text, how many there are, and their scores in the same order."""
    spans = find_pii(docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)), text_col, keep=[id_col])
    text = lambda kinds: F.array_join(F.transform(F.filter("pii", lambda s: s.kind.isin(*kinds)), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    count = lambda kind: F.size(F.filter("pii", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    scores = F.array_join(F.transform("pii", lambda s: s.score.cast("decimal(3,2)").cast("string")), ",").alias("scores")
    return spans.select(id_col, *[count(k) for k in BASE], F.sha2(text(BASE).cast("binary"), 256).alias("base_sha256"), text(KINDS).alias("spans"), F.size("pii").cast("long").alias("n_spans"), scores)

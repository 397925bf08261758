"""Which encoding bytes are in: marks, validity of multi-byte codes, then the letters that single-byte codes would give.

A byte order mark decides. Without one, bytes that are valid UTF-8 are that; many NUL
bytes in every second or fourth place are UTF-16 or UTF-32. What is left is a
single-byte code, or one of two bytes for East Asian scripts. Each candidate that can
read all bytes is judged by what it makes of those above 127: letters inside a word,
of one script and in one case, are likely; capitals after small letters, symbols next
to letters, and controls are not. Equal judgements go by the order of the candidates.
"""

from __future__ import annotations

import codecs
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Byte order marks, longer ones first.
MARKS = ((codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
#: Codes of a byte a character, in the order of preference: Western, Central European, Cyrillic, Greek, Turkish.
SINGLE = ("windows-1252", "iso-8859-15", "windows-1250", "iso-8859-2", "windows-1251", "koi8-r", "cp866", "windows-1253", "iso-8859-7", "windows-1254", "mac-roman", "cp437")
#: Codes of two bytes a character, and the scripts that they are for.
DOUBLE = {"shift_jis": ("HIRAGANA", "KATAKANA"), "euc_jp": ("HIRAGANA", "KATAKANA"), "euc_kr": ("HANGUL",), "gb18030": ("CJK",), "big5": ("CJK",)}
#: What a code loses that old systems used and few files have.
SELDOM = {"mac-roman": 0.5, "cp437": 1.0, "cp866": 0.5}
#: Bytes that are judged; all are decoded.
JUDGED = 1 << 16
#: Letters with marks that the languages of the codes use often, per hundred of such letters; others count as RARE.
USED = {
    "éèàùâêîôûçëïü": 3.0, "äöüß": 3.0, "áéíóúñ¿¡": 3.0, "ãõçâêô": 2.5, "åæøäö": 2.0, "ąćęłńóśźż": 2.5, "áčďéěíňóřšťúůýž": 2.5, "őű": 2.0, "ăâîșț": 1.5, "şğıİ": 2.0, "œ": 1.5, "’“”–—…«»€°": 2.2,
}
RARE = 0.3
_WEIGHT = {c: max(w for letters, w in USED.items() if c in letters) for letters in USED for c in letters}


@lru_cache(maxsize=4096)
def _kind(c: str) -> tuple[str, str]:
    """Script and category of a character above 127."""
    return unicodedata.name(c, "?").split(" ")[0], unicodedata.category(c)


def single_score(text: str) -> float:
    """How likely a text is that a single-byte code has made, a mean over its characters above 127."""
    total = many = 0.0
    scripts: Counter[str] = Counter()
    before = " "
    following = [*text[1:], " "]
    for c, after in zip(text, following):
        if c >= "\x80":
            many += 1
            script, category = _kind(c)
            beside = before.isalpha() or after.isalpha()
            if category[0] == "C":
                total -= 10
            elif category[0] == "L":
                scripts[script] += 1
                total += _WEIGHT.get(c.lower(), RARE) if script == "LATIN" else 2.0
                if category == "Lu" and before.islower():
                    total -= 4
                if script != "LATIN" and ("a" <= before.lower() <= "z" or "a" <= after.lower() <= "z"):
                    total -= 3
                if script == "LATIN" and not beside:
                    total -= 0.5
                if script == "LATIN" and before >= "\x80" and before.isalpha():
                    total -= 1.5
            else:
                total += _WEIGHT.get(c, -0.2)
                if before.isalpha() and after.isalpha() and c not in "’·":
                    total -= 3
        before = c
    if not many:
        return 0.0
    mixed = 1 - max(scripts.values()) / sum(scripts.values()) if scripts else 0.0
    return total / many - 3 * mixed


def double_score(text: str, scripts: tuple[str, ...]) -> float:
    """How likely a text is that a two-byte code has made: the share of its wide characters that are of the code's scripts, or ideographs beside them."""
    kinds = Counter(_kind(c)[0] for c in text if c >= "\x80")
    own = sum(kinds[s] for s in scripts)
    if not own or own * 20 < sum(kinds.values()):
        return -1.0
    good = own + kinds["CJK"] * ("KATAKANA" in scripts) + kinds["IDEOGRAPHIC"] + kinds["FULLWIDTH"]
    return 3.0 * good / sum(kinds.values()) - 1.0


def _read(raw: bytes, name: str) -> str | None:
    try:
        return raw.decode(name)
    except UnicodeDecodeError:
        return None


def wide(raw: bytes) -> str | None:
    """UTF-16 or UTF-32 by where the NUL bytes of Western text are."""
    head = raw[:JUDGED]
    if len(head) < 4 or len(raw) % 2 or head.count(0) * 5 < len(head):
        return None
    share = [head[k::4].count(0) * 4 / len(head) for k in range(4)]
    if len(raw) % 4 == 0 and min(share[:3]) > 0.9:
        return "utf-32-be"
    if len(raw) % 4 == 0 and min(share[1:]) > 0.9:
        return "utf-32-le"
    even, odd = (share[0] + share[2]) / 2, (share[1] + share[3]) / 2
    return "utf-16-be" if even > max(0.6, 2 * odd) else "utf-16-le" if odd > max(0.6, 2 * even) else None


def encoding_of(raw: bytes) -> str:
    """The likeliest encoding. Bytes that no code can hold are taken for Latin-1, which holds all."""
    for mark, name in MARKS:
        if raw.startswith(mark) and _read(raw, name) is not None:
            return name
    found = wide(raw)
    if found and _read(raw, found) is not None:
        return found
    if _read(raw, "utf-8") is not None:
        return "utf-8"
    # only what is above 127 tells, with its neighbours; whole pairs stay whole as lines do
    head = raw[:JUDGED] if len(raw) <= JUDGED else raw[: raw.rfind(b"\n", 0, JUDGED) + 1 or JUDGED]
    best, best_score = "iso-8859-1", -5.0
    for name in (*SINGLE, *DOUBLE):
        text = _read(head, name)
        if text is None or len(raw) > len(head) and _read(raw, name) is None:
            continue
        score = double_score(text, DOUBLE[name]) if name in DOUBLE else single_score(text) - SELDOM.get(name, 0.0)
        if score > best_score + 1e-9:
            best, best_score = name, score
    return best


def detected(content: Column) -> Column:
    """Bytes as text, by the encoding that they are likeliest in; null stays null. Valid UTF-8 without a mark stays in the JVM."""

    @F.pandas_udf("string")
    def read(parts: pd.Series) -> pd.Series:
        return parts.map(lambda raw: None if raw is None else bytes(raw).decode(encoding_of(bytes(raw))))

    plain = F.when(~F.contains(F.substring(F.hex(F.substring(content, 1, 4096)), 1, 8192), F.lit("00")) & ~F.startswith(F.hex(F.substring(content, 1, 3)), F.lit("EFBBBF")), F.try_validate_utf8(content.cast("string")))
    return F.coalesce(plain, read(F.when(plain.isNull(), content)))

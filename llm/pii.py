"""Personal data behind disguises, by offset-preserving deobfuscation (operator 10).

A transducer reads a text and writes its plain form: look-alike characters become ASCII, invisible ones vanish, spelled
digits become digits, and at, dot and plus disguises become signs. Its arcs are the alternatives of one regular
expression, taken leftmost and longest first; each replaced piece keeps its source interval. The detectors run on the source
(the base spans) and on the plain form; a span of the plain form that holds a replaced piece is mapped back to source
offsets and added. Clean text has no replaced piece inside a match, so nothing is added there.

A bare word "at" or a spaced "@" is weak evidence: an address with it counts only if one of its dots was disguised too.
Spelled digits alone are evidence from the third on, as number words also follow plain numbers in prose.

Null and empty texts have no spans. Matches of one kind never overlap in the source; added spans may overlap base ones.
Repeated rows give repeated rows, an empty table an empty result, a null id stays null, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import arrow_map, plain_text

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Each at sign is tried once: its domain to the right, its local part back to the end of the last address."""
    out, last = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]


DETECTORS = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# Look-alikes of ASCII letters that compatibility forms do not cover: Cyrillic, Greek and Armenian letters.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "в": "b", "е": "e", "к": "k", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "Ѕ": "S", "І": "I", "Ј": "J", "Ӏ": "I",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "օ": "o", "ո": "n", "ս": "u", "ց": "g", "հ": "h", "ɑ": "a", "ɡ": "g", "ı": "i", "ⅼ": "l",
    "․": ".", "·": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
INVISIBLE = "­​‌‍⁠﻿"
DIGIT_WORDS = {
    word: str(n)
    for line in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for n, word in enumerate(line.split())
}
AT_WORDS = ("at", "ät", "arroba", "arobase", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "point", "punto")
PLUS_WORDS = ("plus", "más")


@lru_cache(maxsize=1)
def folded() -> dict[str, str]:
    """Single characters that stand for one ASCII letter, digit or sign: compatibility forms, decimal digits, look-alikes."""
    out = {}
    for code in range(128, sys.maxunicode + 1):
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and plain.isascii() and (plain.isalnum() or plain in "@.+()-_%"):
            out[c] = plain
        elif (digit := unicodedata.decimal(c, None)) is not None:
            out[c] = str(digit)
    return {c: p for c, p in out.items() if c not in "ªº¹²³"} | LOOKALIKES


def _any(words) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


_D = rf"(?:{_any(DIGIT_WORDS)})(?![^\W_])"
_AT, _DOT = rf"(?:{_any(AT_WORDS)}|@|a)", rf"(?:{_any(DOT_WORDS)}|\.)"
# a run of blanks is read from its first only, so that long runs stay linear
_OPEN, _CLOSE = r"(?:(?<![ \t])[ \t]+)?[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_ARCS = re.compile(
    rf"(?=[ \t\[({{<&%])(?:(?P<at>{_OPEN}{_AT}{_CLOSE}|&\#64;|&commat;|%40)"
    rf"|(?P<dot>{_OPEN}{_DOT}{_CLOSE}|&\#46;|(?<=[^\W_])[ \t]+(?:{_any(DOT_WORDS)}|\.)[ \t]+(?=[^\W_]))"
    rf"|(?P<weak>(?<=[^\W_])[ \t]+(?:{_any(AT_WORDS)}|@)[ \t]+(?=[^\W_])))"
    rf"|(?<![^\W_])(?:(?P<plus>(?:{_any(PLUS_WORDS)})[ \t]+(?=[0-9(]|{_D}))"
    rf"|(?P<digit>{_D})(?P<gap>(?:[ \t,-]|(?:dash|hyphen)(?![^\W_]))*(?={_D}|[0-9](?![0-9])))?)",
    re.IGNORECASE,
)


def disguised(text: str) -> bool:
    """Whether any arc of the transducer but bare copies can be taken in a way that matters."""
    if not text.isascii() and not folded().keys().isdisjoint(seen := set(text)) or not text.isascii() and not seen.isdisjoint(INVISIBLE):
        return True
    digits = 0
    for m in _ARCS.finditer(text):
        if m.lastgroup in ("digit", "gap"):
            digits += 1
            if digits == 3:
                return True
        elif m.lastgroup != "weak":
            return True
    return False


def plain_form(text: str) -> tuple[str, list[int], list[tuple[int, int, str]]]:
    """The plain form; the offsets where its pieces begin; the source interval and arc ("" for a copy) of each."""
    table = folded()
    letters = text.translate({**{ord(c): p for c, p in table.items()}, **{ord(c): "​" for c in INVISIBLE}})  # as long as the source
    out, begins, pieces = [], [], []
    at = 0

    def put(piece: str, start: int, end: int, arc: str) -> None:
        nonlocal at
        begins.append(at)
        pieces.append((start, end, arc))
        out.append(piece)
        at += len(piece)

    def copy(start: int, end: int) -> None:
        """Unchanged runs are one piece; look-alikes are a piece each, invisible characters an empty one."""
        while start < end:
            stop = start
            while stop < end and letters[stop] == text[stop] and letters[stop] != "​":
                stop += 1
            if stop > start:
                put(text[start:stop], start, stop, "")
            elif letters[start] == "​":
                put("", start, start + 1, "invisible")
                stop += 1
            else:
                put(letters[start], start, start + 1, "letter")
                stop += 1
            start = stop

    # invisible characters must not part the words of an arc: arcs are sought on the text without them
    shown = [i for i, c in enumerate(letters) if c != "​"]
    seen = letters if len(shown) == len(letters) else "".join(letters[i] for i in shown)
    src = (lambda i: i) if seen is letters else (lambda i: shown[i] if i < len(shown) else len(text))
    done = 0
    for m in _ARCS.finditer(seen):
        arc = "gap" if m.lastgroup == "gap" else m.lastgroup
        start, end = src(m.start()), src(m.end() - 1) + 1
        copy(done, start)
        if arc in ("digit", "gap"):
            mid = src(m.end("digit") - 1) + 1
            put(DIGIT_WORDS[m.group("digit").lower().replace("\u0307", "")], start, mid, "digit")
            if end > mid:
                put("", mid, end, "gap")
        else:
            put({"at": "@", "weak": "@", "dot": ".", "plus": "+"}[arc], start, end, arc)
        done = end
    copy(done, len(text))
    return "".join(out), begins, pieces


def hidden(text: str, base: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """The spans that only the plain form shows, in source offsets."""
    plain, begins, pieces = plain_form(text)
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not any(arc for _, _, arc in pieces):
        return out
    for kind, find in DETECTORS.items():
        known = set(base[kind])
        for start, end in find(plain):
            first = bisect_right(begins, start) - 1  # of pieces that begin at one offset, all but the last are empty
            last = bisect_right(begins, end - 1) - 1
            taken = [arc for _, _, arc in pieces[first : last + 1]]
            arcs = set(taken) - {"", "gap"}
            if not arcs or ("weak" in arcs and "dot" not in arcs) or (arcs == {"digit"} and taken.count("digit") < 3):
                continue
            a, b = pieces[first], pieces[last]
            span = (a[0] + (start - begins[first] if not a[2] else 0), b[0] + (end - begins[last]) if not b[2] else b[1])
            if span not in known:
                known.add(span)
                out[kind].append(span)
    return out


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    rows = sorted((start, KINDS.index(kind), end) for kind in KINDS for start, end in spans[kind])
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in rows)


def spans_of(text: str) -> tuple[dict, dict]:
    """Base spans and all spans of a text."""
    base = {kind: find(text) for kind, find in DETECTORS.items()}
    if not disguised(text):
        return base, base
    more = hidden(text, base)
    return base, {kind: sorted(base[kind] + more[kind]) for kind in KINDS}


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, number of base spans by kind, their digest, all spans) of every row."""

    def run(ids, texts):
        out = []
        for text in texts:
            base, every = spans_of(text)
            out.append((*[len(base[k]) for k in KINDS], hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
        return [ids, *zip(*out)] if out else [[]] * 7

    kind = docs.schema[id_col].dataType
    names = [f"n_{k}" for k in KINDS]
    arrow = pa.schema([(id_col, to_arrow_type(kind)), *[(n, pa.int64()) for n in names], ("base_sha256", pa.string()), ("spans", pa.string())])
    schema = f"`{id_col}` {kind.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string"
    return arrow_map(docs.select(id_col, plain_text(text_col)), run, schema, arrow)

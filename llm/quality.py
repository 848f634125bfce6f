"""Quality rules as a short-circuit cascade (operator 4).

Every rule is a test that may reject a text. A sample of the table is run through all rules; a rule's cost is its mean
time, its selectivity the share that it rejects. The rules are then tried in descending order of rejections per second,
and a text's first rejection ends its cascade. The order changes the cost, never the verdict: a text is kept if no rule
rejects it.

Null and empty texts have no words; they fail the base and are not kept. Lines and words are compared exactly, so ties
and repeated rows need no order. An empty table gives an empty result. A row whose id is null keeps it. Columns
besides the id and the text are ignored.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import arrow_map, bounded, plain_text

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50


@dataclass
class Text:
    """A text and what the base has already counted of it."""

    text: str
    raw: bytes
    words: list[bytes]
    lines: list[str]
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def repeat_words(words: Sequence[bytes]) -> int:
    """Words that lie in a three-word window found twice or more, the first one included."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    v = len(known)
    pair = ids[:-1] * v + ids[1:]
    if v > 2_000_000:  # three indices would not fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    key = pair[:-1] * v + ids[2:]
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    at = np.isin(key, twice)
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(at)] |= at
    return int(covered.sum())


def measure(text: str) -> Text:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").strip()]
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    return Text(text, raw, words, lines, len(text) - spaces, symbols, len(lines) - len(set(lines)), repeat_words(words))


def base_failed(t: Text) -> bool:
    return len(t.words) < MIN_WORDS or 100 * t.n_repeat_words > REPEAT_PERCENT * len(t.words)


_LETTER = re.compile(r"[^\W\d_]")
_ALPHA_WORD = re.compile(r"[^ \t\n\x0b\x0c\r]*?[^\W\d_][^ \t\n\x0b\x0c\r]*")


def _few_letters(t: Text) -> bool:
    return 100 * sum(1 for _ in _ALPHA_WORD.finditer(t.text)) < 80 * len(t.words)


def _upper_case(t: Text) -> bool:
    upper = sum(map(str.isupper, t.text))
    return 2 * upper > sum(map(str.isalpha, t.text))


def _one_word(t: Text) -> bool:
    return 100 * max(Counter(t.words).values()) > 30 * len(t.words)


def _dots(t: Text) -> bool:
    return 100 * sum(x.rstrip(" \t\r").endswith(("...", "…")) for x in t.lines) > 30 * len(t.lines)


def _bullets(t: Text) -> bool:
    return 100 * sum(x.lstrip(" \t").startswith(("•", "- ", "* ")) for x in t.lines) > 90 * len(t.lines)


#: name, test. A test is asked only about texts that passed the base, so there is a word and a line.
RULES: list[tuple[str, Callable[[Text], bool]]] = [
    ("symbols", lambda t: 10 * t.n_symbols > len(t.words)),
    ("word_length", lambda t: not 3 * len(t.words) <= t.word_chars <= 10 * len(t.words)),
    ("duplicate_lines", lambda t: 100 * t.n_dup_lines > 40 * len(t.lines)),
    ("exclamations", lambda t: 10 * t.raw.count(b"!") > 3 * len(t.words)),
    ("one_word", _one_word),
    ("few_letters", _few_letters),
    ("upper_case", _upper_case),
    ("dots", _dots),
    ("bullets", _bullets),
]


def estimate(docs: DataFrame, sample_rows: int = 2000, text_col: str = "text") -> DataFrame:
    """(rule, seconds, rejected, asked) over a sample of at most ``sample_rows`` rows."""
    sample = docs.select(plain_text(text_col).alias("_text")).where(F.pmod(F.xxhash64("_text"), F.lit(16)) == 0).limit(sample_rows)

    def run(texts):
        measured = [m for m in map(measure, texts) if not base_failed(m)]
        out = []
        for name, test in RULES:
            start = time.perf_counter()
            rejected = sum(map(test, measured))
            out.append((name, time.perf_counter() - start, rejected, len(measured)))
        return list(zip(*out))

    arrow = pa.schema([("rule", pa.string()), ("seconds", pa.float64()), ("rejected", pa.int64()), ("asked", pa.int64())])
    runs = arrow_map(sample, run, "rule string, seconds double, rejected long, asked long", arrow)
    return runs.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"), F.sum("asked").alias("asked"))


def cascade_order(estimates: DataFrame) -> list[str]:
    """The rules by rejections per second, best first; one row per rule comes to the driver."""
    found = {r["rule"]: r for r in estimates.collect()}
    def gain(name):
        r = found.get(name)
        return (r["rejected"] + 0.5) / (r["seconds"] + 1e-6) if r else 0.0
    return sorted((name for name, _ in RULES), key=lambda name: -gain(name))


def judge(docs: DataFrame, order: Sequence[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept) of every row."""
    order = cascade_order(estimate(docs, text_col=text_col)) if order is None else order
    tests = dict(RULES)

    def run(ids, texts):
        cascade = [tests[name] for name in order]
        out = []
        for text in texts:
            t = measure(text)
            failed = base_failed(t)
            kept = not failed and not any(test(t) for test in cascade)
            out.append((len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, kept))
        return [ids, *zip(*out)] if out else [[]] * 8

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kind = docs.schema[id_col].dataType
    arrow = pa.schema([(id_col, to_arrow_type(kind)), *[(c, pa.int64()) for c in counts], ("base_failed", pa.bool_()), ("kept", pa.bool_())])
    schema = f"`{id_col}` {kind.simpleString()}, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, kept boolean"
    return arrow_map(docs.select(id_col, plain_text(text_col)), run, schema, arrow)


def keep_good(docs: DataFrame, order: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns."""
    order = cascade_order(estimate(docs, text_col=text_col)) if order is None else order
    tests = dict(RULES)
    where = docs.columns.index(text_col)

    def run(batches):
        cascade = [tests[name] for name in order]
        for batch in bounded(batches, where):
            keep = []
            for text in batch.column(where).to_pylist():
                t = measure(text or "")
                keep.append(not base_failed(t) and not any(test(t) for test in cascade))
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


#: The same verdicts in DuckDB.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
n AS (SELECT doc_id, t, l, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) AS alpha, length(regexp_replace(t, '[^!]', '', 'g')) AS bangs,
             length(regexp_replace(t, '\PL', '', 'g')) AS letters, length(regexp_replace(t, '\P{Lu}', '', 'g')) AS uppers,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) AS dots,
             len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*(•|- |\* )'))) AS bullets FROM d),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT i + s) AS n_repeat_words FROM g, range(3) x(s) WHERE c > 1 GROUP BY doc_id),
o AS (SELECT doc_id, max(c) AS top FROM (SELECT doc_id, word, count(*) AS c FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL) GROUP BY doc_id),
b AS (SELECT n.*, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(top, 0) AS top,
             n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
      FROM n LEFT JOIN r USING (doc_id) LEFT JOIN o USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_dup_lines > 40 * len(l)
            OR 10 * bangs > 3 * n_words OR 100 * top > 30 * n_words OR 100 * alpha < 80 * n_words OR 2 * uppers > letters
            OR 100 * dots > 30 * len(l) OR 100 * bullets > 90 * len(l)) AS kept
FROM b"""

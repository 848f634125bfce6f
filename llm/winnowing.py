"""Benchmark decontamination by winnowing (operator 11).

A window is ``length`` consecutive words of a benchmark item; an item of fewer words is one window. Of every ``length`` words,
winnowing keeps the least hash of the k-grams inside, the last of equal ones. Equal windows keep the same k-gram wherever they
stand, so a document that holds a window shares a fingerprint with the item. Items of m < ``length`` words are winnowed by
the scheme of m words, and so are the documents where such items exist (at most ``length`` schemes).

Fingerprints carry the words around them, as far as a window can reach. Document fingerprints that meet the benchmark's in a bit
table of fixed size (``filter_bits``; it only spares rows) are joined with them by hash, and each meeting is extended word by
word to both sides. A meeting of at least a window's words is a hit of all its words.

Words stand for themselves as 64-bit hashes. Null and empty texts have no words, and items without words no windows. Texts
are read whole; a text of any length is one row. Rows of one id are judged each by its own text, and equal rows alike; a null id is kept.
Items of one id count once; those without an id make hits but are not counted or named. An empty table of documents gives an empty
result, an empty benchmark leaves all documents clean. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import bounded, plain_text, ship, words_of, written

LENGTH = 10
FILTER_BITS = 1 << 26  # 8 MB

_STEP = np.uint64(0x100000001B3)
_WORD_BYTES = np.full(256, 0x20, dtype=np.uint8)
_WORD_BYTES[0x30:0x3A] = np.arange(0x30, 0x3A)
_WORD_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
_WORD_BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)
_WORD_BYTES[0x80:] = np.arange(0x80, 0x100)

_PRINT = "m int, gram long, around binary"
_HIT = f"array<struct<{_PRINT.replace(' int', ': int').replace(' long', ': long').replace(' binary', ': binary')}, at: array<int>>>"
_HITS = pa.list_(pa.struct([("m", pa.int32()), ("gram", pa.int64()), ("around", pa.binary()), ("at", pa.list_(pa.int32()))]))


def scheme(m: int) -> tuple[int, int]:
    """(k, w): the k-grams of m words and how many there are."""
    k = m - 2 * m // 5
    return k, m - k + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one piece and the offsets where each text's begin."""
    if not len(texts) or texts.buffers()[2] is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int32)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as hashes above 1, and the offsets where each text's begin.

    Letters and digits of ASCII and all other bytes above 127 make words; A-Z count as a-z.
    """
    spaced = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_WORD_BYTES[data]))
    at, words, ends = words_of(spaced)
    names = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words] or [0], dtype=np.uint64)
    return np.maximum(names, np.uint64(2))[at], ends


def grams(words: np.ndarray, m: int) -> np.ndarray:
    """The hash of the k-gram of the scheme for m words at every place."""
    k, _ = scheme(m)
    out = np.full(max(0, len(words) - k + 1), m, dtype=np.uint64)
    for j in range(k):
        out = _mixed(out * _STEP + words[j : j + len(out)])
    return out


def winnowed(hashed: np.ndarray, ends: np.ndarray, m: int) -> np.ndarray:
    """The ascending places of the k-grams that some window of m words inside one text keeps."""
    k, w = scheme(m)
    n = len(hashed) - w + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    least, place = hashed[:n].copy(), np.arange(n)
    for j in range(1, w):
        later = hashed[j : j + n]
        place = np.where(later <= least, np.arange(j, j + n), place)
        least = np.minimum(least, later)
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    place = place[text[:n] == text[m - 1 : m - 1 + n]]
    return place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place


def around(words: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, m: int, outside: int) -> np.ndarray:
    """One row per place: its k-gram's words and the w - 1 words on both sides, ``outside`` beyond the text's ends."""
    k, w = scheme(m)
    at = place[:, None] + np.arange(1 - w, k + w - 1)[None, :]
    inside = (at >= first[:, None]) & (at < last[:, None])
    return np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(outside))


def item_prints(items: DataFrame, length: int) -> DataFrame:
    """(item_id, cls, prints) of the items (item_id, text) that have words; items of equal words are one class."""
    kind = items.schema["item_id"].dataType
    arrow = pa.schema([("item_id", to_arrow_type(kind)), ("cls", pa.binary()), ("prints", pa.list_(pa.struct([("m", pa.int32()), ("gram", pa.int64()), ("around", pa.binary())])))])

    def run(batches):
        for batch in bounded(batches, 1):
            words, ends = word_hashes(*raw_bytes(batch.column(1)))
            rows = []
            for item, a, b in zip(batch.column(0).to_pylist(), ends, ends[1:]):
                if a == b:
                    continue
                own, m = words[a:b], min(length, int(b - a))
                hashed = grams(own, m)
                place = winnowed(hashed, np.array([0, len(own)]), m)
                near = around(own, place, np.zeros(len(place)), np.full(len(place), len(own)), m, 1)
                prints = [{"m": m, "gram": int(g), "around": x.tobytes()} for g, x in zip(hashed[place].view(np.int64), near)]
                rows.append((item, xxhash.xxh3_128_digest(own.tobytes()), prints))
            yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(list(zip(*rows)) or [[]] * 3, arrow)], schema=arrow)

    return items.mapInArrow(run, f"item_id {kind.simpleString()}, cls binary, prints array<struct<m: int, gram: long, around: binary>>")


def bit_table(prints: DataFrame, bits: int) -> np.ndarray:
    """A table of ``bits`` bits with those of the grams' leading bits set. At most bits / 64 numbers come to the driver."""
    place = F.shiftrightunsigned("gram", 64 - (bits.bit_length() - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    rows = prints.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("word"))
    found = rows.toPandas()
    table = np.zeros(bits // 64, dtype=np.uint64)
    table[found["at"].to_numpy(dtype=np.int64)] = found["word"].to_numpy(dtype=np.int64).view(np.uint64)
    return table


def document_hits(docs: DataFrame, lengths: list[int], table, bits: int) -> DataFrame:
    """(_id, key, n_words, hits) of the documents (_id, _text): their fingerprints that the bit table holds, with their places."""
    kind = docs.schema["_id"].dataType
    arrow = pa.schema([("_id", to_arrow_type(kind)), ("key", pa.binary()), ("n_words", pa.int64()), ("hits", _HITS)])
    shift = np.uint64(64 - (bits.bit_length() - 1))

    def run(batches):
        known = table.value
        for batch in bounded(batches, 1):
            ids = batch.column(0).to_pylist()
            data, offsets = raw_bytes(batch.column(1))
            words, ends = word_hashes(data, offsets)
            keys = []
            for i, a, b in zip(ids, offsets, offsets[1:]):
                key = xxhash.xxh3_128(repr(i).encode())
                key.update(data[a:b])
                keys.append(key.digest())
            found: list[dict] = [defaultdict(list) for _ in ids]
            for m in lengths:
                hashed = grams(words, m)
                place = winnowed(hashed, ends, m)
                bit = hashed[place] >> shift
                place = place[(known[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
                text = np.searchsorted(ends, place, side="right") - 1
                near = around(words, place, ends[text], ends[text + 1], m, 0)
                for t, p, g, x in zip(text.tolist(), (place - ends[text]).tolist(), hashed[place].view(np.int64).tolist(), near):
                    found[t][m, g, x.tobytes()].append(p)
            hits = [[{"m": m, "gram": g, "around": x, "at": at} for (m, g, x), at in f.items()] for f in found]
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array(np.diff(ends), pa.int64()), pa.array(hits, _HITS)], schema=arrow)

    return docs.mapInArrow(run, f"_id {kind.simpleString()}, key binary, n_words long, hits {_HIT}")


def extended(met: DataFrame) -> DataFrame:
    """(key, cls, at, before, after) of the meetings (key, m, around, at, cls, item_around) that reach a window's words.

    ``before`` and ``after`` are the equal words before a place and from it on.
    """
    arrow = pa.schema([("key", pa.binary()), ("cls", pa.binary()), ("at", pa.list_(pa.int32())), ("before", pa.int32()), ("after", pa.int32())])

    def run(batches):
        for batch in batches:
            m = batch.column("m").to_numpy()
            for length in np.unique(m).tolist():
                k, w = scheme(length)
                some = batch.filter(pa.array(m == length))
                sides = [np.frombuffer(b"".join(some.column(c).to_pylist()), dtype=np.uint64).reshape(len(some), -1) for c in ("around", "item_around")]
                same = sides[0] == sides[1]
                before = np.cumprod(same[:, : w - 1][:, ::-1], axis=1).sum(axis=1)
                after = np.cumprod(same[:, w - 1 :], axis=1).sum(axis=1)
                hit = pa.array((after >= k) & (before + after >= length))
                columns = [some.column("key"), some.column("cls"), some.column("at"), pa.array(before, pa.int32()), pa.array(after, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow).filter(hit)

    return met.select("key", "m", "around", "at", "cls", "item_around").mapInArrow(run, "key binary, cls binary, at array<int>, before int, after int")


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, filter_bits: int = FILTER_BITS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``; ``filter_bits`` is a power of two.

    Runs jobs: the items' fingerprints, their bit table, and one pass over the texts, whose few hits are stored.
    """
    spark = docs.sparkSession
    ship(spark)
    items = written(item_prints(benchmark.select(F.col(item_col).alias("item_id"), plain_text(item_text).alias("_text")), length))
    prints = written(items.select("cls", F.explode("prints").alias("p")).select("cls", "p.*").distinct())
    lengths = sorted(r["m"] for r in prints.select("m").distinct().collect())  # at most `length` numbers
    table = spark.sparkContext.broadcast(bit_table(prints, filter_bits))
    rows = written(document_hits(docs.select(F.col(id_col).alias("_id"), plain_text(text_col).alias("_text")), lengths, table, filter_bits))

    hits = rows.where(F.size("hits") > 0).select("key", F.explode("hits").alias("h")).select("key", "h.*").distinct()
    met = hits.join(prints.withColumnRenamed("around", "item_around"), ["m", "gram"])
    found = written(extended(met))
    # all spans of a place hold its k-gram, so their union is one span
    places = found.select("key", F.explode("at").alias("p"), "before", "after").groupBy("key", "p").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    spans = places.select("key", (F.col("p") - F.col("before")).alias("first"), (F.col("p") + F.col("after")).alias("last"))
    covered = F.max("last").over(W.partitionBy("key").orderBy("first", "last").rowsBetween(W.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.coalesce(covered, F.col("first"))))
    n_hit = spans.withColumn("_new", new).groupBy("key").agg(F.sum("_new").cast("long").alias("n_hit"))
    named = items.where(F.col("item_id").isNotNull()).select("cls", F.col("item_id").cast("string").alias("_item")).distinct()
    held = found.select("key", "cls").distinct().join(named, "cls").select("key", "_item").distinct()
    listed = F.array_join(F.sort_array(F.collect_list("_item")), ",")
    n_items = held.groupBy("key").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(listed, 256).alias("items_sha256"))
    judged = written(n_hit.join(n_items, "key", "left"))
    out = rows.select("_id", "key", "n_words").join(judged, "key", "left")
    return out.select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


#: The same rows by joining all runs of words.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bm AS (SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, unnest(list_transform(range(1, CAST(len(w) - m + 2 AS BIGINT)), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS g FROM bm),
ms AS (SELECT DISTINCT m FROM win),
dw AS (SELECT r, m, unnest(range(1, CAST(len(w) - m + 2 AS BIGINT))) AS p, w FROM d, ms WHERE len(w) >= m),
dg AS (SELECT r, m, p, array_to_string(list_slice(w, p, p + m - 1), ' ') AS g FROM dw),
hit AS (SELECT r, m, p, item_id FROM dg JOIN win USING (m, g)),
n AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS q FROM (SELECT DISTINCT r, p, m FROM hit)) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)"""

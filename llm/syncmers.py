"""Document fingerprints from closed syncmers (operator 6).

A run of ``K`` characters is an anchor if its least inner run of ``S`` characters (by hash) is its first or its last. That is
decided by the run alone, so an edit changes only the anchors that it touches. A text's first run is an anchor too, so that
short texts have one. A fingerprint keeps every distinct anchor with a hash below ``SHARE`` (an eighth of all anchors, so it
grows with the text), and the ``SIZE`` of least hash if those are fewer, each with the place where it occurs first: 8
hexadecimal digits of hash and 8 of place, by hash. Two fingerprints are matched by position: of the anchors that both have,
the longest chain that is in the same order in both counts. The likeness is that number over the size of the sample of the
union, 1 for equal fingerprints, 0 if either is empty. The sample of the union follows the same rule as a fingerprint (all hashes
below ``SHARE``, ``SIZE`` at least), and each of its anchors is in the fingerprint of every text that has it. So the likeness
is that of a random sample of n anchors, with a standard error of at most 0.5 / sqrt(n): 0.06 for short texts, 0.01
for those of some 100,000 characters.

Texts shorter than ``K`` have one anchor, the whole text; the empty and the null text have the empty fingerprint. Equal
texts have equal fingerprints.

``with_next`` walks the documents by descending id (null last, then by text). The next document of a range's last row is the
first of the following range, which travels along with the rows; after the last document comes the first. Rows with
equal ids are neighbours. A single document is its own next one. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import bounded, plain_text

K, S, SIZE = 16, 4, 64
SHARE = 1 << 29  # of 2^32 hashes
_B = [np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64)) for n in (1, 2, 4, 8)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def anchors(points: np.ndarray, head: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hash, place) of the closed syncmers of a text of ``K`` characters or more; ``head``: and of its first run."""
    h1 = points.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _B[0] + h1[1:]
    h4 = h2[:-2] * _B[1] + h2[2:]
    h8 = h4[:-4] * _B[2] + h4[4:]
    h16 = h8[:-8] * _B[3] + h8[8:]
    inner = _mixed(h4)
    width = K - S + 1  # inner runs of a run
    two = np.minimum(inner[:-1], inner[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    least = np.minimum(eight[: len(eight) - (width - 8)], eight[width - 8 :])
    n = len(h16)
    is_anchor = (inner[:n] == least) | (inner[width - 1 :] == least)
    is_anchor[0] |= head
    at = np.flatnonzero(is_anchor)
    return (_mixed(h16[at]) >> np.uint64(32)).astype(np.uint32), at


def _kept(hashes: np.ndarray) -> int:
    """How many of the ascending hashes a sample keeps."""
    return min(len(hashes), max(SIZE, int(np.searchsorted(hashes, SHARE))))


def sketch(found: tuple[np.ndarray, np.ndarray]) -> str:
    """The fingerprint of a text's anchors (places ascending)."""
    hashes, first = np.unique(found[0], return_index=True)
    n = _kept(hashes)
    return np.stack([hashes[:n], found[1][first[:n]]], axis=1).astype(">u4").tobytes().hex()


def _short(text: str) -> str:
    return f"{xxhash.xxh32_intdigest(text.encode('utf-8', 'surrogatepass')):08x}00000000" if text else ""


def fingerprint(text: str) -> str:
    return sketch(anchors(code_points(text))) if len(text) >= K else _short(text)


def _parsed(mark: str) -> np.ndarray:
    """(hash, place) rows by hash."""
    return np.frombuffer(bytes.fromhex(mark), dtype=">u4").astype(np.int64).reshape(-1, 2)


def likeness(a: str, b: str) -> float:
    """The likeness of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    left, right = _parsed(a), _parsed(b)
    if not len(left) or not len(right):
        return 0.0
    both, i, j = np.intersect1d(left[:, 0], right[:, 0], assume_unique=True, return_indices=True)
    union = np.union1d(left[:, 0], right[:, 0])
    n = _kept(union)
    sampled = both <= union[n - 1]
    places = np.stack([left[i[sampled], 1], right[j[sampled], 1]], axis=1)
    chain: list[int] = []  # the longest rising subsequence of the places in b, by places in a
    for place in places[np.lexsort((both[sampled], places[:, 0])), 1].tolist():
        at = bisect_left(chain, place)
        chain[at : at + 1] = [place]
    return len(chain) / n


def edited_anchors(points: np.ndarray, own: tuple[np.ndarray, np.ndarray], keep: int, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the first ``keep`` characters followed by ``tail``: only those that touch the tail are sought anew."""
    inside = own[1] <= keep - K
    start = max(0, keep - K + 1)
    joined = np.concatenate([points[start:keep], tail])
    if len(joined) < K:
        return own[0][inside], own[1][inside]
    new = anchors(joined, head=start == 0)
    return np.concatenate([own[0][inside], new[0]]), np.concatenate([own[1][inside], new[1] + start])


class _Document:
    """A document on its way through the walk."""

    def __init__(self, key, text: str):
        self.key, self.text, self.points = key, text, code_points(text)
        self.anchors = anchors(self.points) if len(text) >= K else None
        self.mark = sketch(self.anchors) if self.anchors is not None else _short(text)

    def row(self, follower: _Document) -> tuple:
        n = len(self.text)
        keep, third = n - n // 3, n // 3
        edited = self.text[:keep] + follower.text[:third]
        if edited == self.text:
            mark = self.mark
        elif len(edited) < K:
            mark = _short(edited)
        elif self.anchors is None:
            mark = fingerprint(edited)
        else:
            mark = sketch(edited_anchors(self.points, self.anchors, keep, follower.points[:third]))
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return self.key, n, digest, self.mark, mark, likeness(self.mark, mark), likeness(self.mark, follower.mark)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row. Runs two jobs on the ids."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = F.lit(-(2**63)).cast("long")
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(id_col).cast("long"), lowest).alias("_key"), plain_text(text_col).alias("_text"))
    # at most as many cuts as ranges come to the driver; they balance the ranges, the result does not depend on them
    cuts = rows.agg(F.percentile_approx("_key", [(k + 1) / ranges for k in range(ranges - 1)] or [0.5], 100 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    above = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("_key"))) if cuts else F.lit(0)
    ranged = rows.withColumn("_range", (F.lit(len(cuts)) - above).cast("int"))  # descending
    heads = {r["_range"]: r["_head"] for r in ranged.select("_range", "_key").groupBy("_range").agg(F.max("_key").alias("_head")).collect()}
    order = sorted(heads)
    # the first id of a range goes to the range before it as well; that of the first range to the last one
    also = {heads[r]: order[i - 1] for i, r in enumerate(order)}
    target = F.element_at(F.create_map(*[F.lit(v).cast(t) for k, r in also.items() for v, t in ((k, "long"), (r, "int"))]), F.col("_key")) if also else F.lit(None).cast("int")
    sent = ranged.select("_id", "_key", "_text", F.posexplode(F.array_compact(F.array(F.col("_range"), target))).alias("_ahead", "_to"))
    dealt = sent.repartition(ranges, "_to").sortWithinPartitions("_to", "_ahead", F.desc("_key"), "_text")
    kind = docs.schema[id_col].dataType
    arrow = pa.schema([
        (id_col, to_arrow_type(kind)), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None  # the row that waits for its next one, and its range
        for batch in bounded(batches, 1):
            out = []
            for key, text, ahead, to in zip(*[c.to_pylist() for c in batch.columns]):
                if held is None and ahead:
                    continue  # a range needs one document of those behind it
                document = _Document(key, text)
                if held is not None and to == at:
                    out.append(held.row(document))
                held, at = (None, None) if ahead else (document, to)
            columns = list(zip(*out)) if out else [[]] * len(arrow)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    schema = f"`{id_col}` {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("_id", "_text", "_ahead", "_to").mapInArrow(run, schema)

"""Removal of repeated byte strings with suffix arrays (operator 3).

A byte goes if a string of ``length`` bytes (a window) that covers it starts anywhere else in the corpus too. Equal
windows have the same anchor: the leftmost gram of 24 bytes with the least hash. So all starts of a window meet under its
anchor, and only anchors that occur twice need a look:

1. Every text sends the hashes of its anchors, one entry per task and hash; hashes that two texts or two places share
   are found block by block. Texts with copies are wholly removed (from ``length`` bytes on) and one of them stays a partner.
2. A shared anchor's context is the run of bytes that its windows cover. Equal contexts are counted before the shuffle; a
   context that occurs twice is repeated in all its windows.
3. The different contexts of an anchor are cut into cells of 16 bytes counted from the anchor. A suffix array over the cells of all
   contexts of a task, built by linear grouping (``suffix_groups``), brings together the suffixes that agree in
   the cells that every window from there on holds. A window alone in its group is unique; the others are
   compared byte by byte. Anchors with more than ``hot`` different contexts are spread: their windows are counted one by
   one, by hash, with partial sums.
4. Ranges of repeated windows go back to the places of their contexts and are cut out of the texts.

Null texts are empty; texts shorter than ``length`` have no window. Overlapping and periodic repeats count, ties between equal grams
go to the left. Repeated rows are copies of each other. An empty table gives an empty result. A null id stays null. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import bounded, plain_text, written
from llm.suffix_groups import suffix_array
from tagloom.session import cut_lineage

GRAM = 24
CELL = 16
HOT = 20_000  # different contexts of one anchor that a task takes
_STEP = (1 << 20) - 4096  # positions of a slice of a text; 20 bits hold a place in it
_LOW = np.uint64((1 << 20) - 1)
_ENTRY = np.dtype([("hash", "<u8"), ("own", "<u8"), ("shared", "u1")])
_ENTRIES = 1 << 19
_BASE = [pow(0x9E3779B97F4A7C15, n, 1 << 64) for n in range(GRAM)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at every place."""
    b = [np.uint64(x) for x in _BASE]
    h1 = data.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * b[1] + h1[1:]
    h4 = h2[:-2] * b[2] + h2[2:]
    h8 = h4[:-4] * b[4] + h4[4:]
    h16 = h8[:-8] * b[8] + h8[8:]
    h = h16[:-8] * b[8] + h8[16:]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of every anchor of a text, in order."""
    if len(data) < length:
        return (np.empty(0, dtype=np.uint64),) + (np.empty(0, dtype=np.int64),) * 3
    raw = np.frombuffer(data, dtype=np.uint8)
    width = length - GRAM + 1  # grams of a window
    windows = len(data) - length + 1
    hashes, places = [], []
    for start in range(0, windows, _STEP):
        stop = min(windows, start + _STEP)
        h = gram_hashes(raw[start : stop - 1 + length])
        least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        rest = width - size
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & _LOW).astype(np.int64)
        places.append(at + start)
        hashes.append(h[at])
    place, h = np.concatenate(places), np.concatenate(hashes)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return h[first], place[first], first, last


def _entries(docs: DataFrame, length: int, blocks: int) -> DataFrame:
    """(block, payload): anchor hashes with the text they are of, one entry per hash in a batch, and the pairs already known as shared."""
    arrow = pa.schema([("block", pa.int32()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1, 32 << 20):
            hashes, owners, again = [], [], []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, times = np.unique(anchors(text.encode("utf-8", "surrogatepass"), length)[0], return_counts=True)
                hashes.append(found)
                owners.append(np.full(len(found), np.uint64(own & (2**64 - 1))))
                again.append(times > 1)
            h, own, twice = np.concatenate(hashes), np.concatenate(owners), np.concatenate(again)
            order = np.lexsort((own, h))
            h, own, twice = h[order], own[order], twice[order]
            new = np.ones(len(h), dtype=bool)  # one entry per hash and text; copies of a text are one
            new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
            h, own, twice = h[new], own[new], twice[new]
            more = np.zeros(len(h), dtype=bool)
            more[1:] = h[1:] == h[:-1]
            shared = twice | more
            shared[:-1] |= more[1:]
            begin = np.flatnonzero(~more)
            if len(begin):
                shared = np.repeat(np.logical_or.reduceat(shared, begin), np.diff([*begin, len(h)]))
            entry = np.empty(len(h), dtype=_ENTRY)
            entry["hash"], entry["own"], entry["shared"] = h, own, np.where(more, 2, shared)
            block = np.where(more, own, h) % np.uint64(blocks)  # a hash sends one entry; the rest only report their text
            order = np.argsort(block, kind="stable")
            entry, block = entry[order], block[order].astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.empty(0, dtype=np.int64)
            yield pa.record_batch([pa.array(block[cuts], pa.int32()), pa.array([entry[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(block)])], pa.binary())], schema=arrow)

    return docs.select("x64", "text").mapInArrow(run, "block int, payload binary")


def _shared(blocks: DataFrame) -> DataFrame:
    """(x64, hash) of the anchors that two texts or two places share."""

    def run(block: pa.Table) -> pa.Table:
        entry = np.concatenate([np.frombuffer(p.as_buffer(), dtype=_ENTRY) for p in block.column("payload")])
        known = entry[entry["shared"] > 0]
        entry = entry[entry["shared"] < 2]
        entry = entry[np.argsort(entry["hash"], kind="stable")]
        found = known
        if len(entry):
            new = np.concatenate([[True], entry["hash"][1:] != entry["hash"][:-1]])
            begin = np.flatnonzero(new)
            differs = np.minimum.reduceat(entry["own"], begin) != np.maximum.reduceat(entry["own"], begin)
            found = np.concatenate([known, entry[differs[np.cumsum(new) - 1] & (entry["shared"] == 0)]])
        return pa.table({"x64": pa.array(found["own"].view(np.int64)), "hash": pa.array(found["hash"].view(np.int64))})

    return blocks.groupBy("block").applyInArrow(run, "x64 long, hash long")


def _shared_anchors(text: bytes, hashes: list[int], length: int):
    """(hash, place, first, last) of a text's anchors among the shared ones, as Python lists."""
    h, place, first, last = anchors(text, length)
    keep = np.isin(h, np.array(hashes, dtype=np.int64).view(np.uint64))
    return zip(h[keep].view(np.int64).tolist(), place[keep].tolist(), first[keep].tolist(), last[keep].tolist())


def _context(text: bytes, place: int, first: int, last: int, length: int) -> tuple[bytes, int, int]:
    """The bytes of an anchor's windows, the anchor's offset in them, and their hash."""
    context = text[first : last + length]
    return context, place - first, xxhash.xxh3_64_intdigest(context, place - first) - (1 << 63)


def _places(texts: DataFrame, length: int) -> DataFrame:
    """(cls, hash, ctx, firsts): where each context of a text begins, as packed 64-bit numbers."""
    arrow = pa.schema([("cls", pa.binary()), ("hash", pa.int64()), ("ctx", pa.int64()), ("firsts", pa.binary())])

    def run(batches):
        for batch in bounded(batches, 1):
            rows = []
            for cls, text, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text, at = text.encode("utf-8", "surrogatepass"), {}
                for h, place, first, last in _shared_anchors(text, hashes, length):
                    at.setdefault((h, _context(text, place, first, last, length)[2]), []).append(first)
                rows += [(cls, h, c, np.array(firsts, dtype="<i8").tobytes()) for (h, c), firsts in at.items()]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return texts.select("cls", "text", "hashes").mapInArrow(run, "cls binary, hash long, ctx long, firsts binary")


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """(hash, ctx, times, offset, bytes): the different contexts of a batch with the number of places that have them."""
    arrow = pa.schema([("hash", pa.int64()), ("ctx", pa.int64()), ("times", pa.int64()), ("offset", pa.int32()), ("bytes", pa.binary())])

    def run(batches):
        for batch in bounded(batches, 1, 16 << 20):
            found: dict[tuple[int, int], list] = {}
            for text, hashes, copies in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                text = text.encode("utf-8", "surrogatepass")
                for h, place, first, last in _shared_anchors(text, hashes, length):
                    context, offset, c = _context(text, place, first, last, length)
                    if (h, c) in found:
                        found[h, c][0] += copies
                    else:
                        found[h, c] = [copies, offset, context]
            columns = list(zip(*[(h, c, *v) for (h, c), v in found.items()])) if found else [[]] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return texts.select("cls", "text", "hashes", "copies").mapInArrow(run, "hash long, ctx long, times long, offset int, bytes binary")


def repeated_windows(groups: list[list[tuple[bytes, int, bool]]], length: int) -> list[list[list[tuple[int, int]]]]:
    """The ranges of repeated windows of every context of every group.

    A group holds the different contexts (bytes, anchor offset, occurs twice) of one anchor. One suffix array over
    the cells of all contexts, then byte comparison inside the suffix groups.
    """
    enough = (length - CELL + 1) // CELL  # whole cells that any window holds
    cells: dict[tuple, int] = {}
    symbols: list[int] = []
    bases: list[list[tuple[int, int]]] = []  # of each context: place in the sequence, first cell
    separators = sum(map(len, groups))
    number = 0
    for g, contexts in enumerate(groups):
        bases.append([])
        for data, offset, _ in contexts:
            low, high = -(offset // CELL), (len(data) - offset) // CELL
            bases[-1].append((len(symbols), low))
            for i in range(low, high):
                at = offset + i * CELL
                symbols.append(separators + cells.setdefault((g, i, data[at : at + CELL]), len(cells)))
            symbols.append(number)  # a mark of its own behind each context
            number += 1
    order = suffix_array(symbols)
    agree = [0] * len(symbols)  # number of the suffix group
    now, last = 0, None
    for at in order:
        head = symbols[at : at + enough]
        if head != last:
            now += 1
            last = head
        agree[at] = now
    out = []
    for g, contexts in enumerate(groups):
        together: dict[int, list[tuple[int, int]]] = {}
        repeated = [bytearray(len(data) - length + 1) for data, _, _ in contexts]
        for k, (data, offset, _) in enumerate(contexts):
            base, low = bases[g][k]
            for i in range(-((offset) // CELL), -((offset - (len(data) - length)) // CELL) + 1):
                together.setdefault(agree[base + i - low], []).append((k, i))
        for same in together.values():
            if len(same) < 2:
                continue
            seen: dict[tuple[int, bytes], tuple[int, int]] = {}
            for k, i in same:
                data, offset, _ = contexts[k]
                for s in range(max(0, offset + (i - 1) * CELL + 1), min(offset + i * CELL, len(data) - length) + 1):
                    key = (offset - s, data[s : s + length])
                    if key in seen:
                        other, place = seen[key]
                        repeated[other][place] = repeated[k][s] = 1
                    else:
                        seen[key] = (k, s)
        out.append([])
        for k, (data, _, twice) in enumerate(contexts):
            if twice:
                out[-1].append([(0, len(data) - length)])
                continue
            flags = np.frombuffer(bytes(repeated[k]), dtype=np.uint8)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]])))
            out[-1].append([(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])])
    return out


def _settle(contexts: DataFrame, length: int, buckets: int) -> DataFrame:
    """(hash, ctx, from, to): ranges of repeated windows within a context, for anchors with few different contexts."""

    def run(bucket: pa.Table) -> pa.Table:
        merged: dict[int, dict[int, list]] = {}
        for h, c, times, offset, data in zip(*[bucket.column(n).to_pylist() for n in ("hash", "ctx", "times", "offset", "bytes")]):
            known = merged.setdefault(h, {}).setdefault(c, [0, offset, data])
            known[0] += times
        rows, open_ = [], []
        for h, group in merged.items():
            if len(group) == 1 or all(times > 1 for times, _, _ in group.values()):
                rows += [(h, c, 0, len(data) - length) for c, (times, _, data) in group.items() if times > 1]
            else:
                open_.append((h, list(group), [(data, offset, times > 1) for times, offset, data in group.values()]))
        for (h, keys, _), ranges in zip(open_, repeated_windows([x[2] for x in open_], length)):
            rows += [(h, c, a, b) for c, found in zip(keys, ranges) for a, b in found]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("hash", "ctx", "from", "to"), columns)})

    dealt = contexts.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, "hash long, ctx long, `from` long, `to` long")


def _settle_hot(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with many different contexts: windows counted by hash, no task holds a whole group."""
    arrow = pa.schema([("hash", pa.int64()), ("ctx", pa.int64()), ("times", pa.int64()), ("start", pa.int64()), ("distance", pa.int32()), ("window", pa.binary())])

    def run(batches):
        for batch in bounded(batches, 4, 1 << 20):
            rows = []
            for h, c, times, offset, data in zip(*[x.to_pylist() for x in batch.columns]):
                for s in range(len(data) - length + 1):
                    rows.append((h, c, times, s, offset - s, xxhash.xxh3_128_digest(data[s : s + length])))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, arrow)], schema=arrow)

    schema = "hash long, ctx long, times long, start long, distance int, window binary"
    windows = cut_lineage(contexts.select("hash", "ctx", "times", "offset", "bytes").mapInArrow(run, schema))
    key = ["hash", "distance", "window"]
    twice = windows.groupBy(*key).agg(F.sum("times").alias("_n")).where("_n > 1").select(*key)
    return windows.join(cut_lineage(twice), key).select("hash", "ctx", F.col("start").alias("from"), F.col("start").alias("to")).distinct()


def _cut(texts: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """(cls, n_removed, n_spans, kept_sha256, spans) of the texts with repeated windows."""
    joined = texts.select("cls", "text").join(ranges, "cls")
    arrow = pa.schema([
        ("cls", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ])

    def run(batches):
        for batch in bounded(batches, 1):
            rows = []
            for cls, text, covered in zip(*[x.to_pylist() for x in batch.columns]):
                text = text.encode("utf-8", "surrogatepass")
                edge = np.zeros(len(text) + 1, dtype=np.int64)
                for r in covered:
                    firsts = np.frombuffer(r["firsts"], dtype="<i8")
                    np.add.at(edge, firsts + r["from"], 1)
                    np.add.at(edge, firsts + r["to"] + length, -1)
                gone = (np.cumsum(edge[:-1]) > 0).astype(np.int8)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                kept = np.frombuffer(text, dtype=np.uint8)[gone == 0].tobytes()
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]
                rows.append((cls, int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans))
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return joined.mapInArrow(run, "cls binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>")


def remove_repeats(docs: DataFrame, length: int = 200, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row."""
    if length < GRAM + 2 * CELL:
        raise ValueError("the window is too short for the anchors and cells")
    text = plain_text(text_col)
    docs = docs.select(F.col(id_col).alias("_id"), text.alias("text"), F.xxhash64(text).alias("x64"), F.unhex(F.sha2(text, 256)).alias("cls"))
    rows = cut_lineage(docs.select("_id", "cls", "x64", F.octet_length("text").cast("long").alias("n_bytes")))
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    # an anchor for about (length - GRAM) / 2 bytes
    n_anchors = 2 * size // (length - GRAM)
    pairs = _shared(_entries(docs.where(F.octet_length("text") >= length), length, max(64, n_anchors // _ENTRIES)))
    lists = pairs.groupBy("x64").agg(F.collect_set("hash").alias("hashes"))
    classes = cut_lineage(rows.groupBy("cls", "x64").agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("rep")))
    wanted = classes.join(lists, "x64").select(F.col("cls").alias("_cls"), "copies", "rep", "hashes")
    texts = docs.join(wanted, (F.col("cls") == F.col("_cls")) & F.col("_id").eqNullSafe(F.col("rep"))).select("cls", "text", "hashes", "copies")
    texts = written(texts.dropDuplicates(["cls"]))
    contexts = _contexts(texts, length)
    places = written(_places(texts, length))
    per_anchor = places.groupBy("hash").agg(F.count_distinct("ctx").alias("_n")).where(F.col("_n") > hot).select("hash")
    hot_anchors = cut_lineage(per_anchor)
    ranges = _settle(contexts.join(hot_anchors, "hash", "left_anti"), length, max(64, n_anchors // 20_000))
    if hot_anchors.limit(1).count():
        ranges = ranges.unionByName(_settle_hot(contexts.join(hot_anchors, "hash", "left_semi"), length))
    ranges = cut_lineage(ranges)
    per_text = places.join(ranges, ["hash", "ctx"]).groupBy("cls").agg(F.collect_list(F.struct("firsts", "from", "to")).alias("covered"))
    single = texts.where("copies = 1")
    cut = cut_lineage(_cut(single, per_text, length)).withColumnRenamed("cls", "_cut")
    copies = classes.select(F.col("cls").alias("_cls"), "copies")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    span = F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    none = F.array().cast("array<struct<start: long, end: long>>")
    out = rows.join(copies, F.col("cls") == F.col("_cls")).join(cut, F.col("cls") == F.col("_cut"), "left")
    return out.select(
        F.col("_id").alias(id_col), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("cls")))).alias("kept_sha256"),
        F.when(whole, F.array(span)).otherwise(F.coalesce("spans", none)).alias("spans"),
    )

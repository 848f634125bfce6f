"""N-gram Jaccard join by a token-group matrix (operator 8).

A document's set holds the hashes of its distinct word shingles. Equal sets are one class with one representative. What
the matrix compares are signatures: the hash range is cut into 2^i parts, and a part's tokens together are one
signature. Two sets that link differ in at most H tokens (H follows from the smaller size), so of k > H parts at least
k - H are the same in both; i depends on the smaller size alone, so a set is cut for the one or two schemes that its
partners can have. Every bound below is a bound on the overlap of a query set with a group's union of signatures:

1. The group of all other sets. Of a set's signatures, the H + j with the least hashes must hold j that other sets have
   (j is k - H, at most ``OVERLAP``). Sets without them have no partner; most end here. The union over all sets is
   never gathered: signatures meet by key, in blocks that each task has already reduced to one entry per signature.
2. The same group, with tokens: c of a set's tokens are in the union of the others. Sets with den * c < num * n have no
   partner. For a pair, the smaller c bounds the overlap, so num * n of either set is at most the other's
   ``room`` = (num + den) * c - num * n.
3. The remaining sets' signatures are counted over all sets. A set must share at least k - H; of these all but the rarest
   ``shared - (k - H) + 1`` are dropped, which takes common passages out of the matrix. A signature's sets stay only if its
   least size and greatest room leave them a partner.
4. Groups of similar sets: every set is compared with the roomiest and the least set of each of its kept signatures.
   Links found are closed to groups.
5. Sets that share a kept signature with another group are held against the union of all other groups, as in step 2: tokens
   that only the own group has give no room. A query that is left is held against each other group that shares a kept
   signature: the group's union must hold so many of its tokens that the query has room for a member. Else the group stays
   closed. Opened groups, and small ones at once, are compared set by set, where the rooms allow a link.

Every link is decided on the sets themselves (``den * common >= num * union``). All links between different sets of
one group need not be looked at: they cannot change the components.

Texts without words, null and empty texts have an empty set and link with nothing. Texts of any length are one row. Ids are whole
numbers. Sets are told apart by their digest: rows of one id with unlike texts are documents of their own that happen to be named alike.
A null id takes part and gets the least id of its component, null if there is none. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from llm.common import bounded, plain_text, ship, unused, words_of, written
from llm.components import components
from tagloom.session import cut_lineage

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SLACK = 0.94  # leaves some parts of a scheme for empty ones
_ENTRIES = 1 << 20  # signature entries of one block task, about
_ENTRY = np.dtype([("high", "<u4"), ("low", "u1"), ("own", "<u8"), ("shared", "u1")])
AT_ONCE = 16  # sets of a group that is opened without its own bound, as that costs less than the bound
OVERLAP = 8  # shared signatures that the first bound asks for, at most


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, ascending within a text, and the offsets where each text's begin."""
    at, words, ends = words_of(pc.ascii_lower(texts))
    names = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words] or [0], dtype=np.uint64)
    h = names[at]
    counts = np.diff(ends)
    shingles = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), shingles)
    first = np.concatenate([[0], np.cumsum(shingles)])
    start = np.repeat(ends[:-1], shingles) + np.arange(first[-1]) - np.repeat(first[:-1], shingles)
    length = np.minimum(counts, k)[doc]
    hashed = mixed(length.astype(np.uint64) * _GOLD)
    for j in range(k):
        has = length > j
        hashed[has] = mixed(hashed[has] * np.uint64(0x100000001B3) + h[start[has] + j])
    order = np.lexsort((hashed, doc))
    hashed, doc = hashed[order], doc[order]
    new = np.ones(len(hashed), dtype=bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (doc[1:] != doc[:-1])
    return hashed[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(counts)))])


def _scheme(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least i with (den - num) / num * size < slack * 2^i: the scheme of pairs whose smaller set has this size."""
    differ = np.maximum(size * ((den - num) / num) / _SLACK, 0.5)
    return np.maximum(np.floor(np.log2(differ)) + 1, 0).astype(np.int64)


def signatures(tokens: np.ndarray, ends: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set, scheme, signature, required) of all sets: a partner under the scheme shares at least ``required`` of them.

    Required may be 1 for lack of a better bound; then the least tokens are signatures too (plain prefix filter).
    """
    size = np.diff(ends)
    most = _scheme(size, num, den)
    least = _scheme(-(-size * num // den), num, den)
    out = []
    own = mixed(tokens + _GOLD)
    for scheme in np.unique(np.concatenate([most, least])):
        in_it = ((most == scheme) | (least == scheme)) & (size > 0)
        if not in_it.any():
            continue
        i, parts = int(scheme), 1 << int(scheme)
        sets = np.flatnonzero(in_it)
        which = np.repeat(np.arange(len(size)), size)
        take = in_it[which]
        doc, tok, val = which[take], tokens[take], own[take]
        part = tok >> np.uint64(64 - i) if i else np.zeros(len(tok), dtype=np.uint64)
        new = np.ones(len(tok), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        sums = np.add.reduceat(val, begin)
        sig = mixed(sums + mixed(part[begin] + np.uint64((i + 1) << 40)))
        sdoc = doc[begin]
        filled = np.bincount(sdoc, minlength=len(size))
        # the largest smaller size under this scheme; a pair of sizes a <= b differs in at most a * (den - num) / num tokens
        top = int(np.floor(_SLACK * parts * num / (den - num))) + 1
        differ = np.minimum(size, top) * (den - num) // num
        required = filled - differ  # parts - differ - empty ones
        out.append((sdoc, np.full(len(sig), i), sig, np.maximum(required, 1)[sdoc]))
        weak = sets[required[sets] < 1]
        for d in weak:
            n = int(size[d])
            prefix = tokens[ends[d] : ends[d] + n - (-(-n * num // den)) + 1]
            out.append((np.full(len(prefix), d), np.full(len(prefix), i), mixed(prefix ^ mixed(np.uint64([i + 77]))), np.ones(len(prefix), dtype=np.int64)))
    if not out:
        return (np.empty(0, dtype=np.int64),) * 2 + (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def least_hashes(doc: np.ndarray, scheme: np.ndarray, sig: np.ndarray, required: np.ndarray) -> tuple[np.ndarray, ...]:
    """(set, scheme, signature, overlap) without the ``required - overlap`` greatest signatures of each set and scheme.

    A pair that links shares ``required`` signatures. Those that one side drops are its greatest, so the least ``overlap``
    common ones stay on both sides (a side with a smaller overlap drops none).
    """
    key = doc * 64 + scheme
    order = np.lexsort((sig, key))
    key, sig, required = key[order], sig[order], required[order]
    overlap = np.minimum(required, OVERLAP)
    if not len(key):
        return doc, scheme, sig, overlap
    new = np.concatenate([[True], key[1:] != key[:-1]])
    run = np.cumsum(new) - 1
    sizes = np.bincount(run)
    rank = np.arange(len(key)) - np.flatnonzero(new)[run]
    keep = rank < sizes[run] - required + overlap
    return key[keep] // 64, key[keep] % 64, sig[keep], overlap[keep]


def _packed(sig: np.ndarray, own: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Entries with 40 bits of the signature: a chance meeting only makes one more candidate."""
    entry = np.empty(len(sig), dtype=_ENTRY)
    entry["high"], entry["low"] = sig >> np.uint64(32), (sig >> np.uint64(24)) & np.uint64(255)
    entry["own"], entry["shared"] = own, shared
    return entry


_ROW = "id long, mark long, n long, key binary, asks array<struct<own: long, overlap: long>>, own long, found long"
_ASKS = pa.list_(pa.struct([("own", pa.int64()), ("overlap", pa.int64())]))


def _entries_by_block(sig: np.ndarray, own: np.ndarray, blocks: int) -> tuple[np.ndarray, list[bytes]]:
    """(blocks, payloads) of a batch's (signature, owner) pairs: one entry per signature, and reports of the hits besides.

    An entry says whether another owner in the batch has its signature. All but one of a signature's owners are reported as
    hits and do not travel as entries.
    """
    order = np.lexsort((own, sig))
    sig, own = sig[order], own[order]
    new = np.ones(len(sig), dtype=bool)  # one entry per signature and owner
    new[1:] = (sig[1:] != sig[:-1]) | (own[1:] != own[:-1])
    sig, own = sig[new], own[new]
    again = np.zeros(len(sig), dtype=bool)
    again[1:] = sig[1:] == sig[:-1]
    shared = again.copy()
    shared[:-1] |= again[1:]
    block = np.where(again, own, sig) % np.uint64(blocks)
    order = np.argsort(block, kind="stable")
    entry, block = _packed(sig, own, np.where(again, 2, shared))[order], block[order].astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.empty(0, dtype=np.int64)
    return block[cuts], [entry[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(block)])]


def _hits(payloads) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hits) of a block: how many of an owner's signatures another owner has too."""
    entry = np.concatenate([np.frombuffer(p.as_buffer(), dtype=_ENTRY) for p in payloads]) if len(payloads) else np.empty(0, dtype=_ENTRY)
    reports, entry = entry["own"][entry["shared"] == 2], entry[entry["shared"] < 2]
    sig = entry["high"].astype(np.uint64) << np.uint64(8) | entry["low"]
    order = np.argsort(sig, kind="stable")
    sig, entry = sig[order], entry[order]
    hits = reports
    if len(entry):
        own = entry["own"]
        new = np.concatenate([[True], sig[1:] != sig[:-1]])
        begin = np.flatnonzero(new)
        differs = np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin)
        hits = np.concatenate([reports, own[differs[np.cumsum(new) - 1] | (entry["shared"] == 1)]])
    return np.unique(hits, return_counts=True)


def _map_sets(docs: DataFrame, k: int, num: int, den: int, blocks: int) -> DataFrame:
    """Rows of two kinds: (block, id, mark, n, key, asks) of every document (_id, _text, _mark), and (block, payload) with the signature entries of a batch.

    ``asks`` has, for each scheme of the set, the hash that stands for it and the overlap that it needs. A payload is an
    array of (signature, that hash, shared) entries, one per signature of the batch; shared says that two classes of the
    batch have it. All but one of those report their hit without meeting others again.
    """
    arrow = pa.schema([("block", pa.int32()), ("id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("asks", _ASKS), ("payload", pa.binary())])

    def run(batches):
        for batch in bounded(batches, 1, 3 << 20):
            tokens, ends = shingle_sets(batch.column(1), k)
            n, ids = np.diff(ends), batch.column(0)
            keys = [xxhash.xxh3_128_digest(tokens[a:b].tobytes()) if b > a else None for a, b in zip(ends, ends[1:])]
            doc, scheme, sig, overlap = least_hashes(*signatures(tokens, ends, num, den))
            short = np.array([int.from_bytes(x[:8], "little") if x else 0 for x in keys], dtype=np.uint64)
            own = mixed(short[doc] + (scheme + 1).astype(np.uint64) * _GOLD)
            asks: list[list] = [[] for _ in keys]
            pair, first = np.unique(doc * 64 + scheme, return_index=True)
            for d, o, j in zip((pair // 64).tolist(), own[first].view(np.int64).tolist(), overlap[first].tolist()):
                asks[d].append({"own": o, "overlap": j})
            block, payloads = _entries_by_block(sig, own, blocks)
            rows = len(payloads)
            home = pa.array((ids.to_numpy().view(np.uint64) % np.uint64(blocks)).astype(np.int32))
            yield pa.record_batch([home, ids, batch.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(asks, _ASKS), pa.nulls(len(n), pa.binary())], schema=arrow)
            if rows:
                none = [pa.nulls(rows, f.type) for f in list(arrow)[1:6]]
                yield pa.record_batch([pa.array(block, pa.int32()), *none, pa.array(payloads, pa.binary())], schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker waits for the next task

    return docs.mapInArrow(run, "block int, id long, mark long, n long, key binary, asks array<struct<own: long, overlap: long>>, payload binary")


def _meet(rows: DataFrame) -> DataFrame:
    """The documents' rows as they are, and (own, found): how many of a set's entries another class has too.

    A block's task holds its entries once; documents only pass, so that the map runs once and nothing large is stored.
    """

    def run(block: pa.Table) -> pa.Table:
        is_entry = block.column("payload").is_valid()
        payloads = block.column("payload").filter(is_entry)
        own, found = _hits(payloads)
        documents = block.filter(pc.invert(is_entry)).select(["id", "mark", "n", "key", "asks"])
        documents = documents.append_column("own", pa.nulls(len(documents), pa.int64())).append_column("found", pa.nulls(len(documents), pa.int64()))
        none = [pa.nulls(len(own), f.type) for f in list(documents.schema)[:5]]
        return pa.concat_tables([documents, pa.table([*none, pa.array(own.view(np.int64)), pa.array(found)], names=documents.column_names)])

    return rows.groupBy("block").applyInArrow(run, _ROW)


def _with_tokens(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(sid, n, tokens) of the candidate classes' (sid, rep, key): a text of the id ``rep`` whose set has the digest ``key``."""
    found = docs.join(classes, F.col("_id") == F.col("rep")).select("sid", "key", "_text")

    def run(batches):
        for batch in bounded(batches, 2, 3 << 20):
            tokens, ends = shingle_sets(batch.column(2), k)
            sets = [tokens[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            right = pa.array([xxhash.xxh3_128_digest(s) == key for s, key in zip(sets, batch.column(1).to_pylist())], pa.bool_())
            out = pa.record_batch([batch.column(0), pa.array(np.diff(ends), pa.int64()), pa.array(sets, pa.binary())], names=["sid", "n", "tokens"])
            yield out.filter(right)

    return found.mapInArrow(run, "sid long, n long, tokens binary").dropDuplicates(["sid"])


def _all_signatures(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(sid, n, room, scheme, sig, required) of the sets."""
    arrow = pa.schema([("sid", pa.int64()), ("n", pa.int64()), ("room", pa.int64()), ("scheme", pa.int32()), ("sig", pa.int64()), ("required", pa.int64())])

    def run(batches):
        for batch in bounded(batches, 2, 4 << 20):
            sids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<u8")
            doc, scheme, sig, required = signatures(tokens, np.concatenate([[0], np.cumsum(n)]), num, den)
            room = batch.column(3).to_numpy()
            yield pa.record_batch([pa.array(sids[doc]), pa.array(n[doc]), pa.array(room[doc]), pa.array(scheme.astype(np.int32)), pa.array(sig.view(np.int64)), pa.array(required)], schema=arrow)

    return sets.select("sid", "n", "tokens", "room").mapInArrow(run, "sid long, n long, room long, scheme int, sig long, required long")


def _with_shared(sets: DataFrame, blocks: int) -> DataFrame:
    """Add ``c``: how many of a set's tokens another set has too. Tokens meet as signatures do, in blocks."""
    arrow = pa.schema([("block", pa.int32()), ("payload", pa.binary())])

    def run(batches):
        for batch in bounded(batches, 2, 8 << 20):
            n = batch.column(1).to_numpy()
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<u8")
            block, payloads = _entries_by_block(tokens, np.repeat(batch.column(0).to_numpy().view(np.uint64), n), blocks)
            yield pa.record_batch([pa.array(block, pa.int32()), pa.array(payloads, pa.binary())], schema=arrow)

    def meet(block: pa.Table) -> pa.Table:
        own, found = _hits(block.column("payload"))
        return pa.table({"sid": pa.array(own.view(np.int64)), "found": pa.array(found)})

    entries = sets.select("sid", "n", "tokens").mapInArrow(run, "block int, payload binary")
    counts = entries.groupBy("block").applyInArrow(meet, "sid long, found long").groupBy("sid").agg(F.sum("found").alias("c"))
    return sets.join(counts, "sid")


def _token_rows(sets: DataFrame) -> DataFrame:
    """(sid, g, token) of the sets (sid, g, tokens)."""

    def run(batches):
        for batch in bounded(batches, 2, 8 << 20):
            n = pc.binary_length(batch.column(2)).to_numpy() // 8
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<i8")
            sid, g = (pa.array(np.repeat(batch.column(i).to_numpy(), n)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([sid, g, pa.array(tokens)], names=["sid", "g", "token"])

    return sets.select("sid", "g", "tokens").mapInArrow(run, "sid long, g long, token long")


def _fit(n: Column, room: Column, m: Column, other: Column, num: int) -> Column:
    """Whether two sets of sizes n, m can link by what they share with any other set."""
    return (num * m <= room) & (num * n <= other)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that link, by their sets."""
    left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("_ta"))
    right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("_tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "_ta", "_tb")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), dtype="<u8"), np.frombuffer(y.as_buffer(), dtype="<u8")
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _links(sets: DataFrame, num: int, den: int, blocks: int) -> DataFrame:
    """Links (a, b) between the sets that give all components (steps 2 to 5)."""
    sets = _with_shared(sets, blocks).withColumn("room", (num + den) * F.col("c") - num * F.col("n"))
    sets = written(sets.where(den * F.col("c") >= num * F.col("n")))
    every = written(_all_signatures(sets, num, den))
    counted = cut_lineage(every.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    shared = every.join(counted, "sig")
    per_set = W.partitionBy("sid", "scheme")
    placed = shared.withColumn("_s", F.count(F.lit(1)).over(per_set)).withColumn("_r", F.row_number().over(per_set.orderBy("df", "sig")))
    kept = cut_lineage(placed.where("_s >= required AND _r <= _s - required + 1").select("sig", "sid", "n", "room"))
    ends = kept.groupBy("sig").agg(F.min("n").alias("_n"), F.max("room").alias("_room"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
    kept = cut_lineage(kept.join(cut_lineage(ends), "sig").where(_fit(F.col("n"), F.col("room"), F.col("_n"), F.col("_room"), num)).select("sig", "sid", "n", "room"))

    # groups: each set against the two ends of its signatures' sets
    ends = kept.groupBy("sig").agg(F.max(F.struct("room", "sid", "n")).alias("_hi"), F.min(F.struct("sid", "room", "n")).alias("_lo"))
    to = F.array(*[F.struct(*[F.col(f"{e}.{c}").alias(c) for c in ("sid", "room", "n")]) for e in ("_hi", "_lo")])
    star = kept.join(cut_lineage(ends), "sig").select("sid", "n", "room", F.explode(to).alias("to"))
    star = star.where((F.col("sid") != F.col("to.sid")) & _fit(F.col("n"), F.col("room"), F.col("to.n"), F.col("to.room"), num))
    tried = cut_lineage(star.select(F.least("sid", "to.sid").alias("a"), F.greatest("sid", "to.sid").alias("b")).distinct())
    links = cut_lineage(verified(tried, sets, num, den))

    # queries against other groups
    groups = components(links).select(F.col("node").alias("sid"), "root")
    grouped = kept.join(groups, "sid", "left").withColumn("g", F.coalesce("root", "sid")).drop("root")
    mixed_sigs = grouped.groupBy("sig").agg(F.min("g").alias("_lo"), F.max("g").alias("_hi")).where("_lo <> _hi").select("sig")
    matrix = cut_lineage(grouped.join(cut_lineage(mixed_sigs), "sig"))
    # the bound against all other groups
    tokens = written(_token_rows(sets.join(matrix.select("sid", "g").distinct(), "sid")))
    outside = tokens.groupBy("token").agg(F.min("g").alias("_lo"), F.max("g").alias("_hi")).where("_lo <> _hi").select("token")
    own = cut_lineage(tokens.join(cut_lineage(outside), "token", "left_anti").groupBy("sid").agg(F.count(F.lit(1)).alias("_own")))
    c = F.col("n") - F.coalesce("_own", F.lit(0))
    matrix = matrix.join(own, "sid", "left").withColumn("room", (num + den) * c - num * F.col("n")).drop("_own")
    ends = matrix.groupBy("sig").agg(F.min("n").alias("_n"), F.max("room").alias("_room"), F.min("g").alias("_lo"), F.max("g").alias("_hi"))
    ends = cut_lineage(ends.where("_lo <> _hi").select("sig", "_n", "_room"))
    matrix = cut_lineage(matrix.join(ends, "sig").where(_fit(F.col("n"), F.col("room"), F.col("_n"), F.col("_room"), num)).select("sig", "sid", "n", "room", "g"))
    held = matrix.groupBy("sig", F.col("g").alias("to")).agg(F.min("n").alias("_n"), F.max("room").alias("_room"))
    queries = matrix.join(cut_lineage(held), "sig").where((F.col("g") > F.col("to")) & _fit(F.col("n"), F.col("room"), F.col("_n"), F.col("_room"), num))
    queries = cut_lineage(queries.select("sid", "to").distinct())
    # the bound against each group of some size, then its members
    members = cut_lineage(matrix.select("sid", "n", "room", "g").distinct())
    sizes = members.groupBy(F.col("g").alias("to")).agg(F.count(F.lit(1)).alias("_size"))
    queries = cut_lineage(queries.join(sizes, "to").join(members.select("sid", "n", "room"), "sid"))
    large = queries.where(F.col("_size") > AT_ONCE).select("sid", "to")
    union = tokens.join(large.select(F.col("to").alias("g")).distinct(), "g", "left_semi").select(F.col("g").alias("to"), "token").distinct()
    common = large.join(tokens.select("sid", "token"), "sid").join(union, ["to", "token"]).groupBy("sid", "to").agg(F.count(F.lit(1)).alias("_o"))
    bounded_by = common.join(members.select("sid", "n"), "sid").withColumn("room", (num + den) * F.col("_o") - num * F.col("n"))
    asking = cut_lineage(bounded_by.select("sid", "to", "n", "room").unionByName(queries.where(F.col("_size") <= AT_ONCE).select("sid", "to", "n", "room")))
    inside = members.select(F.col("g").alias("to"), F.col("sid").alias("b"), F.col("n").alias("_n"), F.col("room").alias("_room"))
    asked = asking.join(inside, "to").where(_fit(F.col("n"), F.col("room"), F.col("_n"), F.col("_room"), num))
    asked = asked.select(F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    return links.unionByName(cut_lineage(verified(asked, sets, num, den)))


_UNNAMED = 1 << 62  # rows without an id get one from here on, by their text


def _named(id_col: str, text_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_UNNAMED) + F.xxhash64(F.col(text_col)).bitwiseAND(F.lit(_UNNAMED // 2 - 1)))


def _classes(members: DataFrame) -> DataFrame:
    """(key, rep, asks, sid) of the sets: the least id that has one, and a number. The number is that id, or, for all but one of the
    sets that share it, a hash of the set below all usual ids."""
    classes = written(members.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.min("asks").alias("asks")))
    first = classes.groupBy(F.col("rep").alias("_rep")).agg(F.min("key").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    other = F.lit(-(1 << 62)) - F.xxhash64("key").bitwiseAND(F.lit((1 << 62) - 1))
    numbered = classes.join(written(first), F.col("rep") == F.col("_rep"), "left")
    return numbered.select("key", "rep", "asks", F.when(F.col("key") != F.col("_first"), other).otherwise(F.col("rep")).alias("sid"))


def _joined(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, mark, n, key, root, top) of the rows (_id, _text, _mark): the least id of the component and a key that stands for it."""
    if not num < den <= 2 * num:
        raise ValueError("the threshold must be at least a half and below one")
    ship(docs.sparkSession)
    # about a quarter of the tokens are entries, a word has about six characters
    size = docs.agg(F.sum(F.length("_text"))).first()[0] or 0
    blocks = max(64, 4 * size // (24 * _ENTRIES))
    rows = written(_meet(_map_sets(docs, k, num, den, blocks)))
    members = rows.where("own IS NULL").select("id", "mark", "n", "key", "asks")
    hits = rows.where("own IS NOT NULL").groupBy("own").agg(F.sum("found").alias("_found"))
    classes = written(_classes(members))
    asked = classes.select("key", "rep", "sid", F.explode("asks").alias("_a")).select("key", "rep", "sid", "_a.*")
    wanted = asked.join(hits, "own").where("_found >= overlap").select("key", "rep", "sid").distinct()
    sets = written(_with_tokens(docs, wanted, k))
    linked = components(_links(sets, num, den, blocks)).join(classes.select(F.col("sid").alias("node"), "key", "rep"), "node")
    tops = cut_lineage(linked.groupBy("root").agg(F.min(F.struct("rep", "key")).alias("_top")))
    rooted = linked.join(tops, "root").select(F.col("key").alias("_key"), "_top")
    own = classes.join(rooted, F.col("key") == F.col("_key"), "left").withColumn("_top", F.coalesce("_top", F.struct("rep", "key")))
    own = cut_lineage(own.select(F.col("key").alias("_key"), F.col("_top.rep").alias("_root"), F.col("_top.key").alias("top")))
    out = members.join(own, F.col("key") == F.col("_key"), "left")
    return out.select("id", "mark", "n", "key", F.coalesce("_root", "id").alias("root"), "top")


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row. Sets link when den * intersection >= num * union."""
    out = _joined(docs.select(_named(id_col, text_col).alias("_id"), plain_text(text_col).alias("_text"), F.lit(0).cast("long").alias("_mark")), k, num, den)
    named = lambda c: F.when(F.col(c) < _UNNAMED, F.col(c))
    return out.select(named("id").alias(id_col), F.col("n").alias("n_shingles"), named("root").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, all columns: the one of the least id, of several texts of that id that with the least hash.

    Rows without an id take part and come after those with one. Of rows with equal id and text one stays. Texts without words link with
    nothing and stay, one row for each id and text.
    """
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull())
    found = _joined(docs.select(_named(id_col, text_col).alias("_id"), plain_text(text_col).alias("_text"), mark.alias("_mark")), k, num, den)
    rows = found.groupBy("id", "mark", "top").agg(F.count(F.lit(1)).alias("rows"))
    grouped = rows.where("top IS NOT NULL").groupBy("top").agg(F.min(F.struct("id", "mark", "rows")).alias("_one")).select("_one.*")
    kept = cut_lineage(grouped.unionByName(rows.where("top IS NULL").select("id", "mark", "rows")))
    names = [unused(docs, c) for c in ("id", "mark", "rows")]
    kept = kept.toDF(*names)
    same = docs.join(kept, (_named(id_col, text_col) == F.col(names[0])) & (mark == F.col(names[1])))
    once = same.where(F.col(names[2]) == 1).select(*docs.columns)
    again = same.where(F.col(names[2]) > 1).dropDuplicates(names[:2]).select(*docs.columns)
    return once.unionByName(again)

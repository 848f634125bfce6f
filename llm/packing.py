"""Best-fit packing after dominance reduction (operator 1).

Documents become token ids, cut into pieces of at most ``capacity``. Pieces of one length are alike, so the packing is
planned on the histogram of lengths, which has at most ``capacity`` rows however many pieces there are. The plan first
applies the Martello-Toth reduction: going through the lengths from the longest, a set of at most three pieces that
dominates every other set with that piece is fixed as a sequence, as often as its pieces last. What remains is packed
best-fit in descending order, whole classes of equal pieces into whole classes of equal gaps. Pieces then take their
places by their number within their length, which a balanced running count gives.

The plan's rows are bounded by the lengths and classes, not by the pieces. Null and empty texts are documents of the
closing id alone. Ties between equal lengths are settled by id and piece. Repeated rows are separate documents. An empty
table gives an empty result. Columns besides the id and the text are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import bounded, coded_words, plain_text
from tagloom.operators.ordering import running_totals
from tagloom.session import cut_lineage

CAPACITY = 2048
KNOWN_LIMIT = 1 << 17  # pieces and words a worker remembers the ids of, some 30 MB


class WordIds:
    """Token ids of texts by a tokenizer that never joins words across white space; the ids of pieces of words are kept.

    Words of printable ASCII go to the tokenizer's merge model directly, in lower case and in the pieces of ``PIECE``, where the
    file's own normalizer and pre-tokenizer do the same with every pair of characters; all others, those that may hold a
    special token, and all words of a file with other rules go through the whole tokenizer. A file that joins words is refused.
    """

    PIECE = r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9]+"
    PLAIN = r"^[!-~]+$"
    GAP = "\x01"  # between the pieces of a plain word, which holds no control character

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._start()
        self.direct = True
        self.direct = self._agrees()
        self._start()

    def _agrees(self) -> bool:
        """Whether pieces of a word by ``PIECE`` are what the file makes of it."""
        whole = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        probes = ["ab", "A1", "x'll", "né"]
        apart = whole(probes)
        for gap in " \t\n":
            if whole([gap + gap.join(probes) + gap * 2])[0] != [i for ids in apart for i in ids]:
                raise ValueError("the tokenizer joins words across white space, or its tokens hold white space")
        signs = [chr(c) for c in range(33, 127)]
        words = [a + b for a in signs for b in signs] + [f"{a}'{b}{c}" for a in "xB1'" for b in ("s", "T", "re", "VE", "m", "ll", "d") for c in ("", "a", "1", "'")]
        words.remove("<|")  # not plain
        flat, ends = self.encode(pa.array(words))
        return whole(words) == [x.tolist() for x in np.split(flat, ends[1:-1])]

    def _start(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = self.counts = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype="<u4")

    def _cut(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, int]:
        """The pieces of plain words and then all other words, each word's first place there and number of places, and how many are pieces."""
        plain = pc.and_not(pc.match_substring_regex(words, self.PLAIN), pc.match_substring(words, "<|")) if self.direct else pa.array(np.zeros(len(words), dtype=bool))
        marked = pc.replace_substring_regex(pc.ascii_lower(words.filter(plain)), f"({self.PIECE})", rf"\1{self.GAP}")
        cut = pc.split_pattern(pc.ascii_rtrim(marked, self.GAP), self.GAP)
        ends, chosen = cut.offsets.to_numpy(), plain.to_numpy(zero_copy_only=False)
        first, number = np.empty(len(words), dtype=np.int64), np.ones(len(words), dtype=np.int64)
        first[chosen], number[chosen] = ends[:-1], np.diff(ends)
        first[~chosen] = ends[-1] + np.arange(len(words) - len(cut))
        return pa.concat_arrays([cut.flatten(), words.filter(pc.invert(plain))]), first, number, int(ends[-1])

    def _learn(self, units: list[str], n_pieces: int) -> None:
        """Keep the ids of the units; the first ``n_pieces`` are pieces of plain words."""
        ids = [[t.id for t in self.model.tokenize(u)] for u in units[:n_pieces]]
        ids += [e.ids for e in self.tokenizer.encode_batch_fast(units[n_pieces:], add_special_tokens=False)]
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units))))
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), dtype="<u4", count=int(counts.sum()))])

    def _keep(self, units: list[str]) -> None:
        """Forget all but these units, at most half the limit."""
        units = units[: KNOWN_LIMIT // 2]
        at = np.fromiter(map(self.index.__getitem__, units), dtype=np.int64, count=len(units))
        counts = self.counts[at]
        self.flat = self.flat[_spread(self.starts[at], counts)]
        self.index = dict(zip(units, range(len(units))))
        self.starts, self.counts = np.cumsum(counts) - counts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, unsigned 32-bit, and the offsets where each text's begin."""
        words_at, words, offsets = coded_words(texts)
        cut, first, number, n_pieces = self._cut(words)
        coded = cut.dictionary_encode()  # in order of appearance: pieces first, and no other word equals one
        codes, units = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        if len(self.index) > KNOWN_LIMIT:
            self._keep([u for u in units if u in self.index])
        n_units = int(codes[:n_pieces].max()) + 1 if n_pieces else 0
        new = [[u for u in some if u not in self.index] for some in (units[:n_units], units[n_units:])]
        self._learn(new[0] + new[1], len(new[0]))
        known = np.fromiter(map(self.index.__getitem__, units), dtype=np.int64, count=len(units))
        # from texts to words, to units, to ids
        at = known[codes[_spread(first[words_at], number[words_at])]]
        word_ends = np.concatenate([[0], np.cumsum(number[words_at])])
        ends = np.concatenate([[0], np.cumsum(self.counts[at])])
        return self.flat[_spread(self.starts[at], self.counts[at])], ends[word_ends[offsets]]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of its own only cost memory
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the documents' token ids, closed by ``end_id`` and cut at ``capacity``."""
    kind = docs.schema[id_col].dataType
    fields = [("_id", to_arrow_type(kind)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches):
        encoder = load(tokenizer)
        for batch in bounded(batches, 1, 2 << 20):
            rows = []
            flat, ends = encoder.encode(batch.column(1))
            for k, key in enumerate(batch.column(0).to_pylist()):
                ids = np.append(flat[ends[k] : ends[k + 1]], np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((key, piece, start, len(part), zlib.crc32(part.tobytes()), *([part.astype(np.int32)] * with_ids)))
            columns = list(zip(*rows)) if rows else [[]] * len(arrow)
            yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
        pa.default_memory_pool().release_unused()  # the worker waits for the next task

    schema = f"_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("_id"), plain_text(text_col)).mapInArrow(run, schema)


@dataclass
class Sequences:
    """``times`` sequences that hold the same lengths."""

    lengths: tuple[int, ...]
    times: int


class _Lengths:
    """The lengths still to pack, each with its number of pieces."""

    def __init__(self, histogram: Mapping[int, int]):
        self.left = {n: c for n, c in histogram.items() if c > 0}
        self.keys = sorted(self.left)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for n, c in Counter(lengths).items():
            self.left[n] -= c * times
            if not self.left[n]:
                del self.left[n]
                self.keys.pop(bisect_left(self.keys, n))

    def without(self, used: tuple[int, ...]):
        """The number of pieces of a length besides the ``used`` ones."""
        return lambda n: self.left.get(n, 0) - used.count(n)

    def largest(self, limit: int, used: tuple[int, ...]) -> int | None:
        """The longest length up to ``limit``, ``used`` pieces aside."""
        free = self.without(used)
        for i in range(bisect_left(self.keys, limit + 1) - 1, -1, -1):
            if free(self.keys[i]) > 0:
                return self.keys[i]
        return None

    def smallest(self, count: int, used: tuple[int, ...]) -> list[int]:
        """The ``count`` shortest pieces, ``used`` ones aside (fewer if there are no more)."""
        free, out = self.without(used), []
        for n in self.keys:
            out += [n] * min(count - len(out), max(free(n), 0))
            if len(out) >= count:
                break
        return out


def dominating(lengths: _Lengths, longest: int, capacity: int) -> tuple[int, ...] | None:
    """A set with one ``longest`` piece that dominates all other such sets, by the Martello-Toth tests; else null."""
    room = capacity - longest
    small = lengths.smallest(3, (longest,))
    fit, total = 0, 0
    for n in small:
        total += n
        if total > room:
            break
        fit += 1
    if fit == 0:
        return (longest,)
    partner = lengths.largest(room, (longest,))
    if fit == 1 or partner == room:
        return (longest, partner)
    if fit == 2:
        # the best pair of further pieces: two pointers over the lengths
        best = (0, 0, 0)
        keys = lengths.keys
        low, high = 0, bisect_left(keys, room + 1) - 1
        free = lengths.without((longest,))
        while low <= high:
            a, b = keys[low], keys[high]
            if a + b > room:
                high -= 1
            elif free(a) <= 0 or (a == b and free(a) < 2):
                low += 1
            elif free(b) <= 0:
                high -= 1
            else:
                best = max(best, (a + b, b, a))
                low += 1
        if partner >= best[0]:
            return (longest, partner)
        if partner == best[1] and best[0] == room:  # the partner and what fills the rest exactly
            return (longest, best[1], best[2])
    return None


def reduce(histogram: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[Sequences], dict[int, int]]:
    """The sequences fixed by dominance, and the histogram of what is left."""
    lengths, fixed = _Lengths(histogram), []
    above = capacity + 1
    while (at := bisect_left(lengths.keys, above) - 1) >= 0:
        longest = lengths.keys[at]
        found = dominating(lengths, longest, capacity)
        if found is None:  # nothing dominates for this length now; it stays for the rest and as a partner
            above = longest
            continue
        # what dominates for one piece of a length does so again while the pieces of the set last
        times = min(lengths.left[n] // c for n, c in Counter(found).items())
        fixed.append(Sequences(found, times))
        lengths.take(found, times)
    return fixed, dict(lengths.left)


def best_fit(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Sequences]:
    """Best-fit in descending order on classes: equal pieces go into equal gaps, the smallest that hold them, together."""
    gaps: dict[int, list[Sequences]] = {}
    order: list[int] = []  # gaps in use, ascending
    full: list[Sequences] = []

    def put(sequences: Sequences, gap: int) -> None:
        if gap == 0:
            full.append(sequences)
            return
        if gap not in gaps:
            insort(order, gap)
            gaps[gap] = []
        gaps[gap].append(sequences)

    for n in sorted(histogram, reverse=True):
        left = histogram[n]
        while left:
            at = bisect_left(order, n)
            if at == len(order):  # no gap holds it: new sequences, each filled with as many as it takes
                each = capacity // n
                if left >= each:
                    times = left // each
                    put(Sequences((n,) * each, times), capacity - n * each)
                    left -= times * each
                else:
                    put(Sequences((n,) * left, 1), capacity - n * left)
                    left = 0
                continue
            gap = order[at]
            target = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            each = min(gap // n, max(1, left))
            times = min(target.times, max(1, left // each))
            if times < target.times:
                put(Sequences(target.lengths, target.times - times), gap)
            put(Sequences(target.lengths + (n,) * each, times), gap - n * each)
            left -= times * each
    return full + [s for sequences in gaps.values() for s in sequences]


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Sequences]:
    """The sequences for a histogram of lengths."""
    fixed, kept = reduce(histogram, capacity)
    return fixed + best_fit(kept, capacity)


def places(sequences: list[Sequences]) -> np.ndarray:
    """Rows (length, first number, pieces per sequence, first sequence, offset), ascending: where a length's pieces go by number."""
    next_number: Counter[int] = Counter()
    rows, first = [], 0
    for s in sequences:
        offset = 0
        for n, each in Counter(s.lengths).items():
            rows.append((n, next_number[n], each, first, offset))
            next_number[n] += each * s.times
            offset += n * each
        first += s.times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``_id``, ``piece``, ``length``, more). Runs jobs."""
    cut = cut_lineage(cut)
    # at most ``capacity`` rows come to the driver
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(plan(histogram, capacity))
    ties = [F.col(c) for c in cut.columns if c in ("_id", "piece", "start", "ids_crc32")]
    numbered = running_totals(cut, ["length"], ties, {"_number": F.lit(1)})
    names = numbered.columns
    arrow = None

    def run(batches):
        keys = table[:, 0] << 40 | table[:, 1]
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            number = batch.column(names.index("_number")).to_numpy(zero_copy_only=False) - 1
            found = table[np.searchsorted(keys, length << 40 | number, side="right") - 1] if len(length) else table[:0]
            past = number - found[:, 1]
            sequence, offset = found[:, 3] + past // np.maximum(found[:, 2], 1), found[:, 4] + past % np.maximum(found[:, 2], 1) * length
            kept = [batch.column(i) for i, c in enumerate(names) if c != "_number"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*[c for c in names if c != "_number"], "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "_number")
    return numbered.mapInArrow(run, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece; ``pieces`` gives the ids themselves."""
    packed = pack(pieces(docs, tokenizer, capacity, id_col=id_col, text_col=text_col), capacity)
    return packed.withColumnRenamed("_id", id_col)

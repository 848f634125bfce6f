import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from corpora import ODD, documents, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab THE ing's\n\t  é́漢🙂ΣςİK<|endoftext|>\x00　12.,'ll#", max_size=50), max_size=5))
def test_ids_as_the_library(texts):
    flat, ends = packing.load(PATH).encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


class Counted:
    """A model that notes what it is asked for."""

    def __init__(self, model):
        self.model, self.asked = model, Counter()

    def tokenize(self, word):
        self.asked[word] += 1
        return self.model.tokenize(word)


def test_pieces_are_looked_up_once_and_kept_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_LIMIT", 20)
    ids = packing.WordIds(PATH)
    ids.model = counted = Counted(ids.model)
    for turn in range(20):
        texts = ["Word, word. (word) word's"] + ["".join("abcdefghijk"[int(d)] for d in str(turn * 10 + i)) for i in range(100, 110)]
        flat, ends = ids.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(ids.index) <= 20 + 20
    assert counted.asked["word"] == 1
    assert len(ids.flat) == ids.counts.sum()


def used(sequences):
    count = Counter()
    for s in sequences:
        for n in s.lengths:
            count[n] += s.times
    return count


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 20), max_size=12), st.integers(30, 40))
def test_plan_is_whole_and_reduction_never_costs(histogram, capacity):
    plan = packing.plan(histogram, capacity)
    assert used(plan) == Counter(histogram) and all(sum(s.lengths) <= capacity and s.times > 0 for s in plan)
    # no worse than best-fit alone by more than a sequence, and no better than the volume allows
    total, bins = sum(n * c for n, c in histogram.items()), sum(s.times for s in plan)
    assert -(-total // capacity) <= bins <= sum(s.times for s in packing.best_fit(histogram, capacity)) + 1


def least_bins(items, capacity):
    """The optimum by trying all ways, for a few items."""
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, sorted(bins[:i] + [bins[i] + items[k]] + bins[i + 1 :]))
        place(k + 1, sorted([*bins, items[k]]))

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_fixed_sets_keep_the_optimum(items):
    items = sorted(items, reverse=True)
    fixed, rest = packing.reduce(Counter(items), 20)
    left = sorted((n for n, c in rest.items() for _ in range(c)), reverse=True)
    assert sum(s.times for s in fixed) + (least_bins(left, 20) if left else 0) == least_bins(items, 20)


def test_pieces_and_places(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randint(0, 900)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(3, rows[3][1]), (None, "no id"), (None, "no id")]
    got = packing.pack_documents(documents(spark, rows), PATH).collect()
    want = Counter()
    for key, text in rows:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[key, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r.length for r in got)
    assert len(bins) <= -(-total // 2048) * 1.05 + 1
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []

import hashlib
import random
from collections import Counter

import pytest
from corpora import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import suffix_dedup
from llm.suffix_groups import suffix_array


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_array_of_long_runs():
    for symbols in ([1] * 20_000, [i % 7 for i in range(20_000)], list(range(20_000)), list(range(20_000))[::-1]):
        array = suffix_array(symbols)
        assert sorted(array) == list(range(20_000))
        assert all(symbols[a : a + 40] <= symbols[b : b + 40] for a, b in zip(array, array[1:]))


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (key, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, x in zip(b, gone) if not x)).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rng, rows = random.Random(seed), []
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(60, 400))) for _ in range(12)]
    for _ in range(100):
        parts = [rng.choice(passages)[rng.randint(0, 40) :][: rng.randint(50, 400)] if rng.random() < 0.6 else "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90))) for _ in range(rng.randint(0, 6))]
        text = "".join(parts)
        rows.append((len(rows), text))
        if rng.random() < 0.1:
            rows.append((len(rows), text[: len(text) // 2] + "!" + text[len(text) // 2 :]))
    odd = [None, "", "a" * 3000, "xy" * 1500 + "q" + "a" * 199, "z" * 199, "z" * 200, "a" * 200]
    return rows + [(len(rows) + i, t) for i, t in enumerate(odd)] + [(3, rows[3][1]), (None, "n" * 500), (None, "n" * 500)]


@pytest.mark.parametrize("length,hot", [(200, 10**6), (200, 2), (64, 3), (100, 10**6)])
def test_removed_bytes_as_brute_force(spark, length, hot):
    rows = corpus(length)
    got = suffix_dedup.remove_repeats(documents(spark, rows, parts=4), length, hot).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows, length)
    for r in got:
        assert len(r.spans) == r.n_spans and sum(s.end - s.start for s in r.spans) == r.n_removed


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).collect() == []


def test_anchors_cover_every_window_once():
    rng = random.Random(4)
    data = bytes(rng.randrange(97, 100) for _ in range(5000)) + b"q" * 3000
    _, place, first, last = suffix_dedup.anchors(data, 200)
    assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
    assert ((place >= last) & (place + suffix_dedup.GRAM <= first + 200)).all()

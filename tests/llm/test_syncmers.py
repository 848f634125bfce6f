import hashlib
import random

import numpy as np
import pytest
from corpora import ODD, documents, words

from llm import syncmers


def brute_anchors(text):
    """The definition, one run at a time."""
    inner = syncmers._mixed(np.array([sum((ord(c) + 1) * pow(0x9E3779B97F4A7C15, syncmers.S - 1 - j, 1 << 64) for j, c in enumerate(text[i : i + syncmers.S])) % (1 << 64) for i in range(len(text) - syncmers.S + 1)], dtype=np.uint64)).tolist()
    width = syncmers.K - syncmers.S + 1
    return [i for i in range(len(text) - syncmers.K + 1) if i == 0 or min(inner[i : i + width]) in (inner[i], inner[i + width - 1])]


def test_anchors_by_definition_and_context_free():
    rng = random.Random(1)
    for _ in range(30):
        text = "".join(rng.choice("abcé🙂 ") for _ in range(rng.randint(16, 300)))
        hashes, places = syncmers.anchors(syncmers.code_points(text))
        assert places.tolist() == brute_anchors(text)
        shifted = syncmers.anchors(syncmers.code_points("prefix of words " + text))
        moved = {(h, p - 16) for h, p in zip(*map(list, shifted))}
        assert {(h, p) for h, p in zip(hashes, places) if p > 0} <= moved


def expected(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    out = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        own, new, following = map(syncmers.fingerprint, (text, edited, after))
        out.append((key, n, hashlib.sha256(edited.encode()).hexdigest(), own, new, syncmers.likeness(own, new), syncmers.likeness(own, following)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_as_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(-20, 60)]), rng.choice([*ODD, *[" ".join(words(rng, rng.randint(1, 80))) for _ in range(9)]])) for _ in range(60)]
    got = syncmers.with_next(documents(spark, rows, parts=5)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_one_document_and_none(spark):
    assert [tuple(r) for r in syncmers.with_next(documents(spark, [(4, "alone " * 9)])).collect()] == expected([(4, "alone " * 9)])
    assert syncmers.with_next(documents(spark, [])).collect() == []


def test_likeness_tells_edits_from_strangers():
    rng = random.Random(7)
    texts = [" ".join(words(rng, 200, 5000)) for _ in range(20)]
    for a, b in zip(texts, texts[1:]):
        edited = a[: len(a) - len(a) // 3] + b[: len(a) // 3]
        assert syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(edited)) > 0.3
        assert syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(b)) < 0.1
        assert syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(a)) == 1.0


def brute_likeness(a, b):
    """By definition, from all anchors of both texts."""
    sides = []
    for text in (a, b):
        first = {}
        for h, p in zip(*map(np.ndarray.tolist, syncmers.anchors(syncmers.code_points(text)))):
            first.setdefault(h, p)
        sides.append(first)
    union = sorted(sides[0].keys() | sides[1].keys())
    sample = union[: max(syncmers.SIZE, sum(h < syncmers.SHARE for h in union))]
    both = sorted((h for h in sample if h in sides[0] and h in sides[1]), key=lambda h: sides[0][h])
    longest = []
    for k, h in enumerate(both):
        longest.append(1 + max((longest[i] for i in range(k) if sides[1][both[i]] < sides[1][h]), default=0))
    return max(longest, default=0) / len(sample)


def test_fingerprints_grow_with_the_text_and_keep_whole_places():
    rng = random.Random(11)
    for n in (30, 300, 3000):
        text = words(rng, n, 5000)
        other = [*words(rng, n // 5, 5000), *text[n // 2 :], *text[: n // 3]]
        a, b = " ".join(text), " ".join(other)
        assert syncmers.likeness(syncmers.fingerprint(a), syncmers.fingerprint(b)) == pytest.approx(brute_likeness(a, b))
    long = words(rng, 20_000, 9000)
    changed = long[:10_000] + words(rng, 40, 10**6) + long[10_040:]
    a, b = (syncmers.fingerprint(" ".join(w)) for w in (long, changed))
    assert 0.97 < syncmers.likeness(a, b) < 1.0
    passage = long[5000:9000]
    alone = syncmers.fingerprint(" ".join(passage))
    assert 0.1 < syncmers.likeness(a, alone) < 0.3  # a fifth of the text
    far = "ab" * (1 << 24) + " ".join(passage[:200])
    assert max(syncmers._parsed(syncmers.fingerprint(far))[:, 1]) > 1 << 24

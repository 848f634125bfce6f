import hashlib
import random
import re

import numpy as np
import pytest
from corpora import ODD, documents

from llm import winnowing

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, length=10):
    out = []
    for doc_id, text in docs:
        own, hit, held = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            m = min(length, len(w))
            windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
            for p in range(len(own) - m + 1) if m else ():
                if tuple(own[p : p + m]) in windows:
                    hit |= set(range(p, p + m))
                    held |= {item_id} - {None}
        named = ",".join(sorted(map(str, held)))
        out.append((doc_id, len(own), len(hit), len(held), hashlib.sha256(named.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus(seed):
    """Few kinds of words, so that parts of windows repeat everywhere."""
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["Ab", "b", "É", "c1", "9"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 8, 9, 10, 11, 30]) if i > 6 else rng.choice([9, 10, 12, 40]))) for i in range(7 if seed % 2 else 25)]
    docs = [(i, text(rng.randint(0, 120))) for i in range(40)]
    for i in range(40, 80):
        w = words(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(w) - 1))
        docs.append((i, f"{text(rng.randint(0, 30))}, {'; '.join(w[a : a + rng.randint(1, 30)]).upper()} {text(5)}"))
    return docs, items


def items_frame(spark, items, kind="long"):
    return spark.createDataFrame([(*r, "x", 1) for r in items], f"item_id {kind}, text string, key string, m int")


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, rows, seed):
    docs, items = corpus(seed)
    assert rows(winnowing.find_benchmark(documents(spark, docs), items_frame(spark, items))) == brute(docs, items)


def test_odd_rows(spark, rows):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = list(enumerate(ODD)) + [(3, passage), (3, passage), (3, "tie " + passage), (None, passage.upper()), (None, "other")]
    docs.append((50, "filler " * 60_000 + passage + " filler" * 60_000))
    items = [(1, passage), (1, passage), (20, passage), (None, passage), (4, None), (5, " .!"), (6, "tie")]
    assert rows(winnowing.find_benchmark(documents(spark, docs), items_frame(spark, items))) == brute(docs, items)
    assert not any(r["contaminated"] for r in winnowing.find_benchmark(documents(spark, docs), items_frame(spark, [])).collect())
    none = winnowing.find_benchmark(documents(spark, []), items_frame(spark, items))
    assert none.collect() == [] and none.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_a_crowded_bit_table_changes_nothing(spark, rows):
    docs, items = corpus(2)
    few = winnowing.find_benchmark(documents(spark, docs), items_frame(spark, items), filter_bits=64)
    assert rows(few) == brute(docs, items)


@pytest.mark.parametrize("m", range(1, 11))
def test_every_window_keeps_one_of_its_grams(m):
    rng = np.random.default_rng(m)
    words = rng.integers(2, 5, 400).astype(np.uint64)
    ends = np.array([0, 3, 3, 150, 151, 400])
    hashed = winnowing.grams(words, m)
    place = set(winnowing.winnowed(hashed, ends, m).tolist())
    k, w = winnowing.scheme(m)
    assert k + w - 1 == m and len(place) < 400 or m < 3
    for a, b in zip(ends, ends[1:]):
        for s in range(a, b - m + 1):
            least = min(hashed[s : s + w])
            assert max(j for j in range(s, s + w) if hashed[j] == least) in place

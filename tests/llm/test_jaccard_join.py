import random
from collections import Counter, defaultdict

import pytest
from corpora import documents, near_copies, words

from llm import jaccard_join
from llm.components import components


def closed(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, k, num, den):
    sets, holders = {}, defaultdict(list)
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
        for s in sets[i]:
            holders[s].append(i)
    common = Counter((min(a, b), max(a, b)) for found in holders.values() for x, a in enumerate(found) for b in found[:x])
    links = [p for p, n in common.items() if den * n >= num * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    root = closed(sets, links)
    return {i: (len(s), root[i]) for i, s in sets.items()}


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (2, 60, 100), (1, 1, 2), (4, 99, 100)])
def test_components_as_brute_force(spark, k, num, den):
    rows = near_copies(seed=k)
    got = jaccard_join.join(documents(spark, rows, parts=4), k, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, k, num, den)


@pytest.mark.parametrize("at_once", [16, 0])
def test_copies_that_link_to_their_source_only(spark, monkeypatch, at_once):
    """A family whose copies mostly do not link with each other, and pairs of copies of copies."""
    monkeypatch.setattr(jaccard_join, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    base = words(rng, 150, 5000)
    rows = [(0, " ".join(base))]
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 7)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(copy)))
        if rng.random() < 0.3:
            copy[rng.randrange(len(copy))] = "again"
            rows.append((len(rows), " ".join(copy[: rng.randint(130, 150)])))
    got = jaccard_join.join(documents(spark, rows, parts=4), 4, 85, 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 4, 85, 100)


def test_nulls_repeats_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (None, text), (None, text), (5, text), (7, text.upper()), (8, None), (None, "other words"), (9, "")]
    got = sorted(map(tuple, jaccard_join.join(documents(spark, rows)).collect()), key=repr)
    assert got == sorted([(5, 6, 5), (5, 6, 5), (None, 6, 5), (None, 6, 5), (7, 6, 5), (8, 0, 8), (None, 1, None), (9, 0, 9)], key=repr)
    kept = jaccard_join.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [5, 8, 9]
    assert jaccard_join.join(documents(spark, [])).collect() == [] == jaccard_join.keep_one(documents(spark, [])).collect()


def test_equal_ids_with_unlike_texts(spark):
    """Texts that share an id keep their own links; none is lost, whichever stands for the id."""
    rng = random.Random(21)
    a, b = words(rng, 80, 5000), words(rng, 80, 5000)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "more"])), (3, " ".join([*b, "more"])), (4, " ".join(words(rng, 50, 5000)))]
    rows += [(None, " ".join(["odd", *b])), (1, " ".join(a)), (6, " ".join(words(rng, 60, 5000))), (6, " ".join(words(rng, 60, 5000))), (7, ""), (7, " ")]
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(documents(spark, rows), 4, 85, 100).collect()}
    assert got == {(1, 77, 1), (2, 78, 1), (3, 78, 1), (4, 47, 4), (None, 78, 1), (6, 57, 6), (7, 0, 7)}
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(documents(spark, rows, inside=True), 4, 85, 100).collect())
    assert kept == sorted([rows[0], rows[1], rows[4], rows[7], rows[8], rows[9], rows[10]])


def test_near_copies_without_ids_and_a_very_long_text(spark):
    rng = random.Random(22)
    long = words(rng, 120_000, 50_000)
    other = list(long)
    for i in range(0, 120_000, 500):
        other[i] = "changed"
    base = words(rng, 100, 5000)
    rows = [(None, " ".join(base)), (None, " ".join([*base, "end"])), (None, " ".join(base)), (1, " ".join(long)), (2, " ".join(other))]
    kept = jaccard_join.keep_one(documents(spark, rows, inside=True), 4, 85, 100).collect()
    assert len(kept) == 2 and sorted(r.doc_id or 0 for r in kept) == [0, 1]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200)] + [(300, 301), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: r for n, r in closed({x for p in links for x in p}, links).items() if n != 200}

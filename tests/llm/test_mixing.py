import random
from collections import defaultdict

import numpy as np
from corpora import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import mixing


def shares(sizes, weights, budget, cap=2.0):
    """Weighted shares under a cap, by the words of the contract."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, budget * sum(sizes.values()), set(order)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > cap * sizes[s]}
        if not over:
            target.update({s: unit * weight[s] for s in open_})
            break
        target.update({s: cap * sizes[s] for s in over})
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def corpus(seed=3):
    rng = random.Random(seed)
    return [(i, " ".join(words(rng, rng.randint(0, 120))), rng.choice(["a", "a", "a", "b", "c", "é", "Z", None])) for i in range(600)]


def test_targets_and_totals(spark):
    rows = corpus()
    got = mixing.mix(documents(spark, rows), (5, 2, 1)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want, source_of = shares(sizes, (5, 2, 1), 1.5), {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[source_of[r.doc_id]]
        assert abs(r.target - want[source_of[r.doc_id]]) < 1e-6 and r.taken in (0, r.size, 2 * r.size)
        taken[source_of[r.doc_id]] += r.taken
    assert len(got) == len(rows)
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.01 * target, 30)


def test_reruns_agree_whatever_the_partitions(spark):
    rows = corpus()
    runs = [sorted(map(tuple, mixing.mix(documents(spark, rows, parts=p), (5, 2, 1)).collect())) for p in (1, 7)]
    assert runs[0] == runs[1]


def test_small_blocks_balance_over_levels(spark):
    rng = random.Random(8)
    rows = [(i, "s", rng.randint(1, 500), 0.3, 900) for i in range(900)]
    units = spark.createDataFrame(rows, "id long, source string, size long, chance double, _n long")
    got = mixing.sample(units, seed=1, block=40).collect()
    assert len(got) == 900 and {r.chance for r in got} <= {0.0, 1.0}
    assert abs(sum(r.chance for r in got) - 270) <= 4
    assert abs(sum(r.chance * r.size for r in got) - 0.3 * sum(r[2] for r in rows)) <= 600


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.floats(0, 1)), max_size=30), st.integers(0, 9))
def test_flight_keeps_both_totals(units, seed):
    size, chance = [u[0] for u in units], [u[1] for u in units]
    moved = mixing.flight(size, chance, random.Random(seed))
    assert sum(1e-6 < p < 1 - 1e-6 for p in moved) <= 2
    assert abs(sum(moved) - sum(chance)) < 1e-5 and abs(np.dot(moved, size) - np.dot(chance, size)) < 1e-2


def test_inclusion_probabilities():
    rng, hits = random.Random(4), np.zeros(12)
    size, chance = [rng.randint(1, 99) for _ in range(12)], [rng.random() for _ in range(12)]
    for _ in range(4000):
        hits += mixing.landing(size, mixing.flight(size, chance, rng), rng)
    assert np.abs(hits / 4000 - chance).max() < 0.04


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (3, "one two", None), (None, "x y z", "b"), (None, None, None)]
    docs = documents(spark, rows)
    got = mixing.mix(docs, (5, 2, 1)).collect()
    assert len(got) == 6 and sum(r.size for r in got) == 7 and all(r.taken <= 2 * r.size for r in got)
    mixed = mixing.mixed_rows(docs, (5, 2, 1))
    assert mixed.columns == docs.columns
    assert mixing.mix(documents(spark, []), (1,)).collect() == [] == mixing.mixed_rows(documents(spark, []), (1,)).collect()
    assert all(r.taken == 0 for r in mixing.mix(documents(spark, [(1, None, "a")]), (1,)).collect())


def test_a_small_source_is_settled_alike_beside_a_hot_one(spark):
    """Whether another source needs more levels does not change a small one; its best draw stays near in words."""
    schema = "id long, source string, size long, chance double, _n long"
    small = [(i, "s", 40_000 if i == 7 else 10 + i, 0.4, 30) for i in range(30)]
    hot = [(1000 + i, "h", 50, 0.3, 500) for i in range(500)]
    alone = {r.id: r.chance for r in mixing.sample(spark.createDataFrame(small, schema), block=64).collect()}
    beside = {r.id: r.chance for r in mixing.sample(spark.createDataFrame(small + hot, schema), block=64).collect()}
    assert {r[0]: beside[r[0]] for r in small} == alone
    assert set(beside.values()) <= {0.0, 1.0} and len(beside) == 530
    assert abs(sum(beside[r[0]] for r in hot) - 150) <= 2

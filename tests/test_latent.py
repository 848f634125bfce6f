import random

import numpy as np
import pytest

from tagloom.operators import latent


def topics(seed=3, n=240):
    rng = random.Random(seed)
    kinds = [[f"k{k}w{i}" for i in range(25)] for k in range(6)]
    return [" ".join(rng.choice(kinds[k % 6]) if rng.random() < 0.8 else f"any{rng.randrange(300)}" for _ in range(rng.randint(5, 60))) for k in range(n)]


def weights(model, frame, width):
    """The matrix that is decomposed, row by row."""
    out = []
    for r in frame.select("id", latent._spots("t", width).alias("s")).orderBy("id").collect():
        row = np.bincount(np.array(r.s, dtype=int), minlength=width) * model.idf if r.s else np.zeros(width)
        out.append(row / (np.linalg.norm(row) or 1.0))
    return np.array(out)


def test_directions_as_numpy_finds_them(spark):
    width, dim = 1024, 6
    frame = spark.createDataFrame(list(enumerate(topics())), "id int, t string").repartition(5)
    model = latent.fit_latent_vectors(frame, "t", dim=dim, width=width, passes=4)
    a = weights(model, frame, width)
    _, values, exact = np.linalg.svd(a, full_matrices=False)
    assert model.singular == pytest.approx(values[:dim], rel=0.01)
    left = np.linalg.norm(a - a @ model.basis @ model.basis.T)
    assert left <= 1.001 * np.linalg.norm(a - a @ exact[:dim].T @ exact[:dim])
    assert model.basis.T @ model.basis == pytest.approx(np.eye(dim), abs=1e-9)
    found = np.array([r.vec for r in model.encode(frame, "t").orderBy("id").collect()])
    want = a @ exact[:dim].T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert found @ found.T == pytest.approx(want @ want.T, abs=0.15)
    near, true = found @ found.T - 2 * np.eye(len(a)), want @ want.T - 2 * np.eye(len(a))
    top = near.argmax(axis=1)
    assert np.mean(true[np.arange(len(a)), top] >= true.max(axis=1) - 0.01) > 0.95
    assert np.mean(top % 6 == np.arange(len(a)) % 6) > 0.95  # texts of one topic


def test_blocks_of_a_row_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(latent, "WORDS", 10)
    import pyarrow as pa

    lists = pa.array([[1, 1, 2], [], [3] * 40, [0, 1, 2, 3], [2]], pa.list_(pa.int32()))
    idf = np.array([0.0, 1.0, 2.0, 3.0])
    whole = np.concatenate([latent._summed(r, w[:, None] * np.eye(4)[c], n) for n, r, c, w in latent._blocks(lists, idf)])
    want = np.array([[0, 2, 2, 0], [0] * 4, [0, 0, 0, 120], [0, 1, 2, 3], [0, 0, 2, 0]], float)
    length = np.linalg.norm(want, axis=1, keepdims=True)
    assert whole == pytest.approx(np.divide(want, length, out=np.zeros_like(want), where=length > 0))


def test_empty_texts_and_tables(spark):
    frame = spark.createDataFrame([(1, None, 0), (2, " \n", 0), (3, "a b c", 0), (4, "d e", 0), (4, "d e", 0)], "id int, t string, vec int")
    model = latent.fit_latent_vectors(frame, "t", dim=3, width=64)
    out = model.encode(frame, "t").collect()
    assert tuple(out[0].asDict()) == ("id", "t", "vec") and {r.id: round(sum(x * x for x in r.vec), 6) for r in out} == {1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0}
    assert model.encode(frame.limit(0), "t").collect() == []
    none = latent.fit_latent_vectors(frame.limit(0), "t", dim=3, width=64)
    assert none.singular.tolist() == [0, 0, 0]
    with pytest.raises(ValueError):
        latent.fit_latent_vectors(frame, "t", dim=60, width=64)

import hashlib
import math

import numpy as np
import pytest

from llm import simplex_kmeans
from llm.simplex_kmeans import Simplex, nearest, open_pairs, squared

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, _id long, ints int, apex string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "c", 2, 3, "a") for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [float(np.float32(x)) for x in v]) for i, v in kept]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in sorted(kept, key=key)]
    centroids = [v for _, v in ints[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((far(v, c), j) for j, c in enumerate(centroids)) for _, v in ints]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(ints, own) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(d for d, _ in own)
    return sorted(((i, j, d, sum(e for e, c in own if c == j), total, names[j]) for (i, _), (d, j) in zip(ints, own)), key=repr)


def cloud(seed, n, groups=6, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 64)) / 8
    return [(i, (centres[rng.integers(groups)] + rng.normal(size=64) * spread).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,spread", [(1, 0.05), (2, 0.0005), (3, 1.0)])
def test_against_brute_force(spark, rows, seed, spread):
    data = cloud(seed, 120, spread=spread)
    assert rows(simplex_kmeans.cluster(frame(spark, data))) == brute(data)


def test_odd_rows(spark, rows):
    data = cloud(4, 30)
    data += [(7, data[0][1]), (None, data[1][1]), (None, [0.0] * 64), (90, None), (91, []), (92, [0.5] * 63), (93, [0.5] * 63 + [None])]
    data += [(94, [math.nan] + [0.1] * 63), (95, [math.inf] + [0.1] * 63), (96, [1e4] * 64), (97, [-0.0] * 64)]
    data += [(100 + i, data[3][1]) for i in range(40)]  # copies, among the first centroids too
    assert rows(simplex_kmeans.cluster(frame(spark, data))) == brute(data)
    few = data[:3]
    assert rows(simplex_kmeans.cluster(frame(spark, few))) == brute(few)
    same = [(i, [0.25] * 64) for i in range(20)]  # no simplex beyond one pivot
    assert rows(simplex_kmeans.cluster(frame(spark, same))) == brute(same)
    assert simplex_kmeans.cluster(frame(spark, [])).collect() == []
    with pytest.raises(Exception, match="exceeds"):
        simplex_kmeans.cluster(frame(spark, [(1, [1e30] * 64)])).collect()


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(8)
    groups = rng.integers(-1000, 1000, (8, 64))
    x = np.vstack([groups, groups[rng.integers(8, size=2000)] + rng.integers(-20, 21, (2000, 64))])
    x = np.vstack([x, x[:5], rng.integers(-(2**27), 2**27, (50, 64))])
    simplex = Simplex(x[8:14])
    centroids = np.vstack([groups[:7], x[-1:]])
    apexes, centres = simplex.place(x), simplex.place(centroids)
    exact = np.stack([squared(x, c) for c in centroids], axis=1)
    held = open_pairs(apexes, centres)
    assert held[np.arange(len(x)), exact.argmin(axis=1)].all()
    own, best, taken = nearest(x, apexes, centroids, centres)
    assert (own == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert taken < 0.5 * exact.size
    low = ((apexes[:, None] - centres[None]) ** 2).sum(axis=2)
    mirrored = low + 4 * apexes[:, None, -1] * centres[None, :, -1]
    scale = 1 + (apexes**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None]
    assert (low <= exact + 1e-6 * scale).all() and (mirrored >= exact - 1e-6 * scale).all()

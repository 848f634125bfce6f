import hashlib
import math

import numpy as np
import pytest

from llm import limb_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _id long, ints int, _label string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, "c", 2, 3, "a") for i, v, label in rows], SCHEMA).repartition(parts)


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in kept]
    if not ints:
        return []
    width = len(ints[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in ints]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]

    def assign():
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        return [[min((far(v[p], c), j) for j, c in enumerate(books[p])) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        own = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [v[p] for v, o in zip(cut, own) if o[p][1] == j]
                if mine:
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    error = [sum(d for d, _ in o) for o in own]
    name = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    label = {}
    for (_, _, of), e in zip(kept, error):
        label[of] = label.get(of, 0) + e
    return sorted(((i, "".join(f"{j:02x}" for _, j in o), e, label[of], name) for (i, _, of), o, e in zip(kept, own, error)), key=repr)


def vectors(seed, n, dim=64, spread=0.1):
    rng = np.random.default_rng(seed)
    return [(int(i), rng.normal(size=dim).astype(np.float32).__mul__(spread).tolist(), int(rng.integers(4)) if i % 5 else None) for i in rng.permutation(n)]


@pytest.mark.parametrize("seed,dim,spread", [(1, 64, 0.1), (2, 8, 0.002), (3, 16, 3000.0)])
def test_against_brute_force(spark, rows, seed, dim, spread):
    data = vectors(seed, 150, dim, spread)
    assert rows(limb_codes.compress(frame(spark, data))) == brute(data)


def test_odd_rows(spark, rows):
    data = vectors(4, 25)
    data += [(3, data[0][1], 1), (3, data[0][1], 1), (None, data[1][1], None), (90, None, 1), (91, [0.5] * 63 + [None], 1)]
    data += [(92, [math.nan] + [0.1] * 63, 2), (93, [-math.inf] + [0.1] * 63, 2), (94, [-0.0] * 64, None)]
    data += [(100 + i, data[2][1], 9) for i in range(40)]
    assert rows(limb_codes.compress(frame(spark, data))) == brute(data)
    assert rows(limb_codes.compress(frame(spark, data[:3]))) == brute(data[:3])
    assert limb_codes.compress(frame(spark, [])).collect() == []
    with pytest.raises(Exception, match="length"):
        limb_codes.compress(frame(spark, [(1, [0.0] * 64, 1), (2, [0.0] * 56, 1)])).collect()


def test_products_are_exact_where_doubles_are_not():
    rng = np.random.default_rng(5)
    x, c = rng.integers(-(2**27), 2**27 + 1, (300, 64)), rng.integers(-(2**27), 2**27 + 1, (16, 64))
    x[0], c[0] = 2**27, -(2**27)
    exact = x.astype(object) @ c.T.astype(object)
    assert (limb_codes.products(x, c) == exact).all()
    assert ((x.astype(float) @ c.T.astype(float)).astype(object) != exact).any()

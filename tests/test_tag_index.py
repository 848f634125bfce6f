import random

import pytest

from tagloom.operators import tag_index


def brute(rows, n):
    out = []
    sets = [(i, {t for t in tags or [] if t}) for i, tags in rows]
    for i, a in sets:
        scored = []
        for j, b in sets:
            if i != j:
                scored.append((-round(len(a & b) / (len(a) ** 0.5 * len(b) ** 0.5), 12) if a and b else 1.0, j))
        out += [(i, r + 1, j, round(-s, 9) + 0.0) for r, (s, j) in enumerate(sorted(scored)[:n])]
    return sorted(out)


def titles(seed, n=150):
    """Few common tags, rare ones, equal sets, and rows without tags."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        tags = rng.sample(["a", "b", "c", "d", "e"], rng.randint(0, 4)) + [f"r{rng.randrange(60)}" for _ in range(rng.randint(0, 3))]
        rows.append((f"t{i:03}", tags + tags[:1] + [None, ""]))
    rows += [(f"u{i:02}", ["a", "r1"]) for i in range(25)] + [("v0", None), ("v1", []), ("v2", ["lonely"])]
    return rows


@pytest.mark.parametrize("common,dense,block_rows", [(256, 512, None), (10, 512, 20), (0, 512, None), (5, 3, None)])
def test_against_brute_force(spark, common, dense, block_rows):
    rows = titles(common)
    df = spark.createDataFrame(rows, "id string, tags array<string>")
    got = tag_index.nearest_by_tags(df, 6, common=common, dense=dense, block_rows=block_rows).collect()
    assert sorted((r.id, r["rank"], r.match_id, round(r.score, 9) + 0.0) for r in got) == brute(rows, 6)


def test_few_rows(spark):
    rows = [(1, ["a"]), (2, ["a", "b"]), (3, []), (4, None), (5, ["c"])]
    df = spark.createDataFrame(rows, "id long, tags array<string>")
    got = tag_index.nearest_by_tags(df, 10).collect()
    assert sorted((r.id, r["rank"], r.match_id, round(r.score, 9) + 0.0) for r in got) == brute(rows, 10)
    assert tag_index.nearest_by_tags(df.limit(0), 3).collect() == []


def test_a_tag_of_all_rows_makes_no_pairs(spark):
    """Rows that share one tag only fall into one profile: none meets another in a posting list."""
    df = spark.range(3000).selectExpr("id", "array('all', concat('own', id)) AS tags")
    got = tag_index.nearest_by_tags(df, 3).where("id IN (0, 7, 2999)").collect()
    assert sorted((r.id, r["rank"], r.match_id, round(r.score, 9)) for r in got) == [
        (0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 3, 0.5), (7, 1, 0, 0.5), (7, 2, 1, 0.5), (7, 3, 2, 0.5), (2999, 1, 0, 0.5), (2999, 2, 1, 0.5), (2999, 3, 2, 0.5)]

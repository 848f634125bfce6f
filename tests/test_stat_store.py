import random

from tagloom.operators import stat_store, validation
from tagloom.sources.spec import Feature, FeatureSpec

SPEC = FeatureSpec((
    Feature("title", min_fraction=0.9, min_count=1, min_values=1, max_values=1),
    Feature("tags", single=False, min_fraction=0.5, min_values=1, max_values=3, domain=("a", "b", "c"), min_domain_mass=0.6, drift_linf=0.05),
    Feature("lang", domain=("en",), min_domain_mass=0.5, drift_linf=0.3),
    Feature("score", "double", min_fraction=0.1),
    Feature("absent", min_fraction=1.0, drift_linf=0.1),
))
SCHEMA = "title string, tags array<string>, lang string, score int, surplus long"


def batch(spark, seed, n):
    rng = random.Random(seed)
    rows = [(
        rng.choice(["t1", "t2", None, "a"]), rng.choice([None, [], [None]] + [[rng.choice("abcde"[seed % 2 :]) for _ in range(rng.randint(1, 4))] for _ in range(5)]),
        rng.choice(["en", "de", None]), rng.choice([None, 1, 2]), 1) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_checks_from_the_store_are_those_of_the_rows(spark, rows, tmp_path):
    path, parts = str(tmp_path / "store"), [batch(spark, s, 40 + 30 * s) for s in range(3)]
    for name, part in zip(("202401", "202402", "202403"), parts):
        stat_store.append_statistics(part, name, path)
    now, before = stat_store.read_statistics(spark, path, ["202403"]), stat_store.read_statistics(spark, path, ["202401", "202402"])
    want = validation.validate(parts[2], SPEC, parts[0].union(parts[1]))
    assert rows(stat_store.validate_statistics(now, SPEC, before)) == rows(want)
    together = stat_store.read_statistics(spark, path)
    whole = parts[0].union(parts[1]).union(parts[2])
    assert rows(together.rows) == rows(stat_store.batch_statistics(whole).rows)
    assert rows(together.values) == rows(stat_store.batch_statistics(whole).values)
    assert rows(stat_store.validate_statistics(together, SPEC)) == rows(validation.validate(whole, SPEC))


def test_a_batch_stored_again_counts_once_and_a_failed_run_not_at_all(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    first, second = batch(spark, 1, 50), batch(spark, 2, 20)
    stat_store.append_statistics(first, "1", path)
    stat_store.append_statistics(first, "2", path)
    stat_store.append_statistics(second, "2", path)
    # counts without the rows that name their run, as a run that failed half-way leaves them
    lost = stat_store.batch_statistics(first).values
    lost.selectExpr("*", "'2' AS batch", "'lost' AS run").write.mode("append").partitionBy("batch", "run").parquet(f"{path}/values")
    got, want = stat_store.read_statistics(spark, path), stat_store.batch_statistics(first.union(second))
    assert rows(got.rows) == rows(want.rows) and rows(got.values) == rows(want.values)
    stat_store.append_statistics(first.limit(0), "1", path)
    got, want = stat_store.read_statistics(spark, path), stat_store.batch_statistics(second)
    assert rows(got.values) == rows(want.values) and {r.num_rows for r in got.rows.collect()} == {20}


def test_empty_batches(spark, rows, tmp_path):
    path, empty = str(tmp_path / "store"), batch(spark, 1, 5).limit(0)
    stat_store.append_statistics(empty, "1", path)
    got = stat_store.read_statistics(spark, path)
    assert rows(stat_store.validate_statistics(got, SPEC, got)) == rows(validation.validate(empty, SPEC, empty))
    assert stat_store.read_statistics(spark, path, ["none"]).rows.collect() == []

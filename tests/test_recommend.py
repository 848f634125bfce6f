import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import recommend
from tagloom.plans import evaluation


def evaluate_by_hand(plays, items, history=10, test=5, ns=(1, 5, 10)):
    """The evaluation in plain loops: plays (user, content, ts), items {item: (content, vector)}."""
    by_content = {}
    for item, (content, _) in sorted(items.items()):
        by_content.setdefault(content, []).append(item)
    joined = sorted(((u, t, c, i) for u, c, t in plays for i in by_content.get(c, [])))
    users = {}
    for u, t, c, i in joined:
        users.setdefault(u, []).append((t, c, i))
    sums = {(m, n): 0.0 for m in ("Precision", "Recall", "Accuracy") for n in ns}
    covered, seen = {n: set() for n in ns}, set()
    for u, rows in users.items():
        first = rows[:history]
        known = {c for _, c, _ in first}
        later = []
        for _, c, _ in rows[history:]:
            if c not in known and c not in later:
                later.append(c)
        future = set(later[:test])
        profile = sum(np.array(items[i][1]) for _, _, i in first) / history
        scored = []
        for i, (c, v) in items.items():
            size = np.linalg.norm(profile) * np.linalg.norm(v)
            cos = float(profile @ np.array(v)) / size if size else -1.0
            scored.append((-(-1.0 if c in known else round(cos, 12)), i, c))
        scored.sort()
        if not future:
            continue
        seen |= future
        for n in ns:
            top = {c for _, _, c in scored[:n]}
            hits = len(top & future)
            sums["Precision", n] += hits / n
            sums["Recall", n] += hits / len(future)
            sums["Accuracy", n] += hits > 0
            covered[n] |= top
    out = {f"{m}@{n}": s / len(users) for (m, n), s in sums.items()}
    out.update({f"Coverage@{n}": len(covered[n]) / len(seen) for n in ns})
    return {"total": len(users), **out}


def run(spark, plays, items, **options):
    plays_df = spark.createDataFrame(plays, "user_id string, content_id bigint, ts bigint")
    items_df = spark.createDataFrame([(i, c, [float(x) for x in v]) for i, (c, v) in items.items()], "item bigint, content_id bigint, vec array<double>")
    return evaluation.evaluate(plays_df, items_df, **options)


@pytest.mark.parametrize("shared", [False, True])
def test_evaluation_matches_plain_loops(spark, shared):
    rng = np.random.default_rng(11)
    items = {i: (i // 2 if shared else i, rng.normal(size=4)) for i in range(40)}
    contents = len({c for c, _ in items.values()})
    plays, clock = [], 0
    for u, n in enumerate([1, 9, 10, 11, 16, 40, 60, 300]):  # the last user has most of the plays
        for _ in range(n):
            clock += 1
            plays.append((f"u{u}", int(rng.integers(0, contents + 5)), clock))
    result = run(spark, plays, items, block_rows=16)
    got = result.metrics.first().asDict()
    want = evaluate_by_hand(plays, items)
    assert got.keys() == want.keys()
    for name, value in want.items():
        assert math.isclose(got[name], value, abs_tol=1e-9), name


def test_short_users_and_repeats(spark):
    plays = [("u", c, i) for i, c in enumerate([1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 1, 10, 10, 11, 12, 13, 14, 15])]
    df = spark.createDataFrame(plays, "user_id string, content_id bigint, ts bigint")
    history, test = recommend.history_and_test(df)
    assert [r.content_id for r in history.orderBy("ts").collect()] == [1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert [r.content_id for r in test.orderBy("ts").collect()] == [10, 11, 12, 13, 14]
    short_history, short_test = recommend.history_and_test(df.where("ts < 9"))
    assert (short_history.count(), short_test.count()) == (9, 0)


def test_profile_divides_by_the_window(spark):
    items = spark.createDataFrame([(1, [2.0, 4.0]), (2, [1.0, 0.0])], "item bigint, vec array<double>")
    history = spark.createDataFrame([("u", 1), ("u", 2), ("v", 1)], "user_id string, item bigint")
    got = {r.user_id: r.vec for r in recommend.user_profiles(history, items).collect()}
    assert got == {"u": [0.3, 0.4], "v": [0.2, 0.4]}


def test_users_without_test_items_count_in_the_denominator(spark):
    recs = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "user_id string, rank int, content bigint")
    test = spark.createDataFrame([("a", 5)], "user_id string, content_id bigint")
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    row = recommend.ranking_metrics(recs, test, users, ns=(1,)).first()
    assert row.asDict() == {"total": 2, "Precision@1": 0.5, "Recall@1": 0.5, "Accuracy@1": 0.5, "Coverage@1": 1.0}


def test_no_hits_give_zero(spark):
    recs = spark.createDataFrame([("a", 1, 5)], "user_id string, rank int, content bigint")
    test = spark.createDataFrame([("a", 9)], "user_id string, content_id bigint")
    row = recommend.ranking_metrics(recs, test, test, ns=(1,)).first()
    assert (row["Accuracy@1"], row["Precision@1"]) == (0.0, 0.0)


def test_export_and_type_match(spark):
    items = spark.createDataFrame(
        [(1, "A", "Movie", [1.0, 0.0]), (2, "B", "Movie", [1.0, 0.1]), (3, "C", "Programme", [0.0, 1.0])],
        "id int, title string, type string, vec array<double>")
    recs = recommend.content_to_content(items, 2)
    out = recommend.export_recommendations(recs, items, "id", "title", ["type"], titles=["A"])
    assert out.columns == ["query_id", "query_title", "query_type", "result_rank", "result_id", "result_title", "result_type", "score"]
    assert [(r.result_rank, r.result_title) for r in out.orderBy("result_rank").collect()] == [(1, "B"), (2, "C")]
    assert {r.id: r.type_match for r in recommend.type_match(recs, items).collect()} == {1: 0.5, 2: 0.5, 3: 0.0}


def test_metric_rows_are_appended(spark, tmp_path):
    items = {i: (i, np.eye(6)[i % 6] + 0.1) for i in range(30)}
    plays = [("u", i % 30, i) for i in range(40)]
    result = run(spark, plays, items)
    target, report = str(tmp_path / "metrics"), str(tmp_path / "report")
    for _ in range(2):
        evaluation.publish(result, "m", "/models/m", target, report)
    got = spark.read.parquet(target)
    assert got.columns == ["model_name", "date", "metric_name", "value", "model_path"]
    assert got.count() == 24 and got.select("metric_name").distinct().count() == 12
    assert spark.read.json(f"{report}/per_user").count() == 1
    assert spark.read.json(f"{report}/summary").first()["total"] == 1
    assert got.where(F.length("date") != 19).count() == 0


def test_one_item_per_title(spark):
    df = spark.createDataFrame([("t", 2), ("t", 1), ("s", 9)], "title string, item int")
    assert {tuple(r) for r in evaluation.one_item_per_title(df, "title", "item").collect()} == {("t", 1), ("s", 9)}


def test_items_of_one_content_do_not_multiply_the_plays(spark):
    plays = spark.range(2000).select(F.lit("u").alias("user_id"), (F.col("id") % 2).alias("content_id"), F.col("id").alias("ts"))
    items = spark.range(3000).select(F.col("id").alias("item"), F.lit(0).cast("bigint").alias("content_id"))
    history, test = recommend.history_and_test(plays, items=items)
    assert [(r.ts, r.item) for r in history.orderBy("ts", "item").collect()] == [(0, i) for i in range(10)]
    assert test.count() == 0
    joined = recommend.plays_of_items(plays.where("ts < 4"), items.where("item < 3"))
    assert joined.count() == 6

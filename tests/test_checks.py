import math
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import clusters, metrics, validation
from tagloom.sources.spec import TRAINING_SPEC, Feature, FeatureSpec

LONG = "id int, tag int, y int, p double"


def curve_by_hand(pairs):
    """Average precision and ROC AUC from all pairs of examples."""
    pos, neg = [p for y, p in pairs if y], [p for y, p in pairs if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    ap = 0.0
    for cut in sorted({p for _, p in pairs}, reverse=True):
        above = [y for y, p in pairs if p >= cut]
        ap += sum(1 for y, p in pairs if y and p == cut) / len(pos) * sum(above) / len(above)
    return ap, wins / (len(pos) * len(neg))


def test_curves_with_ties_and_a_hot_tag(spark):
    rnd = random.Random(4)
    data = [(i, 0 if i % 3 else 1, rnd.random() < 0.3, round(rnd.random(), 1 + i % 2)) for i in range(600)]
    df = spark.createDataFrame([(i, t, int(y), p) for i, t, y, p in data], LONG)
    got = {r.tag: r for r in metrics.per_tag_metrics(df).collect()}
    for tag in (0, 1):
        pairs = [(y, p) for _, t, y, p in data if t == tag]
        ap, auc = curve_by_hand(pairs)
        assert math.isclose(got[tag].average_precision, ap) and math.isclose(got[tag].roc_auc, auc)
        assert math.isclose(got[tag].accuracy, sum((p > 0.5) == y for y, p in pairs) / len(pairs))


def test_tags_without_both_classes(spark):
    df = spark.createDataFrame([(1, 0, 0, 0.1), (2, 0, 0, 0.9), (1, 1, 1, 0.1), (2, 1, 1, 0.9)], LONG)
    got = {r.tag: (r.status, r.accuracy, r.roc_auc) for r in metrics.per_tag_metrics(df).collect()}
    assert got == {0: ("no_positives", None, None), 1: ("only_positives", None, None)}
    marked = {r.tag: (r.accuracy, r.average_precision) for r in metrics.per_tag_metrics(df, compat=True).collect()}
    assert marked == {0: (-1.0, -1.0), 1: (10.0, 10.0)}


def test_micro_and_macro(spark):
    df = spark.createDataFrame([(1, 0, 1, 0.9), (2, 0, 0, 0.8), (3, 0, 1, 0.2), (1, 1, 0, 0.1), (2, 1, 0, 0.1), (3, 1, 0, 0.5)], LONG)
    assert tuple(metrics.precision_recall(df).first()) == (0.5, 0.5)
    row = metrics.multilabel_metrics(df).first()
    assert math.isclose(row.binary_accuracy, 4 / 6) and math.isclose(row.macro_f1, 0.25)
    empty = metrics.precision_recall(df.where("y = 0 and p < 0.5")).first()
    assert tuple(empty) == (0.0, 0.0)


def test_perfect_scores_have_full_area(spark):
    df = spark.createDataFrame([(i, 0, int(i < 20), 0.9 if i < 20 else 0.1) for i in range(50)], LONG)
    assert math.isclose(metrics.multilabel_metrics(df).first().pr_auc, 1.0)


def test_focal_loss_by_hand(spark):
    df = spark.createDataFrame([([1, 0], [0.9, 0.2])], "y array<int>, p array<double>")
    want = 0.25 * 0.1**3 * -math.log(0.9) + 0.75 * 0.2**3 * -math.log(0.8)
    assert math.isclose(metrics.mean_focal_loss(df, "y", "p").first()[0], want, rel_tol=1e-6)


def test_gate_and_publishing(spark, tmp_path):
    scores = spark.createDataFrame([(0.7, 0.4), (0.69, 0.9)], "precision double, recall double")
    assert [r.blessed for r in metrics.threshold_gate(scores).collect()] == [1, 0]
    df = spark.range(3)
    good, bad = metrics.threshold_gate(scores.where("precision >= 0.7")), metrics.threshold_gate(scores.where("precision < 0.7"))
    assert not metrics.publish_if(bad, df, str(tmp_path), "v1") and not (tmp_path / "v1").exists()
    assert metrics.publish_if(good, df, str(tmp_path), "v1") and spark.read.parquet(str(tmp_path / "v1")).count() == 3


def test_report_has_both_sides(spark, rows):
    a = spark.createDataFrame([(1, "x", 1)], "id int, label string, value int")
    b = spark.createDataFrame([(1, "x", 0.5), (1, "y", 0.1)], "id int, label string, value double")
    assert rows(metrics.prediction_report(a, b, "id")) == [(1, "x", 1, 0.5), (1, "y", None, 0.1)]


@pytest.fixture()
def good(spark):
    return spark.createDataFrame([("s", "k", ["a", "b"]), ("s2", "k", ["a"])], "synopsis string, keywords string, tags array<string>")


def test_spec_passes_and_fails(spark, good):
    assert validation.validate(good, TRAINING_SPEC, good).where("not passed").count() == 0
    bad = spark.createDataFrame([(None, ["k", "l"], [], 1), ("s", ["k"], ["a"], 1)], "synopsis string, keywords array<string>, tags array<string>, extra int")
    found = {(r.feature, r["check"]) for r in validation.validate(bad, TRAINING_SPEC).where("not passed").collect()}
    assert found == {("extra", "expected"), ("keywords", "type"), ("synopsis", "min_fraction"), ("tags", "min_fraction"), ("keywords", "max_values")}


def test_drift_threshold(spark):
    def tags(n):
        return spark.createDataFrame([(["a"],)] * n + [(["b"],)] * (100 - n), "tags array<string>")

    for n, passed in ((46, True), (44, False)):
        row = validation.linf_drift(tags(n), tags(50), "tags").first()
        assert math.isclose(row.observed, (50 - n) / 100) and row.passed is passed


def test_domain_mass(spark):
    df = spark.createDataFrame([(["a", "b", "c", "c"],)], "t array<string>")
    assert validation.check_domain_mass(df, "t", ["a", "c"], 0.75).first().passed
    domain = spark.createDataFrame([("a",), ("a",)], "v string")
    assert validation.check_domain_mass(df, "t", domain).first().observed == 0.25


def test_inferred_spec_survives_json(spark, good, tmp_path):
    spec = validation.infer_spec(good)
    assert spec.features[0] == Feature("synopsis", "string", True, 1.0, 1, 1, 1, ("s", "s2"))
    assert spec.features[2].max_values is None and spec.features[2].domain == ("a", "b")
    spec.save(str(tmp_path / "spec.json"))
    assert FeatureSpec.load(str(tmp_path / "spec.json")) == spec
    assert spec.schema().simpleString() == "struct<synopsis:string,keywords:string,tags:array<string>>"


def test_inferred_spec_names_open_domains(spark):
    df = spark.createDataFrame([(f"v{i}", "a") for i in range(5)], "many string, few string")
    spec = validation.infer_spec(df, domain_limit=4)
    assert spec.open_domains == ("many",) and FeatureSpec.from_json(spec.to_json()) == spec


def test_quantiles_are_exact_whatever_the_size(spark):
    rows = spark.range(30_000).select((F.col("id") * 7919 % 30_011).cast("double").alias("v"), F.lit(None).cast("double").alias("none"))
    values = sorted(r.v for r in rows.collect())
    got = {r.feature: r for r in validation.numeric_stats(rows, ["v", "none"]).collect()}
    for q in (0.1, 0.25, 0.5, 0.75, 0.9):
        assert got["v"][f"q{round(q * 100)}"] == values[math.ceil(q * len(values)) - 1]
    assert got["none"].num_values == 0 and got["none"].q50 is None


def test_statistics(spark, good):
    got = {r.feature: r for r in validation.feature_stats(good, ["synopsis", "tags"]).collect()}
    assert (got["tags"].num_values, got["tags"].num_distinct, got["tags"].top_value, got["tags"].top_count, got["tags"].mean_values) == (3, 2, "a", 2, 1.5)
    assert (got["synopsis"].min_length, got["synopsis"].max_length, got["synopsis"].missing) == (1, 2, 0)
    other = validation.feature_stats(good.limit(1), ["synopsis", "tags"])
    gap = {r.feature: r.num_distinct_gap for r in validation.compare_stats(validation.feature_stats(good, ["synopsis", "tags"]), other).collect()}
    assert gap["synopsis"] == 1


def test_prediction_sanity(spark):
    df = spark.createDataFrame([([0.5, float("nan")],), ([0.0, 0.5],), ([0.2, 0.3],)], "p array<double>")
    assert tuple(validation.check_predictions(df, "p").first()) == (3, 1, 2)


def test_centroids_overrides_and_special_labels(spark):
    df = spark.createDataFrame([("Dramatic", [0.0], 0), ("Comedies", [1.0], 0), ("b", [5.0], 0), ("x", [9.0], 1)], "word string, vec array<double>, cluster int")
    named = clusters.centroid_word(df)
    assert {r.word: (r.centroid_word, r.num_words) for r in named.collect()} == {
        "Dramatic": ("Comedies", 3), "Comedies": ("Comedies", 3), "b": ("Comedies", 3), "x": ("x", 1)}
    changed = {r.word: r.centroid_word for r in clusters.override_by_prefix(named).collect()}
    assert changed == {"Dramatic": "Drama", "Comedies": "Comedy", "b": "Comedies", "x": "x"}
    whole = clusters.append_special_labels(named, ["eng", "spa"], 140)
    assert [(r.word, r.cluster, r.vec, r.num_words) for r in whole.where("cluster >= 140").orderBy("cluster").collect()] == [("eng", 140, [], 1), ("spa", 141, [], 1)]


def test_keyword_clusters_end_to_end(spark):
    rows = [(f"w{i}", [float(i // 10), 0.0]) for i in range(30)] + [("eng", [0.0, 0.0])]
    out = clusters.keyword_clusters(spark.createDataFrame(rows, "word string, vec array<double>"), k=3)
    assert out.count() == 30 + len(clusters.SPECIAL_LABELS)
    assert out.where("cluster < 3").select("cluster").distinct().count() == 3
    assert out.where(F.col("word") == "eng").count() == 1


def test_title_table_and_default(spark):
    titles = spark.createDataFrame([("b", [0, 1]), ("a", [1])], "title string, indices array<int>")
    vecs = spark.createDataFrame([(0, [0.0]), (1, [2.0])], "idx int, vec array<double>")
    table = clusters.title_embeddings(titles, vecs)
    assert [(r.row, r.title, r.vec) for r in table.orderBy("row").collect()] == [(0, None, [1.5]), (1, "a", [2.0]), (2, "b", [1.0])]
    asked = spark.createDataFrame([("b",), ("?",)], "title string")
    assert {r.title: r.vec for r in clusters.lookup_title_vectors(asked, table).collect()} == {"b": [1.0], "?": [1.5]}


def test_no_text_is_a_shuffle_key(spark):
    """Values are counted by digest; only the most frequent ones' texts are shown, ties to the smaller text."""
    data = [(f"text {i % 9}", [f"w{i % 4}", f"w{i}"]) for i in range(60)] + [(None, None)]
    df = spark.createDataFrame(data, "a string, b array<string>").repartition(3)
    got = {r.feature: r for r in validation.feature_stats(df, ["a", "b"]).collect()}
    assert (got["a"].top_value, got["a"].top_count, got["a"].num_distinct) == ("text 0", 7, 9)
    assert (got["b"].top_value, got["b"].num_values, got["b"].num_distinct) == ("w0", 120, 60)
    best = validation.top_value_table(df, ["a", "b"], 3).orderBy("feature", "rank").collect()
    assert [(r.feature, r["rank"], r.value) for r in best] == [("a", 1, "text 0"), ("a", 2, "text 1"), ("a", 3, "text 2"), ("b", 1, "w0"), ("b", 2, "w1"), ("b", 3, "w2")]
    plan = validation.value_counts(df, "a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(") == 1 and "hashpartitioning(value" not in plan


def test_many_tied_values(spark, monkeypatch):
    monkeypatch.setattr(validation, "_FEW", 5)
    df = spark.range(50).selectExpr("cast(id as string) AS a")
    assert validation.feature_stats(df, ["a"]).first().top_value == "0"

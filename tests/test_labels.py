import random

import pytest
from pyspark.sql import functions as F

from tagloom.functions.vectors import multi_hot
from tagloom.operators import coding, labels, validation


def test_vocab_order_and_unusable_tokens(spark):
    df = spark.createDataFrame([(["b", "a", "c"],), (["b", "", "x\ny"],), (None,)], "t array<string>")
    got = [tuple(r) for r in labels.build_vocab(df, "t").orderBy("idx").collect()]
    assert got == [("b", 2, 0), ("c", 1, 1), ("a", 1, 2)]


def test_apply_keeps_order_and_marks_unknown(spark):
    vocab = labels.build_vocab(spark.createDataFrame([(["b", "b", "a"],)], "t array<string>"), "t")
    df = spark.createDataFrame([(1, ["a", "?", "b"]), (2, []), (3, None)], "id int, t array<string>")
    assert {r.id: r.t_idx for r in labels.apply_vocab(df, "id", "t", vocab).collect()} == {1: [1, 2, 0], 2: [], 3: []}


def test_multi_hot_golden(spark):
    df = spark.createDataFrame([([1, 3, 2, 6],), ([2, 3, 0],), ([3, 0, 5, 2, 4, 1, 6],)], "i array<int>")
    got = [[int(x) for x in r[0]] for r in df.select(multi_hot(F.col("i"), 7)).collect()]
    assert got == [[0, 1, 1, 1, 0, 0, 1], [1, 0, 1, 1, 0, 0, 0], [1] * 7]


def test_multi_hot_refuses_out_of_range(spark):
    df = spark.createDataFrame([([1],), ([5],)], "i array<int>")
    with pytest.raises(Exception, match="label index outside"):
        df.select(multi_hot(F.col("i"), 4)).collect()
    slot = spark.createDataFrame([([4],)], "i array<int>").select(multi_hot(F.col("i"), 4, oov_slot=True)).first()[0]
    assert slot == [0, 0, 0, 0, 1]


def test_transform_and_round_trip(spark):
    df = spark.createDataFrame([(1, "some input", "k", ["x", "y"]), (2, "more input", "k", ["y"])], "id int, synopsis string, keywords string, tags array<string>")
    fitted = labels.fit_preprocess(df)
    out = fitted.transform(df, "id")
    assert out.columns == ["id", "synopsis", "keywords", "tags_xf"]
    assert {r.id: (r.synopsis, r.tags_xf) for r in out.collect()} == {1: ("some input", [1.0, 1.0]), 2: ("more input", [1.0, 0.0])}
    decoded = labels.decode_labels(out, "id", "tags_xf", fitted.vocab)
    assert validation.check_roundtrip(df, decoded, "id").first()[0] == 0
    later = spark.createDataFrame([(9, "s", "k", ["new"])], df.schema)
    with pytest.raises(Exception, match="label index outside"):
        fitted.transform(later, "id").collect()
    with_slot = labels.fit_preprocess(df, oov_slot=True)
    assert with_slot.transform(later, "id").first()["tags_xf"] == [0.0, 0.0, 1.0]


def test_coverage_counts_the_unknown_slot(spark, rows):
    vocab = spark.createDataFrame([("a", 3, 0), ("b", 2, 1), ("c", 1, 2)], "token string, freq bigint, idx bigint")
    pretrained = spark.createDataFrame([("a", [1.0]), ("b", [0.0]), ("z", [1.0])], "token string, vec array<double>")
    assert labels.vocab_coverage(vocab, pretrained).first().asDict() == {"vocab_size": 3, "hits": 1, "missing": 2, "percent": 25}
    assert rows(labels.missing_words(vocab, pretrained).select("token")) == [("c",)]
    assert {r.token: r.vec for r in labels.embedding_for_vocab(vocab, pretrained, 1).collect()} == {"a": [1.0], "b": [0.0], "c": [0.0]}


def test_splits_keep_groups_together(spark, rows):
    df = spark.range(4000).withColumn("g", (F.col("id") / 4).cast("int").cast("string"))
    out = labels.split_by_group(df, "g")
    assert out.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    share = out.where("split = 'test'").count() / 4000
    assert 0.06 < share < 0.14
    assert rows(out) == rows(labels.split_by_group(df.repartition(9), "g"))
    assert labels.split_by_buckets(df, ["id"], {"train": 10}).where("split <> 'train'").count() == 0


def test_wide_labels(spark, rows):
    df = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "id int, a int, b int")
    long = labels.unpivot_labels(df, ["id"], ["a", "b"])
    assert rows(long.select("id", "label")) == [(1, "a"), (3, "a"), (3, "b")]
    wide = labels.pivot_predictions(long, ["id"], "label", "value", ["a", "b"])
    assert wide.columns == ["id", "a_pred", "b_pred"]


def test_filter_to_vocab(spark, rows):
    df = spark.createDataFrame([(1, ["b", "a", "a", "q"]), (2, ["q"])], "id int, t array<string>")
    vocab = spark.createDataFrame([("a",), ("b",), ("a",)], "token string")
    assert rows(labels.filter_to_vocab(df, "id", "t", vocab)) == [(1, ["a", "b"])]


def test_predictions_keep_rows_without_any(spark):
    rows = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "id int, a int, b int")
    long = labels.unpivot_labels(rows, ["id"], ["a", "b"])
    got = labels.pivot_predictions(long, ["id"], "label", "value", ["a", "b"], rows)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0), (2, 0, 0), (3, 1, 1)]


def test_vocabulary_drops_or_marks_unknown_members(spark):
    df = spark.createDataFrame([(1, ["x", "q", "x"]), (2, []), (3, None), (4, ["q"])], "id int, t array<string>")
    vocab = spark.createDataFrame([("x", 0)], "token string, idx bigint")
    marked = {r.id: r.t_idx for r in labels.apply_vocab(df, "id", "t", vocab).collect()}
    assert marked == {1: [0, 1, 0], 2: [], 3: [], 4: [1]}
    dropped = {r.id: r.t_idx for r in labels.apply_vocab(df, "id", "t", vocab, drop_unknown=True).collect()}
    assert dropped == {1: [0, 0], 2: [], 3: [], 4: []}


def test_occurrences_are_not_shuffled(spark):
    """Rows cross as arrays of codes; a chunk's distinct members are what meets the vocabulary."""
    df = spark.createDataFrame([(i, ["the"] * 50 + [f"w{i % 7}", None, "?"]) for i in range(40)], "id long, t array<string>")
    vocab = spark.createDataFrame([("the", 0), ("w3", 1)], "token string, idx long")
    out = labels.apply_vocab(df, "id", "t", vocab, 2)
    assert {r.id: r.t_idx for r in out.collect()} == {i: [0] * 50 + [1 if i % 7 == 3 else 2, 2, 2] for i in range(40)}
    rows = df.select(F.col("id").alias("_key"), F.col("t").alias("_members")).coalesce(1)
    chunks = coding.coded(rows, limit=120)
    assert chunks.where("_tokens IS NOT NULL").count() == 20  # two rows of 53 members in each
    assert chunks.select(F.explode("_tokens")).count() <= 20 * 5
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1  # the explode of distinct members alone


def test_lookup_by_chunk_equals_plain_loop(spark):
    rng = random.Random(3)
    data = [(i, None if i % 11 == 0 else [rng.choice(["a", "b", "c", "é", "", None, "zz"]) for _ in range(rng.randint(0, 9))]) for i in range(200)]
    df = spark.createDataFrame(data, "id long, t array<string>").repartition(5)
    vocab = spark.createDataFrame([("a", 0), ("é", 1), ("", 2)], "token string, idx long")
    index = {"a": 0, "é": 1, "": 2}
    for drop in (False, True):
        got = {r.id: r.t_idx for r in labels.apply_vocab(df, "id", "t", vocab, drop_unknown=drop).collect()}
        assert got == {i: [index.get(x, 3) for x in t or [] if not drop or x in index] for i, t in data}
    kept = {r.id: r.t for r in labels.filter_to_vocab(df, "id", "t", vocab).collect()}
    assert kept == {i: sorted({x for x in t or [] if x in index}) for i, t in data if any(x in index for x in t or [])}

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.functions import text
from tagloom.operators import labels, models
from tagloom.session import cut_lineage
from tagloom.sources import tables
from tagloom.streaming.incremental import process_new_files


def test_tables_and_queries(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    tables.write_table(df, "kept")
    tables.write_table(df.where("id = 1"), "kept")
    assert tables.read_table(spark, "kept").count() == 1
    path = str(tmp_path / "p")
    tables.write_table(df, path, partition_by=["v"])
    assert tables.read_table(spark, path).count() == 2
    assert tables.read_query(spark, "SELECT * FROM kept WHERE v = :v", v="a").count() == 1


def test_splits_from_file_names(spark, tmp_path, rows):
    spark.createDataFrame([(1,)], "id int").write.parquet(str(tmp_path / "train-1"))
    spark.createDataFrame([(2,)], "id int").write.parquet(str(tmp_path / "eval-1"))
    assert rows(tables.read_splits(spark, str(tmp_path), {"train": "train*", "eval": "eval*"})) == [(1, "train"), (2, "eval")]


def test_csv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, None)], "id int, v string")
    path = str(tmp_path / "c")
    tables.write_csv(df, path)
    assert rows(tables.read_csv(spark, path, "id int, v string")) == rows(df)
    (tmp_path / "tags.txt").write_text("Drama\nComedy\n")
    assert rows(tables.read_csv(spark, str(tmp_path / "tags.txt"), "tag string", header=False)) == [("Comedy",), ("Drama",)]


def test_vocabulary_files(spark, tmp_path):
    words = [f"w{i}" for i in range(500)]
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, idx bigint").repartition(5)
    tables.write_vocab(vocab, str(tmp_path / "v"), str(tmp_path / "t"))
    assert [r.token for r in tables.read_vocab(spark, str(tmp_path / "v")).orderBy("idx").collect()] == words
    assert [r.token for r in tables.read_vocab_text(spark, str(tmp_path / "t")).orderBy("idx").collect()] == words
    (tmp_path / "gaps").write_text("b\n\na\n\n")
    got = [(r.token, r.idx) for r in tables.read_vocab_text(spark, str(tmp_path / "gaps")).orderBy("idx").collect()]
    assert got == [("b", 0), ("a", 1)]


def test_rowwise_steps_also_take_a_stream(spark, tmp_path, rows):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "id bigint, synopsis string"

    def step(df):
        return df.select("id", text.clean_text(F.col("synopsis")).alias("clean"))

    spark.createDataFrame([(1, "One, two!")], schema).write.mode("append").parquet(source)
    process_new_files(spark, source, schema, step, target, progress)
    spark.createDataFrame([(2, "Three 4")], schema).write.mode("append").parquet(source)
    process_new_files(spark, source, schema, step, target, progress)
    assert rows(spark.read.parquet(target)) == [(1, "one two"), (2, "three")]


def test_encoder_is_loaded_per_task(spark):
    def load():
        import numpy as np

        return lambda texts: np.array([[len(x)] for x in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(120)] + [(500, None)], "id int, t string")
    got = {r.id: r.vec for r in models.embed_text(df, "t", load).collect()}
    assert got[7] == [7.0] and got[500] == [0.0] and len(got) == 121


def test_encoder_gets_small_parts_of_a_batch(spark):
    def load():
        import numpy as np

        return lambda texts: np.array([[len(texts), len(x)] for x in texts])

    df = spark.range(0, 95, 1, 1).selectExpr("id", "IF(id % 9 = 0, NULL, repeat('x', CAST(id AS INT))) AS t", "named_struct('a', id, 'b', array(id)) AS more")
    out = models.embed_text(df, "t", load, batch=40)
    got = {r.id: r for r in out.collect()}
    assert all(got[i].vec == [15.0 if i >= 80 else 40.0, 0.0 if i % 9 == 0 else float(i)] and got[i].more.b == [i] for i in range(95))
    # whole batches of texts as Python objects are what mapInPandas would hold
    assert "MapInArrow" in out._jdf.queryExecution().optimizedPlan().toString()


def test_tagger_reads_the_rows_once(spark):
    rows = cut_lineage(_tagged_rows(spark))
    read = spark.sparkContext.accumulator(0)

    def counted(text):
        read.add(1)
        return text

    models.train_tagger(rows.withColumn("synopsis", F.udf(counted)("synopsis")), features=16, max_iter=2)
    assert read.value == rows.count()


def test_tagger_learns_a_plain_rule(spark):
    data = [(i, "alpha story" if i % 2 else "beta tale", "k", ["odd"] if i % 2 else ["even", "rare"] if i == 0 else ["even"]) for i in range(80)]
    df = spark.createDataFrame(data, "id int, synopsis string, keywords string, tags array<string>")
    fitted = labels.fit_preprocess(df)
    tagger = models.train_tagger(fitted.transform(df, "id"), features=64)
    scored = tagger.score(df)
    best = models.top_tags(scored, "id", "scores", fitted.vocab, 1)
    got = {r.id: r.tag for r in best.collect()}
    assert all(got[i] == ("odd" if i % 2 else "even") for i in range(80))
    bounds = scored.select(F.array_min("scores").alias("lo"), F.array_max("scores").alias("hi")).agg(F.min("lo"), F.max("hi")).first()
    assert 0 < bounds[0] and bounds[1] < 1


def _tagged_rows(spark):
    rng = random.Random(5)
    words = "sea storm ship love night war car race city home".split()
    data = []
    for i in range(90):
        chosen = rng.sample(words, rng.randint(0, 4))
        tags = [f"about {w}" for w in chosen if w in words[:5]] + (["any"] if chosen else ["none"])
        data.append((i, " ".join(chosen), " ".join(rng.sample(words, 2)), tags))
    df = spark.createDataFrame(data, "id int, synopsis string, keywords string, tags array<string>")
    return labels.fit_preprocess(df).transform(df, "id")


def test_tagger_blocks_give_the_weights_of_plain_descent(spark):
    rows = _tagged_rows(spark)
    features, reg, steps = 32, 0.01, 7
    one = models.train_tagger(rows, features=features, max_iter=steps, reg=reg)
    many = models.train_tagger(rows, features=features, max_iter=steps, reg=reg, block_weights=2 * (2 * features + 1))
    assert one.block >= one.labels == many.labels and many.block == 2

    told = one.features.transform(rows).select("_features", "tags_xf").collect()
    x = np.array([[*r["_features"].toArray(), 1.0] for r in told])
    y = np.array([r["tags_xf"] for r in told], float)
    share = y.mean(axis=0)
    w = np.zeros((y.shape[1], x.shape[1]))
    w[:, -1] = np.log(share / (1 - share))
    ahead, momentum = w, 1.0
    for _ in range(steps):
        slope = (1 / (1 + np.exp(-x @ ahead.T)) - y).T @ x / len(x) + reg * np.c_[ahead[:, :-1], np.zeros(len(w))]
        after = ahead - slope / (0.5 + reg)
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        w, ahead, momentum = after, after + (momentum - 1) / grown * (after - w), grown
    assert np.allclose(one.block_weights(0), w, atol=1e-12)
    blocks = -(-many.labels // many.block)
    assert blocks > 2 and np.allclose(np.concatenate([many.block_weights(b) for b in range(blocks)]), w, atol=1e-12)

    extra = rows.withColumn("block", F.lit("kept"))
    want = {r.id: r.scores for r in one.score(rows).collect()}
    got = {r.id: (r.scores, r.block) for r in many.score(extra).collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[i][0], want[i], atol=1e-12) and got[i][1] == "kept" for i in want)


def test_tagger_takes_dense_and_sparse_vectors(spark):
    vectors = [Vectors.dense([1.0, 0.0, 2.0]), Vectors.sparse(3, [2], [5.0]), Vectors.sparse(3, [], []), Vectors.dense([0.0, 3.0, 0.0])]
    df = spark.createDataFrame(list(enumerate(vectors)), ["id", "v"])

    def dense(batches):
        for batch in batches:
            rows = [x.tolist() for _, part in models._dense_batches(batch.column(1), 3) for x in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows)], names=["id", "row"])

    got = {r.id: r.row for r in df.mapInArrow(dense, "id long, row array<double>").collect()}
    assert got == {i: [*v.toArray().tolist(), 1.0] for i, v in enumerate(vectors)}


def test_tagger_names_empty_input(spark):
    rows = _tagged_rows(spark)
    with pytest.raises(ValueError, match="no rows"):
        models.train_tagger(rows.where("id < 0"), features=8)
    with pytest.raises(ValueError, match="no labels"):
        models.train_tagger(rows.withColumn("tags_xf", F.lit(None).cast("array<int>")), features=8)


def test_tagger_beats_the_constant_from_the_first_step(spark):
    data = [(i, "alpha story" if i % 3 else "beta tale", "k", ["odd"] if i % 3 else ["even"]) for i in range(60)]
    df = spark.createDataFrame(data, "id int, synopsis string, keywords string, tags array<string>")
    rows = labels.fit_preprocess(df).transform(df, "id")
    losses = [models.log_loss(models.train_tagger(rows, features=32, max_iter=n).score(rows), "tags_xf", "scores").first() for n in (1, 10)]
    assert losses[1].model < losses[0].model < losses[0].constant == losses[1].constant


def test_vocabulary_text_of_several_files_keeps_file_order(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "v" / "b.txt").write_text("three\n\nfour\n")
    got = tables.read_vocab_text(spark, str(tmp_path / "v")).orderBy("idx").collect()
    assert [(r.token, r.idx) for r in got] == [("one", 0), ("two", 1), ("three", 2), ("four", 3)]


def test_default_encoder_has_a_fixed_size(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "id int, t string")
    out = models.apply_text_vectors(models.fit_text_vectors(df, "t", dim=16), df)
    assert out.columns == ["id", "t", "vec"] and all(len(r.vec) == 16 for r in out.collect())

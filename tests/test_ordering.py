import random

from pyspark.sql import functions as F

from tagloom.operators import ordering, relational


def test_row_ids_are_dense_and_ordered(spark):
    values = [f"w{i:04d}" for i in range(2000)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, random.Random(v).randint(0, 3)) for v in values], "token string, freq int").repartition(7)
    got = [(r.idx, r.freq, r.token) for r in ordering.with_row_id(df, F.desc("freq"), F.desc("token")).collect()]
    want = sorted(((f, t) for t, f in ((v, random.Random(v).randint(0, 3)) for v in values)), reverse=True)
    assert sorted(got) == [(i, f, t) for i, (f, t) in enumerate(want)]


def test_running_totals_with_a_hot_key(spark):
    data = [("hot" if i % 3 else f"k{i % 5}", i * 37 % 1009 / 1009, i % 4) for i in range(1009)]
    df = spark.createDataFrame(data, "k string, p double, n int").repartition(6)
    got = ordering.running_totals(df, ["k"], [F.desc("p")], {"total": F.col("n"), "place": F.lit(1)}).collect()
    assert len(got) == len(data)
    sums = {}
    for k, p, n in sorted(data, key=lambda r: (r[0], -r[1])):
        total, place = sums.get(k, (0, 0))
        sums[k] = (total + n, place + 1)
        assert any(r.k == k and r.p == p and (r.total, r.place) == sums[k] for r in got)


def test_head_and_tail_cover_all_rows(spark, rows):
    data = [(i % 7 and 1, i) for i in range(500)]
    df = spark.createDataFrame(data, "u int, t int")
    head = ordering.head_per_group(df, "u", [F.col("t")], 10)
    tail = ordering.tail_per_group(df, "u", [F.col("t")], 10)
    assert rows(head.union(tail)) == sorted(data, key=repr)
    assert head.count() == 20


def test_tail_with_ties_nulls_and_a_hot_key(spark, rows):
    data = [("hot" if i % 3 else None, i % 40 if i % 7 else None, i) for i in range(600)] + [("few", 1, 1), ("same", 5, 5)] + [("same", 5, 6)] * 30
    df = spark.createDataFrame(data, "u string, t int, v int").repartition(6)
    total = ordering.tail_per_group(df, "u", [F.col("t"), F.col("v")], 10)
    head = ordering.head_per_group(df, "u", [F.col("t"), F.col("v")], 10)
    assert rows(head.union(total)) == sorted(data, key=repr)
    tied = ordering.tail_per_group(df, "u", [F.col("t")], 10).collect()
    for u in ("hot", None, "few", "same"):
        mine = sorted((-1 if t is None else t) for k, t, _ in data if k == u)
        assert sorted((-1 if r.t is None else r.t) for r in tied if r.u == u) == mine[10:]


def test_chunks_join_to_the_cell(spark):
    """Copies, texts longer and shorter than a piece, an empty text, no text, and a third of all rows in one text."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abé🙂") for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["", "long " * 200, None]
    data = [(f"g{rng.randrange(3)}", rng.choice(texts)) for _ in range(400)] + [("g1", "again")] * 300 + [("none", None)]
    df = spark.createDataFrame(data, "k string, v string").repartition(5)
    for distinct in (False, True):
        for sep in (" ", ", ", ""):
            cells = {r.k: r.v for r in relational.string_agg(df, ["k"], "v", sep, distinct=distinct).collect()}
            got = {}
            for r in relational.text_chunks(df, ["k"], "v", sep, distinct=distinct, size=64).orderBy("k", "chunk").collect():
                assert len(r.v) <= 64 and r.chunk == len(got.setdefault(r.k, []))
                got[r.k].append(r.v)
            assert {k: "".join(v) for k, v in got.items()} == {k: v for k, v in cells.items() if v}
            plain = {k: sorted({v for x, v in data if x == k and v is not None} if distinct else [v for x, v in data if x == k and v is not None], key=lambda v: v.encode()) for k in cells}
            assert cells == {k: sep.join(v) if v else None for k, v in plain.items()}


def test_listed_values_is_the_long_form(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("b", None), ("b", 2)], "k string, v int")
    assert rows(relational.listed_values(df, ["k"], "v")) == [("a", 1, 1, 0), ("a", 3, 2, 1), ("b", 2, 1, 0)]


def test_first_per_key_uses_the_stated_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, t int")
    assert {tuple(r) for r in ordering.first_per_key(df, "k", [F.col("t")]).collect()} == {("a", 1), ("b", 5)}


def test_samples_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    assert rows(ordering.sample_keys(df, "k", 20)) == rows(ordering.sample_keys(df.repartition(9), "k", 20))
    assert rows(ordering.sample_rows(df, 20, ["id"])) == rows(ordering.sample_rows(df.repartition(3), 20, ["id"]))


def test_string_agg_keeps_or_drops_duplicates(spark, rows):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("n", None)], "k string, v string")
    assert rows(relational.string_agg(df, ["k"], "v", " ")) == [("g", "a b b"), ("n", None)]
    assert rows(relational.string_agg(df, ["k"], "v", " ", distinct=True)) == [("g", "a b"), ("n", None)]


def test_distinct_aggregates_skip_nulls(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("n", None)], "k string, v string")
    out = df.groupBy("k").agg(relational.distinct_array("v").alias("a"), relational.distinct_text("v", ",").alias("t"))
    assert {r.k: (r.a, r.t) for r in out.collect()} == {"g": (["a", "b"], "a,b"), "n": ([], None)}


def test_membership_join_ignores_duplicates(spark, rows):
    left = spark.createDataFrame([(1, ["x", "x", "y"]), (2, []), (3, None)], "id int, tags array<string>")
    right = spark.createDataFrame([("x", 10), ("y", 20), ("z", 30)], "label string, c int")
    out = relational.join_on_membership(left, "id", "tags", right, "label").select("id", "c")
    assert rows(out) == [(1, 10), (1, 20)]


def test_flags_histogram_union_and_top_values(spark, rows):
    df = spark.createDataFrame([("a", ["x", "x", "y"], [3, 10]), ("a", ["y"], [10, 2])], "k string, v array<string>, n array<bigint>")
    stats = relational.array_histogram(df, ["k"], "v").first()["stats"]
    assert [tuple(s) for s in stats] == [("x", 2), ("y", 2)]
    merged = relational.union_arrays(df, ["k"], ["v", "n"]).first()
    assert (merged["v"], merged["n"]) == (["x", "y"], [2, 3, 10])
    words = spark.createDataFrame([(w,) for w in "b b a a c"] + [(None,)], "w string").where("w <> ' ' or w is null")
    assert [tuple(r) for r in relational.top_values(words, "w", 2).collect()] == [("a", 2), ("b", 2)]
    assert rows(relational.keep_top_values(words, "w", 2)) == [("a",), ("a",), ("b",), ("b",)]
    flagged = relational.flag_members(words.dropna(), "w", words.where("w = 'c'"), "w")
    assert {tuple(r) for r in flagged.collect()} == {("a", False), ("b", False), ("c", True)}


def test_remap_and_case_free_join(spark, rows):
    df = spark.createDataFrame([("Docudrama",), ("Comedy",), (None,)], "t string")
    assert rows(df.select(relational.remap_values(F.col("t"), {"Docudrama": "Drama"}))) == [("Comedy",), ("Drama",), (None,)]
    left, right = spark.createDataFrame([("ÄB",)], "a string"), spark.createDataFrame([("äb",), ("x",)], "b string")
    assert rows(relational.join_ci(left, right, "a", "b")) == [("ÄB", "äb")]


def test_vector_sums_and_means(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 5.0])], "k int, v array<double>")
    assert {r.k: r.v for r in relational.sum_vectors(df, ["k"], "v").collect()} == {1: [4.0, 6.0], 2: [5.0, 5.0]}
    assert {r.k: r.v for r in relational.mean_vectors(df, ["k"], "v").collect()} == {1: [2.0, 3.0], 2: [5.0, 5.0]}

import pytest
from pyspark.sql import functions as F

from tagloom.plans import catalogue as plans

VIEW = "TitleDetails_title string, TitleType string, TitleDetails_longsynopsis string, TitleGenre string, TitleSubgenres string, TitleTags string, LANGUAGE string, TitleId string, InSeasonSeries_Id string"
PROGRAM = "program_title string, program_val string, program_longsynopsis string, program_type string, program_language string, program_seriesid string"
TAGS = "program_id string, tag_type string, tag_value string"
TRAINING = "program_title string, program_type string, program_language string, program_longsynopsis string, keywords array<string>, tags array<string>"


@pytest.fixture()
def ids(spark):
    return spark.createDataFrame([("THE SHOW", 1), ("The Show", 1), ("Other", 2), ("Other", 3), ("None", None)], "program_title string, content_ordinal_id bigint")


def view(spark, *rows):
    return spark.createDataFrame([tuple(r) + (None,) * (9 - len(r)) for r in rows], VIEW)


def test_training_rows(spark):
    df = spark.createDataFrame([
        ("t", "Movie", "eng", "a b c d", ["k2", "k1", "k1"], ["y"]),
        ("t", "Movie", "eng", "a b c d", ["k3", None], ["x"]),
        ("t", "Movie", "eng", "other", [], ["x"]),
        (None, "Movie", "eng", "third", [None], ["z"]),
    ], TRAINING)
    got = {r.synopsis: (r.keywords, r.tags) for r in plans.training_rows(df, token_limit=3).collect()}
    assert got == {"a b c": ("k1 k1 k2 k3", ["x"]), "third": (None, ["z"])}
    assert plans.training_rows(df, test_limit=1).count() == 1


def test_a_hot_programme_keeps_all_its_keywords(spark):
    df = spark.range(3000).select(
        F.lit("t").alias("program_title"), F.lit("Movie").alias("program_type"), F.lit("eng").alias("program_language"),
        F.lit("same text").alias("program_longsynopsis"), F.array(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).alias("keywords"), F.array(F.lit("x")).alias("tags"))
    text = plans.training_rows(df).first()["keywords"].split(" ")
    assert (len(text), text.count("k0"), text == sorted(text)) == (3000, 1000, True)


def test_keywords_travel_as_whole_arrays(spark):
    df = spark.createDataFrame([("t", "Movie", "eng", "a", ["k2", "k1", "k1"], ["x"])] * 3 + [("t", "Movie", "eng", "a", ["k1", None, "k3"], ["w"])], TRAINING)
    out = plans.training_rows(df)
    assert [tuple(r) for r in out.collect()] == [("a", " ".join(["k1"] * 7 + ["k2"] * 3 + ["k3"]), ["w"])]
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_tag_build(spark):
    programs = spark.createDataFrame([
        ("A", "1", "s1", "Movie", "eng", None), ("A", "1", "s1", "Episode", "spa", None), ("B", "2", "s2", "Movie", "eng", None),
        ("C", "3", "s3", "Movie", "ger", None), ("D", "4", None, "Movie", "eng", None), ("E", "5", "s5", "Movie", "eng", "series"),
        ("Movie", "6", "s6", "Movie", "eng", None), (None, "7", "s7", "Movie", "eng", None),
    ], PROGRAM)
    tags = spark.createDataFrame([
        ("1", "Genre", "Docudrama"), ("1", "Audience", "big kids (ages 8-9)"), ("1", "Audience", "little kids (ages 5-7)"), ("1", "Genre", "Rare"),
        ("9", "Genre", "Documentary drama"), ("8", "Genre", "Comedy"), ("9", "Genre", "Comedy"), ("3", "Genre", "Comedy"), ("7", "Genre", "Comedy"),
    ], TAGS)
    got = [tuple(r) for r in plans.tag_training_rows(programs, tags, top_genres=2).collect()]
    assert got == [("A", "1", "s1", ["Documentary drama", "Episode", "Movie", "eng", "kids (ages 5-9)", "spa"])]


def test_titles(spark, ids, rows):
    cat = view(spark, ("the show", "Movie", "s b"), ("the show", "Movie", "s a"), ("the show", "Movie", "s a"), ("the show", "Programme", "p"),
               ("Other", "Movie", "o"), ("Missing", "Movie", "m"), ("Other", "Movie", None))
    got = rows(plans.titles_merged(cat, ids))
    assert got == sorted([("the show", "Movie", "s a s b", 1), ("the show", "Programme", "p", 1), ("Other", "Movie", "o", 2), ("Other", "Movie", "o", 3)], key=repr)
    assert {r.title for r in plans.titles_lower(cat, ids).collect()} == {"the show", "other"}


def test_tokens_skip_the_first_and_lose_the_default(spark, ids):
    vocab = spark.createDataFrame([(w,) for w in ["a", "b", "c", "c"]], "tokens string")
    cat = view(spark, ("the show", "Movie", "a b c zz"), ("Other", "Movie", "zz a"))
    got = plans.titles_tokens(cat, ids, vocab)
    # offsets from 1: "a" opens the synopsis and is skipped, then "b" opens the token list and is skipped
    assert {r.TitleDetails_title: r.tokens for r in got.collect()} == {"the show": ["c"]}
    whole = plans.titles_tokens(cat, ids, vocab, skip_first=False)
    assert {r.TitleDetails_title: r.tokens for r in whole.collect()} == {"the show": ["a", "b", "c"], "Other": ["a"]}
    none = plans.titles_tokens(view(spark, ("Other", "Movie", "zz zz")), ids, vocab, skip_first=False)
    assert {tuple(r.tokens) for r in none.collect()} == {("TV",)}


def test_long_synopsis_keeps_256_tokens_after_the_first(spark, ids):
    words = [f"w{i:03d}" for i in range(400)]
    vocab = spark.createDataFrame([(w,) for w in words], "tokens string")
    got = plans.titles_tokens(view(spark, ("the show", "Movie", " ".join(words))), ids, vocab).first()["tokens"]
    assert got == words[2:66]


def test_keywords_with_exact_titles(spark, ids):
    vocab = spark.createDataFrame([("a",), ("b",), ("c",)], "tokens string")
    cat = view(spark, ("The Show", "Movie", "x a b c", None, None, " t1,t2 "), ("the show", "Movie", "x a b c"), ("Other", "Movie", "x a b c"))
    got = {r.TitleDetails_title: r.keywords for r in plans.titles_tokens_keywords(cat, ids, vocab).collect()}
    assert got == {"The Show": ["movie", "t1", "t2"], "Other": None}


def test_keyword_text(spark, ids):
    cat = view(spark, ("the show", "Movie", "s2", "Drama", "b ,a", None, "und"), ("the show", "Movie", "s1", "Drama", " ", "", "eng"), ("Other", "Movie", "s", None, None, None, "und"))
    got = {r.TitleDetails_title: (r.keywords, r.TitleDetails_longsynopsis) for r in plans.titles_keywords(cat, ids).collect()}
    assert got == {"the show": (" Drama a b eng", "s1 s2"), "Other": (None, "s")}


def test_keyword_text_of_a_hot_title_equals_the_whole(spark, ids):
    cat = spark.range(1500).select(
        F.lit("the show").alias("TitleDetails_title"), F.lit("Movie").alias("TitleType"),
        F.concat(F.lit("text "), F.lpad(F.col("id").cast("string"), 4, "0")).alias("TitleDetails_longsynopsis"),
        F.concat(F.lit("g"), F.lpad((F.col("id") % 700).cast("string"), 3, "0")).alias("TitleGenre"),
        *[F.lit(None).cast("string").alias(c) for c in ("TitleSubgenres", "TitleTags", "LANGUAGE")])
    row = plans.titles_keywords(cat, ids).first()
    assert row.keywords == " ".join(f"g{i:03d}" for i in range(256))
    assert row.TitleDetails_longsynopsis == " ".join(f"text {i:04d}" for i in range(128))


def test_series_ids(spark, ids):
    cat = spark.createDataFrame([
        ("the show", "Movie", "s", None, None, None, None, "T1", "S1"), ("the show", "Movie", "s", None, None, None, None, "T2", None),
    ], VIEW)
    assert plans.titles_series_ids(cat, ids).first()["InSeasonSeries_Id"] == ["S1", "T2"]
    training = spark.createDataFrame([("The Show", "Movie", "eng", "x", [], []), ("Q", "Movie", "eng", "x", [], [])], TRAINING)
    got = {r.program_title: (r.InSeasonSeries_Id, r.titles_length) for r in plans.training_series_ids(training, cat).collect()}
    assert got == {"The Show": (["S1", "T2"], 2), "Q": (["movie"], 0)}


def test_range_selects_users_not_plays(spark):
    plays = spark.sql("""
        SELECT 'u' AS user_ordinal_id, date'2021-02-03' AS session_date, timestamp'2021-02-03 10:00:00' AS session_timestamp,
               transform(sequence(1, 16), i -> named_struct('content_id', cast(i AS bigint))) AS session_sequence
        UNION ALL SELECT 'u', date'2020-01-01', timestamp'2020-01-01 10:00:00', array(named_struct('content_id', 99L))
        UNION ALL SELECT 'v', date'2021-02-03', timestamp'2021-02-03 10:00:00', transform(sequence(1, 15), i -> named_struct('content_id', cast(i AS bigint)))""")
    got = plans.users_plays(plays)
    assert (got.count(), got.select("user_ordinal_id").distinct().count(), got.where("content_id = 99").count()) == (17, 1, 1)
    assert plans.users_plays(plays, restrict_plays=True).count() == 16


def test_catalogue_tags_keep_duplicate_texts(spark):
    cat = view(spark, ("A", "Movie", "s", "g", None, "b, a", "eng"), ("a", "Movie", "s", "g", None, "", "eng"), ("a", "Movie", None, "g", None, None, "fre"))
    assert [tuple(r) for r in plans.catalogue_tags(cat).collect()] == [("A", "Movie", "eng", "s s", ["a", "b", "eng", "g"])]


def test_full_tags(spark, rows):
    programs = spark.createDataFrame([
        ("M", "1", "s", "Movie", "eng", None), ("M", "2", "s", "Movie", "eng", None), ("N", "3", "s", "Movie", "eng", None),
        ("S", "4", "b", "Episode", "eng", "x"), ("S", "5", "a", "SeriesMaster", "eng", None),
    ], PROGRAM)
    tags = spark.createDataFrame([("1", "Genre", "g1"), ("2", "Other", "o1"), ("2", "Other", "not in vocab"), ("4", "KidsTheme", "k"), ("5", "x", "zz")], TAGS)
    vocab = spark.createDataFrame([("g1",), ("o1",), ("k",), ("k",)], "tokens string")
    want = [("Episode", "S", "a b", "eng", ["Episode", "eng", "k"]), ("Movie", "M", "s", "eng", ["Movie", "eng", "g1", "o1"])]
    assert rows(plans.full_tags(programs, tags, vocab)) == want
    with_genre = {r.program_title: r.genre for r in plans.full_tags(programs, tags, vocab, with_genre=True).collect()}
    assert with_genre == {"M": ["g1"], "S": ["k"]}


def test_full_tags_build_movies_and_series_in_one_pass(spark, rows):
    programs = spark.createDataFrame([
        ("A", "1", "s", "Movie", "eng", None), ("A", "1", "s", "Movie", "eng", None), ("A", "2", "t", "Movie", "eng", None), ("A", "3", "s", "Episode", "eng", None),
        ("A", "4", "q", "Episode", "eng", None), ("A", "5", "s", "Movie", "eng", "x"), ("OnDemand Movie", "6", "s", "Movie", "eng", None), (None, "7", "s", "Movie", "eng", None),
        (None, "8", "z", "Episode", "spa", None), ("A", "9", "s", None, "eng", None), ("A", None, "s", "Movie", "eng", None),
    ], PROGRAM)
    tags = spark.createDataFrame([
        (str(i), kind, tag) for i in (1, 2, 3, 5, 6, 7, 8, 9) for kind, tag in (("Genre", "g"), ("Other", "g"), (None, "not for kids"), (None, "n"))
    ] + [("2", "Other", "only"), ("4", "Other", "absent"), (None, "Genre", "lost")], TAGS)
    vocab = spark.createDataFrame([("g",), ("n",), ("not for kids",), ("only",), ("lost",)], "tokens string")
    out = plans.full_tags(programs, tags, vocab, with_genre=True)
    genre, words = ["g", "not for kids"], ["eng", "g", "n", "not for kids"]
    assert rows(out) == sorted([
        ("Episode", "A", "q s", "eng", genre, ["Episode", *words]), ("Movie", "A", "s", "eng", genre, ["Movie", *words]),
        ("Movie", "A", "t", "eng", genre, ["Movie", *words, "only"]), ("Episode", None, "z", "spa", genre, ["Episode", "g", "n", "not for kids", "spa"]),
    ], key=repr)
    assert rows(out.drop("genre")) == rows(plans.full_tags(programs, tags, vocab))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 4


def test_a_title_with_all_training_rows_is_spread(spark):
    df = spark.range(400).selectExpr("'The Show' AS program_title", "'Movie' AS program_type", "CAST(id AS string) AS program_longsynopsis", "array('x') AS tags")
    cat = view(spark, ("the show", "Movie", "s", None, None, None, "eng", "T1", "S2"), ("The show", "Movie", "s", None, None, None, "eng", "T1"), ("Other", "Movie", "s"))
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        found = plans.training_series_ids(df, cat).withColumn("at", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted((r.program_longsynopsis, r.InSeasonSeries_Id) for r in found) == sorted((str(i), [sid]) for i in range(400) for sid in ("S2", "T1"))
    assert len({r.at for r in found}) > 1


def test_cluster_map_and_stats(spark, rows):
    training = spark.createDataFrame([
        ("T", "Movie", "eng", "s", ["k1", "k1"], ["t1"]), ("t", "Movie", "eng", "s", ["k2"], []), ("X", "Movie", "eng", "s", ["?"], ["?"]),
    ], TRAINING)
    mapping = spark.createDataFrame([("k1", "c", 1), ("k2", "c", 1), ("t1", "d", 2)], "word string, centroid_word string, cluster int")
    got = plans.cluster_map(training, mapping, arrays=("tags", "keywords"))
    assert rows(got.select("program_title", "tags")) == [("T", ["c", "d"]), ("t", ["c"])]
    kept = plans.cluster_map(training.withColumn("genre", F.array(F.lit("g"))).withColumn("old", F.col("keywords")), mapping, arrays=("keywords",), keep=("genre", "old"), guard=True)
    assert rows(kept.select("program_title", "genre", "old", "tags")) == [("T", ["g"], ["k1", "k1"], ["c"]), ("t", ["g"], ["k2"], ["c"])]
    stats = plans.cluster_stats(training, mapping).first()
    assert (stats.program_title, stats.cluster, [tuple(s) for s in stats.stats]) == ("T", [1, 2], [("c", 2), ("d", 1)])


def test_words_union_and_pieces(spark, rows):
    training = spark.createDataFrame([("T", "Movie", "eng", "s", ["k1", "eng"], ["t1"]), ("t", "Movie", "eng", "r", None, ["k1"])], TRAINING)
    assert rows(plans.words_distinct(training)) == [("k1",), ("t1",)]
    assert [tuple(r) for r in plans.titles_union(training).collect()] == [("T", "r", ["k1", "t1"])]
    pieces = plans.title_pieces(view(spark, ("A", "Movie", "s", None, "x , y", "z,,"), ("B", "Movie", "s")), "A").first()
    assert (pieces.subgenres, pieces.title_tags) == (["x", "y"], ["", "z"])


def test_title_keyword_index(spark, ids, rows):
    training = spark.createDataFrame([("The Show", "Movie", "eng", "s", ["b", "zz"], [])], TRAINING)
    cat = view(spark, ("the show", "Movie", "s", None, "a", "b"), ("Other", "Movie", "s"))
    vocab = spark.createDataFrame([("a",), ("b",), ("movie",)], "tokens string")
    assert rows(plans.title_keyword_index(training, cat, ids, vocab)) == [("other", ["movie"], [3]), ("the show", ["a", "b"], [1, 2])]

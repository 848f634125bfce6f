import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import text
from tagloom.functions.text import LETTERS


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


def reference_clean(value, strip_first):
    """The cleaning steps written out one after the other."""
    s = re.sub(f"[^{LETTERS}]", " ", value.lower())
    drop = lambda v: re.sub(rf"((^|\s)[{LETTERS}]{{1}})+\s", " ", v)
    s = drop(s.strip(" ")) if strip_first else drop(s).strip(" ")
    return re.sub(" +", " ", s)


@pytest.mark.parametrize("strip_first", [True, False])
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aBäß  .1\nx", max_size=30), min_size=20, max_size=40))
def test_clean_matches_steps(spark, strip_first, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(text.clean_text(F.col("x"), strip_first)).collect()]
    assert got == [reference_clean(v, strip_first) for v in values]


def test_clean_orders_differ_at_edges(spark):
    assert one(spark, "a word", lambda c: text.clean_text(c, True)) == " word"
    assert one(spark, " a word", lambda c: text.clean_text(c, False)) == "word"
    assert one(spark, "Während, eine ü!", lambda c: text.clean_text(c, False)) == "während eine"


def test_a_long_run_of_short_words_is_dropped_whole(spark):
    # in the executor's own threads, whose stacks are small
    df = spark.createDataFrame([("a bc " * 100_000 + "word is", 1), ("in\tan  o lot", 2)], "x string, n int").repartition(2, "n")
    got = {r["n"]: r["y"] for r in df.select("n", text.drop_short_words(F.col("x"), 3).alias("y")).collect()}
    assert got == {1: " word is", 2: "  lot"}


def test_first_tokens_keeps_empty_pieces(spark):
    assert one(spark, "a  b c", lambda c: text.first_tokens(c, 3)) == "a  b"
    assert one(spark, "a.b.c", lambda c: text.split_on(c, ".")) == ["a", "b", "c"]


def test_offsets_start_at_one(spark):
    words = [str(i) for i in range(300)]
    assert one(spark, words, lambda c: text.offset_window(c, 256), "array<string>") == words[1:257]
    assert one(spark, words, lambda c: text.offset_window(c, 256, skip_first=False), "array<string>") == words[:256]
    assert one(spark, ["TV"], lambda c: text.offset_window(c, 64), "array<string>") == []


def test_strip_drops_before_trimming(spark):
    messy = ["", " ", "und", " a ", "a", None, "\tb", " und"]
    assert one(spark, messy, text.strip_to_string, "array<string>") == " a b und"
    assert one(spark, messy, text.strip_to_array, "array<string>") == ["", "a", "b", "und"]
    assert one(spark, [""], text.strip_to_array, "array<string>") is None


def test_defaults_and_padding(spark):
    assert one(spark, None, lambda c: text.default_array(c, ["TV"]), "array<string>") == ["TV"]
    assert one(spark, [], lambda c: text.default_array(c, ["TV"]), "array<string>") == ["TV"]
    assert one(spark, [5, 6, 7], lambda c: text.pad_indices(c, 2), "array<int>") == [5, 6]
    assert one(spark, [5], lambda c: text.pad_indices(c, 3), "array<int>") == [5, -1, -1]
    assert one(spark, "aa bb", lambda c: text.tokenize_pad(c, 4)) == ["aa", "bb", "", ""]


def test_list_literals_are_parsed_not_run(spark):
    assert one(spark, "['a', \"it's\"]", text.parse_list) == ["a", "it's"]
    assert one(spark, "__import__('os')", text.parse_list) is None


def test_trim_takes_every_white_space(spark):
    assert one(spark, "\t x y\n ", text.trim_ws) == "x y"


def test_date_range_takes_short_months(spark):
    df = spark.sql("SELECT explode(array(date'2021-01-31', date'2021-02-01', date'2021-03-31', date'2021-04-01')) AS d")
    assert [str(r.d) for r in df.where(text.in_dates(F.col("d"), "2021-2-01", "2021-4-01")).collect()] == ["2021-02-01", "2021-03-31"]


def test_join_texts_keeps_separators(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(text.join_texts(F.col("x"), F.col("y"), F.col("z"))).first()[0] == "a  c"


def test_short_words_up_to_three(spark):
    assert one(spark, "ab abc abcd ef ", lambda c: text.drop_short_words(c, 3)) == " abcd "

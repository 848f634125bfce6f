"""Exact nearest rows by the cosine of their tag sets, through an inverted index (Q-RAW-C2C).

Rows of equal tags are one class. Tags fall into two kinds by the number of classes that hold them. Classes that share a rare
tag meet in its posting list, and their overlap is taken in full. What remains are classes that share common tags only: seen
by these alone, classes fall into profiles (their common tags and size), vectors of at most ``dense`` components, which
:func:`similarity.cosine_topk` ranks by block bounds. A profile's score never exceeds that of its classes, so the n best ids
of both lists together are the n best of all. No vector has the vocabulary's length, and a row that shares nothing with any is
ranked without being met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.vectors import multi_hot
from tagloom.operators.ordering import head_per_group
from tagloom.operators.similarity import cosine_topk
from tagloom.session import cut_lineage

COMMON, DENSE = 256, 512
_DIGITS = 12  # as the scores of vectors


def _least(rows: DataFrame, key: str, n: int) -> DataFrame:
    """(key, ids): the ``n`` least ids of every key."""
    return head_per_group(rows.select(key, "id"), key, [F.asc("id")], n).groupBy(key).agg(F.sort_array(F.collect_list("id")).alias("ids"))


def _best(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` best (match_id, score) of every key."""
    return head_per_group(rows.select(key, "match_id", "score"), key, [F.desc("score"), F.asc("match_id")], n)


def _name(*parts: Column) -> Column:
    """A digest of sizes and sorted members."""
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def _by_rare_tags(classes: DataFrame, postings: DataFrame, common: DataFrame, n: int) -> DataFrame:
    """(cls, match_id, score): the best of the classes that share a tag beyond the common ones with a class."""
    rare = cut_lineage(postings.join(F.broadcast(common.select("tag")), "tag", "left_anti"))  # at most `dense` rows
    other = rare.select("tag", F.col("cls").alias("other"))
    pairs = rare.join(other, "tag").select("cls", "other").distinct()
    sides = pairs.join(classes.select("cls", "m", "tags"), "cls").join(classes.select(F.col("cls").alias("other"), F.col("m").alias("_m"), F.col("tags").alias("_tags"), "ids"), "other")
    overlap = F.size(F.array_intersect("tags", "_tags"))
    scored = sides.select("cls", "ids", F.round(overlap / (F.sqrt("m") * F.sqrt("_m")), _DIGITS).alias("score"))
    return _best(scored.select("cls", F.explode("ids").alias("match_id"), "score"), "cls", n)


def _by_common_tags(classes: DataFrame, postings: DataFrame, common: DataFrame, size: int, n: int, block_rows: int | None) -> tuple[DataFrame, DataFrame]:
    """((cls, profile), (profile, match_id, score)): the best of all classes by their common tags alone."""
    held = postings.join(F.broadcast(common), "tag").groupBy(F.col("cls").alias("_cls")).agg(F.sort_array(F.collect_list("idx")).alias("at"))
    seen = classes.join(held, F.col("cls") == F.col("_cls"), "left").withColumn("at", F.coalesce("at", F.array().cast("array<int>")))
    seen = cut_lineage(seen.withColumn("profile", _name(F.col("m"), F.col("at"))).select("cls", "profile", "m", "at", "ids"))
    least = _least(seen.select("profile", F.explode("ids").alias("id")), "profile", n)
    profiles = cut_lineage(seen.groupBy("profile").agg(F.min("m").alias("m"), F.min("at").alias("at")).join(least, "profile"))
    # vectors of length 1: what the common tags leave lies on an axis that no other side has
    rest = F.sqrt(1 - F.size("at") / F.col("m"))
    part = F.transform(multi_hot(F.col("at"), size), lambda x: x / F.sqrt("m"))
    left = profiles.select(F.col("profile").alias("id"), F.concat(part, F.array(rest, F.lit(0.0))).alias("vec"))
    right = profiles.select(F.col("ids")[0].alias("first"), F.concat(part, F.array(F.lit(0.0), rest)).alias("vec"))
    near = cosine_topk(left, right, n, right_id="first", block_rows=block_rows)
    named = near.join(profiles.select(F.col("ids")[0].alias("match_id"), "ids"), "match_id")
    lists = _best(named.select(F.col("id").alias("profile"), F.explode("ids").alias("match_id"), "score"), "profile", n)
    return seen.select("cls", "profile"), lists


def nearest_by_tags(
    rows: DataFrame, n: int, id_col: str = "id", tags: str = "tags", common: int = COMMON, dense: int = DENSE, block_rows: int | None = None,
) -> DataFrame:
    """Each row's ``n`` nearest other rows by the cosine of their tag sets: (id, rank, match_id, score), exact. Runs jobs.

    Ids are unique. Ties go to the smaller ``match_id``. Null and empty tags and repeats do not count. Without a common tag the score is
    0; a row without tags scores -1 with every row. Tags of more than ``common`` classes, at most ``dense`` of them, are met as
    vectors, all others in posting lists.
    """
    sound = F.array_sort(F.array_distinct(F.filter(F.col(tags), lambda t: t.isNotNull() & (t != ""))))
    base = cut_lineage(rows.select(F.col(id_col).alias("id"), F.coalesce(sound, F.array().cast("array<string>")).alias("tags")).withColumn("m", F.size("tags")))
    need = n + 1  # a row's own id may be among them
    keyed = cut_lineage(base.where("m > 0").withColumn("cls", _name(F.col("tags"))))
    classes = cut_lineage(keyed.groupBy("cls").agg(F.min("m").alias("m"), F.min("tags").alias("tags")).join(_least(keyed, "cls", need), "cls"))
    postings = classes.select("cls", F.explode("tags").alias("tag"))
    top = postings.groupBy("tag").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > common).orderBy(F.desc("df"), "tag").limit(dense)
    top = cut_lineage(top.select("tag", (F.row_number().over(W.orderBy(F.desc("df"), "tag")) - 1).alias("idx")))  # a window over at most `dense` rows

    rare = _by_rare_tags(classes, postings, top, need)
    profile, lists = _by_common_tags(classes, postings, top, top.count(), need, block_rows)
    met = rare.unionByName(profile.join(lists, "profile").select("cls", "match_id", "score"))
    best = _best(met.groupBy("cls", "match_id").agg(F.max("score").alias("score")), "cls", need)
    found = keyed.select("id", "cls").join(cut_lineage(best), "cls").select("id", "match_id", "score")
    # rows without tags: the last of every list, and all alike to each other
    blank = base.where("m = 0").select("id")
    group = F.lit(0).alias("_g")
    fill = _least(blank.select(group, "id"), "_g", need).select("_g", F.explode("ids").alias("match_id"))
    every = _least(base.select(group, "id"), "_g", need).select("_g", F.explode("ids").alias("match_id"))
    short = found.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < need).select(group, "id")
    last = short.join(fill, "_g").unionByName(blank.select(group, "id").join(every, "_g"))
    out = found.unionByName(last.select("id", "match_id", F.lit(-1.0).alias("score"))).where(F.col("id") != F.col("match_id"))
    return head_per_group(out, "id", [F.desc("score"), F.asc("match_id")], n, "rank").select("id", "rank", "match_id", "score")

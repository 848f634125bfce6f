"""Recommendations from item vectors and their offline evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators import similarity
from tagloom.operators.ordering import head_per_group
from tagloom.operators.relational import distinct_apart, share_matching, side_by_side, sum_vectors
from tagloom.session import cut_lineage

# Fixed values of the evaluation: plays in a profile, plays to predict, list lengths.
HISTORY = 10
TEST = 5
TOP = (1, 5, 10)


def content_to_content(items: DataFrame, n: int = 10, id_col: str = "id", vec: str = "vec", by: str | None = None, **options) -> DataFrame:
    """Each item's ``n`` most similar other items: (id, rank, match_id, score).

    The item itself is left out by its id, not by its position in the ranking, so items with equal
    vectors keep each other. ``by`` ranks several models' vectors in one run (R21).
    """
    return similarity.cosine_topk(items, items, n, id_col=id_col, vec=vec, exclude_self=True, by=by, **options)


def recommendations_for(asked: DataFrame, items: DataFrame, n: int = 10, id_col: str = "id", vec: str = "vec", **options) -> DataFrame:
    """As :func:`content_to_content` for some items only, ranked against all: what is not asked for is not scored."""
    return similarity.cosine_topk(asked, items, n, id_col=id_col, vec=vec, right_id=id_col, right_vec=vec, exclude_self=True, **options)


def describe_recommendations(recs: DataFrame, items: DataFrame, id_col: str, about: Sequence[str]) -> DataFrame:
    """Add the ``about`` columns of the query and the result item as ``query_*`` and ``result_*``."""
    query = items.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"query_{c}") for c in about])
    result = items.select(F.col(id_col).alias("match_id"), *[F.col(c).alias(f"result_{c}") for c in about])
    return recs.join(query, "id").join(result, "match_id")


def type_match(recs: DataFrame, items: DataFrame, id_col: str = "id", type_col: str = "type") -> DataFrame:
    """Share of an item's recommendations that have its type."""
    named = describe_recommendations(recs, items, id_col, [type_col])
    return share_matching(named, ["id"], f"query_{type_col}", f"result_{type_col}", "type_match")


def export_recommendations(
    recs: DataFrame, items: DataFrame, id_col: str, title: str, about: Sequence[str], titles: Sequence[str] | None = None
) -> DataFrame:
    """Flat recommendation rows, of the listed titles only when given.

    A title list filters before the joins, so only the asked-for rows are described.
    """
    if titles is not None:
        asked = items.where(F.col(title).isin(*titles)).select(F.col(id_col).alias("id"))
        recs = recs.join(asked.distinct(), "id", "left_semi")
    named = describe_recommendations(recs, items, id_col, [title, *about])
    order = [f"query_{c}" for c in (title, *about)]
    return named.select(
        F.col("id").alias("query_id"), *order, F.col("rank").alias("result_rank"), F.col("match_id").alias("result_id"),
        *[f"result_{c}" for c in (title, *about)], "score",
    )


def plays_of_items(
    plays: DataFrame, items: DataFrame, content: str = "content_id", item: str = "item", item_content: str = "content_id"
) -> DataFrame:
    """Plays joined to the items they refer to, with the item's id as ``item``.

    Vectors are joined later, to the few plays that need them. Items that share a content id multiply
    its plays; :func:`history_and_test` reaches the same histories without that.
    """
    ids = items.select(F.col(item).alias("item"), F.col(item_content).alias("_item_content"))
    return plays.join(ids, F.col(content) == F.col("_item_content")).drop("_item_content")


def plays_with_items(plays: DataFrame, items: DataFrame, content: str = "content_id", item_content: str = "content_id") -> DataFrame:
    """Plays that refer to at least one item."""
    return plays.join(distinct_apart(items, F.col(item_content).alias("_known")), F.col(content) == F.col("_known"), "left_semi")


def first_rows_with_items(
    first: DataFrame, items: DataFrame, history: int = HISTORY, user: str = "user_id", content: str = "content_id",
    order: Sequence[str] = ("ts",), item: str = "item", item_content: str = "content_id",
) -> DataFrame:
    """The first ``history`` (play, item) rows per user, from each user's first plays.

    A content's first ``history`` items are all that can be reached, so items that share a content id
    multiply a play by at most that many.
    """
    ids = items.select(F.col(item).alias("item"), F.col(item_content).alias("_item_content"))
    reachable = head_per_group(ids, "_item_content", [F.col("item")], history)
    rows = first.join(reachable, F.col(content) == F.col("_item_content")).drop("_item_content")
    return head_per_group(rows, user, [*[F.col(c) for c in order], F.col(content), F.col("item")], history)


def history_and_test(
    plays: DataFrame, history: int = HISTORY, test: int = TEST, user: str = "user_id", content: str = "content_id",
    order: Sequence[str] = ("ts",), items: DataFrame | None = None, store: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Each user's first ``history`` plays, and the next ``test`` distinct contents outside them.

    With ``items``, the history is the first ``history`` rows of the plays joined to their items, with
    the item's id as ``item``; the large plays are only filtered, never multiplied. ``store`` writes
    the history to the checkpoint folder, as it is used twice.

    A later content's place is its first play after the history. A content outside the history was
    never played in it, so that first play is simply the content's first play: one combined minimum
    per (user, content) replaces a window over all plays of a user, which a heavy user would put into
    one task.
    """
    sequence = [F.col(c) for c in order]
    if items is not None:
        plays = plays_with_items(plays, items, content)
    first = head_per_group(plays, user, [*sequence, F.col(content)], history)
    if items is not None:
        first = first_rows_with_items(first, items, history, user, content, order)
    if store:
        first = cut_lineage(first)
    seen = first.select(F.col(user).alias("_user"), F.col(content).alias("_content")).distinct()
    # grouped by the pair as one value: plays that come from a join on the content are arranged by it, and
    # Spark would then leave a popular content's plays in one task instead of combining and spreading them
    pair = F.struct(F.col(user).alias("_user"), F.col(content).alias("_content")).alias("_pair")
    earliest = plays.groupBy(pair).agg(F.min(sequence[0] if len(order) == 1 else F.struct(*sequence)).alias("_first"))
    unseen = earliest.select("_pair.*", "_first").join(seen, ["_user", "_content"], "left_anti")
    later = head_per_group(unseen, "_user", [F.col("_first"), F.col("_content")], test)
    times = [F.col("_first").alias(order[0])] if len(order) == 1 else [F.col("_first")[c].alias(c) for c in order]
    return first, later.select(F.col("_user").alias(user), F.col("_content").alias(content), *times)


def user_profiles(
    history: DataFrame, items: DataFrame, window: int = HISTORY, user: str = "user_id", item: str = "item", vec: str = "vec",
) -> DataFrame:
    """(user, vec): the sum of a user's history vectors divided by ``window``, also for shorter histories."""
    vectors = items.select(F.col(item).alias("_item"), F.col(vec).alias("vec"))
    rows = history.select(user, F.col("item").alias("_item")).join(vectors, "_item")
    sums = sum_vectors(rows, [user], "vec")
    return sums.select(user, F.transform("vec", lambda x: x / F.lit(float(window))).alias("vec"))


def recommend_unseen(
    profiles: DataFrame, items: DataFrame, history: DataFrame, n: int = max(TOP), user: str = "user_id",
    content: str = "content_id", item: str = "item", item_content: str = "content_id", **options,
) -> DataFrame:
    """Each user's ``n`` best items, seen contents last with score -1.

    Returns (user, rank, item, content, score). A user's seen contents, at most one history long,
    travel with the profile and are masked where the scores are made; no score matrix is kept.
    """
    seen = history.groupBy(F.col(user).alias("_user")).agg(F.collect_set(content).alias("_seen"))
    left = profiles.join(seen, F.col(user) == F.col("_user"), "left").drop("_user")
    best = similarity.cosine_topk(left, items, n, id_col=user, right_id=item, hidden="_seen", label=item_content, **options)
    contents = items.select(F.col(item).alias("match_id"), F.col(item_content).alias("content"))
    named = best.join(contents, "match_id")
    return named.select(F.col("id").alias(user), "rank", F.col("match_id").alias("item"), "content", "score")


def user_results(recs: DataFrame, test: DataFrame, ns: Sequence[int] = TOP, user: str = "user_id", content: str = "content_id") -> DataFrame:
    """Per user with test items: test size and, per list length, hits, precision and recall.

    Lists and test items count as sets of content ids.
    """
    wanted = test.select(F.col(user).alias("user"), F.col(content).alias("content")).distinct()
    sizes = wanted.groupBy("user").agg(F.count(F.lit(1)).alias("n_test"))
    listed = recs.groupBy(F.col(user).alias("user"), "content").agg(F.min("rank").alias("rank"))
    hits = listed.join(wanted, ["user", "content"]).groupBy("user").agg(*[F.count_if(F.col("rank") <= n).alias(f"hits_{n}") for n in ns])
    # users without a recommendation list do not occur in the lists' side and add nothing
    users = listed.select("user").distinct()
    rows = sizes.join(users, "user", "left_semi").join(hits, "user", "left")
    out = rows.select("user", "n_test", *[F.coalesce(f"hits_{n}", F.lit(0)).alias(f"hits_{n}") for n in ns])
    return out.select(
        F.col("user").alias(user), "n_test", *[f"hits_{n}" for n in ns],
        *[(F.col(f"hits_{n}") / F.lit(n)).alias(f"precision_{n}") for n in ns],
        *[(F.col(f"hits_{n}") / F.col("n_test")).alias(f"recall_{n}") for n in ns],
    )


def ranking_metrics(
    recs: DataFrame, test: DataFrame, users: DataFrame, ns: Sequence[int] = TOP, user: str = "user_id", content: str = "content_id",
) -> DataFrame:
    """One row with ``total`` and Precision/Recall/Accuracy/Coverage at each list length.

    ``users`` has rows for every user with plays; the histories do, and are small. The first three
    metrics divide by their number; users without test items count in that number only. Coverage is the number of distinct recommended contents over that of distinct test
    contents, both over users with test items, and may exceed 1. Every user's recall is divided by
    the user's test size.
    """
    results = user_results(recs, test, ns, user, content)
    sums = results.agg(
        *[F.coalesce(F.sum(f"precision_{n}"), F.lit(0.0)).alias(f"p_{n}") for n in ns],
        *[F.coalesce(F.sum(f"recall_{n}"), F.lit(0.0)).alias(f"r_{n}") for n in ns],
        *[F.count_if(F.col(f"hits_{n}") > 0).alias(f"a_{n}") for n in ns],
    )
    total = users.agg(F.count_distinct(user).alias("total"))
    counted = results.select(user)
    seen = test.join(counted, user, "left_semi").agg(F.count_distinct(content).alias("seen"))
    # distinct contents with their best rank first: every list length is then one count
    reached = recs.join(counted, user, "left_semi").groupBy("content").agg(F.min("rank").alias("rank"))
    covered = reached.agg(*[F.count_if(F.col("rank") <= n).alias(f"c_{n}") for n in ns])
    row = side_by_side(sums, total, seen, covered)
    per_user = [
        F.try_divide(F.col(f"{short}_{n}"), F.col("total")).cast("double").alias(f"{name}@{n}")
        for name, short in (("Precision", "p"), ("Recall", "r"), ("Accuracy", "a"))
        for n in ns
    ]
    coverage = [F.try_divide(F.col(f"c_{n}"), F.col("seen")).cast("double").alias(f"Coverage@{n}") for n in ns]
    return row.select("total", *per_user, *coverage)


def metrics_long(metrics: DataFrame, model_name: str, model_path: str = "", date: Column | None = None) -> DataFrame:
    """Metric rows (model_name, date, metric_name, value, model_path)."""
    names = [c for c in metrics.columns if "@" in c]
    when = date if date is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    quoted = metrics.select(*[F.col(f"`{c}`") for c in names])
    return quoted.unpivot([], [F.col(f"`{c}`") for c in names], "metric_name", "value").select(
        F.lit(model_name).alias("model_name"), when.alias("date"), "metric_name", "value", F.lit(model_path).alias("model_path")
    )

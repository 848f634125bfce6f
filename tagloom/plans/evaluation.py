"""The offline evaluation from plays and item vectors to metric rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import join_texts
from tagloom.operators import recommend
from tagloom.operators.models import Encoder, embed_text
from tagloom.operators.ordering import first_per_key
from tagloom.plans.catalogue import SAMPLED_USERS, titles_keywords, users_plays
from tagloom.session import cut_lineage
from tagloom.sources.tables import append_metrics, write_report


@dataclass(frozen=True)
class Evaluation:
    """Intermediate and final tables of one run."""

    history: DataFrame
    test: DataFrame
    profiles: DataFrame
    recommendations: DataFrame
    metrics: DataFrame

    def per_user(self, user: str = "user_id") -> DataFrame:
        return recommend.user_results(self.recommendations, self.test, user=user)


def one_item_per_title(items: DataFrame, title: str, order: str) -> DataFrame:
    """Keep one row per title, the first in a stated order."""
    return first_per_key(items, title, [F.col(order)])


def evaluate(
    plays: DataFrame, items: DataFrame, history: int = recommend.HISTORY, test: int = recommend.TEST,
    ns: tuple[int, ...] = recommend.TOP, user: str = "user_id", order: tuple[str, ...] = ("ts",), block_rows: int | None = None,
) -> Evaluation:
    """Profiles, recommendations and ranking metrics.

    ``plays`` holds (user, content_id, order columns), ``items`` holds (item, content_id, vec). The
    plays are read twice, for the first plays and for the later items. What follows works on a few
    rows per user, which are stored because each is read several times. Every user with plays has a
    history, so the histories also give the number of users.
    """
    first, later = recommend.history_and_test(plays, history, test, user=user, order=order, items=items, store=True)
    later = cut_lineage(later)
    profiles = cut_lineage(recommend.user_profiles(first, items, history, user=user))
    ranked = cut_lineage(recommend.recommend_unseen(profiles, items, first, max(ns), user=user, block_rows=block_rows))
    metrics = recommend.ranking_metrics(ranked, later, first, ns, user=user)
    return Evaluation(first, later, profiles, ranked, metrics)


def evaluate_catalogue(
    play_sequence: DataFrame, catalogue: DataFrame, content_ids: DataFrame, load_encoder: Callable[[], Encoder],
    start: str, end: str, users: int = SAMPLED_USERS, **options,
) -> Evaluation:
    """The whole chain: sampled users' plays, titles with their keywords, one row per title, vectors from its text, evaluation.

    A title's first row is that of its least type and content id; its text is title, keywords and synopsis.
    """
    plays = users_plays(play_sequence, start, end, users=users)
    plays = plays.select(F.col("user_ordinal_id").alias("user_id"), "content_id", F.col("session_timestamp").alias("ts"))
    titles = titles_keywords(catalogue, content_ids).withColumn("_order", F.struct("TitleType", "content_ordinal_id"))
    chosen = one_item_per_title(titles, "TitleDetails_title", "_order")
    texts = chosen.select(F.col("content_ordinal_id").alias("item"), join_texts(F.col("TitleDetails_title"), F.col("keywords"), F.col("TitleDetails_longsynopsis")).alias("text"))
    items = cut_lineage(embed_text(texts, "text", load_encoder).select("item", F.col("item").alias("content_id"), "vec"))
    return evaluate(cut_lineage(plays), items, **options)


def publish(evaluation: Evaluation, model_name: str, model_path: str, metrics_path: str, report_path: str, user: str = "user_id") -> None:
    """Append the metric rows and write the per-user report."""
    append_metrics(recommend.metrics_long(evaluation.metrics, model_name, model_path), metrics_path)
    summary = evaluation.metrics.withColumnsRenamed({c: c.replace("@", "_at_") for c in evaluation.metrics.columns})
    covered = evaluation.recommendations.groupBy("content").agg(F.min("rank").alias("best_rank"))
    seen = evaluation.test.select("content_id").distinct()
    write_report({"per_user": evaluation.per_user(user), "summary": summary, "coverage": covered, "seen": seen}, report_path)

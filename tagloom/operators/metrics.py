"""Classifier metrics on long rows (id, tag, y, p): one row per example and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.vectors import focal_terms
from tagloom.operators.ordering import running_totals
from tagloom.operators.relational import side_by_side

THRESHOLD = 0.5
# The marks for labels that cannot be scored, and the gate's limits.
NO_POSITIVES, ONLY_POSITIVES = -1.0, 10.0
MIN_PRECISION, MIN_RECALL = 0.7, 0.4
_PR_STEPS = 200


def to_long(df: DataFrame, key: str, labels: str, scores: str) -> DataFrame:
    """Label and score arrays to one row per (example, label number)."""
    pairs = F.arrays_zip(F.col(labels).alias("y"), F.col(scores).alias("p"))
    rows = df.select(key, F.posexplode(pairs).alias("tag", "_pair"))
    return rows.select(key, "tag", F.col("_pair.y").cast("int").alias("y"), F.col("_pair.p").cast("double").alias("p"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def per_tag_metrics(df: DataFrame, threshold: float = THRESHOLD, compat: bool = False) -> DataFrame:
    """Accuracy, average precision and ROC AUC per tag, with the share of positives.

    Rows are first combined by (tag, score): equal scores must count together, and the combined
    counts are all the ranking needs. Running counts then come from sorted slices, so a tag with
    most of the rows is spread over many tasks. A tag without both classes has NULL metrics and a
    ``status``; ``compat`` gives -1 and 10 instead. Runs a job.
    """
    points = df.groupBy("tag", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    run = running_totals(points, ["tag"], [F.desc("p")], {"cum_n": F.col("n"), "cum_pos": F.col("pos")})
    hit = F.when(F.col("p") > threshold, F.col("pos")).otherwise(F.col("n") - F.col("pos"))
    precision = F.col("pos") * F.try_divide(F.col("cum_pos"), F.col("cum_n"))
    above = F.col("cum_pos") - F.col("pos") / F.lit(2.0)  # positives ranked above, a tie counting half
    totals = run.groupBy("tag").agg(
        F.sum("n").alias("rows"), F.sum("pos").alias("positives"), F.sum(hit).alias("hits"),
        F.sum(precision).alias("ap"), F.sum((F.col("n") - F.col("pos")) * above).alias("wins"),
    )
    negatives = F.col("rows") - F.col("positives")
    status = F.when(F.col("positives") == 0, "no_positives").when(negatives == 0, "only_positives").otherwise("ok")
    mark = F.when(F.col("status") == "no_positives", F.lit(NO_POSITIVES)).when(F.col("status") == "only_positives", F.lit(ONLY_POSITIVES))
    other = mark if compat else F.lit(None).cast("double")

    def scored(value: Column, name: str) -> Column:
        return F.when(F.col("status") == "ok", value).otherwise(other).alias(name)

    return totals.withColumn("status", status).select(
        "tag", "status", "rows", "positives",
        (F.col("positives") / F.col("rows")).alias("prevalence"),
        scored(F.col("hits") / F.col("rows"), "accuracy"),
        scored(F.try_divide(F.col("ap"), F.col("positives")), "average_precision"),
        scored(F.try_divide(F.col("wins"), F.col("positives") * negatives), "roc_auc"),
    )


def _confusion(threshold: float) -> list[Column]:
    on, y = F.col("p") > threshold, F.col("y") == 1
    return [
        F.count_if(on & y).alias("tp"), F.count_if(on & ~y).alias("fp"),
        F.count_if(~on & y).alias("fn"), F.count_if(~on & ~y).alias("tn"),
    ]


def precision_recall(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row (precision, recall) over all examples and labels (M7)."""
    sums = df.agg(*_confusion(threshold))
    return sums.select(
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )


def _pr_auc(df: DataFrame, steps: int) -> DataFrame:
    """Per tag, the interpolated area under the precision-recall curve at evenly spaced thresholds.

    Counts per threshold bin are all that is kept: ``steps`` rows per tag whatever the row count.
    Between two thresholds true positives are taken as linear in the number of predictions.
    """
    last = steps - 1
    # rows of level i are predicted at the thresholds 0 .. i - 1
    level = F.greatest(F.lit(1), F.ceil(F.col("p") * last).cast("int"))
    bins = df.groupBy("tag", level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    counts = bins.groupBy("tag").agg(
        F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("n"),
        F.map_from_entries(F.collect_list(F.struct("level", "pos"))).alias("pos"),
        F.sum("pos").alias("positives"),
    )
    # step i goes from threshold i to i + 1; rows of level i + 1 leave the prediction in it
    steps_of = counts.select("tag", "n", "pos", "positives", F.explode(F.sequence(F.lit(1), F.lit(last))).alias("level"))
    rows = steps_of.select(
        "tag", "positives", "level",
        F.coalesce(F.try_element_at("n", "level"), F.lit(0)).alias("dn"),
        F.coalesce(F.try_element_at("pos", "level"), F.lit(0)).alias("dtp"),
    )
    run = _small_suffix_sums(rows)
    slope = _ratio(F.col("dtp"), F.col("dn"))
    intercept = F.col("tp_next") - slope * F.col("n_next")
    grow = F.when((F.col("n_here") > 0) & (F.col("n_next") > 0), F.try_divide(F.col("n_here"), F.col("n_next"))).otherwise(F.lit(1.0))
    area = _ratio(slope * (F.col("dtp") + intercept * F.ln(grow)), F.col("positives").cast("double"))
    return run.groupBy("tag").agg(F.sum(area).alias("pr_auc"))


def _small_suffix_sums(rows: DataFrame) -> DataFrame:
    """Predictions and true positives from each level up (``here``) and above it (``next``).

    A window per tag is safe here: a tag has one row per threshold.
    """
    above = W.partitionBy("tag").orderBy(F.desc("level")).rowsBetween(W.unboundedPreceding, -1)
    n_next = F.coalesce(F.sum("dn").over(above), F.lit(0))
    tp_next = F.coalesce(F.sum("dtp").over(above), F.lit(0))
    return rows.select("*", n_next.alias("n_next"), tp_next.alias("tp_next")).withColumn("n_here", F.col("n_next") + F.col("dn"))


def multilabel_metrics(df: DataFrame, key: str = "id", threshold: float = THRESHOLD, steps: int = _PR_STEPS) -> DataFrame:
    """One row (binary_accuracy, macro_f1, pr_auc, cosine_similarity) over labels and examples (M6)."""
    tags = df.groupBy("tag").agg(*_confusion(threshold))
    f1 = _ratio(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn"))
    over_tags = tags.agg(
        (F.sum(F.col("tp") + F.col("tn")) / F.sum(F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))).alias("binary_accuracy"),
        F.avg(f1).alias("macro_f1"),
    )
    tiny = F.lit(1e-12)
    example = df.groupBy(key).agg(
        F.sum(F.col("y") * F.col("p")).alias("yp"), F.sum(F.col("y") * F.col("y")).alias("yy"), F.sum(F.col("p") * F.col("p")).alias("pp")
    )
    cosine = F.col("yp") / (F.sqrt(F.greatest(F.col("yy").cast("double"), tiny)) * F.sqrt(F.greatest("pp", tiny)))
    parts = [over_tags, _pr_auc(df, steps).agg(F.avg("pr_auc").alias("pr_auc")), example.agg(F.avg(cosine).alias("cosine_similarity"))]
    return side_by_side(*parts)


def mean_focal_loss(df: DataFrame, labels: str, scores: str, alpha: float = 0.25, gamma: float = 3.0) -> DataFrame:
    """One row with the mean over examples of the focal loss (M5)."""
    loss = F.aggregate(focal_terms(F.col(labels), F.col(scores), alpha, gamma), F.lit(0.0), lambda acc, x: acc + x)
    return df.agg(F.avg(loss).alias("focal_loss"))


def prediction_report(df: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Actual and predicted values side by side (C2): both sides are (key, label, value) rows."""
    actual = df.select(key, "label", F.col("value").alias("actual"))
    predicted = predictions.select(key, "label", F.col("value").alias("predicted"))
    return actual.join(predicted, [key, "label"], "full_outer")


def threshold_gate(metrics: DataFrame, precision: float = MIN_PRECISION, recall: float = MIN_RECALL) -> DataFrame:
    """(precision, recall, blessed): 1 when both limits are met."""
    passed = (F.col("precision") >= precision) & (F.col("recall") >= recall)
    return metrics.select("precision", "recall", passed.cast("int").alias("blessed"))


def publish_if(gate: DataFrame, df: DataFrame, path: str, version: str) -> bool:
    """Write ``df`` under ``path/version`` when the gate's one row is blessed (C4). Runs jobs."""
    row = gate.select("blessed").first()
    if not row or row[0] != 1:
        return False
    df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/{version}")
    return True

"""Classifier metric and data validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import metrics, stat_store, validation
from tagloom.sources.spec import Feature, FeatureSpec
from workload import standins as t
from workload.registry import query
from workload.standins import new_folder, with_tables


def _long(spark, sf):
    return metrics.to_long(t.tag_scores(spark, sf), "id", "labels", "scores")


CURVES = """, points AS (SELECT tag, p, count(*) AS n, sum(y) AS pos FROM long_scores GROUP BY tag, p),
    run AS (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM points WINDOW w AS (PARTITION BY tag ORDER BY p DESC)),
    curves AS (SELECT tag, sum(pos * cp / cn) AS ap, sum((n - pos) * (cp - pos / 2.0)) AS wins FROM run GROUP BY tag),
    totals AS (SELECT tag, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, avg(CAST((p > 0.5) = (y = 1) AS INT)) AS accuracy FROM long_scores GROUP BY tag)"""


@query("per_tag_metrics", with_tables("long_scores", CURVES + """
    SELECT tag, CASE WHEN positives = 0 THEN 'no_positives' WHEN positives = rows THEN 'no_negatives' ELSE 'ok' END AS status, rows, positives,
           round(positives / rows, 6) AS prevalence, CASE WHEN positives NOT IN (0, rows) THEN round(accuracy, 6) END AS accuracy,
           CASE WHEN positives NOT IN (0, rows) THEN round(ap / positives, 6) END AS average_precision,
           CASE WHEN positives NOT IN (0, rows) THEN round(wins / (positives * (rows - positives)), 6) END AS roc_auc FROM totals JOIN curves USING (tag)"""))
def per_tag_metrics(spark, sf):
    out = metrics.per_tag_metrics(_long(spark, sf))
    return out.withColumn("tag", F.col("tag").cast("bigint")).withColumns({c: F.round(c, 6) for c in ("prevalence", "accuracy", "average_precision", "roc_auc")})


@query("multilabel_metrics", with_tables("long_scores", """,
    per_tag AS (SELECT tag, count(*) FILTER (p > 0.5 AND y = 1) AS tp, count(*) FILTER (p > 0.5 AND y = 0) AS fp,
                count(*) FILTER (p <= 0.5 AND y = 1) AS fn, count(*) FILTER (p <= 0.5 AND y = 0) AS tn FROM long_scores GROUP BY tag),
    cuts AS (SELECT tag, i, count(*) FILTER (greatest(1, ceil(p * 199)) > i AND y = 1) AS tp, count(*) FILTER (greatest(1, ceil(p * 199)) > i) AS n, sum(y) AS positives
           FROM long_scores, range(0, 200) r(i) GROUP BY tag, i),
    steps AS (SELECT a.tag, a.positives, a.tp - b.tp AS dtp, a.n - b.n AS dn, a.n AS n0, b.n AS n1, b.tp AS tp1 FROM cuts a JOIN cuts b ON a.tag = b.tag AND b.i = a.i + 1),
    slopes AS (SELECT *, CASE WHEN dn = 0 THEN 0 ELSE dtp / dn END AS slope, CASE WHEN n0 > 0 AND n1 > 0 THEN n0 / n1 ELSE 1 END AS grow FROM steps),
    areas AS (SELECT tag, sum(CASE WHEN positives = 0 THEN 0 ELSE slope * (dtp + (tp1 - slope * n1) * ln(grow)) / positives END) AS area FROM slopes GROUP BY tag),
    rows AS (SELECT id, sum(y * p) / (sqrt(sum(y * y)) * sqrt(sum(p * p))) AS c FROM long_scores GROUP BY id)
    SELECT round((SELECT sum(tp + tn) / sum(tp + tn + fp + fn) FROM per_tag), 6) AS binary_accuracy,
           round((SELECT avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END) FROM per_tag), 6) AS macro_f1,
           round((SELECT avg(area) FROM areas), 6) AS pr_auc, round((SELECT avg(c) FROM rows), 6) AS cosine_similarity"""))
def multilabel_metrics(spark, sf):
    out = metrics.multilabel_metrics(_long(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("precision_recall", with_tables("long_scores", """
    SELECT round(count(*) FILTER (p > 0.5 AND y = 1) / count(*) FILTER (p > 0.5), 6) AS precision,
           round(count(*) FILTER (p > 0.5 AND y = 1) / count(*) FILTER (y = 1), 6) AS recall FROM long_scores"""))
def precision_recall(spark, sf):
    return metrics.precision_recall(_long(spark, sf)).select(F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def _focal(alpha: float) -> str:
    return f"""(SELECT avg(s) FROM (SELECT id, sum((CASE WHEN y = 1 THEN {alpha} ELSE {1 - alpha} END) * pow(1 - (CASE WHEN y = 1 THEN p ELSE 1 - p END), 3)
        * -ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) AS s FROM long_scores GROUP BY id))"""


@query("focal_loss", with_tables("long_scores", f"SELECT round({_focal(0.25)}, 6) AS focal_loss, round({_focal(0.75)}, 6) AS focal_loss_75"))
def focal_loss(spark, sf):
    from tagloom.operators.relational import side_by_side

    rows = t.tag_scores(spark, sf)
    light = metrics.mean_focal_loss(rows, "labels", "scores")
    heavy = metrics.mean_focal_loss(rows, "labels", "scores", alpha=0.75).withColumnRenamed("focal_loss", "focal_loss_75")
    out = side_by_side(light, heavy)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("threshold_gate", with_tables("long_scores", """, m AS (SELECT count(*) FILTER (p > 0.5 AND y = 1) / count(*) FILTER (p > 0.5) AS precision,
           count(*) FILTER (p > 0.5 AND y = 1) / count(*) FILTER (y = 1) AS recall FROM long_scores)
    SELECT round(precision, 6) AS precision, round(recall, 6) AS recall, CAST(precision >= 0.05 AND recall >= 0.4 AS INT) AS blessed FROM m"""))
def threshold_gate(spark, sf):
    gate = metrics.threshold_gate(metrics.precision_recall(_long(spark, sf)), precision=0.05)
    return gate.select(F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), "blessed")


@query("prediction_report", with_tables("long_scores", "SELECT id, 'tag ' || tag AS label, y AS actual, p AS predicted FROM long_scores"))
def prediction_report(spark, sf):
    rows = _long(spark, sf).withColumn("label", F.concat(F.lit("tag "), F.col("tag").cast("string")))
    return metrics.prediction_report(rows.withColumn("value", F.col("y")), rows.withColumn("value", F.col("p")), "id")


@query("prediction_sanity", with_tables("long_scores", """
    SELECT count(DISTINCT id) AS num_rows, CAST(count(DISTINCT id) FILTER (isnan(p)) AS BIGINT) AS nan_rows, count(DISTINCT id) FILTER (p <= 0 OR p >= 1) AS outside_rows FROM long_scores"""))
def prediction_sanity(spark, sf):
    return validation.check_predictions(t.tag_scores(spark, sf), "scores")


SPEC = FeatureSpec((
    Feature("synopsis", min_fraction=1.0, min_count=1, min_values=1, max_values=1),
    Feature("language", min_fraction=1.0, min_count=1, min_values=1, max_values=1, domain=("en", "es", "de"), min_domain_mass=0.95),
    Feature("quality", "int", min_fraction=0.3, min_count=1),
    Feature("tags", single=False, min_fraction=1.0, min_count=1, min_values=1, drift_linf=0.05),
    Feature("genre", min_fraction=1.0),
))
FEATURES = ["synopsis", "language", "quality", "tags"]


def _rows(spark, sf):
    docs = t.load(spark, sf, "documents").join(t.load(spark, sf, "labels"), "doc_id", "left")
    tags = F.array_compact(F.array("lang", F.when(F.col("toxic") == 1, "toxic")))
    split = F.when(F.col("n_chars") < 1500, "train").otherwise("eval")
    return docs.select(F.col("text").alias("synopsis"), F.col("lang").alias("language"), F.col("quality").cast("int").alias("quality"), tags.alias("tags"), split.alias("split"))


ROWS = """rows AS (SELECT text AS synopsis, lang AS language, CAST(quality AS VARCHAR) AS quality, [lang, CASE WHEN toxic = 1 THEN 'toxic' END] AS tags,
        CASE WHEN n_chars < 1500 THEN 'train' ELSE 'eval' END AS split FROM documents LEFT JOIN labels USING (doc_id)),
    long AS (SELECT split, feature, list_filter(vals, lambda x: x IS NOT NULL) AS vals FROM (
        SELECT split, unnest(['synopsis', 'language', 'quality', 'tags']) AS feature, unnest([[synopsis], [language], [quality], tags]) AS vals FROM rows)),
    items AS (SELECT split, feature, unnest(vals) AS value FROM long)"""


def _stats(by: str) -> str:
    return f"""presence AS (SELECT {by} feature, count(*) AS num_rows, count(*) FILTER (len(vals) > 0) AS present,
        min(len(vals)) FILTER (len(vals) > 0) AS min_values, max(len(vals)) FILTER (len(vals) > 0) AS max_values,
        avg(len(vals)) FILTER (len(vals) > 0) AS mean_values FROM long GROUP BY ALL),
    counted AS (SELECT {by} feature, value, count(*) AS n FROM items GROUP BY ALL),
    tops AS (SELECT {by} feature, value AS top_value, n AS top_count, row_number() OVER (PARTITION BY {by} feature ORDER BY n DESC, value) AS rn FROM counted),
    per_value AS (SELECT {by} feature, count(*) AS num_values, count(DISTINCT value) AS num_distinct, min(length(value)) AS min_length,
        max(length(value)) AS max_length, avg(length(value)) AS mean_length FROM items GROUP BY ALL)"""


@query("feature_stats", f"""WITH {ROWS}, {_stats('split,')}
    SELECT split, feature, num_rows, present, num_rows - present AS missing, round(present / num_rows, 6) AS presence, CAST(min_values AS INT) AS min_values,
           CAST(max_values AS INT) AS max_values, round(mean_values, 6) AS mean_values, num_values, num_distinct, top_value, top_count,
           CAST(min_length AS INT) AS min_length, CAST(max_length AS INT) AS max_length, round(mean_length, 6) AS mean_length
    FROM presence JOIN per_value USING (split, feature) JOIN tops USING (split, feature) WHERE rn = 1""")
def feature_stats(spark, sf):
    out = validation.feature_stats(_rows(spark, sf), FEATURES, by="split")
    return out.withColumns({c: F.round(c, 6) for c in ("presence", "mean_values", "mean_length")})


@query("top_value_table", f"""WITH {ROWS}, counted AS (SELECT feature, value, count(*) AS n FROM items GROUP BY ALL)
    SELECT feature, CAST(rank AS INT) AS rank, value, n FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rank FROM counted) WHERE rank <= 20""")
def top_value_table(spark, sf):
    return validation.top_value_table(_rows(spark, sf), FEATURES)


@query("numeric_stats", """
    SELECT 'value' AS feature, count(value) AS num_values, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max,
           count(*) FILTER (value = 0) AS zeros, quantile_disc(value, 0.1) AS q10, quantile_disc(value, 0.25) AS q25, quantile_disc(value, 0.5) AS q50,
           quantile_disc(value, 0.75) AS q75, quantile_disc(value, 0.9) AS q90 FROM events
    UNION ALL
    SELECT 'user_id', count(v), round(avg(v), 6), round(stddev_pop(v), 6), min(v), max(v), count(*) FILTER (v = 0), quantile_disc(v, 0.1), quantile_disc(v, 0.25),
           quantile_disc(v, 0.5), quantile_disc(v, 0.75), quantile_disc(v, 0.9) FROM (SELECT CAST(user_id AS DOUBLE) AS v FROM events)""")
def numeric_stats(spark, sf):
    out = validation.numeric_stats(t.load(spark, sf, "events"), ["value", "user_id"])
    return out.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@query("compare_stats", f"""WITH {ROWS}, {_stats('split,')},
    s AS (SELECT split, feature, num_rows, present / num_rows AS presence, mean_values, num_distinct FROM presence JOIN per_value USING (split, feature))
    SELECT a.feature, a.num_rows AS train_num_rows, round(a.presence, 6) AS train_presence, round(a.mean_values, 6) AS train_mean_values, a.num_distinct AS train_num_distinct,
           b.num_rows AS eval_num_rows, round(b.presence, 6) AS eval_presence, round(b.mean_values, 6) AS eval_mean_values, b.num_distinct AS eval_num_distinct,
           round(abs(a.presence - b.presence), 6) AS presence_gap, round(abs(a.mean_values - b.mean_values), 6) AS mean_values_gap, abs(a.num_distinct - b.num_distinct) AS num_distinct_gap
    FROM s a JOIN s b USING (feature) WHERE a.split = 'train' AND b.split = 'eval'""")
def compare_stats(spark, sf):
    stats = validation.feature_stats(_rows(spark, sf), FEATURES, by="split")
    out = validation.compare_stats(stats.where("split = 'train'"), stats.where("split = 'eval'"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if "presence" in c or "mean_values" in c})


@query("schema_checks", f"""WITH {ROWS}, p AS (SELECT feature, count(*) AS n, count(*) FILTER (len(vals) > 0) AS present,
        min(len(vals)) FILTER (len(vals) > 0) AS lo, max(len(vals)) FILTER (len(vals) > 0) AS hi FROM long GROUP BY feature),
    spec AS (SELECT unnest(['synopsis', 'language', 'quality', 'tags']) AS feature, unnest([1.0, 1.0, 0.3, 1.0]) AS frac, unnest([1.0, 1.0, NULL, 1.0]) AS low, unnest([1.0, 1.0, NULL, NULL]) AS high)
    SELECT feature, 'min_fraction' AS "check", round(present / n, 6) AS observed, frac AS limit, CAST(present / n >= frac AS INT) AS passed FROM p JOIN spec USING (feature)
    UNION ALL SELECT feature, 'min_count', present, 1.0, CAST(present >= 1 AS INT) FROM p
    UNION ALL SELECT feature, 'min_values', lo, low, CAST(lo >= low AS INT) FROM p JOIN spec USING (feature) WHERE low IS NOT NULL
    UNION ALL SELECT feature, 'max_values', hi, high, CAST(hi <= high AS INT) FROM p JOIN spec USING (feature) WHERE high IS NOT NULL""")
def schema_checks(spark, sf):
    rows = _rows(spark, sf)
    out = validation.check_presence(rows, SPEC).unionByName(validation.check_value_count(rows, SPEC))
    return out.withColumn("observed", F.round("observed", 6)).withColumn("passed", F.col("passed").cast("int"))


@query("domain_mass", """
    SELECT 'word' AS feature, 'domain_mass' AS "check", round(avg(CAST(w IN (SELECT unnest(string_split(text, ' ')) FROM benchmark) AS INT)), 6) AS observed, 0.95 AS limit,
           CAST(avg(CAST(w IN (SELECT unnest(string_split(text, ' ')) FROM benchmark) AS INT)) >= 0.95 AS INT) AS passed
    FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)""")
def domain_mass(spark, sf):
    words = t.load(spark, sf, "documents").select(F.split("text", " ").alias("word"))
    out = validation.check_domain_mass(words, "word", t.token_vocab(spark, sf))
    return out.withColumn("observed", F.round("observed", 6)).withColumn("passed", F.col("passed").cast("int"))


DRIFT = """shares AS (SELECT value, count(*) FILTER (split = 'train') / (SELECT count(*) FROM items WHERE feature = 'tags' AND split = 'train') AS a,
        count(*) FILTER (split = 'eval') / (SELECT count(*) FROM items WHERE feature = 'tags' AND split = 'eval') AS b FROM items WHERE feature = 'tags' GROUP BY value)"""


@query("linf_drift", f"""WITH {ROWS}, {DRIFT} SELECT 'tags' AS feature, 'linf_drift' AS "check", round(max(abs(a - b)), 6) AS observed, 0.05 AS limit,
    CAST(max(abs(a - b)) <= 0.05 AS INT) AS passed FROM shares""")
def linf_drift(spark, sf):
    rows = _rows(spark, sf)
    out = validation.linf_drift(rows.where("split = 'train'"), rows.where("split = 'eval'"), "tags")
    return out.withColumn("observed", F.round("observed", 6)).withColumn("passed", F.col("passed").cast("int"))


ANOMALIES = f"""WITH {ROWS}, {DRIFT}, p AS (SELECT feature, count(*) AS n, count(*) FILTER (len(vals) > 0) AS present FROM long WHERE split = 'train' GROUP BY feature)
    SELECT 'genre' AS feature, 'exists' AS "check", 0.0 AS observed, 1.0 AS limit
    UNION ALL SELECT 'split', 'expected', 0.0, 1.0
    UNION ALL SELECT feature, 'min_fraction', round(present / n, 6), 0.3 FROM p WHERE feature = 'quality' AND present / n < 0.3
    UNION ALL SELECT 'language', 'domain_mass', round(avg(CAST(language IN ('en', 'es', 'de') AS INT)), 6), 0.95 FROM rows WHERE split = 'train'
              HAVING avg(CAST(language IN ('en', 'es', 'de') AS INT)) < 0.95
    UNION ALL SELECT 'tags', 'linf_drift', round(max(abs(a - b)), 6), 0.05 FROM shares HAVING max(abs(a - b)) > 0.05"""


@query("anomalies", ANOMALIES)
def anomalies(spark, sf):
    rows = _rows(spark, sf)
    out = validation.validate(rows.where("split = 'train'"), SPEC, rows.where("split = 'eval'"))
    return out.where(~F.col("passed")).select("feature", "check", F.round("observed", 6).alias("observed"), "limit")


@query("stored_anomalies", ANOMALIES)
def stored_anomalies(spark, sf):
    """V7, V9: the checks of ``anomalies`` from statistics stored in four batches; only the store is read."""
    rows, path = _rows(spark, sf), new_folder(spark)
    half = F.pmod(F.xxhash64("synopsis"), F.lit(2))
    for split in ("train", "eval"):
        for k in (0, 1):
            stat_store.append_statistics(rows.where((F.col("split") == split) & (half == k)), f"{split}-{k}", path)
    stored = [stat_store.read_statistics(spark, path, [f"{split}-{k}" for k in (0, 1)]) for split in ("train", "eval")]
    out = stat_store.validate_statistics(stored[0], SPEC, stored[1])
    return out.where(~F.col("passed")).select("feature", "check", F.round("observed", 6).alias("observed"), "limit")

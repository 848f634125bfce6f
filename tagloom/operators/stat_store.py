"""Statistics stored per batch of rows, so that checks against earlier batches read only the new rows.

A store is a folder of two tables. ``rows`` has one row per (batch, feature): row counts, presence and fewest and most
values. ``values`` counts every distinct value per (batch, feature) under a 128-bit digest, without the value. Both add
up over batches, so any set of batches gives what one pass over all their rows would give.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.validation import _RESULT, _counted, _digests, _is_array, _kind, _long, _values
from tagloom.sources.spec import FeatureSpec

_ROWS = "feature string, type string, single boolean, num_rows long, present long, min_values int, max_values int"
_VALUES = "feature string, h long, i long, n long"


@dataclass(frozen=True)
class Statistics:
    """Merged statistics: ``rows`` (feature, type, single, num_rows, present, min_values, max_values), ``values`` (feature, h, i, n)."""

    rows: DataFrame
    values: DataFrame


def batch_statistics(df: DataFrame, features: Sequence[str] | None = None) -> Statistics:
    """The statistics of one table (V1): an aggregate over its rows, and one count per distinct value."""
    features = list(features or df.columns)
    aggregates, parts = [F.count(F.lit(1)).alias("_n")], []
    for k, name in enumerate(features):
        size = F.array_size(_values(df, name))
        some = F.when(size > 0, size)
        aggregates += [F.count_if(size > 0).alias(f"_p{k}"), F.min(some).alias(f"_l{k}"), F.max(some).alias(f"_h{k}")]
        parts.append(F.struct(
            F.lit(name).alias("feature"), F.lit(_kind(df, name)).alias("type"), F.lit(not _is_array(df, name)).alias("single"),
            F.col("_n").alias("num_rows"), F.col(f"_p{k}").alias("present"), F.col(f"_l{k}").alias("min_values"), F.col(f"_h{k}").alias("max_values"),
        ))
    counts = _counted(_long(df, features, None), ["feature"])
    return Statistics(df.agg(*aggregates).select(F.inline(F.array(*parts))), counts.select("feature", F.col("_h").alias("h"), F.col("_i").alias("i"), "n"))


def append_statistics(df: DataFrame, batch: str, path: str, features: Sequence[str] | None = None) -> None:
    """Store a batch's statistics. A batch that is stored again replaces its earlier statistics.

    Value counts go to a folder of their own per run; the batch's one row per feature is written last and names that
    run. A run that fails before leaves counts that no reader looks at.
    """
    run = uuid.uuid4().hex
    made = batch_statistics(df, features)
    made.values.withColumns({"batch": F.lit(batch), "run": F.lit(run)}).write.mode("append").partitionBy("batch", "run").parquet(f"{path}/values")
    rows = made.rows.withColumns({"run": F.lit(run), "batch": F.lit(batch)}).coalesce(1)  # one row per feature
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/rows")


def read_statistics(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> Statistics:
    """The statistics of all stored batches, or of the named ones, as if their rows were one table.

    Value folders of batches and runs that are not asked for are not read. Runs a job over the few rows of ``rows``.
    """
    rows = spark.read.schema(f"{_ROWS}, run string, batch string").parquet(f"{path}/rows")
    if batches is not None:
        rows = rows.where(F.col("batch").isin(*batches))
    runs = [r["run"] for r in rows.select("run").distinct().collect()]  # one per batch
    merged = rows.groupBy("feature").agg(
        F.min("type").alias("type"), F.min("single").alias("single"), F.sum("num_rows").alias("num_rows"), F.sum("present").alias("present"),
        F.min("min_values").alias("min_values"), F.max("max_values").alias("max_values"),
    )
    stored = spark.read.schema(f"{_VALUES}, batch string, run string").parquet(f"{path}/values").where(F.col("run").isin(*runs))
    return Statistics(merged, stored.groupBy("feature", "h", "i").agg(F.sum("n").alias("n")))


def drift(current: Statistics, previous: Statistics, limits: dict[str, float]) -> DataFrame:
    """(feature, check, observed, limit, passed): the largest difference of a value's share, for all features at once (V7)."""
    spark = current.rows.sparkSession
    wanted = spark.createDataFrame([(f, float(x)) for f, x in limits.items()], "feature string, limit double")
    none = F.lit(0).cast("long")
    new, old = (s.values.where(F.col("feature").isin(*limits)) for s in (current, previous))
    counts = new.select("feature", "h", "i", F.col("n").alias("a"), none.alias("b")).union(old.select("feature", "h", "i", none.alias("a"), F.col("n").alias("b")))
    counts = counts.groupBy("feature", "h", "i").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    totals = counts.groupBy(F.col("feature").alias("_f")).agg(F.sum("a").alias("_a"), F.sum("b").alias("_b"))  # one row per feature
    share = lambda n, total: F.coalesce(F.try_divide(F.col(n), F.col(total)), F.lit(0.0))
    placed = counts.join(F.broadcast(totals), F.col("feature") == F.col("_f"))
    gaps = placed.groupBy("feature").agg(F.max(F.abs(share("a", "_a") - share("b", "_b"))).alias("gap"))
    observed = F.coalesce("gap", F.lit(0.0))
    return wanted.join(gaps, "feature", "left").select("feature", F.lit("linf_drift").alias("check"), observed.alias("observed"), "limit", (observed <= F.col("limit")).alias("passed"))


def domain_mass(stats: Statistics, domains: dict[str, tuple[Sequence[str], float]]) -> DataFrame:
    """(feature, check, observed, limit, passed): the share of a feature's values in its domain, for all features at once (V6)."""
    spark = stats.rows.sparkSession
    wanted = spark.createDataFrame([(f, float(x)) for f, (_, x) in domains.items()], "feature string, limit double")
    listed = spark.createDataFrame([(f, v) for f, (values, _) in domains.items() for v in set(values)], "feature string, value string")
    known = listed.select("feature", *[d.alias(n) for d, n in zip(_digests(F.col("value")), ("h", "i"))], F.lit(1).alias("_in"))
    marked = stats.values.where(F.col("feature").isin(*domains)).join(known, ["feature", "h", "i"], "left")
    shares = marked.groupBy("feature").agg((F.sum(F.when(F.col("_in") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    observed = F.coalesce("share", F.lit(1.0))
    return wanted.join(shares, "feature", "left").select("feature", F.lit("domain_mass").alias("check"), observed.alias("observed"), "limit", (observed >= F.col("limit")).alias("passed"))


def validate_statistics(stats: Statistics, spec: FeatureSpec, previous: Statistics | None = None) -> DataFrame:
    """All checks of ``validate`` from stored statistics (V9); no row of any batch is read. Collects one row per feature."""
    spark = stats.rows.sparkSession
    here = {r["feature"]: r for r in stats.rows.collect()}
    out = [(name, "expected", 0.0, 1.0, False) for name in here if name not in {f.name for f in spec.features}]
    for f in spec.features:
        row = here.get(f.name)
        out.append((f.name, "exists", float(row is not None), 1.0, row is not None))
        if row is None:
            continue
        same = row["type"] == f.type and row["single"] == f.single
        share = row["present"] / row["num_rows"] if row["num_rows"] else 0.0
        out.append((f.name, "type", float(same), 1.0, same))
        for check, limit, seen, fits in (
            ("min_fraction", f.min_fraction, share, lambda x, y: x >= y), ("min_count", f.min_count, row["present"], lambda x, y: x >= y),
            ("min_values", f.min_values, row["min_values"], lambda x, y: x >= y), ("max_values", f.max_values, row["max_values"], lambda x, y: x <= y),
        ):
            if limit is not None:
                out.append((f.name, check, None if seen is None else float(seen), float(limit), seen is None or fits(seen, limit)))
    checks = spark.createDataFrame(out, _RESULT)
    domains = {f.name: (f.domain, f.min_domain_mass) for f in spec.features if f.name in here and f.domain and f.min_domain_mass is not None}
    if domains:
        checks = checks.unionByName(domain_mass(stats, domains))
    if previous is not None:
        before = {r["feature"] for r in previous.rows.select("feature").collect()}
        limits = {f.name: f.drift_linf for f in spec.features if f.drift_linf is not None and f.name in here and f.name in before}
        if limits:
            checks = checks.unionByName(drift(stats, previous, limits))
    return checks

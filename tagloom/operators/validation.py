"""Statistics of a dataset and checks against a feature specification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.ordering import running_totals, topk_per_group
from tagloom.session import cut_lineage
from tagloom.sources.spec import Feature, FeatureSpec

_RESULT = "feature string, check string, observed double, limit double, passed boolean"


def _is_array(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.ArrayType)


def _values(df: DataFrame, col: str) -> Column:
    """A feature's values as an array of texts; NULL when the feature is missing in the row."""
    if _is_array(df, col):
        return F.filter(F.col(col).cast("array<string>"), lambda x: x.isNotNull())
    return F.when(F.col(col).isNotNull(), F.array(F.col(col).cast("string")))


def _long(df: DataFrame, features: Sequence[str], by: str | None) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), _values(df, c).alias("vals")) for c in features])
    keys = [F.col(by)] if by else []
    return df.select(*keys, F.inline(pairs))


_FEW = 10_000  # values whose digests are sent to all tasks


def _digests(value: Column) -> list[Column]:
    """128 bits that stand for a value in keys: two numbers, so that counting keeps no text."""
    return [F.xxhash64(value).alias("_h"), F.xxhash64(F.lit(1), value).alias("_i")]


def _counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _h, _i, n, chars) of the rows (keys, vals): how often each distinct value occurs, without the value."""
    values = rows.select(*keys, F.explode("vals").alias("_v"))
    return values.select(*keys, *_digests(F.col("_v")), F.char_length("_v").alias("_c")).groupBy(*keys, "_h", "_i").agg(F.count(F.lit(1)).alias("n"), F.min("_c").alias("chars"))


def _shown(rows: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """(keys, value, n) of the counted values ``wanted``: the second pass, in which only their texts leave a task. Runs a job."""
    wanted = cut_lineage(wanted.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_h").alias("_wh"), F.col("_i").alias("_wi"), "n"))
    few = wanted.limit(_FEW + 1).count() <= _FEW
    values = rows.select(*keys, F.explode("vals").alias("_v")).select(*keys, "_v", *_digests(F.col("_v")))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], (F.col("_h") == F.col("_wh")) & (F.col("_i") == F.col("_wi")))
    met = values.join(F.broadcast(wanted) if few else wanted, same)
    return met.groupBy(*keys, "_h", "_i", "n").agg(F.min("_v").alias("value")).select(*keys, "value", "n")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n) over a feature's values; a digest is the grouping key, the value crosses once per task."""
    values = df.select(F.explode(_values(df, col)).alias("value"))
    return values.groupBy(*_digests(F.col("value"))).agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("n")).select("value", "n")


def feature_stats(df: DataFrame, features: Sequence[str], by: str | None = None) -> DataFrame:
    """Per feature, and per split with ``by``: presence, values per row, distinct values, lengths (V1).

    Row figures and value figures each take one pass. Values are counted by digest first, so a frequent value
    costs one partial count per task and no text is shuffled; a last pass shows the texts of the most frequent ones. Runs a job.
    """
    keys = [*([by] if by else []), "feature"]
    rows = _long(df, features, by)
    size = F.array_size("vals")
    presence = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(size > 0).alias("present"),
        F.min(F.when(size > 0, size)).alias("min_values"),
        F.max(F.when(size > 0, size)).alias("max_values"),
        F.avg(F.when(size > 0, size)).alias("mean_values"),
    )
    counts = cut_lineage(_counted(rows, keys))
    values = counts.groupBy(*keys).agg(
        F.sum("n").alias("num_values"),
        F.count(F.lit(1)).alias("num_distinct"),
        F.max("n").alias("top_count"),
        F.min("chars").alias("min_length"),
        F.max("chars").alias("max_length"),
        (F.sum(F.col("chars") * F.col("n")) / F.sum("n")).alias("mean_length"),
    )
    best = values.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "top_count")
    top = counts.join(best, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys], F.col("n") == F.col("top_count")), "left_semi")
    shown = _shown(rows, keys, top).groupBy(*keys).agg(F.min("value").alias("top_value"))
    values = values.join(shown, keys, "left")
    joined = presence.join(values, keys, "left")
    return joined.select(
        *keys, "num_rows", "present", (F.col("num_rows") - F.col("present")).alias("missing"),
        (F.col("present") / F.col("num_rows")).alias("presence"),
        "min_values", "max_values", "mean_values",
        F.coalesce("num_values", F.lit(0)).alias("num_values"), F.coalesce("num_distinct", F.lit(0)).alias("num_distinct"),
        "top_value", "top_count",
        "min_length", "max_length", "mean_length",
    )


def top_value_table(df: DataFrame, features: Sequence[str], n: int = 20) -> DataFrame:
    """(feature, rank, value, n): the most frequent values per feature (V1)."""
    rows = _long(df, features, None)
    counts = cut_lineage(_counted(rows, ["feature"]))
    least = topk_per_group(counts, "feature", "n", n, "_h").groupBy(F.col("feature").alias("_f")).agg(F.min("n").alias("_least"))
    top = counts.join(least, (F.col("feature") == F.col("_f")) & (F.col("n") >= F.col("_least")), "left_semi")
    return topk_per_group(_shown(rows, ["feature"], top), "feature", "n", n, "value")


def numeric_stats(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Per numeric column: count, mean, population deviation, range, zeros and exact quantiles (V1). Runs a job.

    Values are counted first; running totals over the sorted values then tell which value holds a quantile's rank (the
    rank is the share of the count, rounded up), spread over tasks however many values a column has.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    rows = df.select(F.inline(pairs))
    stats = rows.groupBy("feature").agg(
        F.count("v").alias("num_values"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.count_if(F.col("v") == 0).alias("zeros"),
    )
    counts = rows.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    totals = running_totals(counts, ["feature"], [F.col("v")], {"upto": F.col("n")})
    # one row per column, so the broadcast has a fixed small size
    placed = totals.join(F.broadcast(stats.select("feature", "num_values")), "feature")
    names = [f"q{round(q * 100)}" for q in quantiles]
    ranks = [F.greatest(F.ceil(F.lit(float(q)) * F.col("num_values")), F.lit(1)) for q in quantiles]
    found = placed.groupBy("feature").agg(*[F.min(F.when(F.col("upto") >= r, F.col("v"))).alias(n) for n, r in zip(names, ranks)])
    return stats.join(found, "feature", "left").select(*stats.columns, *names)


def compare_stats(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("train", "eval")) -> DataFrame:
    """Two statistics tables side by side with differences of presence, mean values and distinct counts (V8)."""
    left = a.select("feature", *[F.col(c).alias(f"{names[0]}_{c}") for c in ("num_rows", "presence", "mean_values", "num_distinct")])
    right = b.select("feature", *[F.col(c).alias(f"{names[1]}_{c}") for c in ("num_rows", "presence", "mean_values", "num_distinct")])
    joined = left.join(right, "feature", "full_outer")
    return joined.withColumns({
        f"{c}_gap": F.abs(F.col(f"{names[0]}_{c}") - F.col(f"{names[1]}_{c}")) for c in ("presence", "mean_values", "num_distinct")
    })


def infer_spec(df: DataFrame, features: Sequence[str] | None = None, domain_limit: int = 20) -> FeatureSpec:
    """A specification from the data (V2): types, presence, value counts, and small domains.

    One statistics row per feature, and at most ``domain_limit`` values of features with few distinct
    values, reach the driver. Text features with more values get no domain and are named in ``open_domains``.
    """
    features = list(features or df.columns)
    stats = {r["feature"]: r for r in feature_stats(df, features).collect()}
    small = [f for f in features if _is_text(df, f) and 0 < stats[f]["num_distinct"] <= domain_limit]
    domains: dict[str, list[str]] = {}
    if small:
        for row in top_value_table(df, small, domain_limit).orderBy("feature", "value").collect():
            domains.setdefault(row["feature"], []).append(row["value"])
    specs = []
    for name in features:
        row = stats[name]
        single = not _is_array(df, name)
        specs.append(Feature(
            name=name, type=_kind(df, name), single=single, min_fraction=1.0 if row["present"] == row["num_rows"] else 0.0,
            min_count=1, min_values=1 if single or (row["min_values"] or 0) >= 1 else 0,
            max_values=1 if single else None, domain=tuple(domains[name]) if name in domains else None,
        ))
    return FeatureSpec(tuple(specs), tuple(f for f in features if _is_text(df, f) and stats[f]["num_distinct"] > domain_limit))


def _kind(df: DataFrame, col: str) -> str:
    kind = df.schema[col].dataType
    return (kind.elementType if isinstance(kind, T.ArrayType) else kind).simpleString()


def _is_text(df: DataFrame, col: str) -> bool:
    return _kind(df, col) == "string"


def _result(feature: str, check: str, observed: Column, limit: Column | float, passed: Column) -> Column:
    limit = limit if isinstance(limit, Column) else F.lit(float(limit))
    return F.struct(
        F.lit(feature).alias("feature"), F.lit(check).alias("check"), observed.cast("double").alias("observed"),
        limit.cast("double").alias("limit"), F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def check_presence(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Presence fraction and count per feature (V3)."""
    return _row_checks(df, spec, ("min_fraction", "min_count"))


def check_value_count(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Fewest and most values per row among rows that have the feature (V4)."""
    return _row_checks(df, spec, ("min_values", "max_values"))


def _row_checks(df: DataFrame, spec: FeatureSpec, wanted: Sequence[str]) -> DataFrame:
    """Presence and value-count checks of all features in one aggregate over the table."""
    known = [f for f in spec.features if f.name in df.columns]
    aggregates, results = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(known):
        size = F.array_size(_values(df, f.name))
        aggregates += [F.count_if(size > 0).alias(f"_p{i}"), F.min(F.when(size > 0, size)).alias(f"_l{i}"),
                       F.max(F.when(size > 0, size)).alias(f"_h{i}")]
        present, low, high = F.col(f"_p{i}"), F.col(f"_l{i}"), F.col(f"_h{i}")
        share = F.coalesce(F.try_divide(present, F.col("_rows")), F.lit(0.0))
        checks = {
            "min_fraction": (f.min_fraction, share, share >= f.min_fraction),
            "min_count": (f.min_count, present, present >= f.min_count),
            "min_values": (f.min_values, low, F.coalesce(low >= f.min_values, F.lit(True))),
            "max_values": (f.max_values, high, F.coalesce(high <= f.max_values, F.lit(True)) if f.max_values is not None else None),
        }
        for name in wanted:
            limit, observed, passed = checks[name]
            if limit is not None:
                results.append(_result(f.name, name, observed, limit, passed))
    if not results:
        return df.sparkSession.createDataFrame([], _RESULT)
    return df.agg(*aggregates).select(F.inline(F.array(*results)))


def check_type(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Types, missing features and unexpected features, from the schema alone (V5, V9)."""
    names = {f.name for f in spec.features}
    rows = []
    for f in spec.features:
        here = f.name in df.columns
        rows.append((f.name, "exists", float(here), 1.0, here))
        if here:
            same = _kind(df, f.name) == f.type and _is_array(df, f.name) != f.single
            rows.append((f.name, "type", float(same), 1.0, same))
    rows += [(c, "expected", 0.0, 1.0, False) for c in df.columns if c not in names]
    return df.sparkSession.createDataFrame(rows, _RESULT)


def check_domain_mass(df: DataFrame, col: str, domain: DataFrame | Sequence[str], min_mass: float = 0.95) -> DataFrame:
    """Share of a feature's values that lie in the domain (V6).

    Values are counted before the domain is looked up, so the join is over distinct values.
    """
    counts = value_counts(df, col)
    if isinstance(domain, DataFrame):
        known = domain.select(F.col(domain.columns[0]).cast("string").alias("value")).distinct().withColumn("_in", F.lit(True))
        marked = counts.join(known, "value", "left")
        inside = F.col("_in").isNotNull()
    else:
        marked, inside = counts, F.col("value").isin(*domain)
    share = F.coalesce(F.try_divide(F.sum(F.when(inside, F.col("n")).otherwise(0)), F.sum("n")), F.lit(1.0))
    return marked.agg(share.alias("share")).select(F.inline(F.array(_result(col, "domain_mass", F.col("share"), min_mass, F.col("share") >= min_mass))))


def linf_drift(current: DataFrame, previous: DataFrame, col: str, threshold: float = 0.05) -> DataFrame:
    """Largest difference of a value's share between two datasets (V7)."""
    sides = [value_counts(d, col).select("value", F.col("n").alias("a") if i == 0 else F.lit(0).cast("bigint").alias("a"),
                                         F.lit(0).cast("bigint").alias("b") if i == 0 else F.col("n").alias("b"))
             for i, d in enumerate((current, previous))]
    counts = sides[0].union(sides[1]).groupBy("value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # a one-row subquery over the counts, whose shuffle the plan reuses
    totals = counts.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b")).alias("t")).scalar()
    share = {c: F.coalesce(F.try_divide(F.col(c), F.col("_t")[c]), F.lit(0.0)) for c in ("a", "b")}
    gap = counts.withColumn("_t", totals).agg(F.max(F.abs(share["a"] - share["b"])).alias("gap"))
    return gap.select(F.inline(F.array(_result(col, "linf_drift", F.coalesce("gap", F.lit(0.0)), threshold, F.coalesce("gap", F.lit(0.0)) <= threshold))))


def validate(df: DataFrame, spec: FeatureSpec, previous: DataFrame | None = None) -> DataFrame:
    """All checks as (feature, check, observed, limit, passed) rows (V9)."""
    known = [f for f in spec.features if f.name in df.columns]
    checks = [check_type(df, spec), _row_checks(df, spec, ("min_fraction", "min_count", "min_values", "max_values"))]
    checks += [check_domain_mass(df, f.name, f.domain, f.min_domain_mass) for f in known if f.domain and f.min_domain_mass is not None]
    if previous is not None:
        checks += [linf_drift(df, previous, f.name, f.drift_linf) for f in known if f.drift_linf is not None and f.name in previous.columns]
    return reduce(DataFrame.unionByName, checks)


def check_roundtrip(original: DataFrame, decoded: DataFrame, key: str, tags: str = "tags") -> DataFrame:
    """One row (differences): members that occur on one side only."""
    left = original.select(key, F.explode(F.array_distinct(tags)).alias("tag"))
    right = decoded.select(key, F.explode(F.array_distinct(tags)).alias("tag"))
    sides = left.withColumn("side", F.lit(1)).union(right.withColumn("side", F.lit(-1)))
    per_tag = sides.groupBy(key, "tag").agg(F.sum("side").alias("balance"))
    return per_tag.agg(F.count_if(F.col("balance") != 0).alias("differences"))


def check_predictions(df: DataFrame, scores: str) -> DataFrame:
    """One row (num_rows, nan_rows, outside_rows): scores must be numbers strictly between 0 and 1."""
    nan = F.exists(scores, lambda p: F.isnan(p) | p.isNull())
    outside = F.exists(scores, lambda p: (p <= 0) | (p >= 1))
    return df.agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(nan).alias("nan_rows"), F.count_if(outside).alias("outside_rows"))

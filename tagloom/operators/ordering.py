"""Ranking operators that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.text import fingerprint
from tagloom.session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits


def _sorted_slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition and sort ``df``; ``_at`` orders all rows and ``_slice`` is the partition.

    The result is written to the checkpoint folder: every later use, and every retry after a lost
    executor, must see the same slices.
    """
    ordered = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    return cut_lineage(ordered).withColumn("_slice", F.shiftright("_at", _POSITION_BITS))


def with_row_id(df: DataFrame, *order: Column, name: str = "idx", start: int = 0) -> DataFrame:
    """Dense row numbers along a total order (W2) without a one-partition window. Runs a job."""
    rows = _sorted_slices(df, order)
    # one row per partition of the sort, so the window and the broadcast have a fixed small size
    sizes = rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        rows.join(F.broadcast(starts), "_slice")
        .withColumn(name, position + F.col("_before") + F.lit(start))
        .drop("_at", "_slice", "_before")
    )


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    """Running sums of ``values`` per key along ``order``, the current row included. Runs a job.

    A window over the key would put a hot key into one task. Here rows are cut into sorted slices,
    summed inside each slice, and moved up by the totals of the earlier slices. ``order`` must be a
    total order within a key.
    """
    rows = _sorted_slices(df, [*[F.col(k) for k in keys], *order])
    parts = [*keys, "_slice"]
    names = list(values)
    totals = rows.groupBy(*parts).agg(*[F.sum(values[n]).alias(f"_t_{n}") for n in names])
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(p).alias(f"_k_{p}") for p in parts],
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in names],
    )
    inside = W.partitionBy(*parts).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(values[n]).over(inside).alias(f"_r_{n}") for n in names])
    same = [F.col(p).eqNullSafe(F.col(f"_k_{p}")) for p in parts]
    condition = same[0]
    for extra in same[1:]:
        condition = condition & extra
    joined = local.join(starts, condition)
    return joined.select(*df.columns, *[(F.col(f"_r_{n}") + F.col(f"_b_{n}")).alias(n) for n in names])


def head_per_group(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column], n: int, name: str | None = None) -> DataFrame:
    """First ``n`` rows per key (W3, W5, O4); ``name`` keeps the 1-based rank.

    Spark applies the limit in each task before the shuffle, so a hot key sends at most ``n`` rows
    per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rank = name or "_rank"
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)
    return ranked if name else ranked.drop(rank)


def with_rank(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The 1-based place of every row in its key (W7), balanced for hot keys. Runs a job."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return running_totals(df, keys, order, {name: F.lit(1)})


def tail_per_group(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column], n: int) -> DataFrame:
    """All rows after the first ``n`` per key (W4), in ascending order, balanced for hot keys. Runs a job.

    Only keys and order values are ranked, and of these only the first ``n`` per key and task are shuffled: a key's n-th place
    tells which rows are behind it. Whole rows are sorted and stored for those keys alone whose n-th place is held by more rows than fit.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)])
    narrow = df.select(*keys, place.alias("_place"))
    head = head_per_group(narrow, keys, [F.col("_place")], n).groupBy(*keys).agg(F.sort_array(F.collect_list("_place")).alias("_head"))
    last = F.element_at("_head", -1)
    full = head.where(F.size("_head") == n).select(*[F.col(k).alias(f"_k_{k}") for k in keys], last.alias("_last"), F.size(F.array_remove("_head", last)).alias("_before"))
    full = cut_lineage(full)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    held = narrow.join(full, same).where(F.col("_place") == F.col("_last")).groupBy(*full.columns).agg(F.count(F.lit(1)).alias("_held"))
    tied = held.where(F.col("_before") + F.col("_held") > n).drop("_held")
    later = df.join(full, same).where(place > F.col("_last")).select(*df.columns)
    ties = df.join(cut_lineage(tied), same).where(place == F.col("_last"))
    ranked = with_rank(ties.select(*df.columns, "_before"), keys, order, "_rank")
    return later.unionByName(ranked.where(F.col("_before") + F.col("_rank") > n).select(*df.columns))


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key over a stated order."""
    return head_per_group(df, keys, order, 1)


def topk_per_group(df: DataFrame, keys: Sequence[str] | str, score: str, k: int, tie: str, rank: str = "rank") -> DataFrame:
    """The ``k`` highest scores per key with their rank, ties by ``tie`` ascending."""
    return head_per_group(df, keys, [F.desc(score), F.asc(tie)], k, rank)


def sample_keys(df: DataFrame, key: str, n: int = 50_000, salt: str = "3") -> DataFrame:
    """A reproducible sample of ``n`` keys by salted hash order (W1). ``df`` has one row per key."""
    return df.orderBy(fingerprint(F.col(key), salt=salt), F.col(key)).limit(n)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in a seeded hash order of the rows' key columns (P13), the same on every run."""
    return df.orderBy(fingerprint(F.concat_ws("|", *keys), salt=str(seed)), *keys).limit(n)

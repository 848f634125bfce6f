"""Relational operators that the DataFrame API does not name directly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.ordering import running_totals


def distinct_apart(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Distinct rows for the small side of a join whose other side may have a hot key.

    The distinct runs on the columns as one value, so its result is not arranged by the join key.
    Spark then shuffles it once more for the join, and can split a hot key of the other side; it
    cannot when an aggregate feeds the join directly.
    """
    return df.select(F.struct(*cols).alias("_row")).distinct().select("_row.*")


def remap_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others (P5)."""
    if not mapping:
        return col
    branches = reduce(lambda acc, kv: acc.when(col == kv[0], F.lit(kv[1])), mapping.items(), F)
    return branches.otherwise(col)


def when_or_null(condition: Column, col: Column) -> Column:
    """The value where the condition holds, else a typed NULL."""
    return F.when(condition, col)


def flag_members(df: DataFrame, col: str, reference: DataFrame, ref_col: str, flag: str = "is_member") -> DataFrame:
    """Mark the rows whose value occurs in another list."""
    known = distinct_apart(reference, F.col(ref_col).alias("_ref")).withColumn("_hit", F.lit(True))
    joined = df.join(known, F.col(col) == F.col("_ref"), "left")
    return joined.select(*df.columns, F.col("_hit").isNotNull().alias(flag))


def join_ci(left: DataFrame, right: DataFrame, left_col: str, right_col: str, how: str = "inner") -> DataFrame:
    """Equi join that ignores case."""
    return left.join(right, F.lower(left[left_col]) == F.lower(right[right_col]), how)


def join_on_membership(left: DataFrame, left_key: str, array_col: str, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` joined to each row of ``right`` whose key is a member of the array.

    Members are made distinct before the explode: the test is membership, not multiplicity. The
    join is then an equi join on the member, where comparing every pair would be quadratic. Only ``left_key``, unique
    per row, travels with a member; the other columns are joined to the pairs that are found.
    """
    members = left.select(F.col(left_key).alias("_key"), F.explode(F.array_distinct(array_col)).alias("_member"))
    pairs = members.join(right, F.col("_member") == right[key]).drop("_member")
    return left.join(pairs, F.col(left_key) == F.col("_key")).drop("_key")


def array_concat_agg(df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str], out: str | None = None) -> DataFrame:
    """Per key, the members of all arrays in row order, duplicates kept (A9); NULL arrays add nothing.

    The result is one cell per key. Where a key's members may be too many for a cell, use the long form,
    :func:`array_members`.
    """
    rows = df.where(F.col(col).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(col).alias("_v")))).alias("_rows"))
    return rows.select(*keys, F.flatten(F.transform("_rows", lambda r: r["_v"])).alias(out or col))


def array_members(df: DataFrame, keys: Sequence[str], col: str, order: Sequence[str], out: str = "value") -> DataFrame:
    """(keys, order, pos, value): every array member as a row, in any number (the long form of A5, A8, A9, A13)."""
    return df.select(*keys, *order, F.posexplode(col).alias("pos", out))


def _copies(df: DataFrame, keys: Sequence[str], col: str, out: str = "_v") -> DataFrame:
    """(keys, value, _n): the distinct texts of every key with their number. A digest stands for the text in the grouping key."""
    name = F.sha2(F.col(col).cast("string"), 256)
    rows = df.select(*keys, F.col(col).alias(out), name.alias("_digest"))
    return rows.groupBy(*keys, "_digest").agg(F.min(out).alias(out), F.count(F.lit(1)).alias("_n")).drop("_digest")


def copies_joined(pairs: Column, sep: str) -> Column:
    """Join sorted (v, n) structs, each value ``n`` times; NULL for none."""
    texts = F.transform(pairs, lambda p: F.concat(F.repeat(F.concat(p["v"], F.lit(sep)), (p["n"] - 1).cast("int")), p["v"]))
    return F.when(F.array_size(pairs) > 0, F.array_join(texts, sep))


def string_agg(df: DataFrame, keys: Sequence[str], col: str, sep: str, distinct: bool = False, out: str | None = None) -> DataFrame:
    """Join a group's texts in ascending order, NULLs left out (A4, A5).

    Equal texts are counted first, so copies cross the shuffle once per task. A group without any
    text gives NULL. The result is one cell per group; :func:`text_chunks` gives the same text in pieces.
    """
    pairs = F.sort_array(F.collect_list(F.when(F.col("_v").isNotNull(), F.struct(F.col("_v").alias("v"), (F.lit(1) if distinct else F.col("_n")).alias("n")))))
    grouped = _copies(df, keys, col).groupBy(*keys).agg(pairs.alias("_pairs"))
    return grouped.select(*keys, copies_joined(F.col("_pairs"), sep).alias(out or col))


def text_chunks(df: DataFrame, keys: Sequence[str], col: str, sep: str, distinct: bool = False, out: str | None = None, size: int = 1 << 20) -> DataFrame:
    """(keys, chunk, text): what :func:`string_agg` joins, in pieces of ``size`` characters, chunk 0 first. Runs a job.

    A group may have any number of texts and characters: running totals over the sorted distinct texts tell where each text's copies
    begin, and every task cuts only the pieces of its own. The last piece is shorter; a group without any text has no piece.
    """
    step = F.col("_length") * (F.lit(1) if distinct else F.col("_n"))
    rows = _copies(df, keys, col).where(F.col("_v").isNotNull()).withColumn("_length", F.length("_v").cast("long") + len(sep))
    totals = running_totals(rows, keys, [F.col("_v")], {"_end": step}).withColumn("_begin", F.col("_end") - step)
    # every copy stands behind a separator; the first one's lies before place 0
    begin, end = F.col("_begin") - len(sep), F.col("_end") - len(sep)
    cut = totals.select(*keys, "_v", "_length", begin.alias("_begin"), F.explode(F.sequence(F.floor(F.greatest(begin, F.lit(0)) / size), F.floor((end - 1) / size))).alias("chunk"), end.alias("_end"))
    first, last = F.greatest(F.col("chunk") * size, F.col("_begin"), F.lit(0)), F.least((F.col("chunk") + 1) * size, F.col("_end"))
    offset = F.pmod(first - F.col("_begin"), F.col("_length"))
    unit = F.concat(F.lit(sep), F.col("_v"))
    piece = F.substring(F.repeat(unit, F.ceil((offset + last - first) / F.col("_length")).cast("int")), (offset + 1).cast("int"), (last - first).cast("int"))
    pieces = cut.where(last > first).select(*keys, "chunk", F.struct(first.alias("at"), piece.alias("text")).alias("_piece"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list("_piece")), lambda p: p["text"]), "")
    return pieces.groupBy(*keys, "chunk").agg(text.alias(out or col))


def distinct_array(col: str) -> Column:
    """A group's distinct values, ascending.

    Every task collects its distinct values first, so copies cross the one shuffle once per task, and several such
    columns need no extra copies of the rows.
    """
    return F.sort_array(F.collect_set(col))


def distinct_text(col: str, sep: str) -> Column:
    """A group's distinct texts joined in ascending order, NULL for none (A4); see :func:`distinct_array`."""
    return F.when(F.count(col) > 0, F.array_join(distinct_array(col), sep))


def array_histogram(df: DataFrame, keys: Sequence[str], col: str, out: str = "stats") -> DataFrame:
    """Per key, how often each array member occurs, as sorted (value, count) structs."""
    counted = df.select(*keys, F.explode(col).alias("value")).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("count"))
    return counted.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("value", "count"))).alias(out))


def listed_values(df: DataFrame, keys: Sequence[str], col: str, out: str = "value") -> DataFrame:
    """(keys, value, n, first): the sorted list of a group's values as rows, equal ones as one row with their number and first place.

    The long form of the lists of :func:`first_and_list`, for groups of any size. Runs a job.
    """
    rows = _copies(df, keys, col, out).where(F.col(out).isNotNull()).withColumnRenamed("_n", "n")
    totals = running_totals(rows, keys, [F.col(out)], {"_upto": F.col("n")})
    return totals.select(*keys, out, "n", (F.col("_upto") - F.col("n")).alias("first"))


def first_and_list(df: DataFrame, keys: Sequence[str], firsts: Sequence[str], lists: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, some columns from its first row and others as sorted lists.

    Equal list values are counted before the group is put together, so copies add counts, not rows. A list is one cell per
    key; :func:`listed_values` gives it as rows.
    """
    head = df.groupBy(*keys).agg(F.min(F.struct(*order, *firsts)).alias("_first"))
    out = head.select(*keys, *[F.col("_first")[c].alias(c) for c in firsts])
    for c in lists:
        counted = _copies(df.where(F.col(c).isNotNull()), keys, c, c)
        pairs = F.sort_array(F.collect_list(F.struct(F.col(c).alias("v"), F.col("_n").cast("int").alias("n"))))
        members = counted.groupBy(*keys).agg(F.flatten(F.transform(pairs, lambda p: F.array_repeat(p["v"], p["n"]))).alias(c))
        out = out.join(members, list(keys), "left")
    return out


def union_arrays(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key, the set union of each array column (A14), in one pass over the rows."""

    def tagged(c: str) -> Column:
        values = F.coalesce(F.col(c).cast("array<string>"), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(c).alias("c"), v.alias("v")))

    pairs = F.flatten(F.array(*[tagged(c) for c in cols]))
    members = df.select(*keys, F.explode_outer(pairs).alias("_m")).select(*keys, "_m.c", "_m.v").distinct()
    types = {f.name: f.dataType for f in df.schema.fields}
    return members.groupBy(*keys).agg(*[
        F.sort_array(F.collect_list(F.when(F.col("c") == c, F.col("v"))).cast(types[c])).alias(c) for c in cols
    ])


def _by_key(df: DataFrame, keys: Sequence[str], vec: str, pick: Column, out: str) -> DataFrame:
    # the keys as one value, for the reason given at distinct_apart: results are often joined back
    grouped = df.groupBy(F.struct(*keys).alias("_keys")).agg(pick.alias("_v"))
    return grouped.select("_keys.*", vector_to_array("_v").alias(out))


def sum_vectors(df: DataFrame, keys: Sequence[str], vec: str, out: str | None = None) -> DataFrame:
    """Element-wise vector sum per key, combined in the map tasks first."""
    return _by_key(df, keys, vec, Summarizer.sum(array_to_vector(F.col(vec).cast("array<double>"))), out or vec)


def mean_vectors(df: DataFrame, keys: Sequence[str], vec: str, out: str | None = None) -> DataFrame:
    """Element-wise vector mean per key, combined in the map tasks first."""
    return _by_key(df, keys, vec, Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>"))), out or vec)


def num_labels(df: DataFrame, col: str, out: str = "labels_count") -> DataFrame:
    """Number of distinct array members over all rows (A2)."""
    return df.select(F.explode(col).alias("t")).agg(F.count_distinct("t").alias(out))


def top_values(df: DataFrame, col: str, n: int = 100) -> DataFrame:
    """The ``n`` most frequent values with counts, ties by value (O2)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("counter"))
    return counts.orderBy(F.desc("counter"), F.asc(col)).limit(n)


def keep_top_values(df: DataFrame, col: str, n: int = 100) -> DataFrame:
    """Rows whose value is one of the ``n`` most frequent (A23). The kept list has at most ``n`` rows."""
    return df.join(F.broadcast(top_values(df, col, n).select(col)), col, "left_semi")


def share_matching(df: DataFrame, keys: Sequence[str], left: str, right: str, out: str) -> DataFrame:
    """Share of a key's rows where two columns agree."""
    return df.groupBy(*keys).agg(F.avg((F.col(left) == F.col(right)).cast("double")).alias(out))


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row results with different column names as one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in stacked.columns])

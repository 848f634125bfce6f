"""Two trees of directions, and the pairs of blocks that an exact top-k ranking has to look at.

Rows of one side are split by the nearest of a few of their own rows, level by level, until a node fits a block. A node's
shape is a centre and the greatest angle to it. What two nodes can score at best follows from the angle between their centres
and their radii. The ranking goes down both trees twice: first to the nearest nodes only, where a worst k-th score per
left block comes from real scores; then with that score carried down, past every pair of nodes that cannot reach it.

Everything is a table keyed by node: rows meet the pivots of their node in groups of a block's size, pairs of nodes meet their
shapes in joins. No node holds more than ``FANOUT`` children, no pivot or shape reaches the driver, nothing is broadcast by hand.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagloom.session import cut_lineage

# the block functions travel to the tasks by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FANOUT = 16
_DEEPEST = 24  # below, nodes are cut by hash
STEP = "\x1f"  # between the parts of a node's name; JSON escapes it, so no group holds it
_ANGLE_SLACK = 1e-7  # what doubles lose in an arc cosine
_NEAREST = 3  # nodes that the first descent follows at least

Directions = Callable[[np.ndarray], np.ndarray]


def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long vectors as a matrix of doubles."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in chunks]
    flat = flat[0].astype(np.float64, copy=False) if len(flat) == 1 else np.concatenate(flat, dtype=np.float64)  # one copy at most
    if len(column) and flat.size % len(column):
        raise ValueError("vectors differ in length")
    return flat.reshape(len(column), -1)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a row of zeros stays."""
    size = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(size > 0, size, 1.0)[:, None]


def root_directions(rows: np.ndarray) -> np.ndarray:
    """Square roots of the shares of non-negative rows: their cosine is the Bhattacharyya coefficient."""
    return unit_rows(np.sqrt(np.maximum(rows, 0.0)))


def best_cosine(angle: np.ndarray) -> np.ndarray:
    """The greatest cosine at an angle or more."""
    return np.cos(angle)


def best_divergence(angle: np.ndarray) -> np.ndarray:
    """Minus the least divergence of shares whose root directions are that far apart.

    By Jensen's inequality KL(p, q) >= -2 ln(sum of sqrt(p q)), and that holds in both directions.
    """
    with np.errstate(divide="ignore"):
        return 2 * np.log(np.maximum(np.cos(angle), 0.0))


@dataclass(frozen=True)
class Tree:
    """``rows`` with their leaf ``_node``; ``nodes`` (node, parent, depth, leaf, n, hide, real, centre, radius)."""

    rows: DataFrame
    nodes: DataFrame
    depth: int


def group_name(by: str | None) -> Column:
    """The name of a row's group, the root of its tree. Null is a group."""
    return F.to_json(F.struct(F.col(by).alias("by"))) if by else F.lit("")


def grow(side: DataFrame, directions: Directions, block_rows: int, by: str | None = None) -> Tree:
    """The tree of the rows (id, vec, and others; ``hide`` if there). Runs jobs, a few per level.

    Rows without a direction have trees of their own, which are cut by hash like nodes of equal rows.
    """
    real = F.exists("vec", lambda v: v != 0) & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    root = F.when(F.col("_real"), group_name(by)).otherwise(F.concat(group_name(by), F.lit("!")))
    hashed = F.xxhash64("id", F.monotonically_increasing_id())  # stored at once: rows of one id differ
    active = cut_lineage(side.withColumn("_h", hashed).withColumn("_real", real).withColumn("_node", root))
    schema = active.schema
    arrow_schema = to_arrow_schema(schema)
    done, depth = [], 0
    while True:
        sizes = cut_lineage(active.groupBy("_node").agg(F.count(F.lit(1)).alias("_n")))
        big = sizes.where(F.col("_n") > block_rows).select("_node", F.ceil(F.col("_n") / block_rows).cast("int").alias("_s"))
        if big.isEmpty():
            break
        big = F.broadcast(big)  # a row per block of rows at most; without it Spark sends every row to meet its node's size
        done.append(active.join(big, "_node", "left_anti"))
        rows = active.join(big, "_node")
        least = rows.groupBy("_node", F.pmod(F.shiftright("_h", 8), F.lit(FANOUT)).alias("_b")).agg(F.min("_h").alias("_h")).drop("_b")
        pivots = rows.join(F.broadcast(least), ["_node", "_h"]).groupBy("_node").agg(F.collect_list("vec").alias("pivots"))
        sent = pivots.join(big, "_node").select(F.col("_node").alias("_of"), F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("_part"), "pivots")
        salted = rows.withColumn("_salt", F.pmod("_h", "_s").cast("int")).drop("_s")
        active = cut_lineage(salted.groupBy("_node", "_salt").cogroup(sent.groupBy("_of", "_part")).applyInArrow(_dealt(directions, arrow_schema, depth), schema))
        depth += 1
    if done:
        active = cut_lineage(reduce(DataFrame.unionByName, done, active.select(*schema.names)))
    return Tree(active, _shapes(active, directions, depth), depth)


def _dealt(directions: Directions, arrow_schema: pa.Schema, depth: int):
    """The task that names the children of the rows of one node."""

    def run(rows: pa.Table, sent: pa.Table) -> pa.Table:
        if not len(rows):
            return arrow_schema.empty_table()
        pivots = directions(matrix_of(sent.column("pivots").combine_chunks().flatten()))
        apart: list[np.ndarray] = []
        for p in pivots:
            if not any(p @ q > 1 - 1e-12 for q in apart) and p.any():
                apart.append(p)
        if len(apart) < 2 or depth >= _DEEPEST:
            digits = (rows.column("_h").to_numpy() >> (4 * depth % 64)) & (FANOUT - 1)
            child = np.char.add("=", digits.astype(str))
        else:
            child = (directions(matrix_of(rows.column("vec"))) @ np.array(apart).T).argmax(axis=1).astype(str)
        name = rows.column("_node")[0].as_py() + STEP
        at = rows.schema.get_field_index("_node")
        return rows.set_column(at, "_node", pa.array([name + c for c in child], pa.string())).select(arrow_schema.names).cast(arrow_schema)

    return run


_SHAPE = T.StructType([
    T.StructField("node", T.StringType()), T.StructField("leaf", T.BooleanType()), T.StructField("n", T.LongType()), T.StructField("hide", T.LongType()),
    T.StructField("real", T.BooleanType()), T.StructField("centre", T.ArrayType(T.DoubleType())), T.StructField("radius", T.DoubleType()),
])


def _parent(node: str | Column) -> Column:
    return F.regexp_extract(node, f"^(.*){STEP}[^{STEP}]*$", 1)


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip((x * y).sum(axis=1), -1.0, 1.0))


def _shapes(rows: DataFrame, directions: Directions, depth: int) -> DataFrame:
    """All nodes with their shapes, from the leaves to the roots."""
    arrow_schema = to_arrow_schema(_SHAPE)

    def shape(name: str, leaf: bool, n: int, hide: int, real: bool, units: np.ndarray, weights: np.ndarray, radii: np.ndarray) -> pa.Table:
        centre = unit_rows((units * weights[:, None]).sum(axis=0, keepdims=True))
        centre = centre if centre.any() else units[:1]
        radius = float((_angles(units, centre) + radii).max()) + _ANGLE_SLACK if real else math.pi
        return pa.table([[name], [leaf], [n], [hide], [real], [centre[0].tolist()], [min(radius, math.pi)]], schema=arrow_schema)

    def leaf(block: pa.Table) -> pa.Table:
        units = directions(matrix_of(block.column("vec")))
        hide = max(block.column("hide").to_pylist()) if "hide" in block.column_names else 0
        return shape(block.column("_node")[0].as_py(), True, len(block), hide, block.column("_real")[0].as_py(), units, np.ones(len(units)), np.zeros(len(units)))

    def inner(block: pa.Table) -> pa.Table:
        n = block.column("n").to_numpy()
        return shape(block.column("parent")[0].as_py(), False, int(n.sum()), max(block.column("hide").to_pylist()), block.column("real")[0].as_py(),
                     matrix_of(block.column("centre")), n.astype(float), block.column("radius").to_numpy())

    needed = [c for c in ("_node", "_real", "vec", "hide") if c in rows.columns]
    leaves = cut_lineage(rows.select(*needed).groupBy("_node").applyInArrow(leaf, _SHAPE))
    steps = F.length("node") - F.length(F.replace("node", F.lit(STEP), F.lit("")))
    leaves = leaves.withColumn("depth", steps).withColumn("parent", _parent("node"))
    levels, below = [], None
    for d in range(depth, -1, -1):
        level = leaves.where(F.col("depth") == d)
        level = level if below is None else cut_lineage(level.unionByName(below))
        levels.append(level)
        if d:
            below = level.groupBy("parent").applyInArrow(inner, _SHAPE).withColumn("depth", F.lit(d - 1)).withColumn("parent", _parent("node"))
    return cut_lineage(reduce(DataFrame.unionByName, levels))


def _measured(pairs: DataFrame, left: Tree, right: Tree, best: Callable[[np.ndarray], np.ndarray], worst: float) -> DataFrame:
    """(l, r, nl, n, hide, apart, far, best) of the pairs (l, r): rows on both sides, the angle of the centres and the greatest angle, the best score."""
    mine = left.nodes.select(F.col("node").alias("l"), F.col("centre").alias("lc"), F.col("radius").alias("lr"), F.col("n").alias("nl"), "hide")
    theirs = right.nodes.select(F.col("node").alias("r"), F.col("centre").alias("rc"), F.col("radius").alias("rr"), "n", "real")
    both = pairs.join(mine, "l").join(theirs, "r").select("l", "r", "nl", "n", "hide", "real", "lc", "lr", "rc", "rr")
    kinds = {"l": T.StringType(), "r": T.StringType(), "nl": T.LongType(), "n": T.LongType(), "hide": T.LongType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in (*kinds, "apart", "far", "best")])
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            real = b.column("real").to_numpy(zero_copy_only=False)
            apart = np.where(real, _angles(matrix_of(b.column("lc")), matrix_of(b.column("rc"))), math.pi)
            reach = b.column("lr").to_numpy() + b.column("rr").to_numpy() + _ANGLE_SLACK
            found = np.where(real, best(np.maximum(apart - reach, 0.0)), worst)
            yield pa.record_batch([*[b.column(c) for c in kinds], pa.array(apart), pa.array(np.minimum(apart + reach, math.pi)), pa.array(found)], schema=arrow_schema)

    return both.mapInArrow(run, schema)


def _children(pairs: DataFrame, left: Tree, right: Tree) -> DataFrame:
    """The pairs of the children of (l, r); a leaf is its own child."""
    out = pairs.select("l", "r")
    for name, tree in (("l", left), ("r", right)):
        below = tree.nodes.where("depth > 0").select(F.col("parent").alias(name), F.col("node").alias("_child"))
        out = out.join(below, name, "left").withColumn(name, F.coalesce("_child", name)).drop("_child")
    return out


def _roots(left: Tree, right: Tree) -> DataFrame:
    """The pairs of roots of one group; rows without a direction only on the right."""
    top = lambda tree: tree.nodes.where("depth = 0")
    mine = top(left).where("real").select(F.col("node").alias("l"), F.col("node").alias("_g"))
    return mine.join(top(right).select(F.col("node").alias("r"), F.when(F.col("real"), F.col("node")).otherwise(F.expr("left(node, length(node) - 1)")).alias("_g")), "_g").drop("_g")


def nearest_pairs(left: Tree, right: Tree, need: int, best: Callable, worst: float) -> DataFrame:
    """The leaves (l, r) near each left leaf that together have ``need`` rows to offer, and those that it hides besides."""
    pairs = _roots(left, right)
    order = W.partitionBy("l").orderBy("apart", "r")
    for _ in range(max(left.depth, right.depth) + 1):
        before = F.sum("n").over(order) - F.col("n")
        ranked = _measured(pairs, left, right, best, worst).withColumn("_before", before).withColumn("_place", F.row_number().over(order))
        kept = cut_lineage(ranked.where((F.col("_before") < need + F.col("hide")) | (F.col("_place") <= _NEAREST)).select("l", "r"))
        pairs = _children(kept, left, right)
    return kept


def reaching_pairs(left: Tree, right: Tree, floors: DataFrame, best: Callable, worst: float) -> DataFrame:
    """The leaves (l, r) whose best score reaches the floor (l, floor) of the left leaf; floors are carried to all nodes above."""
    parts = F.split("l", STEP)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), STEP))
    floors = cut_lineage(floors.select(F.explode(above).alias("l"), "floor").groupBy("l").agg(F.min("floor").alias("floor")))
    pairs = _roots(left, right)
    for _ in range(max(left.depth, right.depth) + 1):
        measured = _measured(pairs, left, right, best, worst).join(floors, "l")
        kept = cut_lineage(measured.where(F.col("best") >= F.col("floor") - 1e-9).select("l", "r"))
        pairs = _children(kept, left, right)
    return kept


def open_pairs(left: Tree, right: Tree, lo: float, hi: float) -> tuple[DataFrame, int, int]:
    """(leaves (l, r, least, best) with cosines that may lie in [lo, hi], row pairs below, row pairs above). Whole pairs of nodes
    whose cosines all lie on one side are counted and not opened. Rows without a direction are left out."""
    pairs = _roots(left, right).where(~F.col("r").endswith("!"))
    counts = {"below": 0, "above": 0}
    for _ in range(max(left.depth, right.depth) + 1):
        measured = _measured(pairs, left, right, best_cosine, -1.0).withColumn("least", F.cos("far"))
        side = F.when(F.col("best") < lo - 1e-9, "below").when(F.col("least") > hi + 1e-9, "above")
        sided = cut_lineage(measured.withColumn("side", side))
        rows = (F.col("nl").cast("decimal(38,0)") * F.col("n")).cast("decimal(38,0)")
        for r in sided.where("side IS NOT NULL").groupBy("side").agg(F.sum(rows).alias("n")).collect():
            counts[r["side"]] += int(r["n"])
        kept = sided.where("side IS NULL").select("l", "r", "least", "best")
        pairs = _children(kept, left, right)
    return kept, counts["below"], counts["above"]

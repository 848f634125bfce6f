"""Mixing sources to target weights by the cube method (operator 2).

A source's target over its size is the number of times each of its documents is due: whole copies are taken for
certain, the fraction is an inclusion probability. The fractions are rounded by the cube method: three documents at a time
move along the direction that keeps both the sum of probabilities (documents) and the sum of probability times size (tokens),
until one of them is 0 or 1. A block of rows ends with at most two open documents; those of all blocks of a source meet
in new blocks, level by level, until each source has at most two. The landing draws these jointly, with
their probabilities, so that the token total comes as near as it can. A source's last block is drawn anew up to ``DRAWS``
times, and the draw nearest in tokens stands.

Targets share ``budget`` times all words by the sources' weights; none exceeds twice its source's size, and what is over goes to
the others by weight until none is above. Sources are ordered by code point, null last, and take the weights in turn.

Null texts have size 0 and null sources are a source of their own. A source of size 0 has target 0 and nothing is taken.
Blocks and random numbers depend on ids and ``seed`` alone, so reruns agree. Rows with the same id and source are one
document, taken or left together. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import n_words, unused
from tagloom.operators.ordering import with_row_id
from tagloom.session import cut_lineage

BLOCK = 4096  # documents of a block of the flight
DRAWS = 32
CAP = 2.0
_EPS = 1e-9


def targets(sources: DataFrame, weights: Sequence[float], budget: float, cap: float = CAP) -> DataFrame:
    """Add ``target`` to (source, source_size): weighted shares under a cap.  One job per round of resharing."""
    listed = with_row_id(sources, F.col("source").asc_nulls_last(), name="_place")
    share = F.array(*[F.lit(float(w)) for w in weights])
    listed = cut_lineage(listed.withColumn("_weight", F.element_at(share, (F.col("_place") % len(weights) + 1).cast("int"))))
    total = listed.agg(F.sum("source_size")).first()[0] or 0  # numbers only come to the driver
    level = 0.0  # words per unit of weight
    limit = F.col("source_size") * cap
    while total:
        above = F.col("_weight") * level > limit
        open_, full = listed.agg(F.sum(F.when(~above, F.col("_weight"))), F.sum(F.when(above, limit))).first()
        if not open_:
            break
        higher = (budget * total - (full or 0.0)) / open_
        if higher <= level:
            break
        level = higher
    return listed.select("source", "source_size", "_n", F.least(F.col("_weight") * level, limit).alias("target"))


def flight(size: Sequence[int], chance: Sequence[float], rng: random.Random) -> list[float]:
    """Move the probabilities to 0 or 1, all but at most two of them, with the sums of probability and of size kept."""
    chance = list(chance)
    live: list[int] = []
    for i in range(len(chance)):
        if not _EPS < chance[i] < 1 - _EPS:
            chance[i] = float(round(chance[i]))
            continue
        live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        x, y, z = size[a], size[b], size[c]
        step = (y - z, z - x, x - y) if not x == y == z else (1, -1, 0)
        up = min((1 - chance[k]) / u if u > 0 else chance[k] / -u for k, u in zip(live, step) if u)
        down = min(chance[k] / u if u > 0 else (1 - chance[k]) / -u for k, u in zip(live, step) if u)
        way = up if rng.random() < down / (up + down) else -down
        for k, u in zip(live, step):
            chance[k] += way * u
            if chance[k] < _EPS or chance[k] > 1 - _EPS:
                chance[k] = float(round(chance[k]))
        live = [k for k in live if _EPS < chance[k] < 1 - _EPS]
    return chance


def landing(size: Sequence[int], chance: Sequence[float], rng: random.Random) -> list[float]:
    """Settle at most two open documents: of the joint draws with the right probabilities, the one nearest in tokens."""
    chance = list(chance)
    live = [i for i, p in enumerate(chance) if _EPS < p < 1 - _EPS]
    if len(live) == 1:
        chance[live[0]] = float(rng.random() < chance[live[0]])
    elif live:
        a, b = live
        p, q = chance[a], chance[b]
        due = p * size[a] + q * size[b]
        def draws(both):
            return [((1.0, 1.0), both), ((1.0, 0.0), p - both), ((0.0, 1.0), q - both), ((0.0, 0.0), 1 - p - q + both)]
        def miss(d):
            return sum(w * abs(s * size[a] + t * size[b] - due) for (s, t), w in d)
        options = [draws(max(0.0, p + q - 1)), draws(min(p, q))]
        best, u = min(options, key=miss), rng.random()
        for (s, t), w in best:
            chance[a], chance[b] = s, t
            u -= w
            if u < 0:
                break
    return chance


def best_landing(size: Sequence[int], chance: Sequence[float], rng: random.Random, draws: int = DRAWS) -> list[float]:
    """Flight and landing of a source's last block, drawn anew until the token total is near; of ``draws`` the nearest."""
    due = sum(s * p for s, p in zip(size, chance))
    best, least = None, 0.0
    for _ in range(draws):
        drawn = landing(size, flight(size, chance, rng), rng)
        miss = abs(sum(s * p for s, p in zip(size, drawn)) - due)
        if best is None or miss < least:
            best, least = drawn, miss
        if least <= due / 2000:
            break
    return best


def _generator(seed: int, *parts) -> random.Random:
    return random.Random(hashlib.sha256(repr((seed, *parts)).encode()).digest())


def sample(units: DataFrame, seed: int = 11, block: int = BLOCK) -> DataFrame:
    """Round ``chance`` of (id, source, size, chance, _n) to 0 or 1, balanced within each source of ``_n`` units.

    A level is one shuffle of the open units. A source of at most ``block`` of them is settled in that level, whatever the
    others have; the open units of a larger one become two per block.
    """
    columns = ["id", "source", "size", "chance"]
    id_type, source_type = (units.schema[c].dataType.simpleString() for c in ("id", "source"))
    schema = f"id {id_type}, source {source_type}, size long, chance double"

    def level_of(number: int):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["_order", "size"], kind="stable")
            source = frame["source"].iloc[0]
            rng = _generator(seed, number, None if pd.isna(source) else str(source), int(frame["_block"].iloc[0]))
            size = frame["size"].tolist()
            chance = frame["chance"].tolist()
            last = frame["_n"].iloc[0] <= block
            chance = best_landing(size, chance, rng) if last else flight(size, chance, rng)
            return frame.assign(chance=chance)[columns]

        return run

    settled, number, current = None, 0, units
    while True:
        last = (current.agg(F.max("_n")).first()[0] or 0) <= block
        order = F.xxhash64("id", "source", F.lit(seed + number))
        # blocks by a hash of the unit within its source: about ``block`` rows each, whatever the source's share
        dealt = current.select(*columns, "_n", order.alias("_order"), F.pmod(order, F.ceil(F.col("_n") / block).cast("long")).alias("_block"))
        done = cut_lineage(dealt.groupBy("source", "_block").applyInPandas(level_of(number), schema))
        open_ = done.where(F.col("chance").between(_EPS, 1 - _EPS))
        closed = done.where(~F.col("chance").between(_EPS, 1 - _EPS))
        settled = closed if settled is None else settled.unionByName(closed)
        if last:
            return settled
        counts = open_.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
        current, number = open_.join(counts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), number + 1


def plan(sized: DataFrame, weights: Sequence[float], budget: float = 1.5, seed: int = 11) -> DataFrame:
    """(id, source, source_size, target, copies) of each unit of (id, source, size)."""
    units = sized.groupBy("id", "source").agg(F.sum("size").cast("long").alias("size"))
    sources = units.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    due = cut_lineage(targets(sources, weights, budget).withColumnRenamed("source", "_src"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    due = due.withColumn("_whole", F.floor(ratio + _EPS)).withColumn("chance", F.greatest(ratio - F.col("_whole"), F.lit(0.0)))
    same = F.col("source").eqNullSafe(F.col("_src"))
    settled = sample(units.join(due.select("_src", "chance", "_n"), same).drop("_src"), seed)
    copies = (F.col("_whole") + F.round(F.col("settled")).cast("long")).alias("copies")
    return settled.withColumnRenamed("chance", "settled").join(due.drop("chance"), same).select("id", "source", "source_size", "target", copies)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size")))


def mix(docs: DataFrame, weights: Sequence[float], budget: float = 1.5, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) of every row; ``taken`` counts the words of all copies that the mix takes."""
    sized = _sized(docs, id_col, text_col, source_col)
    chosen = plan(sized, weights, budget, seed).select(F.col("id").alias("_cid"), F.col("source").alias("_cs"), "source_size", "target", "copies")
    joined = sized.join(chosen, F.col("id").eqNullSafe(F.col("_cid")) & F.col("source").eqNullSafe(F.col("_cs")))
    return joined.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: Sequence[float], budget: float = 1.5, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as the mix takes it, all columns."""
    chosen = plan(_sized(docs, id_col, text_col, source_col), weights, budget, seed)
    names = [unused(docs, c) for c in ("unit", "origin", "copies", "again")]
    chosen = chosen.where("copies > 0").select("id", "source", "copies").toDF(*names[:3])
    joined = docs.join(chosen, F.col(id_col).eqNullSafe(F.col(names[0])) & F.col(source_col).eqNullSafe(F.col(names[1])))
    repeated = joined.withColumn(names[3], F.explode(F.sequence(F.lit(1), F.col(names[2]))))
    return repeated.select(*[F.col(c) for c in docs.columns])

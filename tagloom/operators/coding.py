"""Looking up the members of arrays in a table without shuffling the members.

A task cuts its rows into chunks and codes each chunk's members by the chunk's distinct ones. Only these meet the table: a member
that every text has is one row per chunk, not one per occurrence. Rows wait as arrays of codes, and get their chunk's answers in one
task of a bounded size; their members' places never leave the row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagloom.session import cut_lineage

# the tasks' functions travel by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 20  # members of a chunk; a longer row is a chunk alone
_CHUNKS_BITS = 33


def _parts(lengths: np.ndarray, limit: int):
    """(start, end) of runs of rows with at most ``limit`` members together."""
    start, held = 0, 0
    for k, n in enumerate(lengths.tolist()):
        if k > start and held + n > limit:
            yield start, k
            start, held = k, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def coded(rows: DataFrame, limit: int = CHUNK) -> DataFrame:
    """(_chunk, _key, _codes, _tokens) of the rows (_key, _members): one row each with codes, one per chunk with its distinct members.

    Stored, so that a chunk's number and codes stay what they are. Null rows have no members; a null member has the code -1.
    """
    schema = T.StructType([
        T.StructField("_chunk", T.LongType()), T.StructField("_key", rows.schema["_key"].dataType),
        T.StructField("_codes", T.ArrayType(T.IntegerType())), T.StructField("_tokens", T.ArrayType(T.StringType())),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        chunk = TaskContext.get().partitionId() << _CHUNKS_BITS
        for batch in batches:
            lists = batch.column(1)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            for start, end in _parts(lengths, limit):
                members = lists.slice(start, end - start).flatten().dictionary_encode()
                codes = pc.fill_null(members.indices, -1).cast(pa.int32())
                offsets = np.concatenate([[0], np.cumsum(lengths[start:end])]).astype(np.int32)
                n = end - start
                yield pa.record_batch([pa.array(np.full(n, chunk)), batch.column(0).slice(start, n), pa.ListArray.from_arrays(pa.array(offsets), codes), pa.nulls(n, arrow.field(3).type)], schema=arrow)
                tokens = pa.ListArray.from_arrays(pa.array([0, len(members.dictionary)], pa.int32()), members.dictionary)
                yield pa.record_batch([pa.array([chunk]), pa.nulls(1, arrow.field(1).type), pa.nulls(1, arrow.field(2).type), tokens], schema=arrow)
                chunk += 1

    return cut_lineage(rows.select("_key", "_members").mapInArrow(run, schema))


def looked_up(
    rows: DataFrame, table: DataFrame, answer: Callable[[pa.Array, pa.Array, np.ndarray, np.ndarray], pa.Array], out: T.DataType, limit: int = CHUNK,
) -> DataFrame:
    """(_key, _out) of the rows (_key, _members) by a table (_token, _value), whose tokens are unique.

    ``answer(tokens, values, codes, offsets)`` gets a chunk's distinct members with their values, null if the table lacks them, and the rows
    as codes (-1 for a null member), and returns one entry per row.
    """
    chunks = coded(rows, limit)
    asked = chunks.where(F.col("_tokens").isNotNull()).select(F.col("_chunk").alias("_of"), F.posexplode("_tokens").alias("_pos", "_asked"))
    found = asked.join(table.select("_token", "_value"), F.col("_asked") == F.col("_token"), "left").select("_of", "_pos", "_asked", "_value")
    schema = T.StructType([T.StructField("_key", rows.schema["_key"].dataType), T.StructField("_out", out)])
    arrow = to_arrow_schema(schema)

    def run(chunk: pa.Table, words: pa.Table) -> pa.Table:
        if not len(chunk):
            return arrow.empty_table()
        words = words.sort_by("_pos")
        lists = chunk.column("_codes").combine_chunks()
        codes, offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        column = answer(words.column("_asked").combine_chunks(), words.column("_value").combine_chunks(), codes, offsets)
        return pa.table([chunk.column("_key"), column], schema=arrow)

    waiting = chunks.where(F.col("_codes").isNotNull()).select("_chunk", "_key", "_codes")
    return waiting.groupBy("_chunk").cogroup(found.groupBy("_of")).applyInArrow(run, schema)


def listed(values: pa.Array, keep: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The kept ones of all values as one list per row."""
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.filter(pa.array(keep, pa.bool_())))

"""Text vectors learnt from the data: a randomised singular value decomposition of hashed word weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.relational import sum_vectors

WORDS = 1 << 16  # words of a block in a task
MOST_NUMBERS = 20_000_000  # of a dense matrix of columns x directions: 160 MB


def _spots(col: str, width: int) -> Column:
    """The hashed columns of a text's words, with repeats. NULL and empty texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(col), F.lit(""))), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(width)).cast("int"))


def _blocks(lists: pa.ListArray, idf: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, row, column, weight) of blocks of about ``WORDS`` words: the non-zero weights of unit rows, by row."""
    ends = np.cumsum(lists.value_lengths().to_numpy())
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + WORDS, "right")))
        part = lists.slice(start, stop - start)
        rows = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
        cells, counts = np.unique(rows * len(idf) + part.flatten().to_numpy(), return_counts=True)
        row, column = np.divmod(cells, len(idf))
        weight = counts * idf[column]
        length = np.sqrt(np.bincount(row, weight**2, len(part)))[row]
        some = length > 0
        yield len(part), row[some], column[some], weight[some] / length[some]
        start = stop


def _summed(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows of ``values`` by ascending key."""
    out = np.zeros((size, values.shape[1]))
    if len(keys):
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        out[keys[first]] = np.add.reduceat(values, first)
    return out


@dataclass(frozen=True)
class LatentVectors:
    """A fitted encoder (M1): ``basis`` (columns x dim) of the weights' leading directions, and their singular values."""

    idf: np.ndarray
    basis: np.ndarray
    singular: np.ndarray

    def encode(self, df: DataFrame, col: str, out: str = "vec") -> DataFrame:
        """Add a text's vector, of length 1; it is 0 where no word tells the text apart."""
        sent = df.sparkSession.sparkContext.broadcast((self.idf, self.basis))
        kept = [f for f in df.schema.fields if f.name != out]
        schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.DoubleType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, basis = sent.value
            for batch in batches:
                parts = [_summed(row, weight[:, None] * basis[column], n) for n, row, column, weight in _blocks(batch.column(0), idf)]
                made = np.concatenate(parts) if parts else np.empty((0, basis.shape[1]))
                length = np.linalg.norm(made, axis=1, keepdims=True)
                made = np.divide(made, length, out=np.zeros_like(made), where=length > 1e-9)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * basis.shape[1], pa.int32()), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], vectors], names=schema.names)

        return df.select(_spots(col, len(self.idf)).alias("_spots"), *[f.name for f in kept]).mapInArrow(run, schema)


def fit_latent_vectors(df: DataFrame, col: str, dim: int = 64, width: int = 1 << 14, extra: int = 16, passes: int = 2, seed: int = 7) -> LatentVectors:
    """Learn text vectors from all rows (M1). Runs a job for the word counts and ``passes`` + 1 over the texts.

    Words are hashed to ``width`` columns and weighted by their frequency and rarity, rows have length 1. With A for
    these rows, a pass multiplies A'A with ``dim`` + ``extra`` directions: a task meets its rows' non-zero weights
    only and sends sums per column. Directions are random at first and made orthogonal after each pass; the last
    pass gives the small matrix whose eigenvectors turn them to the leading ones. What reaches the driver has ``width``
    x (``dim`` + ``extra``) numbers, at most ``MOST_NUMBERS``, however many rows there are.
    """
    directions = dim + extra
    if width < directions or width * directions > MOST_NUMBERS:
        raise ValueError(f"{width} columns x {directions} directions: columns may not be fewer, nor the product more than {MOST_NUMBERS}")
    context = df.sparkSession.sparkContext
    rows = df.select(_spots(col, width).alias("_spots"))
    found = np.zeros(width)
    n = rows.count()
    for r in rows.select(F.explode(F.array_distinct("_spots")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect():
        found[r["c"]] = r["n"]
    idf = np.log((n + 1) / (found + 1))

    def gram(at: np.ndarray) -> np.ndarray:
        sent = context.broadcast((idf, at))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, basis = sent.value
            total = np.zeros_like(basis)
            for batch in batches:
                for size, row, column, weight in _blocks(batch.column(0), weights):
                    seen = _summed(row, weight[:, None] * basis[column], size)
                    order = np.argsort(column, kind="stable")
                    own = column[order]
                    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
                    if len(own):
                        total[own[first]] += np.add.reduceat(weight[order, None] * seen[row[order]], first)
            used = np.flatnonzero(total.any(axis=1))
            for k in range(0, len(used), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(used[k : k + 1024].astype(np.int32)), pa.array(list(total[used[k : k + 1024]]), pa.list_(pa.float64()))], names=["c", "y"])

        out = np.zeros_like(at)
        for r in sum_vectors(rows.mapInArrow(run, "c int, y array<double>"), ["c"], "y").collect():
            out[r["c"]] = r["y"]
        sent.destroy()
        return out

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, directions)))[0]
    for _ in range(passes):
        basis = np.linalg.qr(gram(basis))[0]
    small = basis.T @ gram(basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:dim]
    leading = basis @ turn[:, best]
    # the largest number of a direction is positive, so that signs do not depend on chance
    signs = np.sign(leading[np.abs(leading).argmax(axis=0), np.arange(dim)])
    return LatentVectors(idf, leading * np.where(signs == 0, 1.0, signs), np.sqrt(np.maximum(values[best], 0.0)))

"""Vector codes by exact products of limbs (operator 13).

Vectors become whole numbers and are cut into equal parts; each part position has a codebook. A part's nearest entry is the first least
``|c|^2 - 2 x.c``. The products come from float64 BLAS: whole numbers are broken into a high and a low limb of ``LIMB_BITS`` bits, so that the sums
of every limb product stay below 2^53 and are exact; the four products are put together in int64. Sums of parts are whole numbers too,
so codebooks do not depend on how rows are spread.

Vectors that are null or hold nulls, NaN or infinity are left out. All others must have one length that the number of parts divides, and
components of a size of up to 2^27 after scaling; else the job fails with an error. Rows without an id take part and come last among the first
entries; rows of one id are separate vectors and come in the order of their components. With fewer vectors than entries the codebooks are
smaller. Without vectors the result is empty. Null labels are one label. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from llm.common import ship, written
from llm.simplex_kmeans import sound, whole_numbers

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMB_BITS = 14  # two limbs hold 2^27 with its sign; 2^28 x 2^24 components stay below 2^53
_STRIPE = 1 << 14


def limbs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The high (signed) and low limb of every number, as doubles."""
    high = x >> LIMB_BITS
    return high.astype(np.float64), (x - (high << LIMB_BITS)).astype(np.float64)


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``x @ c.T`` of whole numbers, exact, over the last two axes."""
    xh, xl = limbs(x)
    ch, cl = (np.swapaxes(limb, -1, -2) for limb in limbs(c))
    high, middle, low = xh @ ch, xh @ cl + xl @ ch, xl @ cl
    return (high.astype(np.int64) << (2 * LIMB_BITS)) + (middle.astype(np.int64) << LIMB_BITS) + low.astype(np.int64)


def encode(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every part: x is parts x rows x width, books are parts x entries x width."""
    score = (books * books).sum(axis=2)[:, None, :] - 2 * products(x, books)
    code = score.argmin(axis=2)
    return code, np.take_along_axis(score, code[:, :, None], axis=2)[:, :, 0] + (x * x).sum(axis=2)


def _stripes(batches, parts: int, dim: int):
    """(batch, whole numbers as parts x rows x width) of stripes of rows."""
    for batch in batches:
        for at in range(0, len(batch), _STRIPE):
            some = batch.slice(at, _STRIPE)
            ints = np.frombuffer(b"".join(some.column("ints").to_pylist()), dtype="<i4").astype(np.int64)
            yield some, ints.reshape(len(some), parts, dim // parts).swapaxes(0, 1)


def _moved(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each task sends one sum per used entry, and as many numbers as the books hold reach the driver."""
    parts, entries, width = books.shape

    def run(batches):
        count = np.zeros(parts * entries, dtype=np.int64)
        sums = np.zeros((parts * entries, width), dtype=np.int64)
        for _, x in _stripes(batches, parts, parts * width):
            slot = (encode(x, books)[0] + (np.arange(parts) * entries)[:, None]).ravel()
            order = np.argsort(slot, kind="stable")
            used, first = np.unique(slot[order], return_index=True)
            count += np.bincount(slot, minlength=len(count))
            sums[used] += np.add.reduceat(x.reshape(-1, width)[order], first, axis=0)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["slot", "n", "sums"])

    found = stored.select("ints").mapInArrow(run, "slot int, n long, sums array<long>")
    rows = found.select("slot", "n", F.posexplode("sums")).groupBy("slot", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect()
    moved = books.copy().reshape(parts * entries, width)
    for r in rows:
        moved[r["slot"], r["pos"]] = r["s"] // r["n"]
    return moved.reshape(books.shape)


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every kept vector; at most 256 ``entries``.

    The codebooks (parts x entries) are all that comes to the driver. Every round reads the stored whole numbers once. Runs jobs.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vec_col).cast("array<double>").alias("_vec")).where(sound(F.col("_vec")))
    kinds = {c: kept.schema[c].dataType for c in ("_id", "_label")}
    schema = f"{id_col} {kinds['_id'].simpleString()}, code string, error long, label_error long, codebooks_sha256 string"
    first = kept.orderBy(F.asc_nulls_last("_id"), "_vec").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], schema)
    dim = len(first[0]["_vec"])
    if dim % parts:
        raise ValueError(f"{parts} parts do not divide {dim} components")
    books = whole_numbers(pa.array([r["_vec"] for r in first], pa.list_(pa.float64())), scale, dim).reshape(len(first), parts, dim // parts).swapaxes(0, 1)
    own = [(c, to_arrow_type(t)) for c, t in kinds.items()]
    sql = ", ".join(f"{c} {t.simpleString()}" for c, t in kinds.items())

    def store(batches):
        for batch in batches:
            ints = whole_numbers(batch.column(2), scale, dim).astype("<i4")
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in ints], pa.binary())], schema=pa.schema([*own, ("ints", pa.binary())]))

    stored = written(kept.mapInArrow(store, f"{sql}, ints binary"))
    for _ in range(rounds):
        books = _moved(stored, books)

    def assign(batches):
        for some, x in _stripes(batches, parts, dim):
            code, error = encode(x, books)
            names = [r.tobytes().hex() for r in code.T.astype(np.uint8)]
            yield pa.record_batch([some.column(0), some.column(1), pa.array(names, pa.string()), pa.array(error.sum(axis=0), pa.int64())], schema=pa.schema([*own, ("code", pa.string()), ("error", pa.int64())]))

    coded = written(stored.mapInArrow(assign, f"{sql}, code string, error long"))
    labels = written(coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error")))
    name = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    joined = coded.join(labels, F.col("_label").eqNullSafe(F.col("_of")))
    return joined.select(F.col("_id").alias(id_col), "code", "error", "label_error", F.lit(name).alias("codebooks_sha256"))

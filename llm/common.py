"""What the operators share: table readers, column choice, and Arrow maps over plain Python lists."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import ensure_checkpoint_dir

#: A word of the contracts: a run of anything but the six ASCII white-space characters. ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain_text(column: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def n_words(column: str | Column = "text") -> Column:
    """The number of words, JVM-side. Null and empty texts have none."""
    return F.regexp_count(plain_text(column), F.lit(WORD)).cast("long")


def ship(spark: SparkSession) -> None:
    """Send this package and the one it uses to the executors, once per session, wherever the driver found them.

    Batches for Python are cut at ``BATCH_BYTES`` from then on, unless the session asks for less: whole texts would fill 64 MB.
    """
    context = spark.sparkContext
    if context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    if getattr(context, "_corpus_operators_sent", False):
        return
    import llm
    import tagloom

    archive = os.path.join(tempfile.mkdtemp(prefix="corpus-operators-"), "corpus_operators.zip")  # on the driver; Spark's file server sends it
    with zipfile.ZipFile(archive, "w") as packed:
        for package in (llm, tagloom):
            root = Path(package.__file__).parent
            for file in sorted(root.rglob("*.py")):
                packed.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    context._corpus_operators_sent = True


def unused(df: DataFrame, name: str) -> str:
    """A column name made of ``name`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded(batches: Iterator[pa.RecordBatch], text: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the bytes of their column ``text`` go beyond ``limit`` (a longer text is a batch alone)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy()
        start, held = 0, 0
        for k, n in enumerate(size):
            if held and held + n > limit:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if start < len(size):
            yield batch.slice(start)


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of all texts as indices into an array of distinct words, and the offsets where each text's begin.

    The array may hold an empty string, which white space at a text's ends leaves; it is no word and no index points to it.
    """
    split = pc.ascii_split_whitespace(texts)
    coded = split.values.dictionary_encode()
    at, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
    empty = pc.index(coded.dictionary, "").as_py()
    if empty >= 0:
        real = at != empty
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        at = at[real]
    return at, coded.dictionary, ends


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """As :func:`coded_words`, the distinct words in a list."""
    at, words, ends = coded_words(texts)
    return at, words.to_pylist(), ends


def written(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet under the checkpoint folder and read it back: column by column, and smaller than a checkpoint."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[..., Sequence[Sequence]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Map batches: ``fn`` gets one Python list per column of ``df`` and returns one sequence per output column.

    Batches are cut by the bytes of the last text column, so that a worker holds few texts at a time.
    """
    texts = [i for i, f in enumerate(df.schema.fields) if f.dataType.typeName() == "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, texts[-1]) if texts else batches:
            columns = fn(*[c.to_pylist() for c in batch.columns])
            yield pa.record_batch([pa.array(v, type=f.type) for v, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)

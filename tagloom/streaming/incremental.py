"""Row-wise steps over newly arrived files.

The batch job is the only mode of the work itself. Cleaning, tokenising, joining to a fixed
vocabulary and scoring look at one row at a time, so the same functions also take a streaming
DataFrame; this helper runs them over files that have arrived since the last run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def process_new_files(
    spark: SparkSession, source: str, schema: T.StructType | str, step: Callable[[DataFrame], DataFrame], target: str, progress: str
) -> None:
    """Apply ``step`` to the parquet files not seen before and append the result to ``target``.

    ``progress`` is a folder every executor can reach; it holds what has been read, so a failed run
    starts again without loss or repeats.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    query = (
        step(rows).writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    query.awaitTermination()

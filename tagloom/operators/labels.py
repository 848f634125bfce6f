"""Vocabularies, label vectors and reproducible splits."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.text import hash_slot
from tagloom.functions.vectors import multi_hot
from tagloom.operators import coding
from tagloom.operators.ordering import with_row_id
from tagloom.operators.relational import distinct_apart

# the lookups travel to the tasks by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def build_vocab(df: DataFrame, col: str) -> DataFrame:
    """(token, freq, idx) over all rows (T3), most frequent first, ties by descending token.

    ``col`` holds a text or an array of texts. Empty tokens and tokens with a line break are left
    out. The index comes from a distributed sort, so it also works when tokens do not fit one task.
    """
    is_array = df.schema[col].dataType.typeName() == "array"
    # the outer form keeps Spark from testing the array's size first, which would compute it twice
    tokens = df.select((F.explode_outer(col) if is_array else F.col(col)).alias("token"))
    usable = tokens.where((F.col("token") != "") & ~F.col("token").rlike(r"[\r\n]"))
    counts = usable.groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    return with_row_id(counts, F.desc("freq"), F.desc("token")).select("token", "freq", "idx")


def apply_vocab(
    df: DataFrame, key: str, col: str, vocab: DataFrame, size: int | None = None, out: str | None = None, drop_unknown: bool = False
) -> DataFrame:
    """(key, index array) per row with the members' order kept (T4). Runs a job.

    Unknown and null members get the index ``size``, one past the vocabulary. A chunk's distinct members meet the
    vocabulary, not their occurrences (:mod:`coding`); join the result back on ``key`` when other columns are needed.
    """
    unknown = size if size is not None else vocab.count()
    known = vocab.select(F.col("token").alias("_token"), F.col("idx").cast("int").alias("_value"))

    def indices(tokens: pa.Array, values: pa.Array, codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
        index = np.append(values.fill_null(-1 if drop_unknown else unknown).to_numpy(), -1 if drop_unknown else unknown)  # the last for null members
        found = index[codes].astype(np.int32)
        return coding.listed(pa.array(found), found >= 0, offsets)

    rows = df.select(F.col(key).alias("_key"), F.col(col).cast("array<string>").alias("_members"))
    found = coding.looked_up(rows, known, indices, T.ArrayType(T.IntegerType()))
    return found.select(F.col("_key").alias(key), F.col("_out").alias(out or f"{col}_idx"))


def filter_to_vocab(df: DataFrame, key: str, col: str, vocab: DataFrame, token: str = "token") -> DataFrame:
    """(key, distinct members that the vocabulary holds, ascending) (T11); rows without any are left out.

    A row's members are reduced to the held ones in its chunk; only these come together by key.
    """
    allowed = distinct_apart(vocab, F.col(token).alias("_token")).withColumn("_value", F.lit(1))

    def held(tokens: pa.Array, values: pa.Array, codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
        keep = np.append(values.is_valid().to_numpy(zero_copy_only=False), False)[codes]
        return coding.listed(tokens.take(pa.array(np.maximum(codes, 0))) if len(codes) else tokens.slice(0, 0), keep, offsets)

    rows = df.select(F.col(key).alias("_key"), F.array_distinct(col).alias("_members"))
    kept = coding.looked_up(rows, allowed, held, T.ArrayType(T.StringType())).where(F.array_size("_out") > 0)
    together = F.array_sort(F.array_distinct(F.flatten(F.collect_list("_out"))))
    return kept.groupBy(F.col("_key").alias(key)).agg(together.alias(col))


def decode_labels(df: DataFrame, key: str, vector: str, vocab: DataFrame, out: str = "tags") -> DataFrame:
    """(key, tags) of the set positions of a 0/1 vector, in index order."""
    hits = df.select(key, F.posexplode(vector).alias("_pos", "_value")).where(F.col("_value") > 0)
    named = hits.join(vocab.select(F.col("idx").alias("_idx"), "token"), F.col("_pos") == F.col("_idx"))
    grouped = named.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_pos", "token"))).alias("_pairs"))
    return grouped.select(key, F.transform("_pairs", lambda p: p["token"]).alias(out))


def unpivot_labels(df: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Wide 0/1 label columns to one row per label that is present."""
    return df.unpivot(list(keys), list(labels), "label", "value").where(F.col("value") > 0)


def pivot_predictions(df: DataFrame, keys: Sequence[str], label: str, value: str, labels: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
    """Long predictions to one column per label (T6b), 0 where a label is absent.

    A fixed label list saves the extra pass; of repeated predictions the greatest counts. ``rows`` has all keys,
    also those without any prediction.
    """
    wide = df.groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col(label) == name, F.col(value))), F.lit(0)).alias(f"{name}_pred") for name in labels])
    if rows is None:
        return wide
    joined = rows.select(*keys).distinct().join(wide, list(keys), "left")
    return joined.select(*keys, *[F.coalesce(f"{name}_pred", F.lit(0)).alias(f"{name}_pred") for name in labels])


def pretrained_hits(vocab: DataFrame, pretrained: DataFrame) -> DataFrame:
    """Vocabulary rows with ``is_covered``: the pretrained set has the token with a non-zero vector."""
    nonzero = F.exists("vec", lambda x: x != 0)
    known = distinct_apart(pretrained.where(nonzero), F.col("token").alias("_token")).withColumn("_hit", F.lit(True))
    joined = vocab.join(known, F.col("token") == F.col("_token"), "left")
    return joined.select(*vocab.columns, F.col("_hit").isNotNull().alias("is_covered"))


def vocab_coverage(vocab: DataFrame, pretrained: DataFrame) -> DataFrame:
    """One row (vocab_size, hits, missing, percent); the percent counts the unknown slot as well."""
    hits = F.count_if("is_covered")
    return pretrained_hits(vocab, pretrained).agg(
        F.count(F.lit(1)).alias("vocab_size"),
        hits.alias("hits"),
        F.count_if(~F.col("is_covered")).alias("missing"),
        F.floor(hits * 100 / (F.count(F.lit(1)) + 1)).cast("bigint").alias("percent"),
    )


def missing_words(vocab: DataFrame, pretrained: DataFrame) -> DataFrame:
    """Vocabulary rows that the pretrained set lacks."""
    return vocab.join(pretrained.select("token"), "token", "left_anti")


def embedding_for_vocab(vocab: DataFrame, pretrained: DataFrame, dim: int) -> DataFrame:
    """(token, idx, vec) with zeros where the pretrained set has no vector."""
    vectors = pretrained.select(F.col("token").alias("_token"), F.col("vec").cast("array<double>").alias("_vec"))
    joined = vocab.join(vectors, F.col("token") == F.col("_token"), "left")
    return joined.select("token", "idx", F.coalesce("_vec", F.array_repeat(F.lit(0.0), dim)).alias("vec"))


@dataclass(frozen=True)
class LabelTransform:
    """A fitted feature transform (T10): pass-through columns plus ``<labels>_xf`` vectors.

    The vocabulary is fitted once and reused on later data, where unknown labels fall into the extra
    slot when ``oov_slot`` is set and are an error otherwise.
    """

    vocab: DataFrame
    labels: str
    keep: tuple[str, ...]
    size: int
    oov_slot: bool = False

    def transform(self, df: DataFrame, key: str) -> DataFrame:
        indices = apply_vocab(df, key, self.labels, self.vocab, self.size, out="_indices")
        vectors = indices.select(
            F.col(key).alias("_key"), multi_hot(F.col("_indices"), self.size, self.oov_slot).alias(transformed_name(self.labels))
        )
        return df.join(vectors, F.col(key) == F.col("_key")).select(key, *self.keep, transformed_name(self.labels))


def transformed_name(col: str) -> str:
    """Name of a transformed feature."""
    return f"{col}_xf"


def fit_preprocess(
    df: DataFrame, labels: str = "tags", keep: Sequence[str] = ("synopsis", "keywords"), oov_slot: bool = False, num_labels: int | None = None
) -> LabelTransform:
    """Fit the label vocabulary of :class:`LabelTransform`; its size is counted on the driver."""
    vocab = build_vocab(df, labels)
    return LabelTransform(vocab, labels, tuple(keep), num_labels or vocab.count(), oov_slot)


def split_by_group(df: DataFrame, key: str | Column, test_share: float = 0.1, seed: int = 42, out: str = "split") -> DataFrame:
    """Add a train/test column; all rows of a group fall on one side.

    The side is a function of the key's hash, so there is no shuffle and no list of keys, and later
    data for a known group lands on the same side.
    """
    key = F.col(key) if isinstance(key, str) else key
    slots = 10_000
    is_test = hash_slot(key, slots=slots, salt=str(seed)) < round(test_share * slots)
    return df.withColumn(out, F.when(is_test, "test").otherwise("train"))


def split_rows(df: DataFrame, keys: Sequence[str], test_share: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Add a train/test column by the hash of a row's key columns."""
    return split_by_group(df, F.concat_ws("|", *keys), test_share, seed, out)


def split_by_buckets(df: DataFrame, keys: Sequence[str], buckets: Mapping[str, int], out: str = "split") -> DataFrame:
    """Add a split column by hash buckets, e.g. ``{"train": 8, "eval": 2}``."""
    slot = hash_slot(F.concat_ws("|", *keys), slots=sum(buckets.values()))
    chosen, upper = None, 0
    for name, size in buckets.items():
        upper += size
        chosen = F.when(slot < upper, name) if chosen is None else chosen.when(slot < upper, name)
    return df.withColumn(out, chosen)

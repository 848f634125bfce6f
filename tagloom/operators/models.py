"""Text features, a multi-label tagger, and batch scoring."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.operators.relational import sum_vectors
from tagloom.session import cut_lineage, ensure_checkpoint_dir

BATCH = 50
DENSE_ROWS = 256  # rows of a dense block in a task
BLOCK_WEIGHTS = 1 << 22  # weights of a block of labels; 32 MB of doubles
SPARSE = 0  # how a vector's type is stored
Encoder = Callable[[Sequence[str]], np.ndarray]


def embed_text(df: DataFrame, col: str, load_encoder: Callable[[], Encoder], out: str = "vec", batch: int = BATCH) -> DataFrame:
    """Add a vector per text from a given encoder.

    ``load_encoder`` runs once per task and returns a function from a list of texts to a matrix. The
    texts reach it in batches of ``batch``; NULL counts as an empty text. A task turns only one such batch
    into Python texts and gives its rows back before the next.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    place = df.columns.index(col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder()
        for whole in batches:
            for start in range(0, len(whole), batch):
                part = whole.slice(start, batch)
                found = np.asarray(encoder([x or "" for x in part.column(place).to_pylist()]), dtype=float)
                ends = pa.array(np.arange(len(part) + 1) * found.shape[1], pa.int32())
                vectors = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, vectors], names=schema.names)

    return df.mapInArrow(encode, schema)


def _word_weights(col: str, features: int, prefix: str) -> list:
    """Stages from a text column to hashed, frequency-weighted word counts; the model is ``features`` numbers."""
    return [
        RegexTokenizer(inputCol=col, outputCol=f"{prefix}_words", pattern=r"\s+"),
        HashingTF(inputCol=f"{prefix}_words", outputCol=f"{prefix}_counts", numFeatures=features),
        IDF(inputCol=f"{prefix}_counts", outputCol=f"{prefix}_weights"),
    ]


def fit_text_vectors(df: DataFrame, col: str, dim: int = 256) -> PipelineModel:
    """A text encoder learnt from the data in one pass (M1): hashed word weights of unit length.

    It stands in when no encoder is given. Its size does not grow with the words in the data.
    """
    return Pipeline(stages=[*_word_weights(col, dim, "_text"), Normalizer(inputCol="_text_weights", outputCol="_vec")]).fit(df)


def apply_text_vectors(model: PipelineModel, df: DataFrame, out: str = "vec") -> DataFrame:
    """Add the encoder's vector as an array."""
    return model.transform(df).select(*df.columns, vector_to_array("_vec").alias(out))


def _dense_batches(features: pa.StructArray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows as a dense matrix with a column of ones) of feature vectors as Arrow has them."""
    for start in range(0, len(features), DENSE_ROWS):
        part = features.slice(start, DENSE_ROWS)
        values = part.field("values")
        counts = values.value_lengths().to_numpy()
        spots = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        spots[np.repeat(part.field("type").to_numpy() == SPARSE, counts)] = part.field("indices").flatten().to_numpy()
        rows = np.zeros((len(part), width + 1))
        rows[:, width] = 1.0
        rows[np.repeat(np.arange(len(part)), counts), spots] = values.flatten().to_numpy()
        yield start, rows


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def _stored_folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Tagger:
    """Text features and one linear scorer per label.

    ``weights`` is a stored table (block, label, weights) with features + 1 numbers per label; ``labels`` labels lie in blocks of
    ``block``, and only one block at a time is on the driver.
    """

    features: PipelineModel
    weights: DataFrame
    labels: int
    block: int

    def block_weights(self, number: int) -> np.ndarray:
        """The weights of one block of labels, a row per label."""
        return np.array([r["weights"] for r in self.weights.where(F.col("block") == number).orderBy("label").collect()])

    def _block_scores(self, rows: DataFrame, number: int, kept: Sequence[T.StructField], out: str) -> tuple[DataFrame, Broadcast]:
        """``rows`` (the feature vector and ``kept``) with their probabilities of a block's labels, and the weights sent."""
        sent = rows.sparkSession.sparkContext.broadcast(self.block_weights(number))
        schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.DoubleType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = sent.value.T
            for batch in batches:
                parts = [_sigmoid(x @ w) for _, x in _dense_batches(batch.column(0), len(w) - 1)]
                flat = np.concatenate(parts).ravel() if parts else np.empty(0)
                scores = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * w.shape[1], pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], scores], names=schema.names)

        return rows.select("_features", *[f.name for f in kept]).mapInArrow(run, schema), sent

    def score(self, df: DataFrame, out: str = "scores") -> DataFrame:
        """Add label probabilities to rows with the raw text columns (M3).

        The feature steps are the fitted ones, so training and scoring cannot differ. A batch of rows meets a block's
        broadcast weights in one matrix product. With more than one block the rows are stored and a job per block
        stores its scores, which then meet by row in one shuffle.
        """
        kept = [f for f in df.schema.fields if f.name != out]
        rows = self.features.transform(df).select("_features", *[f.name for f in kept])
        blocks = -(-self.labels // self.block)
        if blocks == 1:
            return self._block_scores(rows, 0, kept, out)[0]
        rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
        folder = _stored_folder(df.sparkSession, "scores")
        for number in range(blocks):
            part, sent = self._block_scores(rows, number, [T.StructField("_row", T.LongType())], "_part")
            part.write.parquet(f"{folder}/block={number}")
            sent.destroy()
        parts = df.sparkSession.read.schema("_row long, _part array<double>, block int").parquet(folder)
        joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "_part"))), lambda p: p["_part"]))
        scores = parts.groupBy("_row").agg(joined.alias(out))
        return rows.join(scores, "_row").select(*[f.name for f in kept], out)


def train_tagger(
    df: DataFrame, labels: str = "tags_xf", texts: Sequence[str] = ("synopsis", "keywords"),
    features: int = 1 << 10, max_iter: int = 20, reg: float = 0.01, block_weights: int = BLOCK_WEIGHTS,
) -> Tagger:
    """Fit a tagger on text columns and a 0/1 label array (M2). Runs a job per iteration and block of labels.

    The texts become hashed word weights, joined to one unit vector; all labels get logistic scorers by accelerated
    gradient descent that starts from the constant predictor. A label's scorer does not depend on the others, so
    labels are fitted in blocks of at most ``block_weights`` numbers (one label at least): a pass multiplies batches of rows with a
    block's weights, tasks send sums per label, and a finished block is stored. Neither driver nor task holds more
    than a block, and the weights do not depend on the blocks. A row without a label array counts as one without labels.
    """
    spark = df.sparkSession
    words = [_word_weights(name, features, f"_{name}") for name in texts]
    hits = F.filter(F.transform(labels, lambda y, i: F.when(y > 0, i)), lambda i: i.isNotNull())
    hits = F.coalesce(hits, F.array().cast("array<int>"))
    # the texts are read once: their hashed counts are stored, and the weights are fitted and applied to those
    counting = PipelineModel([step for split, count, _ in words for step in (split, count)])
    counts = [f"_{name}_counts" for name in texts]
    stored = cut_lineage(counting.transform(df).select(*counts, hits.alias("_hits"), F.array_size(labels).alias("_size")))
    size, n = stored.agg(F.max("_size"), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("there are no rows to learn from")
    weighing = [weight.fit(stored) for _, _, weight in words]
    joining = [VectorAssembler(inputCols=[f"_{name}_weights" for name in texts], outputCol="_joined"), Normalizer(inputCol="_joined", outputCol="_features")]
    pipeline = PipelineModel([*(step for (split, count, _), weight in zip(words, weighing) for step in (split, count, weight)), *joining])
    rows = cut_lineage(PipelineModel([*weighing, *joining]).transform(stored).select("_features", "_hits"))
    if not size:
        raise ValueError("there are no labels to learn")
    width = features * len(texts)
    block = max(1, block_weights // (width + 1))
    counted = cut_lineage(rows.select(F.explode("_hits").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n")))
    folder = _stored_folder(spark, "tagger")
    for number in range(-(-size // block)):
        first = number * block
        counts = np.zeros(min(block, size - first))
        for r in counted.where(F.col("i").between(first, first + len(counts) - 1)).collect():
            counts[r["i"] - first] = r["n"]
        weights = _fit_block(rows, first, counts / n, n, width, max_iter, reg)
        table = pa.table({"label": np.arange(first, first + len(counts)), "weights": pa.array(list(weights))})
        spark.createDataFrame(table).write.parquet(f"{folder}/block={number}")
    weights = spark.read.schema("label long, weights array<double>, block int").parquet(folder)
    return Tagger(pipeline, weights, size, block)


def _fit_block(rows: DataFrame, first: int, share: np.ndarray, n: int, width: int, max_iter: int, reg: float) -> np.ndarray:
    """The weights of the labels from ``first`` on, ``share`` of whose rows have them."""
    size = len(share)
    share = np.clip(share, 1e-9, 1 - 1e-9)
    weights = np.zeros((size, width + 1))
    weights[:, width] = np.log(share / (1 - share))

    def gradient(at: np.ndarray) -> np.ndarray:
        sent = rows.sparkSession.sparkContext.broadcast(at)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(sent.value)
            for batch in batches:
                named = batch.column(1)
                for start, x in _dense_batches(batch.column(0), width):
                    error = _sigmoid(x @ sent.value.T)
                    own = named.slice(start, len(x))
                    row = np.repeat(np.arange(len(x)), own.value_lengths().to_numpy())
                    label = own.flatten().to_numpy() - first
                    inside = (label >= 0) & (label < size)
                    error[row[inside], label[inside]] -= 1.0
                    total += error.T @ x
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total))], names=["label", "g"])

        parts = rows.mapInArrow(run, "label long, g array<double>")
        sums = sum_vectors(parts, ["label"], "g").collect()
        sent.destroy()
        out = np.empty_like(at)
        for r in sums:
            out[r["label"]] = r["g"]
        penalty = reg * at
        penalty[:, width] = 0.0
        return out / n + penalty

    # rows have length 1 besides the one, so the loss curves by at most (1 + 1) / 4 + reg
    step, ahead, momentum = 1.0 / (0.5 + reg), weights, 1.0
    for _ in range(max_iter):
        after = ahead - step * gradient(ahead)
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = after + (momentum - 1) / grown * (after - weights)
        weights, momentum = after, grown
    return weights


def log_loss(df: DataFrame, labels: str, scores: str, eps: float = 1e-12) -> DataFrame:
    """One row (model, constant): the mean loss per label of given scores, and that of each label's share."""
    pairs = df.select(F.posexplode(F.arrays_zip(F.col(labels).alias("y"), F.col(scores).alias("p"))).alias("i", "x")).select("i", F.col("x.y").alias("y"), F.col("x.p").alias("p"))
    entropy = lambda y, p: -(y * F.ln(F.greatest(p, F.lit(eps))) + (1 - y) * F.ln(F.greatest(1 - p, F.lit(eps))))
    by_label = pairs.groupBy("i").agg(F.sum(entropy(F.col("y"), F.col("p"))).alias("model"), F.avg("y").alias("share"), F.count(F.lit(1)).alias("n"))
    constant = F.col("n") * entropy(F.col("share"), F.col("share"))
    return by_label.agg((F.sum("model") / F.sum("n")).alias("model"), (F.sum(constant) / F.sum("n")).alias("constant"))


def top_tags(df: DataFrame, key: str, scores: str, vocab: DataFrame, k: int = 5) -> DataFrame:
    """(key, rank, tag, score) of the ``k`` best labels per row, ties by label number.

    The ranking is a sort inside each row's array, so no shuffle is needed before the name lookup.
    """
    pairs = F.transform(F.col(scores), lambda p, i: F.struct((-p.cast("double")).alias("minus"), i.alias("idx")))
    best = F.slice(F.sort_array(pairs), 1, k)
    rows = df.select(key, F.posexplode(best).alias("_pos", "_best"))
    named = rows.select(key, (F.col("_pos") + 1).alias("rank"), F.col("_best.idx").alias("idx"), (-F.col("_best.minus")).alias("score"))
    return named.join(vocab.select("idx", F.col("token").alias("tag")), "idx").select(key, "rank", "tag", "score")

"""Clusters of labels and the words that stand for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.ordering import with_row_id
from tagloom.operators.relational import mean_vectors

CLUSTERS = 140
SEED = 42

# Labels kept as their own cluster, and labels that may replace a centroid word.
SPECIAL_LABELS = [
    "eng", "spa", "Episode", "Movie", "older teens (ages 15+)", "tweens (ages 10-12)", "teens (ages 13-14)",
    "big kids (ages 8-9)", "little kids (ages 5-7)", "preschoolers (ages 2-4)", "not for kids",
]
KEPT_LABELS = [
    "Documentary", "Comedy", "Drama", "Thriller", "Horror", "Romance", "Sitcom", "Action & Adventure", "Fantasy",
    "Crime", "Mystery", "Children's/Family Entertainment", "History", "Science fiction", "Sports", "Educational",
    "Animated", "Military & War", "Western", "Gay and Lesbian",
]


def cluster_labels(df: DataFrame, vec: str = "vec", k: int = CLUSTERS, seed: int = SEED, out: str = "cluster") -> DataFrame:
    """Add a KMeans cluster number per row (R22). Fitting runs jobs; the model is ``k`` vectors."""
    return cluster_with_centers(df, vec, k, seed, out)[0]


def cluster_with_centers(df: DataFrame, vec: str = "vec", k: int = CLUSTERS, seed: int = SEED, out: str = "cluster") -> tuple[DataFrame, DataFrame]:
    """The rows with their cluster number, and the centres (cluster, center)."""
    features = df.withColumn("_features", array_to_vector(F.col(vec).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol=out).fit(features)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return model.transform(features).drop("_features"), df.sparkSession.createDataFrame(centers, f"{out} int, center array<double>")


def in_cluster_order(df: DataFrame, cluster: str = "cluster", word: str = "word") -> DataFrame:
    """Rows sorted by cluster and word."""
    return df.orderBy(cluster, word)


def centroid_word(df: DataFrame, word: str = "word", vec: str = "vec", cluster: str = "cluster") -> DataFrame:
    """Add ``centroid_word``, the member nearest its cluster's mean, and ``num_words``.

    Ties go to the smaller word. Means and minima are combined in the map tasks, so a large cluster
    sends one partial result per task.
    """
    means = mean_vectors(df, [cluster], vec, "_mean")
    gap = F.aggregate(
        F.zip_with(F.col(vec).cast("array<double>"), "_mean", lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda acc, x: acc + x
    )
    gaps = df.join(means, cluster).select(F.struct(F.col(cluster).alias("_cluster")).alias("_group"), word, F.round(gap, 12).alias("_gap"))
    # the grouping value differs from the join key on purpose: a large cluster is then combined in the
    # tasks that joined it, where reusing the join's arrangement would keep it in one task
    nearest = gaps.groupBy("_group").agg(F.min(F.struct("_gap", word)).alias("_best"), F.count(F.lit(1)).alias("num_words"))
    named = nearest.select("_group._cluster", F.col("_best")[word].alias("centroid_word"), "num_words")
    return df.join(named, F.col(cluster) == F.col("_cluster")).drop("_cluster")


def override_by_prefix(df: DataFrame, word: str = "word", kept: Sequence[str] = KEPT_LABELS, prefix: int = 4) -> DataFrame:
    """Replace the centroid word by the first kept label whose prefix occurs in the word.

    The prefix is a regular expression and case matters.
    """
    matches = [F.when(F.col(word).rlike(label[:prefix]), F.lit(label)) for label in kept]
    return df.withColumn("centroid_word", F.coalesce(*matches, "centroid_word"))


def append_special_labels(df: DataFrame, labels: Sequence[str] = SPECIAL_LABELS, start: int = CLUSTERS, word: str = "word", vec: str = "vec") -> DataFrame:
    """Append labels as clusters of their own with an empty vector and size 1."""
    schema = df.select(word, vec, "cluster", "centroid_word", "num_words").schema
    rows = [(label, [], start + i, label, 1) for i, label in enumerate(labels)]
    return df.select(*schema.names).unionByName(df.sparkSession.createDataFrame(rows, schema))


def keyword_clusters(
    words: DataFrame, k: int = CLUSTERS, seed: int = SEED, kept: Sequence[str] = KEPT_LABELS, special: Sequence[str] = SPECIAL_LABELS, given: bool = False,
) -> DataFrame:
    """The full label-to-cluster table from (word, vec) rows: cluster, name, override, special labels.

    ``given`` takes the clusters that the rows already have in ``cluster``, 0 to ``k - 1``.
    """
    ordinary = words.where(~F.col("word").isin(*special))
    named = centroid_word(ordinary if given else cluster_labels(ordinary, k=k, seed=seed))
    return append_special_labels(override_by_prefix(named, kept=kept), special, k)


def title_embeddings(titles: DataFrame, vectors: DataFrame, title: str = "title", indices: str = "indices") -> DataFrame:
    """(row, title, vec): the mean vector of each title's keywords; row 0 is the mean of all titles.

    Titles are numbered from 1 in title order. Row 0 stands for unknown titles.
    """
    members = titles.select(title, F.explode(indices).alias("idx")).join(vectors.select("idx", "vec"), "idx")
    means = mean_vectors(members, [title], "vec")
    numbered = with_row_id(means, F.col(title), name="row", start=1).select("row", title, "vec")
    overall = mean_vectors(numbered.withColumn("row", F.lit(0).cast("bigint")), ["row"], "vec")
    return overall.select("row", F.lit(None).cast("string").alias(title), "vec").unionByName(numbered)


def lookup_title_vectors(titles: DataFrame, table: DataFrame, title: str = "title") -> DataFrame:
    """Title vectors with the row-0 vector for titles the table lacks."""
    known = table.where("row > 0").select(F.col(title).alias("_title"), F.col("vec").alias("_vec"))
    default = table.where("row = 0").select("vec").scalar()
    joined = titles.join(known, F.col(title) == F.col("_title"), "left")
    return joined.select(*titles.columns, F.coalesce(F.col("_vec"), default).alias("vec"))

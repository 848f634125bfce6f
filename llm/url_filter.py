"""URL filter: host and path rules first, then gradient-boosted trees on lexical features (operator 9, DataFrame functions only).

Labelled URLs train the trees: length, depth, digit ratio, entropy, number of parameters and statistics of the host's
suffix (how many URLs have it, how many of its labelled ones are blocked, counted over all rows). The training sample is
bounded by ``sample_rows`` (rows in the order of a hash of the URL); rules, features and statistics cover every row.

A null URL, or one without ``://``, has an empty host and path; no rule fits it. Without labelled URLs of both kinds
there is nothing to learn and unruled URLs get the verdict of the labelled ones, or allow. Repeated rows are kept, each
with the same verdict. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "depth", "host_depth", "digit_ratio", "entropy", "n_params", "suffix_urls", "suffix_blocked", "first_blocked"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case and the path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` from (verdict, host, path) rules; the longest that fits wins, else null."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, host, path in reversed(longest_first):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    kinds = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(kinds, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def lexical(pages: DataFrame) -> DataFrame:
    """Add the features that need the URL alone, and the keys of the statistics."""
    url = F.coalesce(F.col("_url"), F.lit(""))
    count = lambda pattern: F.regexp_count(url, F.lit(pattern)).cast("double")
    return pages.select(
        "*",
        F.length(url).cast("double").alias("length"), F.length("host").cast("double").alias("host_length"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("depth"), F.regexp_count("host", F.lit(r"\.")).cast("double").alias("host_depth"),
        (count("[0-9]") / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"), entropy(url).alias("entropy"), count("[?&][^=&#]+=").alias("n_params"),
        F.substring_index("host", ".", -1).alias("_suffix"), F.regexp_extract("path", "^/([^/]*)/", 1).alias("_first"),
    )


def with_statistics(rows: DataFrame) -> DataFrame:
    """Add how many URLs share a suffix and the smoothed share of blocked labels among the other URLs of a suffix or first folder.

    Distinct URLs count, and a labelled URL is left out of its own shares, so that no row's features hold its label.
    """
    urls = rows.select("_url", "_suffix", "_first", "label").distinct()
    labels = [F.coalesce(F.sum("label"), F.lit(0.0)), F.count("label")]
    suffixes = urls.groupBy("_suffix").agg(F.log1p(F.count(F.lit(1))).alias("suffix_urls"), *[c.alias(f"_s{i}") for i, c in enumerate(labels)])
    firsts = urls.groupBy("_first").agg(*[c.alias(f"_f{i}") for i, c in enumerate(labels)])
    own = F.coalesce("label", F.lit(0.0))
    others = lambda k: (F.col(f"{k}0") - own + 0.5) / (F.col(f"{k}1") - F.col("label").isNotNull().cast("int") + 1.0)
    joined = rows.join(suffixes, "_suffix").join(firsts, "_first")
    return joined.withColumns({"suffix_blocked": others("_s"), "first_blocked": others("_f")}).drop("_s0", "_s1", "_f0", "_f1")


def train(labelled: DataFrame, sample_rows: int = 20_000, seed: int = 7):
    """Fit the trees on a bounded sample of distinct URLs, stored before the fit; null if the labels are all alike. Runs jobs."""
    urls = labelled.select("_url", "label", *FEATURES).distinct()
    sample = cut_lineage(urls.orderBy(F.xxhash64("_url"), "_url").limit(sample_rows).select("label", *FEATURES))
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None, next(iter(counts), 0.0)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=10, maxDepth=3, stepSize=0.3, seed=seed)
    return trees.fit(assembler.transform(sample)), None


def score(rows: DataFrame, model, constant: float | None) -> DataFrame:
    """Add ``_blocked`` (0 or 1) by the trees."""
    if model is None:
        return rows.withColumn("_blocked", F.lit(float(constant)))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    return model.setPredictionCol("_blocked").transform(assembler.transform(rows))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], labels: DataFrame | None = None, sample_rows: int = 20_000, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    ``labels`` has (url, label) with 1.0 for blocked, one row per URL; without it the URLs that a rule decides are the labelled ones.
    """
    url = F.col(url_col)
    host, path = host_and_path(url)
    rows = lexical(ruled(pages.select(F.col(id_col).alias("_id"), url.alias("_url"), host.alias("host"), path.alias("path")), rules))
    if labels is None:
        rows = rows.withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    else:
        rows = rows.join(labels.select(F.col("url").alias("_l_url"), F.col("label").cast("double").alias("label")), F.col("_url") == F.col("_l_url"), "left")
    rows = with_statistics(rows)
    model, constant = train(rows.where(F.col("label").isNotNull()), sample_rows)
    verdict = F.coalesce(F.col("rule_verdict"), F.when(F.col("_blocked") == 1.0, "block").otherwise("allow"))
    return score(rows, model, constant).select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))

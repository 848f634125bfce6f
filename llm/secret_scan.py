"""Secret scan: candidates by pattern, false positives removed by a random forest (operator 5, DataFrame functions only).

A candidate is a run of 16 or more token characters that holds a digit, or a value assigned to a secret's name. The
forest sees its length, the transitions between its character classes, how much of it common words of the corpus
cover, whether it is part of a path or address, and the words around all its places. Labelled findings train it.

Without labels given, findings label themselves by what is certain: a value with an issuer's fixed prefix and length, or
one assigned to a secret's name, is a secret, also in an address; bare numbers, identifiers of a fixed layout (UUIDs, dates),
placeholders and all else in addresses are not. A secret that labels itself keeps score 1: the forest cannot outvote it. The training sample is bounded by ``sample_rows`` (in the order of a hash of the finding);
candidates and the dictionary's counts of distinct texts cover every row.

Null and empty texts have no findings. Equal candidates of one id are one finding, so repeated rows add nothing new. Empty
tables give empty results. Without findings of both labels, the labelled ones keep their label and the others are no
secrets. ``redact`` passes other columns through unchanged.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import plain_text, unused
from tagloom.session import cut_lineage

RUN = r"(?<![A-Za-z0-9_+/.-])(?=[A-Za-z0-9_+/.-]{0,200}[0-9])[A-Za-z0-9_+/.-]{15,}[A-Za-z0-9_+/-]"
NAMES = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)"
ASSIGNED = r"(?i)" + NAMES + r"[a-z_-]{0,12}[\x22\x27]?[ \t]{0,2}[=:][ \t]{0,2}[\x22\x27]?([^\s\x22\x27=:;,]{8,})"
ISSUED = r"^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"
LAYOUT = r"^(?:[0-9]+(?:[.:/-][0-9]+)*|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}T?[0-9:.Z+-]*)$"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|x{4}|1234567|0{7}"
FEATURES = [
    "length", "distinct", "changes", "digits", "uppers", "lowers", "signs", "hex", "covered", "path", "in_address",
    "issued", "assigned", "secret_word", "hash_word", "layout", "placeholder",
]
MARK = "[SECRET]"
DICTIONARY_SHARE = 0.001  # a word is in the dictionary if this share of the distinct texts, and two of them, hold it


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _is(text: str, pattern: str) -> Column:
    return F.regexp_like(text, F.lit(pattern)).cast("double")


def candidate_list(text: Column) -> Column:
    """The distinct candidates of a text."""
    named = F.when(text.contains("=") | text.contains(":"), F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(1))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), named))


def _pieces(text: Column, candidate: Column) -> Column:
    """What stands before, between and after the places of a candidate."""
    return F.split(text, F.concat(F.lit(r"\Q"), F.replace(candidate, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))


def contexts(cut: DataFrame) -> DataFrame:
    """Add ``_contexts``, the (before, after) of every place: 32 characters before it and 16 after it. ``cut`` has (candidate, _pieces).

    A candidate has 8 characters or more, so four pieces more before a place and two more after it reach far enough.
    """
    # columns of their own, so that they are made once and not for every place
    cut = cut.withColumns({"_ends": F.transform("_pieces", lambda p: F.right(p, F.lit(32))), "_heads": F.transform("_pieces", lambda p: F.left(p, F.lit(16)))})
    n, candidate = F.size("_pieces"), F.col("candidate")

    def at(i: Column) -> Column:
        earlier = [F.when(i >= k, F.concat(F.get("_ends", i - k), candidate)).otherwise(F.lit("")) for k in (4, 3, 2, 1)]
        later = [F.when(i + k < n, F.concat(candidate, F.get("_heads", i + k))).otherwise(F.lit("")) for k in (2, 3)]
        return F.struct(
            F.right(F.concat(*earlier, F.get("_ends", i)), F.lit(32)).alias("before"),
            F.left(F.concat(F.get("_heads", i + 1), *later), F.lit(16)).alias("after"),
        )

    return cut.withColumn("_contexts", F.transform(F.sequence(F.lit(0), n - 2), at))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, candidate, start, places, assigned, secret_word, named, in_address, hash_word): distinct candidates of a row.

    The words around every place are read. One place is enough for an assignment (``assigned``), a secret's name
    (``secret_word``) or both together (``named``); an address or a hash's name counts only if no place is without it.
    """
    rows = docs.select(F.col(id_col).alias("_id"), plain_text(text_col).alias("_text"))
    each = rows.select("_id", "_text", F.explode(candidate_list(F.col("_text"))).alias("candidate"))
    cut = each.select("_id", "candidate", _pieces(F.col("_text"), F.col("candidate")).alias("_pieces"))
    placed = contexts(cut).select(
        "_id", "candidate", F.length(F.get("_pieces", F.lit(0))).alias("start"), (F.size("_pieces") - 1).cast("long").alias("places"), "_contexts"
    )
    fits = lambda place, pattern: F.regexp_like(place, F.lit(pattern))
    assigned = lambda c: fits(c["before"], r"[=:]\s*[\x22\x27]?$")
    secret = lambda c: fits(c["before"], "(?i)" + NAMES + r"[a-z_-]{0,12}[\x22\x27]?\s{0,2}[=:]?\s{0,2}[\x22\x27]?$")
    hashed = lambda c: fits(c["before"], r"(?i)(?:commit|sha\d*|md5|checksum|digest|uuid|hash|version|isbn|order|serial)\S{0,3}\s*[\x22\x27]?$")
    address = lambda c: fits(c["before"], r"(?:://|@|www\.)\S*$").cast("double") + fits(c["after"], r"^@").cast("double")
    told = placed.select(
        "_id", "candidate", "start", "places",
        F.exists("_contexts", assigned).cast("double").alias("assigned"), F.exists("_contexts", secret).cast("double").alias("secret_word"),
        F.exists("_contexts", lambda c: assigned(c) & secret(c)).cast("double").alias("named"),
        F.array_min(F.transform("_contexts", address)).alias("in_address"), F.forall("_contexts", hashed).cast("double").alias("hash_word"),
    )
    return told.groupBy("_id", "candidate").agg(
        F.min("start").alias("start"), *[F.max(c).alias(c) for c in ("places", "assigned", "secret_word", "named")],
        *[F.min(c).alias(c) for c in ("in_address", "hash_word")],
    )


def dictionary(docs: DataFrame, text_col: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """(word): the lower-case words of four letters or more in a ``share`` of the distinct texts, and in two at least.

    Texts count by digest, so neither copies of a text nor repeats in it move a word in.
    """
    rows = docs.select(F.xxhash64(plain_text(text_col)).alias("_digest"), F.array_distinct(F.split(F.lower(plain_text(text_col)), r"[^\p{L}]+")).alias("_words"))
    words = rows.select("_digest", F.explode("_words").alias("word")).where(F.length("word") >= 4)
    # a one-row subquery over the digests
    texts = docs.agg(F.count_distinct(F.xxhash64(plain_text(text_col))).alias("n")).scalar()
    counts = words.groupBy("word").agg(F.count_distinct("_digest").alias("n"))
    return counts.where(F.col("n") >= F.greatest(F.lit(2), F.ceil(F.lit(share) * texts))).select("word")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add the forest's features to the candidates."""
    c = F.col("candidate")
    n = F.length(c)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "8"), "[^aB8]", "_")
    pieces = found.select("_id", "candidate", F.explode(F.split(F.lower(c), r"[^\p{L}]+")).alias("word")).where(F.length("word") >= 4)
    covered = pieces.join(words, "word").groupBy("_id", "candidate").agg(F.sum(F.length("word")).alias("_letters"))
    key = [F.col("_id").eqNullSafe(F.col("_cid")), c == F.col("_cc")]
    rows = found.join(covered.select(F.col("_id").alias("_cid"), F.col("candidate").alias("_cc"), "_letters"), key, "left")
    return rows.select(
        *found.columns,
        n.cast("double").alias("length"), (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct"),
        (_count(classes, "aB|Ba|a8|8a|B8|8B|_") / n).alias("changes"),
        (_count(c, "[0-9]") / n).alias("digits"), (_count(c, "[A-Z]") / n).alias("uppers"), (_count(c, "[a-z]") / n).alias("lowers"),
        (_count(c, "[^A-Za-z0-9]") / n).alias("signs"), _is("candidate", "^[0-9a-fA-F]+$").alias("hex"),
        (F.coalesce("_letters", F.lit(0)) / n).alias("covered"),
        (_is("candidate", r"/.*/|^\.{0,2}/|\.[a-z]{2,4}$")).alias("path"), _is("candidate", ISSUED).alias("issued"),
        _is("candidate", LAYOUT).alias("layout"), _is("candidate", PLACEHOLDER).alias("placeholder"),
    )


def self_labels(rows: DataFrame) -> DataFrame:
    """Add ``label``: 1 and 0 for what is certain, else null. An address is no secret, but may hold a certain one."""
    no = (F.col("layout") + F.col("placeholder")) > 0
    yes = (F.col("issued") == 1) | (F.col("named") == 1)
    return rows.withColumn("label", F.when(no, 0.0).when(yes, 1.0).when(F.col("in_address") > 0, 0.0))


def train(labelled: DataFrame, sample_rows: int = 20_000, seed: int = 5):
    """Fit the forest on a bounded sample; null if the labels are all alike. Runs a job or two."""
    sample = labelled.orderBy(F.xxhash64("_id", "candidate"), "_id", "candidate").limit(sample_rows).select("label", *FEATURES)
    if sample.agg(F.count_distinct("label").alias("n")).first()["n"] < 2:
        return None
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
    return RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=20, maxDepth=6, seed=seed).fit(assembler.transform(sample))


def scan(docs: DataFrame, labels: DataFrame | None = None, sample_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, candidate, start, places, score, is_secret) of every candidate. ``labels`` has (id, candidate, label)."""
    rows = features(candidates(docs, id_col, text_col), dictionary(docs, text_col))
    if labels is None:
        rows = self_labels(rows)
    else:
        known = labels.select(F.col(id_col).alias("_lid"), F.col("candidate").alias("_lc"), F.col("label").cast("double").alias("label"))
        rows = rows.join(known, [F.col("_id").eqNullSafe(F.col("_lid")), F.col("candidate") == F.col("_lc")], "left").drop("_lid", "_lc")
    rows = cut_lineage(rows)  # training and scoring read the same findings
    model = train(rows.where(F.col("label").isNotNull()), sample_rows)
    if model is None:
        scored = rows.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features", handleInvalid="keep")
        scored = model.transform(assembler.transform(rows)).withColumn("score", vector_to_array("probability")[1])
        if labels is None:
            scored = scored.withColumn("score", F.when(F.col("label") == 1, 1.0).otherwise(F.col("score")))
    return scored.select(F.col("_id").alias(id_col), "candidate", "start", "places", F.round("score", 6).alias("score"), (F.col("score") > 0.5).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = MARK) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``. Texts without candidates take no part in the join."""
    owner, held = unused(docs, "owner"), unused(docs, "held")
    secrets = findings.where("is_secret").groupBy(F.col(id_col).alias(owner)).agg(F.sort_array(F.collect_set("candidate"), asc=False).alias(held))
    may = F.size(candidate_list(plain_text(text_col))) > 0
    longest_first = F.expr(f"array_sort({held}, (a, b) -> CASE WHEN length(a) <> length(b) THEN length(b) - length(a) WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END)")
    clean = F.aggregate(longest_first, F.col(text_col), lambda t, s: F.replace(t, s, F.lit(mark)))
    joined = docs.where(may).join(secrets, F.col(id_col).eqNullSafe(F.col(owner)), "left")
    cleaned = joined.withColumn(text_col, F.when(F.col(held).isNull(), F.col(text_col)).otherwise(clean)).select(*docs.columns)
    return docs.where(~may).unionByName(cleaned)

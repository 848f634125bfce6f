"""The logical tables of the library, derived from the supplied tables, for Spark and as SQL.

Each stand-in reads whole supplied tables. ``SQL`` holds the same derivation for the oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import ensure_checkpoint_dir


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A new folder that every executor reaches."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dealt out by their id, for steps that work hard on each text; the supplied files are one row group each."""
    return load(spark, sf_dir, "documents").repartition("doc_id")


def program(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as programmes: the source as title, the size as type, the language with its three-letter code."""
    kind = F.when(F.col("n_chars") < 1500, "Movie").when(F.col("n_chars") < 5000, "Episode").otherwise("SeriesMaster")
    language = F.when(F.col("lang") == "en", "eng").when(F.col("lang") == "es", "spa").otherwise(F.col("lang"))
    title = F.when(F.col("source") == "src0", "OnDemand Movie").otherwise(F.col("source"))
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("program_val"), title.alias("program_title"), F.col("text").alias("program_longsynopsis"),
        kind.alias("program_type"), language.alias("program_language"),
        F.when(F.col("source").isin("src1", "src2"), F.col("source")).alias("program_seriesid"),
    )


def program_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag rows per document: its distinct words and a source name as genres, label values as age bands and themes."""
    docs = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    genre = (
        F.when(F.col("source") == "src3", "Docudrama").when(F.col("source") == "src4", "Historical drama")
        .when(F.col("source") == "src5", "Romantic comedy").otherwise(F.concat(F.lit("genre "), F.col("source")))
    )
    age = F.when(F.col("quality") == 1, "little kids (ages 5-7)").when(F.col("quality") == 0, "big kids (ages 8-9)")
    adult = F.when(F.col("toxic") == 1, "not for kids")
    single = F.array(genre, age, adult, F.col("lang"))
    kind = F.when(F.col("_pos").isin(1, 2), "Audience").when(F.col("_pos") == 3, "KidsTheme").otherwise("Genre")
    rows = docs.select(F.col("doc_id").cast("string").alias("program_id"), F.posexplode(F.concat(single, F.array_distinct(F.split("text", " ")))).alias("_pos", "tag_value"))
    return rows.where(F.col("tag_value").isNotNull()).select("program_id", kind.alias("tag_type"), "tag_value")


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programme rows with keyword and tag arrays from the document's columns and labels."""
    docs = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    kind = F.when(F.col("n_chars") < 1500, "Movie").otherwise("Episode")
    quality = F.when(F.col("quality").isNotNull(), F.concat(F.lit("quality "), F.col("quality").cast("string")))
    toxic = F.when(F.col("toxic") == 1, "not for kids")
    return docs.select(
        "doc_id", F.initcap("source").alias("program_title"), kind.alias("program_type"), F.col("lang").alias("program_language"),
        F.col("text").alias("program_longsynopsis"),
        F.concat(F.array("lang", "source"), F.array_sort(F.array_distinct(F.split("text", " ")))).alias("keywords"),
        F.array_compact(F.array("lang", quality, toxic)).alias("tags"),
    )


def catalogue_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue titles, the document of the same number as synopsis."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id"), "text", "lang")
    parts = load(spark, sf_dir, "part")
    language = F.when(F.col("lang") == "en", "eng").when(F.col("lang") == "es", "spa").otherwise("und")
    return parts.join(docs, F.col("p_partkey") == F.col("doc_id"), "left").select(
        F.col("p_name").alias("TitleDetails_title"),
        F.when(F.col("p_type").isin("ECONOMY", "PROMO", "SMALL"), "Movie").otherwise("Programme").alias("TitleType"),
        F.col("text").alias("TitleDetails_longsynopsis"),
        F.initcap("p_type").alias("TitleGenre"),
        F.when(F.col("p_size") > 5, F.concat(F.lit(" "), F.col("p_brand"), F.lit(" , "), F.col("p_type"))).alias("TitleSubgenres"),
        F.when(F.col("p_size") < 45, F.replace(F.col("p_name"), F.lit(" "), F.lit(","))).alias("TitleTags"),
        language.alias("LANGUAGE"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("TitleId"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("S"), F.col("p_size").cast("string"))).alias("InSeasonSeries_Id"),
    )


def content_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings of each title with the title's smallest part number."""
    names = load(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("content_ordinal_id"))
    return names.select(F.explode(F.array(F.upper("p_name"), "p_name")).alias("program_title"), "content_ordinal_id")


def token_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of the benchmark passages."""
    return load(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("tokens")).distinct()


def content_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct title words, brands, languages and sources, as a vocabulary that tags and keywords can meet."""
    parts = load(spark, sf_dir, "part")
    docs = load(spark, sf_dir, "documents")
    return (
        parts.select(F.explode(F.split("p_name", " ")).alias("tokens")).union(parts.select("p_brand"))
        .union(docs.select("lang")).union(docs.select("source")).distinct()
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays: (user_id, content_id, ts)."""
    return load(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("content_id"), "ts"
    )


def play_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per user and day, its plays nested in time order."""
    plays = events(spark, sf_dir).withColumn("session_date", F.to_date("ts"))
    return plays.groupBy(F.col("user_id").cast("string").alias("user_ordinal_id"), "session_date").agg(
        F.min("ts").alias("session_timestamp"),
        F.transform(F.sort_array(F.collect_list(F.struct("ts", "content_id"))), lambda s: F.struct(s["content_id"].alias("content_id"))).alias("session_sequence"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item vectors: (item, content_id, vec, type)."""
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item"), F.col("vec_id").alias("content_id"), F.col("embedding").alias("vec"),
        F.col("label").cast("string").alias("type"),
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label words with vectors and a given cluster."""
    return load(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("word "), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vec"), F.col("label").alias("cluster")
    )


def tag_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector a 0/1 label array and a score array over all components: the label is the class, the score a rounded sigmoid."""
    label = F.transform("embedding", lambda _, i: (F.col("label") == i).cast("int"))
    score = F.transform("embedding", lambda x: F.round(1.0 / (1.0 + F.exp(-8.0 * x.cast("double"))), 2))
    return load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("labels"), score.alias("scores"))


def second_vector(vec: str = "vec"):
    """A second model's vector of an item, as long as the first: every component times its size."""
    return F.transform(F.col(vec).cast("array<double>"), lambda x: x * F.abs(x))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label-to-cluster table over the training labels: languages, sources and quality marks."""
    docs = load(spark, sf_dir, "documents")
    found = docs.select(F.col("lang").alias("word")).union(docs.select("source")).distinct()
    return found.select("word", F.upper(F.substring("word", 1, 4)).alias("centroid_word"), F.char_length("word").cast("bigint").alias("cluster"))


SQL = {
    "program": """program AS (
        SELECT CAST(doc_id AS VARCHAR) AS program_val, CASE WHEN source = 'src0' THEN 'OnDemand Movie' ELSE source END AS program_title,
               text AS program_longsynopsis,
               CASE WHEN n_chars < 1500 THEN 'Movie' WHEN n_chars < 5000 THEN 'Episode' ELSE 'SeriesMaster' END AS program_type,
               CASE lang WHEN 'en' THEN 'eng' WHEN 'es' THEN 'spa' ELSE lang END AS program_language,
               CASE WHEN source IN ('src1', 'src2') THEN source END AS program_seriesid
        FROM documents)""",
    "program_tags": """program_tags AS (
        SELECT * FROM (
            SELECT CAST(doc_id AS VARCHAR) AS program_id, 'Genre' AS tag_type,
                   CASE source WHEN 'src3' THEN 'Docudrama' WHEN 'src4' THEN 'Historical drama' WHEN 'src5' THEN 'Romantic comedy'
                        ELSE 'genre ' || source END AS tag_value FROM documents
            UNION ALL SELECT CAST(doc_id AS VARCHAR), 'Genre', unnest(list_distinct(string_split(text, ' '))) FROM documents
            UNION ALL SELECT CAST(doc_id AS VARCHAR), 'Audience',
                   CASE quality WHEN 1 THEN 'little kids (ages 5-7)' WHEN 0 THEN 'big kids (ages 8-9)' END
                   FROM documents LEFT JOIN labels USING (doc_id)
            UNION ALL SELECT CAST(doc_id AS VARCHAR), 'Audience', CASE WHEN toxic = 1 THEN 'not for kids' END
                   FROM documents LEFT JOIN labels USING (doc_id)
            UNION ALL SELECT CAST(doc_id AS VARCHAR), 'KidsTheme', lang FROM documents) WHERE tag_value IS NOT NULL)""",
    "training": """training AS (
        SELECT d.doc_id, upper(source[1]) || lower(source[2:]) AS program_title, CASE WHEN n_chars < 1500 THEN 'Movie' ELSE 'Episode' END AS program_type,
               lang AS program_language, text AS program_longsynopsis, [lang, source] || list_sort(list_distinct(string_split(text, ' '))) AS keywords,
               list_filter([lang, CASE WHEN quality IS NOT NULL THEN 'quality ' || quality END, CASE WHEN toxic = 1 THEN 'not for kids' END],
                           lambda x: x IS NOT NULL) AS tags
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "catalogue": """catalogue AS (
        SELECT p_name AS title, CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN 'Movie' ELSE 'Programme' END AS type, text AS synopsis,
               upper(p_type[1]) || lower(p_type[2:]) AS genre, CASE WHEN p_size > 5 THEN ' ' || p_brand || ' , ' || p_type END AS subgenres,
               CASE WHEN p_size < 45 THEN replace(p_name, ' ', ',') END AS tags,
               CASE WHEN lang = 'en' THEN 'eng' WHEN lang = 'es' THEN 'spa' ELSE 'und' END AS language,
               'T' || p_partkey AS title_id, CASE WHEN p_size > 25 THEN 'S' || p_size END AS series_id
        FROM part LEFT JOIN documents ON p_partkey = doc_id)""",
    "content_id": """content_id AS (
        SELECT unnest([upper(p_name), p_name]) AS program_title, cid FROM (SELECT p_name, min(p_partkey) AS cid FROM part GROUP BY p_name))""",
    "token_vocab": "token_vocab AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS tokens FROM benchmark)",
    "content_vocab": """content_vocab AS (
        SELECT DISTINCT tokens FROM (SELECT unnest(string_split(p_name, ' ')) AS tokens FROM part UNION ALL SELECT p_brand FROM part
        UNION ALL SELECT lang FROM documents UNION ALL SELECT source FROM documents))""",
    "plays": "plays AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS content_id, ts FROM events)",
    "items": "items AS (SELECT vec_id AS item, vec_id AS content_id, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS VARCHAR) AS type FROM embeddings)",
    "words": "words AS (SELECT 'word ' || vec_id AS word, CAST(embedding AS DOUBLE[]) AS vec, label AS cluster FROM embeddings)",
    "long_scores": """long_scores AS (
        SELECT vec_id AS id, t AS tag, CAST(label = t AS INT) AS y, round(1.0 / (1.0 + exp(-8.0 * CAST(embedding[t + 1] AS DOUBLE))), 2) AS p
        FROM (SELECT *, unnest(range(len(embedding))) AS t FROM embeddings))""",
    "mapping": """mapping AS (
        SELECT word, upper(word[1:4]) AS centroid_word, length(word) AS cluster
        FROM (SELECT lang AS word FROM documents UNION SELECT source FROM documents))""",
}


def with_tables(names: str, query: str) -> str:
    """``WITH`` the named stand-ins in front of a query; the query may go on with its own ``, name AS (...)``."""
    return "WITH " + ", ".join(SQL[n] for n in names.split()) + " " + query

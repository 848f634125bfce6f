"""Queries that write with the library's sinks and read back with its sources, in the folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tagloom.functions import text
from tagloom.operators import labels, metrics, recommend, relational, validation
from tagloom.plans import catalogue as plans
from tagloom.sources import tables
from tagloom.sources.spec import FeatureSpec
from workload import standins as t
from workload.registry import query
from workload.standins import new_folder, with_tables


@query("table_roundtrip", "SELECT c_custkey, c_nationkey, c_name FROM customer UNION ALL SELECT c_custkey, c_nationkey, c_name FROM customer WHERE c_nationkey = 3")
def table_roundtrip(spark, sf):
    """A partitioned table written, extended and read."""
    path = new_folder(spark)
    rows = t.load(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    tables.write_table(rows, path, partition_by=["c_nationkey"])
    tables.write_table(rows.where("c_nationkey = 3"), path, mode="append", partition_by=["c_nationkey"])
    return tables.read_table(spark, path).select("c_custkey", F.col("c_nationkey").cast(rows.schema["c_nationkey"].dataType).alias("c_nationkey"), "c_name")


@query("parquet_roundtrip", "SELECT vec_id, label, len(embedding) AS dim FROM embeddings")
def parquet_roundtrip(spark, sf):
    """Two Parquet folders read as one, with a given schema."""
    path, rows = new_folder(spark), t.load(spark, sf, "embeddings")
    tables.write_parquet(rows.where("vec_id % 2 = 0"), f"{path}/even")
    tables.write_parquet(rows.where("vec_id % 2 = 1"), f"{path}/odd")
    back = tables.read_parquet(spark, f"{path}/even", f"{path}/odd", schema=rows.schema)
    return back.select("vec_id", "label", F.array_size("embedding").cast("long").alias("dim"))


@query("splits_roundtrip", "SELECT doc_id, CASE WHEN source IN ('src1', 'src2') THEN 'eval' ELSE 'train' END AS split FROM documents")
def splits_roundtrip(spark, sf):
    """S3: file patterns as one table with a split column."""
    path, rows = new_folder(spark), t.load(spark, sf, "documents").select("doc_id", "source")
    held = F.col("source").isin("src1", "src2")
    tables.write_parquet(rows.where(~held), f"{path}/train-0")
    tables.write_parquet(rows.where(held & (F.col("source") == "src1")), f"{path}/eval-0")
    tables.write_parquet(rows.where(held & (F.col("source") == "src2")), f"{path}/eval-1")
    return tables.read_splits(spark, path, {"train": "train-*", "eval": "eval-*"}).select("doc_id", "split")


@query("csv_roundtrip", "SELECT doc_id, md5(text) AS digest, source FROM documents")
def csv_roundtrip(spark, sf):
    """Whole texts with quotes and line breaks through CSV."""
    path, rows = new_folder(spark), t.load(spark, sf, "documents").select("doc_id", "text", "source")
    tables.write_csv(rows, path)
    back = tables.read_csv(spark, path, rows.schema)
    return back.select("doc_id", F.md5("text").alias("digest"), "source")


@query("vocab_roundtrip", """WITH v AS (SELECT source AS token, row_number() OVER (ORDER BY count(*) DESC, source DESC) - 1 AS idx FROM documents GROUP BY source)
    SELECT token, idx, 'table' AS kind FROM v UNION ALL SELECT token, idx, 'text' FROM v""")
def vocab_roundtrip(spark, sf):
    """A vocabulary as a table and as a text file."""
    path = new_folder(spark)
    tables.write_vocab(labels.build_vocab(t.load(spark, sf, "documents"), "source"), f"{path}/table", f"{path}/text")
    stored = tables.read_vocab(spark, f"{path}/table").withColumn("kind", F.lit("table"))
    return stored.unionByName(tables.read_vocab_text(spark, f"{path}/text").withColumn("kind", F.lit("text")))


@query("read_by_query", "SELECT p_partkey, p_name FROM part WHERE p_size > 25 AND p_type = 'SMALL'")
def read_by_query(spark, sf):
    """SQL text with named parameters."""
    name = f"parts_{uuid.uuid4().hex}"
    t.load(spark, sf, "part").createOrReplaceTempView(name)
    return tables.read_query(spark, f"SELECT p_partkey, p_name FROM {name} WHERE p_size > :size AND p_type = :type", size=25, type="SMALL")


@query("limited_training_rows", with_tables("training", f"""
    SELECT array_to_string(list_slice(string_split(program_longsynopsis, ' '), 1, {plans.TOKEN_LIMIT}), ' ') AS synopsis, keywords FROM (
        SELECT program_longsynopsis, string_agg(k, ' ' ORDER BY k) AS keywords FROM (SELECT *, unnest(keywords) AS k FROM training)
        GROUP BY program_title, program_type, program_language, program_longsynopsis)
    ORDER BY synopsis, keywords LIMIT 50"""))
def limited_training_rows(spark, sf):
    """O3: the first rows in a stated order."""
    return plans.training_rows(t.training_table(spark, sf), test_limit=50).select("synopsis", "keywords")


@query("metrics_appended", """SELECT 'a' AS model_name, 'Rows@1' AS metric_name, CAST(count(*) AS DOUBLE) AS value, 'p' AS model_path, 1 AS dated FROM documents
    UNION ALL SELECT 'b', 'Rows@1', CAST(count(*) AS DOUBLE), 'p', 1 FROM labels""")
def metrics_appended(spark, sf):
    """Metric rows of two runs in one table, dated in text form."""
    path = new_folder(spark)
    for model, name in (("a", "documents"), ("b", "labels")):
        row = t.load(spark, sf, name).agg(F.count(F.lit(1)).cast("double").alias("Rows@1"))
        tables.append_metrics(recommend.metrics_long(row, model, "p"), path)
    dated = F.regexp_like("date", F.lit("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")).cast("int")
    return tables.read_parquet(spark, path).select("model_name", "metric_name", "value", "model_path", dated.alias("dated"))


@query("report_series", """SELECT 'lang' AS series, lang AS name, count(*) AS n FROM documents GROUP BY lang
    UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source""")
def report_series(spark, sf):
    """Named series of a report as JSON tables."""
    path, docs = new_folder(spark), t.load(spark, sf, "documents")
    series = {c: docs.groupBy(F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n")) for c in ("lang", "source")}
    tables.write_report(series, path)
    back = [spark.read.schema("name string, n bigint").json(f"{path}/{c}").withColumn("series", F.lit(c)) for c in series]
    return back[0].unionByName(back[1])


@query("inferred_spec", """SELECT 'lang' AS feature, 'string' AS type, 1.0 AS min_fraction, array_to_string(list_sort(list(DISTINCT lang)), '|') AS domain, 0 AS open FROM documents
    UNION ALL SELECT 'source', 'string', 1.0, CASE WHEN count(DISTINCT source) <= 20 THEN array_to_string(list_sort(list(DISTINCT source)), '|') ELSE '' END, CAST(count(DISTINCT source) > 20 AS INT) FROM documents
    UNION ALL SELECT 'text', 'string', 1.0, '', CAST(count(DISTINCT text) > 20 AS INT) FROM documents""")
def inferred_spec(spark, sf):
    """A specification from the data, through its stored form."""
    spec = FeatureSpec.from_json(validation.infer_spec(t.load(spark, sf, "documents"), ["lang", "source", "text"]).to_json())
    rows = [(f.name, f.type, f.min_fraction, "|".join(f.domain or ()), int(f.name in spec.open_domains)) for f in spec.features]
    return spark.createDataFrame(rows, "feature string, type string, min_fraction double, domain string, open int")


@query("named_title_recommendations", with_tables("items", """,
    scored AS (SELECT a.item AS id, b.item AS match_id, round(list_cosine_similarity(a.vec, b.vec), 12) AS score FROM items a JOIN items b ON a.item <> b.item WHERE a.item IN (3, 5, 8)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS rank FROM scored)
    SELECT id AS query_id, 'title ' || id AS query_title, CAST(rank AS INT) AS result_rank, match_id AS result_id, 'title ' || match_id AS result_title, round(score, 6) AS score
    FROM ranked WHERE rank <= 10"""))
def named_title_recommendations(spark, sf):
    """Recommendations of the titles that are asked for."""
    items = t.items(spark, sf).withColumn("title", F.concat(F.lit("title "), F.col("item").cast("string")))
    names = ["title 3", "title 5", "title 8"]
    recs = recommend.recommendations_for(items.where(F.col("title").isin(*names)), items, 10, id_col="item")
    return recommend.export_recommendations(recs, items, "item", "title", [], titles=names).withColumn("score", F.round("score", 6))


@query("keywords_concatenated", with_tables("training", """
    SELECT program_title, array_to_string(flatten(list(tags ORDER BY doc_id)), '|') AS tags, sum(len(tags))::BIGINT AS n FROM training GROUP BY program_title"""))
def keywords_concatenated(spark, sf):
    """The tags of a title's rows in row order, duplicates kept."""
    out = relational.array_concat_agg(t.training_table(spark, sf), ["program_title"], "tags", ["doc_id"])
    return out.select("program_title", F.array_join("tags", "|").alias("tags"), F.array_size("tags").cast("long").alias("n"))


@query("keyword_members", with_tables("training", """
    SELECT program_title, doc_id, unnest(range(len(keywords))) AS pos, unnest(keywords) AS value FROM training"""))
def keyword_members(spark, sf):
    """The long form of a title's keywords: no cell grows with the title."""
    out = relational.array_members(t.training_table(spark, sf), ["program_title"], "keywords", ["doc_id"])
    return out.withColumn("pos", F.col("pos").cast("long"))


@query("gated_publishing", """SELECT version, doc_id, quality FROM labels, (SELECT unnest(['good']) AS version)""")
def gated_publishing(spark, sf):
    """C4: rows are published when the gate lets them pass, and only then."""
    path, rows = new_folder(spark), t.load(spark, sf, "labels").select("doc_id", "quality")
    for version, precision in (("good", 0.9), ("poor", 0.1)):
        gate = metrics.threshold_gate(spark.createDataFrame([(precision, 0.9)], "precision double, recall double"))
        metrics.publish_if(gate, rows, path, version)
    found = spark.read.option("basePath", path).parquet(f"{path}/*")
    return found.select(F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/[^/]+$", 1).alias("version"), "doc_id", "quality")


@query("tag_strings", with_tables("catalogue", r"""
    SELECT title, genre, array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split(concat_ws(',', genre, subgenres, tags, language), ','),
           lambda x: x NOT IN ('', 'und')), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')))), ' ') AS words, language FROM catalogue"""))
def tag_strings(spark, sf):
    """Stripped labels joined to one text."""
    rows = t.catalogue_view(spark, sf)
    pieces = F.split(F.concat_ws(",", "TitleGenre", "TitleSubgenres", "TitleTags", "LANGUAGE"), ",")
    words = text.strip_to_string(pieces, drop=("", "und"))
    return rows.select(F.col("TitleDetails_title").alias("title"), F.col("TitleGenre").alias("genre"), words.alias("words"), F.col("LANGUAGE").alias("language"))

"""Filters, joins, aggregates and functions on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import text
from tagloom.operators import ordering, recommend, relational
from workload import standins as t
from workload.catalogue_queries import shown, stamp
from workload.registry import query
from workload.standins import with_tables


@query("filtered_programs", with_tables("program", """
    SELECT program_val, program_title, CASE program_language WHEN 'eng' THEN 'English' WHEN 'spa' THEN 'Spanish' ELSE program_language END AS language,
           CASE WHEN program_type = 'Movie' THEN program_title END AS movie_title, 'stand-in' AS dataset
    FROM program WHERE program_longsynopsis IS NOT NULL AND program_seriesid IS NULL AND program_type NOT IN ('SeriesMaster')
      AND program_title <> 'OnDemand Movie' AND length(program_longsynopsis) > 30 AND regexp_matches(program_longsynopsis, 'th|ei')"""))
def filtered_programs(spark, sf):
    rows = t.program(spark, sf).where(
        F.col("program_longsynopsis").isNotNull() & F.col("program_seriesid").isNull() & ~F.col("program_type").isin("SeriesMaster")
        & (F.col("program_title") != "OnDemand Movie") & (F.char_length("program_longsynopsis") > 30) & F.col("program_longsynopsis").rlike("th|ei"))
    return rows.select(
        "program_val", "program_title", relational.remap_values(F.col("program_language"), {"eng": "English", "spa": "Spanish"}).alias("language"),
        relational.when_or_null(F.col("program_type") == "Movie", F.col("program_title")).alias("movie_title"), F.lit("stand-in").alias("dataset"))


@query("membership_join", with_tables("training mapping", """
    SELECT doc_id, word, cluster FROM training JOIN mapping ON list_contains(keywords, word)"""))
def membership_join(spark, sf):
    return relational.join_on_membership(t.training_table(spark, sf), "doc_id", "keywords", t.mapping(spark, sf), "word").select("doc_id", "word", "cluster")


@query("case_free_join", with_tables("catalogue content_id", """
    SELECT title, type, cid AS content_ordinal_id, count(*) AS n FROM catalogue JOIN content_id ON lower(title) = lower(program_title) GROUP BY ALL"""))
def case_free_join(spark, sf):
    joined = relational.join_ci(t.catalogue_view(spark, sf), t.content_id(spark, sf), "TitleDetails_title", "program_title")
    return joined.groupBy(F.col("TitleDetails_title").alias("title"), F.col("TitleType").alias("type"), "content_ordinal_id").agg(F.count(F.lit(1)).alias("n"))


@query("plays_of_items", with_tables("plays items", """
    SELECT user_id, plays.content_id, item, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS played FROM plays JOIN items ON plays.content_id = items.content_id"""))
def plays_of_items(spark, sf):
    out = recommend.plays_of_items(t.events(spark, sf), t.items(spark, sf))
    return out.select("user_id", "content_id", "item", stamp("ts").alias("played"))


@query("first_and_list", """
    SELECT p_brand, min_by(p_type, ROW(p_size, p_partkey)) AS p_type, min_by(p_name, ROW(p_size, p_partkey)) AS p_name, string_agg(p_size, '|' ORDER BY p_size) AS p_size
    FROM part GROUP BY p_brand""")
def first_and_list(spark, sf):
    parts = t.load(spark, sf, "part").withColumn("size", F.col("p_size"))
    out = relational.first_and_list(parts, ["p_brand"], ["p_type", "p_name"], ["p_size"], ["size", "p_partkey"])
    return out.withColumn("p_size", shown("p_size"))


@query("listed_values", """
    SELECT p_brand, p_size AS size, n, CAST(sum(n) OVER (PARTITION BY p_brand ORDER BY p_size) - n AS BIGINT) AS first
    FROM (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY p_brand, p_size)""")
def listed_values(spark, sf):
    return relational.listed_values(t.load(spark, sf, "part"), ["p_brand"], "p_size", "size")


@query("union_of_arrays", with_tables("training", """
    SELECT program_type, (SELECT string_agg(DISTINCT k, '|' ORDER BY k) FROM (SELECT unnest(keywords) AS k FROM training b WHERE b.program_type = a.program_type)) AS keywords,
           (SELECT string_agg(DISTINCT k, '|' ORDER BY k) FROM (SELECT unnest(tags) AS k FROM training b WHERE b.program_type = a.program_type)) AS tags
    FROM (SELECT DISTINCT program_type FROM training) a"""))
def union_of_arrays(spark, sf):
    out = relational.union_arrays(t.training_table(spark, sf), ["program_type"], ["keywords", "tags"])
    return out.withColumn("keywords", shown("keywords")).withColumn("tags", shown("tags"))


@query("kept_top_words", """
    WITH words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents),
    best AS (SELECT w FROM words GROUP BY w ORDER BY count(*) DESC, w LIMIT 50)
    SELECT doc_id, w, count(*) AS n FROM words WHERE w IN (SELECT w FROM best) GROUP BY doc_id, w""")
def kept_top_words(spark, sf):
    words = t.load(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return relational.keep_top_values(words, "w", 50).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))


@query("vector_sums", """
    SELECT label, pos, round(sum(x), 6) AS total, round(avg(x), 6) AS mean
    FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY label, pos""")
def vector_sums(spark, sf):
    rows = t.load(spark, sf, "embeddings").select("label", "embedding")
    both = relational.sum_vectors(rows, ["label"], "embedding", "s").join(relational.mean_vectors(rows, ["label"], "embedding", "m"), "label")
    out = both.select("label", F.posexplode(F.arrays_zip("s", "m")).alias("pos", "v"))
    return out.select("label", F.col("pos").cast("bigint").alias("pos"), F.round("v.s", 6).alias("total"), F.round("v.m", 6).alias("mean"))


@query("row_ids", """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")
def row_ids(spark, sf):
    orders = t.load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.with_row_id(orders, F.desc("o_totalprice"), F.col("o_orderkey"), name="place", start=1).select("o_orderkey", "place")


@query("top_orders", """
    SELECT o_custkey, CAST(rank AS INT) AS rank, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def top_orders(spark, sf):
    return ordering.topk_per_group(t.load(spark, sf, "orders"), "o_custkey", "o_totalprice", 3, "o_orderkey").select("o_custkey", "rank", "o_orderkey")


@query("running_balance", """
    SELECT l_returnflag, l_orderkey, l_linenumber, CAST(sum(l_linenumber) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM lineitem""")
def running_balance(spark, sf):
    lines = t.load(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return ordering.running_totals(lines, ["l_returnflag"], [F.col("l_orderkey"), F.col("l_linenumber")], {"total": F.col("l_linenumber")})


@query("sampled_rows", "SELECT doc_id, source FROM documents ORDER BY md5(doc_id || '|' || source || '42'), doc_id LIMIT 100")
def sampled_rows(spark, sf):
    return ordering.sample_rows(t.load(spark, sf, "documents").select("doc_id", "source"), 100, ["doc_id", "source"])


@query("sampled_keys", "SELECT CAST(user_id AS VARCHAR) AS user_id FROM (SELECT DISTINCT user_id FROM events) ORDER BY md5(user_id || '3'), CAST(user_id AS VARCHAR) LIMIT 12")
def sampled_keys(spark, sf):
    users = t.load(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id")).distinct()
    return ordering.sample_keys(users, "user_id", 12)


@query("scalar_functions", r"""
    SELECT doc_id, lower(text[1:512]) AS lowered, array_to_string(list_slice(string_split(text, ' '), 1, 256), ' ') AS opening,
           regexp_replace(' ' || source || ' 	', '^\s+|\s+$', '', 'g') AS trimmed, concat_ws(',', source, quality, lang) AS joined, source || ',' || quality AS chained,
           coalesce(nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''), 'TV') AS defaulted, md5(doc_id || '3') AS mark,
           regexp_replace(text, '((^|\s)[äÄöÖüÜßa-zA-Z]{1,3})+\s', ' ', 'g') AS long_words, CAST(len(string_split(text, '.')) AS INT) AS sentences,
           round(ln(n_chars + 1) / sqrt(n_chars + 1), 6) AS ratio
    FROM documents LEFT JOIN labels USING (doc_id)""")
def scalar_functions(spark, sf):
    rows = t.load(spark, sf, "documents").join(t.load(spark, sf, "labels"), "doc_id", "left")
    body, quality = F.col("text"), F.col("quality").cast("string")
    emptied = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return rows.select(
        "doc_id", F.lower(F.substring(body, 1, 512)).alias("lowered"), text.first_tokens(body).alias("opening"),
        text.trim_ws(F.concat(F.lit(" "), F.col("source"), F.lit(" \t"))).alias("trimmed"), F.concat_ws(",", "source", quality, "lang").alias("joined"),
        F.concat("source", F.lit(","), quality).alias("chained"), F.coalesce(F.nullif(emptied, F.lit("")), F.lit("TV")).alias("defaulted"),
        text.fingerprint(F.col("doc_id"), salt="3").alias("mark"), text.drop_short_words(body, 3).alias("long_words"),
        F.array_size(text.split_on(body, ".")).alias("sentences"), F.round(F.try_divide(F.ln(F.col("n_chars") + 1), F.sqrt(F.col("n_chars") + 1)), 6).alias("ratio"))


@query("array_functions", with_tables("training", """
    SELECT doc_id, array_to_string(list_slice(w, 2, 257), ' ') AS after_first, array_to_string(list_concat(keywords, tags), '|') AS chained,
           CAST(len(list_concat(keywords, tags)) AS INT) AS size, array_to_string(CASE WHEN len(list_filter(tags, lambda x: x = 'not for kids')) = 0 THEN ['TV'] ELSE ['not for kids'] END, '|') AS adult
    FROM (SELECT *, string_split(program_longsynopsis, ' ') AS w FROM training)"""))
def array_functions(spark, sf):
    adult = F.filter("tags", lambda x: x == "not for kids")
    return t.training_table(spark, sf).select(
        "doc_id", F.array_join(text.offset_window(F.split("program_longsynopsis", " "), 256), " ").alias("after_first"),
        F.array_join(F.concat("keywords", "tags"), "|").alias("chained"), F.array_size(F.concat("keywords", "tags")).alias("size"),
        F.array_join(text.default_array(adult, ["TV"]), "|").alias("adult"))


@query("plays_in_range", with_tables("plays", """
    SELECT user_id, count(DISTINCT content_id) AS contents, count(*) AS plays FROM plays
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY user_id HAVING count(DISTINCT content_id) > 15"""))
def plays_in_range(spark, sf):
    inside = t.events(spark, sf).where(text.in_dates(F.to_date("ts"), "2024-1-5", "2024-1-20"))
    return inside.groupBy("user_id").agg(F.count_distinct("content_id").alias("contents"), F.count(F.lit(1)).alias("plays")).where("contents > 15")

"""Similarity, recommendation, cluster and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import vectors
from tagloom.operators import clusters, labels, latent, models, recommend, similarity
from tagloom.operators.ordering import with_row_id
from tagloom.plans import catalogue as plans
from tagloom.plans import evaluation
from tagloom.session import cut_lineage
from workload import standins as t
from workload import catalogue_queries  # noqa: F401  its oracle texts are used here
from workload.registry import ORACLES, query
from workload.standins import with_tables

ITEMS = "items"
SCORES = """, scored AS (SELECT a.item AS id, b.item AS match_id, a.type AS query_type, b.type AS result_type,
        round(list_cosine_similarity(a.vec, b.vec), 12) AS score FROM items a JOIN items b ON a.item <> b.item),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS rank FROM scored)"""


@query("cosine_top10", with_tables(ITEMS, SCORES + " SELECT id, CAST(rank AS INT) AS rank, match_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"))
def cosine_top10(spark, sf):
    recs = recommend.content_to_content(t.items(spark, sf), 10, id_col="item")
    return recs.withColumn("score", F.round("score", 6))


@query("cosine_top10_blocked", with_tables(ITEMS, SCORES + " SELECT id, CAST(rank AS INT) AS rank, match_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"))
def cosine_top10_blocked(spark, sf):
    recs = recommend.content_to_content(t.items(spark, sf), 10, id_col="item", block_rows=192)
    return recs.withColumn("score", F.round("score", 6))


@query("cosine_top10_pruned", with_tables(ITEMS, SCORES + " SELECT id, CAST(rank AS INT) AS rank, match_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"))
def cosine_top10_pruned(spark, sf):
    recs = similarity.cosine_topk(items := t.items(spark, sf), items, 10, id_col="item", exclude_self=True, block_rows=48)
    return recs.withColumn("score", F.round("score", 6))


@query("two_model_top5", with_tables(ITEMS, """,
    pair AS (SELECT 'first' AS model, item, vec FROM items UNION ALL SELECT 'second', item, list_transform(vec, lambda x: x * abs(x)) FROM items),
    ranked AS (SELECT model, a.item AS id, b.item AS match_id, round(list_cosine_similarity(a.vec, b.vec), 12) AS score,
                      row_number() OVER (PARTITION BY model, a.item ORDER BY round(list_cosine_similarity(a.vec, b.vec), 12) DESC, b.item) AS rank
               FROM pair a JOIN pair b USING (model) WHERE a.item <> b.item)
    SELECT model, id, CAST(rank AS INT) AS rank, match_id, round(score, 6) AS score FROM ranked WHERE rank <= 5"""))
def two_model_top5(spark, sf):
    items = t.items(spark, sf)
    items = items.withColumn("vec", F.col("vec").cast("array<double>"))
    both = items.withColumn("model", F.lit("first")).unionByName(items.withColumn("vec", t.second_vector()).withColumn("model", F.lit("second")))
    return recommend.content_to_content(both, 5, id_col="item", by="model").withColumn("score", F.round("score", 6))


@query("two_model_top5_blocked", ORACLES["two_model_top5"])
def two_model_top5_blocked(spark, sf):
    """Both models by their trees, in blocks of 100 rows."""
    items = t.items(spark, sf)
    items = items.withColumn("vec", F.col("vec").cast("array<double>"))
    both = items.withColumn("model", F.lit("first")).unionByName(items.withColumn("vec", t.second_vector()).withColumn("model", F.lit("second")))
    return recommend.content_to_content(both, 5, id_col="item", by="model", block_rows=100).withColumn("score", F.round("score", 6))


@query("type_match", with_tables(ITEMS, SCORES + " SELECT id, round(avg(CAST(query_type = result_type AS INT)), 6) AS type_match FROM ranked WHERE rank <= 15 GROUP BY id"))
def type_match(spark, sf):
    items = t.items(spark, sf)
    out = recommend.type_match(recommend.content_to_content(items, 15, id_col="item"), items, "item")
    return out.withColumn("type_match", F.round("type_match", 6))


@query("recs_export", with_tables(ITEMS, SCORES + """
    SELECT id AS query_id, 'title ' || id AS query_title, query_type, CAST(rank AS INT) AS result_rank, match_id AS result_id,
           'title ' || match_id AS result_title, result_type, round(score, 6) AS score FROM ranked WHERE rank <= 15 AND query_type IN ('1', '2')"""))
def recs_export(spark, sf):
    items = t.items(spark, sf).withColumn("title", F.concat(F.lit("title "), F.col("item").cast("string")))
    recs = recommend.recommendations_for(items.where(F.col("type").isin("1", "2")), items, 15, id_col="item")
    out = recommend.export_recommendations(recs, items, "item", "title", ["type"])
    return out.withColumn("score", F.round("score", 6))


@query("score_histogram", with_tables(ITEMS, SCORES + """, span AS (SELECT min(score) AS lo, max(score) AS hi FROM scored),
    counted AS (SELECT least(CAST(floor((score - lo) / (hi - lo) * 100) AS BIGINT), 99) AS bin, count(*) AS n FROM scored, span GROUP BY 1)
    SELECT b AS bin, round(lo + b * ((hi - lo) / 100), 6) AS lo, round(lo + (b + 1) * ((hi - lo) / 100), 6) AS hi, coalesce(n, 0) AS n
    FROM range(100) r(b) LEFT JOIN counted ON b = bin, span"""))
def score_histogram(spark, sf):
    out = similarity.score_histogram(t.items(spark, sf), id_col="item")
    return out.withColumn("lo", F.round("lo", 6)).withColumn("hi", F.round("hi", 6))


DISTRIBUTIONS = """, positive AS (SELECT item, list_transform(vec, lambda x: exp(x)) AS e FROM items),
    p AS (SELECT item, list_transform(e, lambda x: x / list_sum(e)) AS p FROM positive),
    logs AS (SELECT item, p, list_transform(p, lambda x: ln(x)) AS l FROM p),
    kl AS (SELECT a.item AS id, b.item AS match_id, round(list_dot_product(a.p, a.l) - list_dot_product(a.p, b.l), 12) AS d,
                  round((list_dot_product(a.p, a.l) - list_dot_product(a.p, b.l) + list_dot_product(b.p, b.l) - list_dot_product(b.p, a.l)) / 2, 12) AS s
           FROM logs a JOIN logs b ON a.item <> b.item)"""


def _positive(spark, sf):
    return t.items(spark, sf).withColumn("vec", F.transform("vec", lambda x: F.exp(x.cast("double"))))


def _nearest(column: str) -> str:
    return with_tables(ITEMS, DISTRIBUTIONS + f""" SELECT id, CAST(rank AS INT) AS rank, match_id, round({column}, 6) AS divergence
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {column}, match_id) AS rank FROM kl) WHERE rank <= 15""")


@query("kl_pairs", _nearest("d"))
def kl_pairs(spark, sf):
    out = similarity.kl_nearest(_positive(spark, sf), 15, id_col="item")
    return out.withColumn("divergence", F.round("divergence", 6))


@query("symmetric_kl_pairs", _nearest("s"))
def symmetric_kl_pairs(spark, sf):
    out = similarity.kl_nearest(_positive(spark, sf), 15, symmetric=True, id_col="item")
    return out.withColumn("divergence", F.round("divergence", 6))


@query("neighbour_distances", with_tables(ITEMS, DISTRIBUTIONS + """,
    near AS (SELECT id, match_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, match_id) AS rank FROM kl) WHERE rank <= 5)
    SELECT near.id, match_id, round(list_sum(list_transform(list_zip(a.p, b.p), lambda z: z[1] * ln((z[1] + 1e-12) / (z[2] + 1e-12)))), 6) AS kl,
           round(list_cosine_similarity(x.vec, y.vec), 6) AS cosine
    FROM near JOIN p a ON a.item = id JOIN p b ON b.item = match_id JOIN items x ON x.item = id JOIN items y ON y.item = match_id"""))
def neighbour_distances(spark, sf):
    pairs = similarity.kl_nearest(_positive(spark, sf), 5, id_col="item").select("id", "match_id")
    share = lambda vec: vectors.to_distribution(F.transform(vec, lambda x: F.exp(x.cast("double"))))  # noqa: E731  made where both vectors are, they travel as they are stored
    left = t.items(spark, sf).select(F.col("item").alias("id"), "vec")
    right = left.select(F.col("id").alias("match_id"), F.col("vec").alias("w"))
    both = pairs.join(left, "id").join(right, "match_id").withColumn("p", share("vec")).withColumn("q", share("w"))
    return both.select(
        "id", "match_id", F.round(vectors.kl_distance(F.col("p"), F.col("q")), 6).alias("kl"),
        F.round(vectors.cosine(F.col("vec"), F.col("w")), 6).alias("cosine"))


HISTORY = """, known AS (SELECT user_id, plays.content_id, ts, item FROM plays JOIN items ON plays.content_id = items.content_id),
    history AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, content_id) AS rn FROM known) WHERE rn <= 10),
    later AS (SELECT user_id, content_id, min(ts) AS ts FROM known k WHERE NOT EXISTS (
                  SELECT 1 FROM history h WHERE h.user_id = k.user_id AND h.content_id = k.content_id) GROUP BY user_id, content_id),
    test AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, content_id) AS rn FROM later) WHERE rn <= 5)"""
PROFILES = """, member AS (SELECT user_id, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM history JOIN items USING (item)),
    sums AS (SELECT user_id, pos, sum(x) / 10 AS x FROM member GROUP BY user_id, pos),
    profiles AS (SELECT user_id, list(x ORDER BY pos) AS vec FROM sums GROUP BY user_id)"""
RANKED = """, user_scores AS (SELECT user_id, item, i.content_id AS content, round(list_cosine_similarity(p.vec, i.vec), 12) AS raw FROM profiles p, items i),
    masked AS (SELECT user_id, item, content, CASE WHEN EXISTS (SELECT 1 FROM history h WHERE h.user_id = s.user_id AND h.content_id = s.content)
                      THEN -1.0 ELSE raw END AS score FROM user_scores s),
    recs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item) AS rank FROM masked) WHERE rank <= 10)"""


def _evaluation(spark, sf, **options):
    return evaluation.evaluate(t.events(spark, sf), t.items(spark, sf), **options)


def _split(spark, sf):
    return recommend.history_and_test(t.events(spark, sf), items=t.items(spark, sf))


@query("history_test_split", with_tables("plays items", HISTORY + """
    SELECT user_id, content_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS played, 'history' AS part FROM history
    UNION ALL SELECT user_id, content_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 'test' FROM test"""))
def history_test_split(spark, sf):
    history, test = _split(spark, sf)
    cols = ["user_id", "content_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("played")]
    return history.select(*cols, F.lit("history").alias("part")).union(test.select(*cols, F.lit("test").alias("part")))


@query("user_profiles", with_tables("plays items", HISTORY + PROFILES + " SELECT user_id, pos, round(x, 6) AS value FROM sums"))
def user_profiles(spark, sf):
    history, _ = _split(spark, sf)
    out = recommend.user_profiles(history, t.items(spark, sf)).select("user_id", F.posexplode("vec").alias("pos", "value"))
    return out.select("user_id", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query("user_topn", with_tables("plays items", HISTORY + PROFILES + RANKED + " SELECT user_id, CAST(rank AS INT) AS rank, item, content, round(score, 6) AS score FROM recs"))
def user_topn(spark, sf):
    return _evaluation(spark, sf).recommendations.withColumn("score", F.round("score", 6))


@query("user_topn_blocked", ORACLES["user_topn"])
def user_topn_blocked(spark, sf):
    """The users' lists by the trees of users and items, in blocks of 100 rows."""
    return _evaluation(spark, sf, block_rows=100).recommendations.withColumn("score", F.round("score", 6))


METRICS = """, hits AS (SELECT user_id, n_test, sum(CAST(rank <= 1 AS INT)) AS h1, sum(CAST(rank <= 5 AS INT)) AS h5, sum(CAST(rank <= 10 AS INT)) AS h10 FROM (
        SELECT t.user_id, n_test, rank FROM (SELECT user_id, count(*) AS n_test FROM test GROUP BY user_id) t
        LEFT JOIN (SELECT r.user_id, rank FROM recs r JOIN test x ON x.user_id = r.user_id AND x.content_id = r.content) r ON r.user_id = t.user_id)
        GROUP BY user_id, n_test),
    h AS (SELECT user_id, n_test, coalesce(h1, 0) AS h1, coalesce(h5, 0) AS h5, coalesce(h10, 0) AS h10 FROM hits),
    listed AS (SELECT content, rank FROM recs WHERE user_id IN (SELECT user_id FROM test)),
    seen AS (SELECT count(DISTINCT content_id) AS n FROM test),
    total AS (SELECT count(DISTINCT user_id) AS total FROM known)"""


@query("user_results", with_tables("plays items", HISTORY + PROFILES + RANKED + METRICS + """
    SELECT user_id, n_test, CAST(h1 AS BIGINT) AS hits_1, CAST(h5 AS BIGINT) AS hits_5, CAST(h10 AS BIGINT) AS hits_10,
           round(h1 / 1, 6) AS precision_1, round(h5 / 5, 6) AS precision_5, round(h10 / 10, 6) AS precision_10,
           round(h1 / n_test, 6) AS recall_1, round(h5 / n_test, 6) AS recall_5, round(h10 / n_test, 6) AS recall_10 FROM h"""))
def user_results(spark, sf):
    out = _evaluation(spark, sf).per_user()
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.startswith(("precision", "recall"))})


def _metric(name: str, top: str) -> str:
    return f'round({top}, 6) AS "{name}"'


RANKING = ", ".join(
    [_metric(f"Precision@{n}", f"(SELECT sum(h{n} / {n}) FROM h) / total") for n in (1, 5, 10)]
    + [_metric(f"Recall@{n}", f"(SELECT sum(h{n} / n_test) FROM h) / total") for n in (1, 5, 10)]
    + [_metric(f"Accuracy@{n}", f"(SELECT count(*) FILTER (h{n} > 0) FROM h) / total") for n in (1, 5, 10)]
    + [_metric(f"Coverage@{n}", f"(SELECT count(DISTINCT content) FROM listed WHERE rank <= {n}) / (SELECT n FROM seen)") for n in (1, 5, 10)]
)


@query("ranking_metrics", with_tables("plays items", HISTORY + PROFILES + RANKED + METRICS + f" SELECT total, {RANKING} FROM total"))
def ranking_metrics(spark, sf):
    out = _evaluation(spark, sf).metrics
    return out.select("total", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in out.columns if c != "total"])


LETTERS = "abcdefghijklmnop"
CATALOGUE_RUN = f"""WITH raw_plays AS (SELECT CAST(user_id AS VARCHAR) AS u, CAST(ts AS DATE) AS d, CAST(json_extract_string(props, '$.k') AS BIGINT) AS content_id, ts FROM events),
    starts AS (SELECT u, d, min(ts) AS t FROM raw_plays GROUP BY u, d),
    chosen AS (SELECT u FROM raw_plays WHERE d >= DATE '2024-01-05' AND d < DATE '2024-01-20' GROUP BY u HAVING count(DISTINCT content_id) > 15
               ORDER BY md5(u || '3'), u LIMIT 100),
    plays AS (SELECT u AS user_id, content_id, t AS ts FROM raw_plays JOIN starts USING (u, d) WHERE u IN (SELECT u FROM chosen)),
    named AS ({ORACLES["titles_keywords"]}),
    first_rows AS (SELECT *, row_number() OVER (PARTITION BY "TitleDetails_title" ORDER BY "TitleType", content_ordinal_id) AS rn FROM named),
    texts AS (SELECT content_ordinal_id AS item, concat_ws(' ', "TitleDetails_title", coalesce(keywords, ''), "TitleDetails_longsynopsis") AS text FROM first_rows WHERE rn = 1),
    items AS (SELECT item, item AS content_id, list_transform(string_split('{' '.join(LETTERS)}', ' '), lambda c: CAST(length(text) - length(replace(text, c, '')) AS DOUBLE)) AS vec FROM texts)"""


@query("catalogue_evaluation", CATALOGUE_RUN + HISTORY + PROFILES + RANKED + METRICS + f" SELECT total, {RANKING} FROM total")
def catalogue_evaluation(spark, sf):
    """The evaluation from raw plays and catalogue rows, with an encoder that counts letters."""

    def load_encoder():
        import numpy as np

        return lambda texts: np.array([[x.count(c) for c in LETTERS] for x in texts], dtype=float)

    run = evaluation.evaluate_catalogue(t.play_sequence(spark, sf), t.catalogue_view(spark, sf), t.content_id(spark, sf), load_encoder, "2024-1-05", "2024-1-20", users=100)
    return run.metrics.select("total", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in run.metrics.columns if c != "total"])


@query("metrics_long", with_tables("plays items", HISTORY + PROFILES + RANKED + METRICS + f""", wide AS (SELECT {RANKING} FROM total)
    SELECT 'stand-in' AS model_name, '2024-02-01 00:00:00' AS date, metric_name, value, 'vectors' AS model_path
    FROM (UNPIVOT wide ON COLUMNS(*) INTO NAME metric_name VALUE value)"""))
def metrics_long(spark, sf):
    out = recommend.metrics_long(_evaluation(spark, sf).metrics, "stand-in", "vectors", F.lit("2024-02-01 00:00:00"))
    return out.withColumn("value", F.round("value", 6))


# every seventh item loses its direction: such pairs have no score and are left out
@query("score_summary", with_tables("plays items", HISTORY + PROFILES + """,
    user_scores AS (SELECT round(list_cosine_similarity(p.vec, i.vec), 12) AS raw FROM profiles p, items i WHERE item % 7 <> 0)
    SELECT count(*) AS n, round(avg(raw), 6) AS mean, round(stddev_pop(raw), 6) AS std, round(median(raw), 6) AS median FROM user_scores"""))
def score_summary(spark, sf):
    history, _ = _split(spark, sf)
    items = t.items(spark, sf)
    profiles = recommend.user_profiles(history, items)
    zero = F.transform("vec", lambda x: x * 0)
    some = items.withColumn("vec", F.when(F.col("item") % 7 == 0, zero).otherwise(F.col("vec")))
    out = similarity.score_summary(profiles, some, left_id="user_id", right_id="item")
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "median")])


@query("raw_tag_recommendations", with_tables("catalogue content_id", """,
    ids AS (SELECT DISTINCT lower(program_title) AS name, cid FROM content_id),
    titles AS (SELECT DISTINCT title, type, cid FROM catalogue JOIN ids ON lower(title) = name WHERE synopsis IS NOT NULL),
    train AS (SELECT upper(p_name) AS name, list(DISTINCT w) AS tags FROM (SELECT p_name, unnest(string_split(p_name, ' ') || [p_brand, p_type]) AS w FROM part) GROUP BY p_name),
    tagged AS (SELECT title || '/' || type AS id, type, tags FROM titles JOIN train ON lower(title) = lower(name)),
    scored AS (SELECT a.id, b.id AS match_id, a.type AS qt, b.type AS rt,
               round(len(list_intersect(a.tags, b.tags)) / (sqrt(len(a.tags)) * sqrt(len(b.tags))), 12) AS score FROM tagged a JOIN tagged b ON a.id <> b.id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, match_id) AS rank FROM scored)
    SELECT r.id, CAST(rank AS INT) AS rank, match_id, round(score, 6) AS score, round(m, 6) AS type_match
    FROM ranked r JOIN (SELECT id, avg(CAST(qt = rt AS INT)) AS m FROM ranked WHERE rank <= 15 GROUP BY id) USING (id) WHERE rank <= 15"""))
def raw_tag_recommendations(spark, sf):
    parts = t.load(spark, sf, "part")
    training = parts.select(F.upper("p_name").alias("program_title"), F.concat(F.split("p_name", " "), F.array("p_brand", "p_type")).alias("tags"))
    titles = plans.titles_with_tags(t.catalogue_view(spark, sf), t.content_id(spark, sf), training)
    titles = titles.withColumn("id", F.concat("TitleDetails_title", F.lit("/"), "TitleType"))
    out = plans.tag_recommendations(titles, "id", "TitleType")
    return out.select("id", "rank", "match_id", F.round("score", 6).alias("score"), F.round("type_match", 6).alias("type_match"))


@query("mean_pooled_titles", with_tables("items", """,
    titles AS (SELECT p_name AS title, unnest([p_partkey, p_size]) AS idx FROM part),
    member AS (SELECT title, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM titles JOIN items ON idx = item),
    means AS (SELECT title, pos, avg(x) AS x FROM member GROUP BY title, pos),
    numbered AS (SELECT title, row_number() OVER (ORDER BY title) AS row FROM (SELECT DISTINCT title FROM means))
    SELECT row, title, pos, round(x, 6) AS value FROM means JOIN numbered USING (title)
    UNION ALL SELECT 0, '', pos, round(avg(x), 6) FROM means GROUP BY pos"""))
def mean_pooled_titles(spark, sf):
    parts = t.load(spark, sf, "part")
    titles = parts.select(F.col("p_name").alias("title"), F.array(F.col("p_partkey"), F.col("p_size").cast("bigint")).alias("indices"))
    vecs = t.items(spark, sf).select(F.col("item").alias("idx"), "vec")
    out = clusters.title_embeddings(titles, vecs).select("row", F.coalesce("title", F.lit("")).alias("title"), F.posexplode("vec").alias("pos", "value"))
    return out.select("row", "title", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query("title_vector_lookup", with_tables("items", """,
    titles AS (SELECT p_name AS title, item FROM part JOIN items ON p_partkey = item),
    member AS (SELECT title, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM titles JOIN items USING (item)),
    means AS (SELECT title, pos, avg(x) AS x FROM member GROUP BY title, pos),
    whole AS (SELECT pos, avg(x) AS x FROM means GROUP BY pos),
    asked AS (SELECT DISTINCT p_brand AS title FROM part UNION SELECT DISTINCT p_name FROM part)
    SELECT asked.title, whole.pos, round(coalesce(means.x, whole.x), 6) AS value
    FROM asked CROSS JOIN whole LEFT JOIN means ON means.title = asked.title AND means.pos = whole.pos"""))
def title_vector_lookup(spark, sf):
    parts = t.load(spark, sf, "part")
    titles = parts.select(F.col("p_name").alias("title"), F.array("p_partkey").alias("indices"))
    table = clusters.title_embeddings(titles, t.items(spark, sf).select(F.col("item").alias("idx"), "vec"))
    asked = parts.select(F.col("p_brand").alias("title")).union(parts.select("p_name")).distinct()
    out = clusters.lookup_title_vectors(asked, table).select("title", F.posexplode("vec").alias("pos", "value"))
    return out.select("title", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))


@query("concat_vectors", with_tables("items", """
    SELECT item, i - 1 AS pos, round((vec || list_transform(vec, lambda x: x * abs(x)))[i], 6) + 0.0 AS value FROM items, range(1, 129) r(i)"""))
def concat_vectors(spark, sf):
    joined = vectors.concat_vectors(F.col("vec"), t.second_vector())
    out = t.items(spark, sf).select("item", F.posexplode(joined).alias("pos", "value"))
    return out.select("item", F.col("pos").cast("bigint").alias("pos"), (F.round("value", 6) + F.lit(0.0)).alias("value"))


@query("centroid_words", with_tables("words", """, member AS (SELECT word, cluster, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM words),
    means AS (SELECT cluster, pos, avg(x) AS m FROM member GROUP BY cluster, pos),
    gaps AS (SELECT cluster, word, round(sum((x - m) * (x - m)), 12) AS gap FROM member JOIN means USING (cluster, pos) GROUP BY cluster, word),
    best AS (SELECT cluster, word AS centroid_word, row_number() OVER (PARTITION BY cluster ORDER BY gap, word) AS rn, count(*) OVER (PARTITION BY cluster) AS num_words FROM gaps)
    SELECT words.word, cluster, centroid_word, num_words FROM words JOIN best USING (cluster) WHERE rn = 1"""))
def centroid_words(spark, sf):
    return clusters.centroid_word(t.words(spark, sf)).select("word", "cluster", "centroid_word", "num_words")


@query("cluster_override", """
    SELECT word, CASE WHEN contains(word, 'whet') THEN 'whethers' WHEN contains(word, 'tion') THEN 'tions' WHEN contains(word, 'ther') THEN 'thereof' ELSE word[1:2] END AS centroid_word
    FROM (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM documents)
    UNION ALL SELECT unnest(['eng', 'spa', 'Episode', 'Movie', 'older teens (ages 15+)', 'tweens (ages 10-12)', 'teens (ages 13-14)', 'big kids (ages 8-9)',
        'little kids (ages 5-7)', 'preschoolers (ages 2-4)', 'not for kids']), unnest(['eng', 'spa', 'Episode', 'Movie', 'older teens (ages 15+)',
        'tweens (ages 10-12)', 'teens (ages 13-14)', 'big kids (ages 8-9)', 'little kids (ages 5-7)', 'preschoolers (ages 2-4)', 'not for kids'])""")
def cluster_override(spark, sf):
    found = t.load(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    named = found.select("word", F.array().cast("array<double>").alias("vec"), F.lit(0).alias("cluster"), F.substring("word", 1, 2).alias("centroid_word"), F.lit(1).alias("num_words"))
    changed = clusters.override_by_prefix(named, kept=["whethers", "tions", "thereof"])
    return clusters.append_special_labels(changed).select("word", "centroid_word")


@query("kmeans_labels", "SELECT count(*) AS vectors, 10 AS clusters, 0 AS misplaced FROM embeddings")
def kmeans_labels(spark, sf):
    """Every vector lies in the cluster of its nearest centre, and every cluster has one."""
    words, centers = clusters.cluster_with_centers(t.words(spark, sf).drop("cluster"), k=10)
    gap = F.aggregate(F.zip_with(F.col("vec").cast("array<double>"), "center", lambda x, c: (x - c) * (x - c)), F.lit(0.0), lambda acc, x: acc + x)
    # ten rows of centres
    gaps = words.crossJoin(F.broadcast(centers.withColumnRenamed("cluster", "other"))).select("word", "cluster", "other", gap.alias("gap"))
    per_word = gaps.groupBy("word", "cluster").agg(F.min("gap").alias("least"), F.min(F.when(F.col("other") == F.col("cluster"), F.col("gap"))).alias("own"))
    return per_word.agg(F.count(F.lit(1)).alias("vectors"), F.count_distinct("cluster").cast("int").alias("clusters"),
                        F.count_if(F.col("own") > F.col("least") + 1e-9).cast("int").alias("misplaced"))


@query("clusters_in_order", with_tables("words", """ SELECT row_number() OVER (ORDER BY cluster, word) AS place, cluster, word FROM words"""))
def clusters_in_order(spark, sf):
    """Cluster members in cluster order, numbered as they come."""
    rows = clusters.in_cluster_order(t.words(spark, sf).select("cluster", "word"))
    return with_row_id(rows, F.col("cluster"), F.col("word"), name="place", start=1).select("place", "cluster", "word")


@query("keyword_clusters", with_tables("words", """, member AS (SELECT word, cluster, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM words),
    means AS (SELECT cluster, pos, avg(x) AS m FROM member GROUP BY cluster, pos),
    gaps AS (SELECT cluster, word, round(sum((x - m) * (x - m)), 12) AS gap FROM member JOIN means USING (cluster, pos) GROUP BY cluster, word),
    best AS (SELECT cluster, word AS centroid_word, row_number() OVER (PARTITION BY cluster ORDER BY gap, word) AS rn, count(*) OVER (PARTITION BY cluster) AS num_words FROM gaps)
    SELECT words.word, cluster, CASE WHEN contains(words.word, 'rd 1') THEN 'rd 1 and more' ELSE centroid_word END AS centroid_word, num_words
    FROM words JOIN best USING (cluster) WHERE rn = 1
    UNION ALL SELECT """ + f"unnest({clusters.SPECIAL_LABELS!r}), 10 + unnest(range({len(clusters.SPECIAL_LABELS)})), unnest({clusters.SPECIAL_LABELS!r}), 1".replace('"', "''" )))
def keyword_clusters(spark, sf):
    out = clusters.keyword_clusters(t.words(spark, sf), k=10, kept=["rd 1 and more"], given=True)
    return out.select("word", F.col("cluster").cast("long").alias("cluster"), "centroid_word", F.col("num_words").cast("long").alias("num_words"))


@query("embed_text", """
    SELECT doc_id, length(text) AS chars, len(string_split(text, ' ')) AS blanks FROM documents""")
def embed_text(spark, sf):
    def load_encoder():
        import numpy as np

        return lambda texts: np.array([[len(x), x.count(" ") + 1] for x in texts], dtype=float)

    out = models.embed_text(t.load(spark, sf, "documents").select("doc_id", "text"), "text", load_encoder)
    return out.select("doc_id", F.col("vec")[0].cast("bigint").alias("chars"), F.col("vec")[1].cast("bigint").alias("blanks"))


@query("text_vectors", "SELECT doc_id, 64 AS dim, 1 AS unit_or_zero FROM documents")
def text_vectors(spark, sf):
    """Every text has a vector of the asked size that has length 1, or 0 where no word tells it apart."""
    docs = t.documents(spark, sf).select("doc_id", "text")
    out = models.apply_text_vectors(models.fit_text_vectors(docs, "text", dim=64), docs)
    norm = F.round(vectors.l2_norm(F.col("vec")), 9)
    return out.select("doc_id", F.array_size("vec").alias("dim"), norm.isin(0.0, 1.0).cast("int").alias("unit_or_zero"))


@query("latent_vectors", "SELECT doc_id, 32 AS dim, 1 AS unit_or_zero FROM documents")
def latent_vectors(spark, sf):
    """M1: vectors along the leading directions of all texts' word weights. Directions themselves are tested against numpy."""
    docs = t.documents(spark, sf).select("doc_id", "text")
    out = latent.fit_latent_vectors(docs, "text", dim=32).encode(docs, "text")
    norm = F.round(vectors.l2_norm(F.col("vec")), 9)
    return out.select("doc_id", F.array_size("vec").alias("dim"), norm.isin(0.0, 1.0).cast("int").alias("unit_or_zero"))


def _tagger(spark, sf):
    rows = t.training_table(spark, sf).select(
        "doc_id", F.col("program_longsynopsis").alias("synopsis"), F.concat_ws(" ", "keywords").alias("keywords"), "tags")
    fitted = labels.fit_preprocess(rows)
    prepared = cut_lineage(fitted.transform(rows, "doc_id"))  # read for fitting and for scoring
    tagger = models.train_tagger(prepared, features=256, max_iter=5)
    return tagger.score(prepared), fitted.vocab


@query("train_tagger", """
    SELECT doc_id, least(5, (SELECT count(DISTINCT tag) FROM (SELECT lang AS tag FROM documents UNION ALL SELECT 'quality ' || quality FROM labels
           UNION ALL SELECT 'not for kids' FROM labels WHERE toxic = 1))) AS tags, 1 AS in_range, 1 AS descending FROM documents""")
def train_tagger(spark, sf):
    """Every document has its five best tags, scores strictly between 0 and 1, best first."""
    scored, vocab = _tagger(spark, sf)
    best = models.top_tags(scored, "doc_id", "scores", vocab, 5)
    per_doc = best.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("r"))
    inside = F.forall("r", lambda x: (x["score"] > 0) & (x["score"] < 1))
    falls = F.forall(F.sequence(F.lit(1), F.array_size("r") - 1), lambda i: F.element_at("r", i)["score"] >= F.element_at("r", i + 1)["score"])
    return per_doc.select("doc_id", F.array_size("r").cast("long").alias("tags"), inside.cast("int").alias("in_range"),
                          F.when(F.array_size("r") < 2, True).otherwise(falls).cast("int").alias("descending"))


@query("tagger_loss", "SELECT 1 AS better_than_constant")
def tagger_loss(spark, sf):
    """The fitted tagger's loss is below that of the labels' shares."""
    scored, _ = _tagger(spark, sf)
    return models.log_loss(scored, "tags_xf", "scores").select((F.col("model") < F.col("constant")).cast("int").alias("better_than_constant"))

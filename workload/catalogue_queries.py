"""Catalogue queries on the stand-in tables. Arrays are shown as joined texts so that rows compare by value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.text import TOKEN_LIMIT
from tagloom.operators import labels, ordering, relational
from tagloom.plans import catalogue as plans
from workload import standins as t
from workload.registry import query
from workload.standins import with_tables


def shown(col: str, sep: str = "|") -> Column:
    return F.array_join(F.col(col).cast("array<string>"), sep).alias(col)


def stamp(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


CUT = f"array_to_string(list_slice(string_split({{}}, ' '), 1, {TOKEN_LIMIT}), ' ')"
TRIMMED = r"list_distinct(list_transform(list_filter({}, lambda x: x NOT IN ({})), lambda x: regexp_replace(x, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')))"


@query("ingest_training_rows", with_tables("training", f"""
    SELECT {CUT.format('program_longsynopsis')} AS synopsis, keywords, tags FROM (
        SELECT program_longsynopsis, string_agg(k, ' ' ORDER BY k) AS keywords, min(array_to_string(tags, '|')) AS tags
        FROM (SELECT *, unnest(keywords) AS k FROM training)
        GROUP BY program_title, program_type, program_language, program_longsynopsis)"""))
def ingest_training_rows(spark, sf):
    return plans.training_rows(t.training_table(spark, sf)).select("synopsis", "keywords", shown("tags"))


@query("ingest_tag_build", with_tables("program program_tags", """,
    raw AS (SELECT DISTINCT program_id, CASE tag_value WHEN 'Docudrama' THEN 'Documentary drama' WHEN 'Historical drama' THEN 'History drama'
                WHEN 'Romantic comedy' THEN 'Romance comedy' ELSE tag_value END AS tag FROM program_tags WHERE tag_type = 'Genre'),
    frequent AS (SELECT tag FROM raw GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 100),
    ages AS (SELECT program_id, CASE WHEN tag_value IN ('little kids (ages 5-7)', 'big kids (ages 8-9)') THEN 'kids (ages 5-9)' ELSE tag_value END AS tag
             FROM program_tags WHERE tag_value IN ('not for kids', 'preschoolers (ages 2-4)', 'little kids (ages 5-7)', 'big kids (ages 8-9)',
                 'tweens (ages 10-12)', 'teens (ages 13-14)', 'older teens (ages 15+)')),
    chosen AS (SELECT * FROM program WHERE program_longsynopsis IS NOT NULL AND program_seriesid IS NULL AND program_language IN ('eng', 'spa')
               AND program_type IN ('Episode', 'Movie') AND program_title NOT IN ('OnDemand Movie', 'Movie')),
    tagged AS (SELECT program_id, tag FROM raw WHERE tag IN (SELECT tag FROM frequent) UNION SELECT program_id, tag FROM ages),
    every AS (SELECT program_title, program_val, program_longsynopsis, tag FROM chosen JOIN tagged ON program_val = program_id
              UNION SELECT program_title, program_val, program_longsynopsis, unnest([program_type, program_language]) FROM chosen
                    WHERE program_val IN (SELECT program_id FROM tagged))
    SELECT program_title, program_val AS program_id, program_longsynopsis AS synopsis, string_agg(tag, '|' ORDER BY tag) AS tags
    FROM every GROUP BY ALL"""))
def ingest_tag_build(spark, sf):
    out = plans.tag_training_rows(t.program(spark, sf), t.program_tags(spark, sf))
    return out.select("program_title", "program_id", "synopsis", shown("tags"))


TITLES = """,
    ids AS (SELECT DISTINCT lower(program_title) AS name, cid FROM content_id),
    titles AS (SELECT title, type, cid, string_agg(DISTINCT synopsis, ' ' ORDER BY synopsis) AS synopsis
               FROM catalogue JOIN ids ON lower(title) = name WHERE synopsis IS NOT NULL GROUP BY title, type, cid)"""
TITLE_COLUMNS = 'title AS "TitleDetails_title", type AS "TitleType", cid AS content_ordinal_id'


@query("titles_merged", with_tables("catalogue content_id", f'{TITLES} SELECT {TITLE_COLUMNS}, synopsis AS "TitleDetails_longsynopsis" FROM titles'))
def titles_merged(spark, sf):
    return plans.titles_merged(t.catalogue_view(spark, sf), t.content_id(spark, sf))


@query("titles_lower", with_tables("catalogue content_id", f'{TITLES} SELECT {TITLE_COLUMNS}, synopsis AS "TitleDetails_longsynopsis", lower(title) AS title FROM titles'))
def titles_lower(spark, sf):
    return plans.titles_lower(t.catalogue_view(spark, sf), t.content_id(spark, sf))


TOKENS = """,
    opening AS (SELECT DISTINCT title, unnest(list_slice(string_split(synopsis, ' '), 2, 257)) AS token FROM titles),
    found AS (SELECT title, list(token ORDER BY token) AS tokens FROM opening WHERE token IN (SELECT tokens FROM token_vocab) GROUP BY title),
    kept AS (SELECT titles.*, list_slice(coalesce(tokens, ['TV']), 2, 65) AS tokens FROM titles LEFT JOIN found USING (title))"""


@query("titles_tokens", with_tables("catalogue content_id token_vocab", f"""{TITLES}{TOKENS}
    SELECT {TITLE_COLUMNS}, synopsis AS "TitleDetails_longsynopsis", array_to_string(tokens, '|') AS tokens FROM kept WHERE len(tokens) > 0"""))
def titles_tokens(spark, sf):
    out = plans.titles_tokens(t.catalogue_view(spark, sf), t.content_id(spark, sf), t.token_vocab(spark, sf))
    return out.withColumn("tokens", shown("tokens"))


@query("titles_tokens_keywords", with_tables("catalogue content_id token_vocab", f""",
    titles AS (SELECT title, type, cid, string_agg(DISTINCT synopsis, ' ' ORDER BY synopsis) AS synopsis, string_agg(DISTINCT tags, ',' ORDER BY tags) AS tags
               FROM catalogue JOIN content_id ON title = program_title WHERE synopsis IS NOT NULL GROUP BY title, type, cid){TOKENS}
    SELECT {TITLE_COLUMNS}, synopsis AS "TitleDetails_longsynopsis", array_to_string(tokens, '|') AS tokens,
           array_to_string(list_sort({TRIMMED.format("string_split('movie,' || tags, ',')", "''")}), '|') AS keywords
    FROM kept WHERE len(tokens) > 0"""))
def titles_tokens_keywords(spark, sf):
    out = plans.titles_tokens_keywords(t.catalogue_view(spark, sf), t.content_id(spark, sf), t.token_vocab(spark, sf))
    return out.withColumn("tokens", shown("tokens")).withColumn("keywords", shown("keywords"))


@query("titles_keywords", with_tables("catalogue content_id", f"""{TITLES},
    pieces AS (SELECT title, type, cid, unnest(string_split(concat_ws(',', genre, subgenres, tags, language), ',')) AS piece
               FROM catalogue JOIN ids ON lower(title) = name WHERE synopsis IS NOT NULL),
    joined AS (SELECT title, type, cid, string_agg(DISTINCT regexp_replace(piece, '^\\s+|\\s+$', '', 'g'), ' '
                      ORDER BY regexp_replace(piece, '^\\s+|\\s+$', '', 'g')) AS keywords
               FROM pieces WHERE piece NOT IN ('', 'und') GROUP BY title, type, cid)
    SELECT {TITLE_COLUMNS}, {CUT.format('keywords')} AS keywords, {CUT.format('synopsis')} AS "TitleDetails_longsynopsis"
    FROM titles LEFT JOIN joined USING (title, type, cid)"""))
def titles_keywords(spark, sf):
    return plans.titles_keywords(t.catalogue_view(spark, sf), t.content_id(spark, sf))


@query("titles_series_ids", with_tables("catalogue content_id", f"""{TITLES},
    series AS (SELECT title, type, array_to_string(list_sort(list(DISTINCT coalesce(series_id, title_id))), '|') AS sid
               FROM catalogue WHERE synopsis IS NOT NULL GROUP BY title, type)
    SELECT {TITLE_COLUMNS}, synopsis AS "TitleDetails_longsynopsis", sid AS "InSeasonSeries_Id" FROM titles JOIN series USING (title, type)"""))
def titles_series_ids(spark, sf):
    out = plans.titles_series_ids(t.catalogue_view(spark, sf), t.content_id(spark, sf))
    return out.withColumn("InSeasonSeries_Id", shown("InSeasonSeries_Id"))


@query("training_series_ids", with_tables("catalogue training", """,
    series AS (SELECT title, type, list_sort(list(DISTINCT coalesce(series_id, title_id))) AS sid FROM catalogue WHERE synopsis IS NOT NULL GROUP BY title, type),
    named AS (SELECT (['small ring', 'red widget', 'blue bolt', 'nothing'])[1 + length(program_longsynopsis) % 4] AS program_title, program_type, program_longsynopsis, tags FROM training)
    SELECT program_title, program_type, program_longsynopsis, array_to_string(tags, '|') AS tags,
           coalesce(array_to_string(sid, '|'), 'movie') AS "InSeasonSeries_Id", CAST(coalesce(len(sid), 0) AS INT) AS titles_length
    FROM named LEFT JOIN series ON lower(program_title) = lower(title)"""))
def training_series_ids(spark, sf):
    names = F.array(*[F.lit(n) for n in ("small ring", "red widget", "blue bolt", "nothing")])
    picked = F.element_at(names, (F.char_length("program_longsynopsis") % 4 + 1).cast("int"))
    training = t.training_table(spark, sf).withColumn("program_title", picked)
    out = plans.training_series_ids(training, t.catalogue_view(spark, sf))
    return out.withColumn("tags", shown("tags")).withColumn("InSeasonSeries_Id", shown("InSeasonSeries_Id"))


@query("title_ids", with_tables("catalogue", """
    SELECT DISTINCT title AS "TitleDetails_title", coalesce(series_id, title_id) AS "InSeasonSeries_Id",
           CAST(coalesce(series_id, title_id) IN (SELECT 'S' || s_suppkey FROM supplier) AS INT) AS is_member FROM catalogue"""))
def title_ids(spark, sf):
    known = t.load(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("known"))
    out = plans.title_ids(t.catalogue_view(spark, sf), known)
    return out.withColumn("is_member", F.col("is_member").cast("int"))


CMV = f""",
    chosen AS (SELECT *, unnest(string_split(concat_ws(',', genre, subgenres, tags, language), ',')) AS piece FROM catalogue
               WHERE language IN ('eng', 'spa') AND type IN ('Programme', 'Movie') AND title NOT IN ('OnDemand Movie')),
    pieces AS (SELECT lower(title) AS k, type, language, list_sort({TRIMMED.format('list(piece)', "''")}) AS tags FROM chosen GROUP BY ALL),
    texts AS (SELECT lower(title) AS k, type, language, min(title) AS title, string_agg(synopsis, ' ' ORDER BY synopsis) AS synopsis FROM catalogue
              WHERE language IN ('eng', 'spa') AND type IN ('Programme', 'Movie') AND title NOT IN ('OnDemand Movie') GROUP BY ALL),
    cmv AS (SELECT title, type, language, synopsis, tags FROM texts JOIN pieces USING (k, type, language))"""


@query("catalogue_tags", with_tables("catalogue", CMV + " SELECT title, type, language, synopsis, array_to_string(tags, '|') AS tags FROM cmv"))
def catalogue_tags(spark, sf):
    return plans.catalogue_tags(t.catalogue_view(spark, sf)).withColumn("tags", shown("tags"))


@query("catalogue_synopses", with_tables("catalogue", CMV + """
    SELECT k AS title, type, language, chunk, substr(synopsis, chunk * 1000 + 1, 1000) AS synopsis
    FROM (SELECT k, type, language, synopsis, unnest(range(CAST(ceil(length(synopsis) / 1000) AS BIGINT))) AS chunk FROM texts)"""))
def catalogue_synopses(spark, sf):
    return plans.catalogue_synopses(t.catalogue_view(spark, sf), size=1000)


FULL = """,
    good AS (SELECT * FROM program WHERE program_language IN ('eng', 'spa') AND program_longsynopsis IS NOT NULL
             AND program_val IN (SELECT program_id FROM program_tags)),
    tag_rows AS (SELECT program_id, tag_value AS tag, CASE WHEN tag_type IN ('Genre', 'KidsTheme') OR tag_value = 'not for kids' THEN tag_value END AS genre
                 FROM program_tags WHERE tag_value IN (SELECT tokens FROM content_words)),
    movies AS (SELECT 'Movie' AS program_type, program_title, program_longsynopsis, program_language, program_val FROM good
               WHERE program_type = 'Movie' AND program_title <> 'OnDemand Movie' AND program_seriesid IS NULL),
    movie_rows AS (SELECT m.* EXCLUDE (program_val), tag, genre FROM movies m JOIN tag_rows ON program_val = program_id
                   UNION ALL SELECT m.* EXCLUDE (program_val), unnest([program_type, program_language]), NULL FROM movies m),
    series AS (SELECT * FROM good WHERE program_type IN ('Episode', 'SeriesMaster')),
    series_rows AS (SELECT program_title, program_longsynopsis, program_language, tag, genre FROM series JOIN tag_rows ON program_val = program_id
                    UNION ALL SELECT program_title, program_longsynopsis, program_language, unnest(['Episode', program_language]), NULL FROM series),
    every AS (SELECT program_type, program_title, program_longsynopsis, program_language, list_sort(list(DISTINCT genre)) AS genre,
                     list_sort(list(DISTINCT tag)) AS tags FROM movie_rows GROUP BY ALL
              UNION ALL
              SELECT 'Episode', program_title, string_agg(DISTINCT program_longsynopsis, ' ' ORDER BY program_longsynopsis), program_language,
                     list_sort(list(DISTINCT genre)), list_sort(list(DISTINCT tag)) FROM series_rows GROUP BY program_title, program_language)"""
CONTENT_WORDS = """, content_words AS (SELECT DISTINCT tag_value AS tokens FROM program_tags WHERE tag_value NOT LIKE 'genre src1%')"""


def content_words(spark, sf):
    tags = t.program_tags(spark, sf)
    return tags.where(~F.col("tag_value").startswith("genre src1")).select(F.col("tag_value").alias("tokens")).distinct()


@query("full_tags", with_tables("program program_tags", CONTENT_WORDS + FULL + """
    SELECT program_type, program_title, program_longsynopsis, program_language, array_to_string(tags, '|') AS tags FROM every"""))
def full_tags(spark, sf):
    out = plans.full_tags(t.program(spark, sf), t.program_tags(spark, sf), content_words(spark, sf))
    return out.withColumn("tags", shown("tags"))


@query("full_tags_genre", with_tables("program program_tags", CONTENT_WORDS + FULL + """
    SELECT program_type, program_title, program_longsynopsis, program_language, coalesce(array_to_string(list_filter(genre, lambda x: x IS NOT NULL), '|'), '') AS genre,
           array_to_string(tags, '|') AS tags FROM every"""))
def full_tags_genre(spark, sf):
    out = plans.full_tags(t.program(spark, sf), t.program_tags(spark, sf), content_words(spark, sf), with_genre=True)
    return out.withColumn("genre", F.coalesce(shown("genre"), F.lit(""))).withColumn("tags", shown("tags"))


@query("users_sampled_plays", """
    WITH plays AS (SELECT CAST(user_id AS VARCHAR) AS u, CAST(ts AS DATE) AS d, CAST(json_extract_string(props, '$.k') AS BIGINT) AS content_id, ts FROM events),
    starts AS (SELECT u, d, min(ts) AS t FROM plays GROUP BY u, d),
    chosen AS (SELECT u FROM plays WHERE d >= DATE '2024-01-05' AND d < DATE '2024-01-20' GROUP BY u HAVING count(DISTINCT content_id) > 15
               ORDER BY md5(u || '3'), u LIMIT 100)
    SELECT u AS user_ordinal_id, CAST(d AS VARCHAR) AS session_date, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS session_start, content_id
    FROM plays JOIN starts USING (u, d) WHERE u IN (SELECT u FROM chosen)""")
def users_sampled_plays(spark, sf):
    out = plans.users_plays(t.play_sequence(spark, sf), "2024-1-05", "2024-1-20", users=100)
    return out.select("user_ordinal_id", F.col("session_date").cast("string").alias("session_date"), stamp("session_timestamp").alias("session_start"), "content_id")


@query("words_distinct", with_tables("training", """
    SELECT DISTINCT word FROM (SELECT unnest(keywords) AS word FROM training UNION SELECT unnest(tags) FROM training)
    WHERE word NOT IN ('eng', 'spa', 'Episode', 'Movie', 'older teens (ages 15+)', 'tweens (ages 10-12)', 'teens (ages 13-14)',
                       'big kids (ages 8-9)', 'little kids (ages 5-7)', 'preschoolers (ages 2-4)', 'not for kids')"""))
def words_distinct(spark, sf):
    return plans.words_distinct(t.training_table(spark, sf))


@query("cluster_map", with_tables("training mapping", """,
    rows AS (SELECT program_title, program_type, program_language, program_longsynopsis, centroid_word
             FROM (SELECT *, unnest(list_distinct(list_concat(tags, keywords))) AS label FROM training) JOIN mapping ON label = word)
    SELECT program_title, program_type, program_language, program_longsynopsis, array_to_string(list_sort(list(DISTINCT centroid_word)), '|') AS tags
    FROM rows GROUP BY ALL"""))
def cluster_map(spark, sf):
    out = plans.cluster_map(t.training_table(spark, sf), t.mapping(spark, sf), arrays=("tags", "keywords"), guard=True)
    return out.withColumn("tags", shown("tags"))


@query("cluster_stats", with_tables("training mapping", """,
    shown AS (SELECT lower(program_title) AS k, min(program_title) AS program_title, min(program_type) AS program_type,
                     min(program_longsynopsis) AS program_longsynopsis FROM training WHERE len(tags) + len(keywords) > 0 GROUP BY ALL),
    labels_of AS (SELECT DISTINCT lower(program_title) AS k, unnest(list_concat(tags, keywords)) AS label FROM training),
    hits AS (SELECT k, centroid_word, cluster FROM labels_of JOIN mapping ON label = word),
    counted AS (SELECT k, centroid_word, count(*) AS n FROM hits GROUP BY ALL)
    SELECT program_title, program_type, program_longsynopsis,
           (SELECT string_agg(DISTINCT cluster, '|' ORDER BY cluster) FROM hits h WHERE h.k = s.k) AS cluster,
           (SELECT string_agg(centroid_word || ':' || n, '|' ORDER BY centroid_word) FROM counted c WHERE c.k = s.k) AS stats
    FROM shown s WHERE k IN (SELECT k FROM hits)"""))
def cluster_stats(spark, sf):
    out = plans.cluster_stats(t.training_table(spark, sf), t.mapping(spark, sf))
    pairs = F.transform("stats", lambda s: F.concat(s["tags"], F.lit(":"), s["count"].cast("string")))
    return out.withColumn("cluster", shown("cluster")).withColumn("stats", F.array_join(pairs, "|"))


@query("titles_union", with_tables("training", """,
    k AS (SELECT lower(program_title) AS key, * FROM training WHERE len(tags) > 0),
    named AS (SELECT key, min(program_title) AS program_title, min(program_longsynopsis) AS program_longsynopsis FROM k GROUP BY key),
    tagged AS (SELECT key, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM (SELECT key, unnest(tags) AS tag FROM k) GROUP BY key)
    SELECT program_title, program_longsynopsis, tags FROM named JOIN tagged USING (key)"""))
def titles_union(spark, sf):
    return plans.titles_union(t.training_table(spark, sf)).withColumn("tags", shown("tags"))


@query("title_pieces", with_tables("catalogue", f"""
    SELECT title AS "TitleDetails_title", min(synopsis) AS synopsis,
           coalesce(array_to_string(list_sort({TRIMMED.format("flatten(list(string_split(subgenres, ',')))", "NULL").replace("x NOT IN (NULL)", "x IS NOT NULL")}), '|'), '') AS subgenres,
           coalesce(array_to_string(list_sort({TRIMMED.format("flatten(list(string_split(tags, ',')))", "NULL").replace("x NOT IN (NULL)", "x IS NOT NULL")}), '|'), '') AS title_tags
    FROM catalogue GROUP BY title"""))
def title_pieces(spark, sf):
    out = plans.title_pieces(t.catalogue_view(spark, sf))
    return out.withColumns({c: F.coalesce(shown(c), F.lit("")) for c in ("subgenres", "title_tags")})


@query("title_keyword_index", with_tables("training catalogue content_id content_vocab", f"""{TITLES},
    numbered AS (SELECT tokens, row_number() OVER (ORDER BY tokens) AS n FROM content_vocab),
    words AS (SELECT DISTINCT lower(program_title) AS title, unnest(keywords) AS word FROM training
              UNION
              SELECT lower(title), regexp_replace(w, '^\\s+|\\s+$', '', 'g') FROM (
                  SELECT title, unnest(string_split(coalesce(nullif(concat_ws(',', string_agg(DISTINCT tags, ','), string_agg(DISTINCT subgenres, ',')), ''), 'movie'), ',')) AS w
                  FROM catalogue WHERE synopsis IS NOT NULL AND title IN (SELECT title FROM titles) GROUP BY title, type) WHERE w <> '')
    SELECT title AS program_title, string_agg(word, '|' ORDER BY word) AS keywords, string_agg(n, '|' ORDER BY n) AS index
    FROM words JOIN numbered ON word = tokens GROUP BY title"""))
def title_keyword_index(spark, sf):
    out = plans.title_keyword_index(t.training_table(spark, sf), t.catalogue_view(spark, sf), t.content_id(spark, sf), t.content_vocab(spark, sf))
    return out.withColumn("keywords", shown("keywords")).withColumn("index", shown("index"))


@query("tagged_title_keywords", with_tables("catalogue content_id", CMV + """,
    ids AS (SELECT DISTINCT lower(program_title) AS name, cid FROM content_id)
    SELECT title AS program_title, type AS program_type, synopsis AS program_longsynopsis, language AS program_language,
           array_to_string(tags, ' ') AS keywords, cid AS content_ordinal_id FROM cmv JOIN ids ON lower(title) = name"""))
def tagged_title_keywords(spark, sf):
    tagged = plans.catalogue_tags(t.catalogue_view(spark, sf)).withColumnsRenamed(
        {"title": "program_title", "type": "program_type", "synopsis": "program_longsynopsis", "language": "program_language"})
    return plans.tagged_title_keywords(tagged, t.content_id(spark, sf))


@query("num_labels", with_tables("training", "SELECT count(DISTINCT tag) AS labels_count FROM (SELECT unnest(keywords) AS tag FROM training)"))
def num_labels(spark, sf):
    return relational.num_labels(t.training_table(spark, sf), "keywords")


@query("top_values", """
    SELECT word, count(*) AS counter FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word ORDER BY counter DESC, word LIMIT 100""")
def top_values(spark, sf):
    words = t.load(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return relational.top_values(words, "word", 100)


@query("keyword_histogram", with_tables("training", """
    SELECT program_language, string_agg(k || ':' || n, '|' ORDER BY k) AS stats
    FROM (SELECT program_language, k, count(*) AS n FROM (SELECT program_language, unnest(keywords) AS k FROM training) GROUP BY ALL) GROUP BY program_language"""))
def keyword_histogram(spark, sf):
    out = relational.array_histogram(t.training_table(spark, sf), ["program_language"], "keywords")
    pairs = F.transform("stats", lambda s: F.concat(s["value"], F.lit(":"), s["count"].cast("string")))
    return out.select("program_language", F.array_join(pairs, "|").alias("stats"))


@query("brand_texts", """
    SELECT p_brand, string_agg(p_name, ',' ORDER BY p_name) AS names FROM part GROUP BY p_brand""")
def brand_texts(spark, sf):
    return relational.string_agg(t.load(spark, sf, "part"), ["p_brand"], "p_name", ",", out="names")


@query("brand_text_chunks", """
    SELECT p_brand, chunk, substr(names, chunk * 100 + 1, 100) AS names FROM (SELECT *, unnest(range(CAST(ceil(length(names) / 100) AS BIGINT))) AS chunk
    FROM (SELECT p_brand, string_agg(p_name, ', ' ORDER BY p_name) AS names FROM part GROUP BY p_brand))""")
def brand_text_chunks(spark, sf):
    return relational.text_chunks(t.load(spark, sf, "part"), ["p_brand"], "p_name", ", ", out="names", size=100)


@query("plays_history_head_tail", with_tables("plays", """,
    ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, content_id) AS rn FROM plays)
    SELECT user_id, content_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS played, CASE WHEN rn <= 10 THEN 'head' ELSE 'tail' END AS part FROM ranked"""))
def plays_history_head_tail(spark, sf):
    plays = t.events(spark, sf)
    order = [F.col("ts"), F.col("content_id")]
    head = ordering.head_per_group(plays, "user_id", order, 10).withColumn("part", F.lit("head"))
    tail = ordering.tail_per_group(plays, "user_id", order, 10).withColumn("part", F.lit("tail"))
    return head.union(tail).select("user_id", "content_id", stamp("ts").alias("played"), "part")


@query("first_play_per_content", with_tables("plays", """
    SELECT user_id, content_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS played FROM plays GROUP BY user_id, content_id"""))
def first_play_per_content(spark, sf):
    out = ordering.first_per_key(t.events(spark, sf), ["user_id", "content_id"], [F.col("ts")])
    return out.select("user_id", "content_id", stamp("ts").alias("played"))


@query("vocab_tokens", with_tables("training token_vocab", """
    SELECT doc_id, string_agg(w, '|' ORDER BY w) AS words FROM (SELECT DISTINCT doc_id, unnest(string_split(program_longsynopsis, ' ')) AS w FROM training)
    WHERE w IN (SELECT tokens FROM token_vocab) GROUP BY doc_id"""))
def vocab_tokens(spark, sf):
    rows = t.training_table(spark, sf).select("doc_id", F.split("program_longsynopsis", " ").alias("words"))
    return labels.filter_to_vocab(rows, "doc_id", "words", t.token_vocab(spark, sf), "tokens").withColumn("words", shown("words"))

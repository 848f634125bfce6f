"""Text, vocabulary, label and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import text, vectors
from tagloom.operators import labels, validation
from workload import standins as t
from workload.catalogue_queries import shown
from workload.registry import query
from workload.standins import with_tables

CLEAN_A = r"""regexp_replace(regexp_replace(trim(regexp_replace(lower(text), '[^äÄöÖüÜßa-zA-Z]', ' ', 'g')),
    '((^|\s)[äÄöÖüÜßa-zA-Z]{1})+\s', ' ', 'g'), ' +', ' ', 'g')"""
CLEAN_B = r"""regexp_replace(trim(regexp_replace(regexp_replace(lower(text), '[^äÄöÖüÜßa-zA-Z]', ' ', 'g'),
    '((^|\s)[äÄöÖüÜßa-zA-Z]{1})+\s', ' ', 'g')), ' +', ' ', 'g')"""


@query("clean_text_a", f"SELECT doc_id, {CLEAN_A} AS cleaned FROM documents")
def clean_text_a(spark, sf):
    return t.documents(spark, sf).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("clean_text_b", f"SELECT doc_id, {CLEAN_B} AS cleaned FROM documents")
def clean_text_b(spark, sf):
    return t.documents(spark, sf).select("doc_id", text.clean_text(F.col("text"), strip_first=False).alias("cleaned"))


@query("tokenize_pad", f"""
    SELECT doc_id, array_to_string(list_slice(list_concat(w, list_transform(range(277), lambda i: '')), 1, 277), '|') AS tokens
    FROM (SELECT doc_id, list_filter(string_split({CLEAN_B}, ' '), lambda x: x <> '') AS w FROM documents)""")
def tokenize_pad(spark, sf):
    tokens = text.tokenize_pad(text.clean_text(F.col("text"), strip_first=False))
    return t.documents(spark, sf).select("doc_id", tokens.alias("tokens")).withColumn("tokens", shown("tokens"))


def _tokens(spark, sf):
    cleaned = text.clean_text(F.col("text"), strip_first=False)
    return t.documents(spark, sf).select("doc_id", text.words(cleaned).alias("tokens"))


DOC_TOKENS = f"tokens AS (SELECT doc_id, list_filter(string_split({CLEAN_B}, ' '), lambda x: x <> '') AS w FROM documents)"
DOC_VOCAB = """vocab AS (SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token DESC) - 1 AS idx
    FROM (SELECT token, count(*) AS freq FROM (SELECT unnest(w) AS token FROM tokens) GROUP BY token))"""


@query("vocab_build", f"WITH {DOC_TOKENS}, {DOC_VOCAB} SELECT token, freq, idx FROM vocab")
def vocab_build(spark, sf):
    return labels.build_vocab(_tokens(spark, sf), "tokens")


@query("vocab_apply", f"""WITH {DOC_TOKENS}, known AS (SELECT token, row_number() OVER (ORDER BY count(*) DESC, token DESC) - 1 AS idx
        FROM (SELECT unnest(string_split(lower(text), ' ')) AS token FROM benchmark) WHERE token <> '' AND NOT regexp_matches(token, '[\r\n]') GROUP BY token),
    placed AS (SELECT doc_id, unnest(w) AS token, unnest(range(len(w))) AS pos FROM tokens),
    found AS (SELECT doc_id, string_agg(coalesce(idx, (SELECT count(*) FROM known)), ' ' ORDER BY pos) AS indices
              FROM placed LEFT JOIN known USING (token) GROUP BY doc_id)
    SELECT doc_id, coalesce(indices, '') AS indices FROM tokens LEFT JOIN found USING (doc_id)""")
def vocab_apply(spark, sf):
    rows = _tokens(spark, sf)
    known = labels.build_vocab(t.load(spark, sf, "benchmark").select(F.split(F.lower("text"), " ").alias("tokens")), "tokens")
    out = labels.apply_vocab(rows, "doc_id", "tokens", known, out="indices")
    return out.select("doc_id", F.array_join(F.col("indices").cast("array<string>"), " ").alias("indices"))


TAG_VOCAB = """tag_vocab AS (SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token DESC) - 1 AS idx
    FROM (SELECT token, count(*) AS freq FROM (SELECT unnest(tags) AS token FROM training) GROUP BY token))"""


@query("multi_hot", with_tables("training", f""", {TAG_VOCAB}
    SELECT doc_id, idx AS label, CAST(list_contains(tags, token) AS INT) AS value FROM training, tag_vocab"""))
def multi_hot(spark, sf):
    rows = t.training_table(spark, sf)
    fitted = labels.fit_preprocess(rows, "tags", keep=("program_longsynopsis", "keywords"))
    out = fitted.transform(rows, "doc_id")
    return out.select("doc_id", F.posexplode("tags_xf").alias("label", "value")).select(
        "doc_id", F.col("label").cast("bigint").alias("label"), F.col("value").cast("int").alias("value"))


@query("decode_labels", with_tables("training", f""", {TAG_VOCAB}
    SELECT doc_id, string_agg(token, '|' ORDER BY idx) AS tags FROM (SELECT doc_id, unnest(tags) AS token FROM training) JOIN tag_vocab USING (token) GROUP BY doc_id"""))
def decode_labels(spark, sf):
    rows = t.training_table(spark, sf)
    fitted = labels.fit_preprocess(rows, "tags", keep=())
    return labels.decode_labels(fitted.transform(rows, "doc_id"), "doc_id", "tags_xf", fitted.vocab).withColumn("tags", shown("tags"))


@query("label_roundtrip", with_tables("training", f""", {TAG_VOCAB},
    members AS (SELECT doc_id, unnest(tags) AS token FROM training), decoded AS (SELECT doc_id, token FROM members JOIN tag_vocab USING (token))
    SELECT count(*) AS differences FROM (SELECT * FROM members EXCEPT SELECT * FROM decoded)"""))
def label_roundtrip(spark, sf):
    rows = t.training_table(spark, sf)
    fitted = labels.fit_preprocess(rows, "tags", keep=())
    decoded = labels.decode_labels(fitted.transform(rows, "doc_id"), "doc_id", "tags_xf", fitted.vocab)
    return validation.check_roundtrip(rows, decoded, "doc_id")


@query("unseen_labels", with_tables("training", """, known AS (SELECT lang AS token, row_number() OVER (ORDER BY freq DESC, lang DESC) - 1 AS idx
        FROM (SELECT lang, count(*) AS freq FROM documents WHERE lang <> 'fr' GROUP BY lang)),
    slots AS (SELECT idx FROM known UNION ALL SELECT count(*) FROM known)
    SELECT doc_id, slots.idx AS label, CAST(slots.idx = coalesce(known.idx, (SELECT count(*) FROM known)) AS INT) AS value
    FROM training LEFT JOIN known ON program_language = token, slots"""))
def unseen_labels(spark, sf):
    rows = t.training_table(spark, sf).select("doc_id", F.array("program_language").alias("tags"))
    fitted = labels.fit_preprocess(rows.where(F.col("tags")[0] != "fr"), "tags", keep=(), oov_slot=True)
    out = fitted.transform(rows, "doc_id").select("doc_id", F.posexplode("tags_xf").alias("label", "value"))
    return out.select("doc_id", F.col("label").cast("bigint").alias("label"), F.col("value").cast("int").alias("value"))


@query("pad_indices", with_tables("training", """
    SELECT doc_id, array_to_string(list_slice(list_concat(list_transform(string_split(program_longsynopsis, ' '), lambda w: len(w)), list_transform(range(64), lambda i: -1)), 1, 64), ' ') AS padded
    FROM training"""))
def pad_indices(spark, sf):
    sizes = F.transform(F.split("program_longsynopsis", " "), F.char_length)
    return t.training_table(spark, sf).select("doc_id", F.array_join(text.pad_indices(sizes, 64).cast("array<string>"), " ").alias("padded"))


@query("label_columns", with_tables("training", """
    SELECT doc_id, label, 1 AS value FROM (SELECT doc_id, unnest(['quality', 'toxic']) AS label, unnest([quality, toxic]) AS value FROM labels) WHERE value > 0"""))
def label_columns(spark, sf):
    return labels.unpivot_labels(t.load(spark, sf, "labels"), ["doc_id"], ["quality", "toxic"])


@query("label_columns_back", "SELECT doc_id, quality AS quality_pred, toxic AS toxic_pred FROM labels")
def label_columns_back(spark, sf):
    rows = t.load(spark, sf, "labels")
    long = labels.unpivot_labels(rows, ["doc_id"], ["quality", "toxic"])
    return labels.pivot_predictions(long, ["doc_id"], "label", "value", ["quality", "toxic"], rows)


PRETRAINED = """pretrained AS (SELECT word AS token, [length(word) * 1.0, strpos(word, 'a') * 1.0] AS vec
    FROM (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM benchmark) WHERE word <> '')"""


def _pretrained(spark, sf):
    found = t.load(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("token")).where("token <> ''").distinct()
    return found.withColumn("vec", F.array(F.char_length("token").cast("double"), F.locate("a", F.col("token")).cast("double")))


@query("vocab_coverage", f"""WITH {DOC_TOKENS}, {DOC_VOCAB}, {PRETRAINED},
    marked AS (SELECT token, token IN (SELECT token FROM pretrained) AS hit FROM vocab)
    SELECT count(*) AS vocab_size, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS missing,
           CAST(floor(count(*) FILTER (hit) * 100 / (count(*) + 1)) AS BIGINT) AS percent FROM marked""")
def vocab_coverage(spark, sf):
    return labels.vocab_coverage(labels.build_vocab(_tokens(spark, sf), "tokens"), _pretrained(spark, sf))


@query("missing_words", f"WITH {DOC_TOKENS}, {DOC_VOCAB}, {PRETRAINED} SELECT token, freq, idx FROM vocab WHERE token NOT IN (SELECT token FROM pretrained)")
def missing_words(spark, sf):
    return labels.missing_words(labels.build_vocab(_tokens(spark, sf), "tokens"), _pretrained(spark, sf))


@query("embedding_for_vocab", f"""WITH {DOC_TOKENS}, {DOC_VOCAB}, {PRETRAINED}
    SELECT token, idx, coalesce(vec[1], 0.0) AS v0, coalesce(vec[2], 0.0) AS v1 FROM vocab LEFT JOIN pretrained USING (token)""")
def embedding_for_vocab(spark, sf):
    out = labels.embedding_for_vocab(labels.build_vocab(_tokens(spark, sf), "tokens"), _pretrained(spark, sf), 2)
    return out.select("token", "idx", F.col("vec")[0].alias("v0"), F.col("vec")[1].alias("v1"))


SLOT = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % {}"


@query("split_by_group", f"SELECT doc_id, CASE WHEN {SLOT.format('source || ' + repr('42'), 10000)} < 1000 THEN 'test' ELSE 'train' END AS split FROM documents")
def split_by_group(spark, sf):
    return labels.split_by_group(t.load(spark, sf, "documents"), "source").select("doc_id", "split")


@query("split_rows", f"SELECT doc_id, CASE WHEN {SLOT.format('doc_id || ' + repr('42'), 10000)} < 2000 THEN 'test' ELSE 'train' END AS split FROM documents")
def split_rows(spark, sf):
    return labels.split_rows(t.load(spark, sf, "documents"), ["doc_id"]).select("doc_id", "split")


@query("split_buckets", f"""SELECT doc_id, CASE WHEN s < 8 THEN 'train' ELSE 'eval' END AS split, 'train' AS single
    FROM (SELECT doc_id, {SLOT.format('CAST(doc_id AS VARCHAR)', 10)} AS s FROM documents)""")
def split_buckets(spark, sf):
    docs = t.load(spark, sf, "documents").select("doc_id")
    both = labels.split_by_buckets(docs, ["doc_id"], {"train": 8, "eval": 2})
    return labels.split_by_buckets(both, ["doc_id"], {"train": 10}, out="single")


@query("top_tags", with_tables("long_scores", """
    SELECT id, CAST(rank AS INT) AS rank, 'tag ' || tag AS tag, round(p, 2) AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p DESC, tag) AS rank FROM long_scores) WHERE rank <= 5"""))
def top_tags(spark, sf):
    from tagloom.operators.models import top_tags as best

    scores = t.tag_scores(spark, sf)
    vocab = scores.select(F.posexplode("scores").alias("idx", "_p")).select("idx", F.concat(F.lit("tag "), F.col("idx").cast("string")).alias("token")).distinct()
    return best(t.tag_scores(spark, sf), "id", "scores", vocab)


@query("list_literals", """SELECT doc_id, array_to_string([source, lang], '|') AS items FROM documents""")
def list_literals(spark, sf):
    literal = F.concat(F.lit("['"), F.col("source"), F.lit("', '"), F.col("lang"), F.lit("']"))
    return t.load(spark, sf, "documents").select("doc_id", text.parse_list(literal).alias("items")).withColumn("items", shown("items"))


@query("joined_texts", "SELECT doc_id, text || ' ' || coalesce(CAST(quality AS VARCHAR), '') || ' ' || source AS features FROM documents LEFT JOIN labels USING (doc_id) WHERE length(text || ' ' || coalesce(CAST(quality AS VARCHAR), '') || ' ' || source) > 30")
def joined_texts(spark, sf):
    rows = t.load(spark, sf, "documents").join(t.load(spark, sf, "labels"), "doc_id", "left")
    joined = rows.select("doc_id", text.join_texts(F.col("text"), F.col("quality").cast("string"), F.col("source")).alias("features"))
    return joined.where(F.char_length("features") > 30)


@query("normalized_vectors", """
    SELECT vec_id, i - 1 AS pos, round(v[i] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS value
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), range(1, 65) r(i)""")
def normalized_vectors(spark, sf):
    unit = vectors.l2_normalize(F.col("embedding"))
    rows = t.load(spark, sf, "embeddings").select("vec_id", F.posexplode(unit).alias("pos", "value"))
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("value", 6).alias("value"))

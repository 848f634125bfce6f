"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from functools import wraps

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from llm import jaccard_join, limb_codes, mixing, packing, pii, quality, secret_scan, simplex_kmeans, suffix_dedup, syncmers, token_counts, url_filter, winnowing
from llm.common import ship, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark, sf):
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


@query("op7_token_counts")
def op7_token_counts(spark, sf):
    counted = token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query("op4_quality_rules", quality.SQL)
def op4_quality_rules(spark, sf):
    return quality.judge(table(spark, sf, "documents"))


@query("op10_pii")
def op10_pii(spark, sf):
    return pii.find_pii(table(spark, sf, "documents"))


@query("op5_secret_scan")
def op5_secret_scan(spark, sf):
    return secret_scan.scan(table(spark, sf, "documents"))


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query("op9_url_filter")
def op9_url_filter(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES)


WEIGHTS = (5, 2, 1)


@query("op2_source_mix")
def op2_source_mix(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), WEIGHTS)


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
          ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) USING (doc_id)"""


@query("op8_ngram_jaccard_join", JACCARD_SQL)
def op8_ngram_jaccard_join(spark, sf):
    return jaccard_join.join(table(spark, sf, "documents"), 4, 85, 100)


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark, sf):
    return suffix_dedup.remove_repeats(table(spark, sf, "documents")).drop("spans")


@query("op6_syncmer_fingerprints")
def op6_syncmer_fingerprints(spark, sf):
    return syncmers.with_next(table(spark, sf, "documents"))


@query("op11_benchmark_winnowing", winnowing.SQL)
def op11_benchmark_winnowing(spark, sf):
    return winnowing.find_benchmark(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op12_simplex_kmeans")
def op12_simplex_kmeans(spark, sf):
    return simplex_kmeans.cluster(table(spark, sf, "embeddings"))


@query("op13_limb_codes")
def op13_limb_codes(spark, sf):
    return limb_codes.compress(table(spark, sf, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)

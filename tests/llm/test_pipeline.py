import random

import corpus_pipeline
from corpora import documents
from test_jaccard_join import brute
from test_quality import good

from llm import quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(9)
    rows = []
    for i in range(60):
        text = good(rng)
        rows.append((len(rows), text, f"s{i % 4}"))
        if i % 5 == 0:
            rows.append((len(rows), text + ". End", f"s{i % 3}"))
        if i % 7 == 0:
            rows.append((len(rows), text.replace(".", ". password=0f1e2d3c4b5a69788", 1), f"s{i % 3}"))
    return rows + [(len(rows), "SHOUT " * 60, "s0"), (len(rows) + 1, None, None), (len(rows) + 2, "", "s1")]


def test_stages(spark, tmp_path):
    rows = corpus()
    documents(spark, rows, inside=True).write.parquet(f"{tmp_path}/documents.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    assert columns[:5] == COLUMNS and len(columns) > 30
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    kept = [r[0] for r in rows if r[1] and not quality.base_failed(t := quality.measure(r[1])) and not any(test(t) for _, test in quality.RULES)]
    assert sorted(r.doc_id for r in seen["quality_rules"]) == kept
    root = brute([(i, rows[i][1]) for i in kept], 5, 80, 100)
    assert sorted(r.doc_id for r in seen["near_duplicates"]) == sorted(i for i, (_, c) in root.items() if i == c)
    assert len(seen["secret_scans"]) == len(seen["near_duplicates"])
    assert all("0f1e2d3c4b5a69788" not in r.text and r.n_chars == len(r.text) for r in seen["secret_scans"])
    words = sum(len(r.text.split()) for r in seen["secret_scans"])
    assert abs(sum(len(r.text.split()) for r in seen["source_mix"]) - 1.5 * words) < 0.1 * words
    packed = seen["best_fit_packing"]
    assert {r.doc_id for r in packed} == {r.doc_id for r in seen["source_mix"]}
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


def test_empty_table(spark, tmp_path):
    documents(spark, [], extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

import random
from collections import Counter

from corpora import ODD, documents, words

from llm import quality


def plain(text):
    w = text.encode().split()
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + s for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for s in range(3)}
    lines = [x for x in text.split("\n") if x.encode().strip()]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_base_counts():
    rng = random.Random(1)
    texts = [rng.choice([" ", "\n", "\t", "\x0b", " "]).join(words(rng, rng.randint(0, 40), 5)) + rng.choice(["", " |#", "\n\n"]) for _ in range(300)]
    for text in [*texts, *[t or "" for t in ODD]]:
        t = quality.measure(text)
        assert (len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words) == plain(text)


def good(rng, n=120):
    return ". ".join(" ".join(f"{a}{b}" for a, b in zip(words(rng, 12, 900), "abcdefghijkl")) for _ in range(n // 12))


BAD = ["SHOUT " * 60, "a | b " * 40, "one line\n" * 60, "hey!! " * 60, "1234 " * 60, "short text"]


def test_order_changes_no_verdict(spark):
    rng = random.Random(2)
    texts = [good(rng) for _ in range(20)] + BAD
    docs = documents(spark, list(enumerate([*texts, *ODD])) + [(None, texts[0]), (0, texts[0])])
    names = [name for name, _ in quality.RULES]
    first = sorted(map(tuple, quality.judge(docs, names).collect()), key=repr)
    assert first == sorted(map(tuple, quality.judge(docs, names[::-1]).collect()), key=repr)
    verdict = {r[0]: r[-1] for r in first if r[0] is not None}
    assert all(verdict[i] for i in range(20)) and not any(verdict[i] for i in range(20, len(verdict)))


def test_cascade_order_by_gain(spark):
    estimates = spark.createDataFrame([("symbols", 1.0, 5, 9), ("one_word", 0.1, 5, 9), ("dots", 0.1, 0, 9)], "rule string, seconds double, rejected long, asked long")
    order = quality.cascade_order(estimates)
    assert order[:3] == ["one_word", "symbols", "dots"] or order.index("one_word") < order.index("symbols")
    assert sorted(order) == sorted(name for name, _ in quality.RULES)


def test_keep_good_keeps_columns(spark):
    rng = random.Random(3)
    docs = documents(spark, [(1, good(rng)), (2, BAD[0]), (3, None), (1, good(rng))])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1, 1]
    assert quality.judge(documents(spark, [])).collect() == [] == quality.keep_good(documents(spark, [])).collect()

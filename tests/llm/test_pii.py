import random
import re

import pytest
from corpora import ODD, documents

from llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def accepted(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and pii.luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def test_base_spans_as_the_patterns():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice("ab1234 .@+-()5%9") for _ in range(80))
        want = {k: [m.span() for m in re.finditer(p, text) if accepted(k, m.group())] for k, p in PATTERNS.items()}
        assert {k: find(text) for k, find in pii.DETECTORS.items()} == want


DISGUISED = {
    "email": [
        "john.doe [at] mail.example [dot] com", "john at mail dot example dot com", "john (at) example.com", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ",
        "јohn@example.com", "jo​hn@exam​ple.com", "john [AT] example {DOT} org", "user @ host dot com", "joe&#64;example.org",
    ],
    "ip": ["one nine two dot one six eight dot zero dot one", "192[.]168[.]0[.]1", "１９２.168.0.1"],
    "card": ["four one one one one one one one one one one one one one one one", "４１１１ １１１１ １１１１ １１１１", "4111-1111-1111-one one one one"],
    "phone": ["plus one five five five two three four five six seven eight", "+1 (４５６) 555-2186", "+1 five five five 123 4567"],
}


@pytest.mark.parametrize("kind,secret", [(k, s) for k, found in DISGUISED.items() for s in found])
def test_disguises_map_to_source_offsets(kind, secret):
    text = f"Vor, écrit: {secret}; gone"
    base, every = pii.spans_of(text)
    start = text.index(secret)
    assert (start, start + len(secret)) in every[kind] and set(base[kind]) <= set(every[kind])


ALONE = {
    "email": ["john [at] example.com", "john (a) example.com", "john@example . com", "john@example dot com", "john@example[.]com", "joe&#64;example.org", "joe%40example.org", "joe@example&#46;org"],
    "ip": ["192 . 168 . 0 . 1", "192 point 168.0.1", "one nine two.168.0.1"],
    "card": ["4111-1111-1111-one one one one"],
    "phone": ["plus 44 20 7946 0958", "Más 44 (20) 7946-0958", "+1 five five five 123 4567"],
}


@pytest.mark.parametrize("kind,secret", [(k, s) for k, found in ALONE.items() for s in found])
def test_each_disguise_alone_in_plain_text(kind, secret):
    text = f"call {secret}; gone"
    base, every = pii.spans_of(text)
    start = text.index(secret)
    assert (start, start + len(secret)) in every[kind] and (start, start + len(secret)) not in base[kind]


def test_the_gate_passes_all_that_the_transducer_finds():
    rng = random.Random(8)
    parts = [*pii.DIGIT_WORDS, *pii.AT_WORDS, *pii.DOT_WORDS, *pii.PLUS_WORDS, *"@.+([{<>})]19 \t", "joe", "host", "com", "44 20 7946 0958", "&#64;", "&#46;", "%40", "sİx"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(12))
        base = {kind: find(text) for kind, find in pii.DETECTORS.items()}
        assert pii.disguised(text) or not any(pii.hidden(text, base).values()), text


CLEAN = [
    "look at example.com today", "meet me @ example.com", "+1 (848) 555-1373 un deux", "the point at issue dot", "un deux trois quatre",
    "à la carte, naïve façade — Straße", "call one two three", "version 1.2.3 at level two dot five", "Привет мир at home",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_gets_nothing(text):
    base, every = pii.spans_of(text)
    assert base == every


def test_rows(spark):
    rows = [*enumerate(ODD), (1, "a@b.de"), (None, "a@b.de 4111111111111111"), (None, "a@b.de 4111111111111111")]
    got = pii.find_pii(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    named = [r for r in got if r.doc_id is None]
    assert [(r.n_email, r.n_card, r.spans) for r in named] == [(1, 1, "email:0:6,card:7:23")] * 2
    assert pii.find_pii(documents(spark, [])).collect() == []


def test_long_texts_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "one " * 50_000, "x at " * 50_000):
        pii.spans_of(text)


def test_long_runs_of_blanks_stay_linear():
    for text in (" " * 300_000, "a" + "\t" * 300_000 + "b", "one" + " " * 300_000 + "one two", "( " * 100_000):
        pii.spans_of(text)

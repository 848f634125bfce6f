import random

import public_tokenizers
import sentencepiece
from corpora import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def whole(text, size=10**9):
    machine = token_counts.load(PATH)
    parts = [token_counts.chunk_map(machine, text[i : i + size], i == 0) for i in range(0, len(text), size)] or [("", None, "")]
    total = parts[0]
    for p in parts[1:]:
        total = token_counts.compose(machine, total, p)
    return token_counts.closed(machine, total)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab the ing\n\t  ▁é́漢🙂<s>\x00　E12.,", max_size=60), st.integers(1, 9))
def test_counts_as_the_library(text, size):
    assert whole(text) == len(LIBRARY.encode(text)) == whole(text, size)


def test_composition_is_associative():
    machine, rng = token_counts.load(PATH), random.Random(3)
    for _ in range(200):
        a, b, c = (token_counts.chunk_map(machine, "".join(rng.choice("ab \n▁é") for _ in range(rng.randint(0, 8))), False) for _ in range(3))
        left = token_counts.compose(machine, token_counts.compose(machine, a, b), c)
        right = token_counts.compose(machine, a, token_counts.compose(machine, b, c))
        assert token_counts.closed(machine, left) == token_counts.closed(machine, right)


def test_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, "again"), (None, "no id"), (None, "no id")]
    got = token_counts.count_tokens(documents(spark, rows), PATH, chunk=1000).collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(documents(spark, []), PATH).collect() == []

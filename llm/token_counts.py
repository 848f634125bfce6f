"""Token counts by a compiled tokenizer (operator 7).

A piece vocabulary with merge scores is compiled into a deterministic transducer. A text prefix has exactly one
tokenisation, so the machine only has to remember which unfinished tokens may still become final: a state is the set of
(last finished token, node of the piece trie, tokens more than the least hypothesis), and a transition on a character is
annotated with the number of tokens that are certain from then on. Two tokens may stand side by side if merging their
joined characters gives these two back. States and transitions are built when first met and kept in the worker.

A text is cut into chunks. A chunk's state map is written as (head, count, tail): the characters before its first
restart point, the tokens between its restart points, the characters after the last. A restart point is a place where
no piece can span, so the machine is in its start state there whatever came before. Two maps compose to
(head1, count1 + tokens(tail1 + head2) + count2, tail2), which is associative; the maps of a long text are scanned in
chunk order.

Nulls count as empty texts, an empty text has no tokens. Repeated rows give repeated rows. A row whose id is null keeps it.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import arrow_map, plain_text

CHUNK = 1 << 18  # code points of a chunk
KNOWN_LIMIT = 1 << 19  # segments and states that a worker remembers; beyond, it starts again
SPACE = "▁"


class Transducer:
    """Counts the tokens of a segment; ``scores`` are the merge scores of the pieces."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.trie: list[dict[str, int]] = [{}]
        self.piece_at: list[str | None] = [None]
        for piece in scores:
            node = 0
            for c in piece:
                if c not in self.trie[node]:
                    self.trie[node][c] = len(self.trie)
                    self.trie.append({})
                    self.piece_at.append(None)
                node = self.trie[node][c]
            self.piece_at[node] = piece
        self._pairs: dict[tuple[str, str], bool] = {}
        self._alone: dict[str, bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((None, 0, 0),)
        self.ids = {start: 0}
        self.states = [start]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.last = [0]
        self.known: dict[str, int] = {}

    def merge(self, text: str) -> list[str]:
        """The plain merge loop, for the compilation of token pairs only."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (self.scores.get(parts[i] + parts[i + 1], float("-inf")), -i))
            if parts[best] + parts[best + 1] not in self.scores:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _may_follow(self, left: str | None, right: str) -> bool:
        if right not in self._alone:
            self._alone[right] = self.merge(right) == [right]
        if left is None or not self._alone[right]:
            return self._alone[right]
        if (left, right) not in self._pairs:
            if len(self._pairs) > KNOWN_LIMIT:
                self._pairs.clear()
            self._pairs[left, right] = self.merge(left + right) == [left, right]
        return self._pairs[left, right]

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        """The transition of a state on a character: (next state, tokens emitted)."""
        if c not in self.trie[0]:  # not a piece: its bytes, and a restart
            move = (0, self.last[state] + len(c.encode("utf-8", "surrogatepass")))
        else:
            follow = []
            for left, node, more in self.states[state]:
                child = self.trie[node].get(c)
                if child is not None:
                    follow.append((left, child, more))
                    piece = self.piece_at[child]
                    if piece is not None and self._may_follow(left, piece):
                        follow.append((piece, 0, more + 1))
            least = min(more for _, _, more in follow)
            key = tuple(sorted(((left, node, more - least) for left, node, more in follow), key=lambda h: (h[0] or "", h[1])))
            if key not in self.ids:
                self.ids[key] = len(self.states)
                self.states.append(key)
                self.moves.append({})
                self.last.append(next(more for _, node, more in key if node == 0))
            move = (self.ids[key], least)
        self.moves[state][c] = move
        return move

    def run(self, segment: str) -> int:
        """Tokens of a segment that starts in the start state."""
        if len(self.states) > KNOWN_LIMIT:
            self._reset()
        state = total = 0
        moves = self.moves
        for c in segment:
            state, out = moves[state].get(c) or self._compile(state, c)
            total += out
        return total + self.last[state]

    def count(self, text: str) -> int:
        """Tokens of a text between two restart points (its spaces written as the space piece)."""
        total = 0
        for segment, n in Counter(SEGMENT.findall(text)).items():
            tokens = self.known.get(segment)
            if tokens is None:
                tokens = self.run(segment)
                if len(segment) <= 64:
                    if len(self.known) > KNOWN_LIMIT:
                        self.known.clear()
                    self.known[segment] = tokens
            total += n * tokens
        return total


#: No piece has a space piece after another character, and none has a line feed: segments never share a token.
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
_FIRST = re.compile(f"(?<=\n)|(?<=[^{SPACE}])(?={SPACE})|(?=\n)")


@lru_cache(maxsize=2)
def load(path: str) -> Transducer:
    """Compile a sentencepiece model of the merge kind with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): model.get_score(i) for i in plain}
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in scores):
        raise ValueError("a piece spans a restart point; this vocabulary needs other segments")
    return Transducer(scores)


def chunk_map(machine: Transducer, chunk: str, first: bool) -> tuple[str, int | None, str]:
    """A chunk's state map; count is None if the chunk has no restart point and is all head."""
    text = chunk.replace(" ", SPACE)
    if first and text:
        text = SPACE + text
    cut = next((m.start() for m in _FIRST.finditer(text) if 0 < m.start() < len(text)), None)
    if cut is None:
        return text, None, ""
    end = len(text)
    while True:  # the last restart point; a segment is short, so this looks at few characters
        end -= 1
        if end == cut or text[end] == "\n" or text[end - 1] == "\n" or (text[end] == SPACE and text[end - 1] != SPACE):
            break
    return text[:cut], machine.count(text[cut:end]), text[end:]


def compose(machine: Transducer, a: tuple, b: tuple) -> tuple:
    """The state map of two neighbouring chunks."""
    if a[1] is None and b[1] is None:
        return a[0] + b[0], None, ""
    if a[1] is None:
        return a[0] + b[0], b[1], b[2]
    if b[1] is None:
        return a[0], a[1], a[2] + b[0]
    return a[0], a[1] + machine.count(a[2] + b[0]) + b[1], b[2]


def closed(machine: Transducer, whole: tuple) -> int:
    """The tokens of a whole text from its state map."""
    head, count, tail = whole
    return machine.count(head) + (count or 0) + machine.count(tail)


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row."""
    text = plain_text(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).withColumn("_row", F.monotonically_increasing_id())
    chunks = rows.select(
        "_id", "_row", F.octet_length("_text").cast("long").alias("_bytes"),
        F.posexplode(F.when(F.length("_text") <= chunk, F.array("_text")).otherwise(
            F.transform(F.sequence(F.lit(0), F.floor((F.length("_text") - 1) / chunk).cast("int")), lambda i: F.substring("_text", i * chunk + 1, F.lit(chunk)))
        )).alias("_at", "_chunk"),
    )

    def maps(ids, row, size, at, texts):
        machine = load(model)
        done = [chunk_map(machine, t, k == 0) for t, k in zip(texts, at)]
        return ids, row, size, at, [m[0] for m in done], [m[1] for m in done], [m[2] for m in done]

    kinds = [("_row", pa.int64()), ("_bytes", pa.int64()), ("_at", pa.int32()), ("_head", pa.string()), ("_count", pa.int64()), ("_tail", pa.string())]
    id_type = docs.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = pa.schema([("_id", to_arrow_type(id_type)), *kinds])
    mapped = arrow_map(chunks, maps, f"_id {id_type.simpleString()}, _row long, _bytes long, _at int, _head string, _count long, _tail string", arrow)
    # a group is one text; it has a small map for each chunk
    grouped = mapped.groupBy("_row", "_id", "_bytes").agg(F.sort_array(F.collect_list(F.struct("_at", "_head", "_count", "_tail"))).alias("_maps"))

    def scan(ids, size, maps_of):
        machine = load(model)
        totals = []
        for parts in maps_of:
            whole = None
            for p in parts:
                part = (p["_head"], p["_count"], p["_tail"])
                whole = part if whole is None else compose(machine, whole, part)
            totals.append(closed(machine, whole))
        return ids, size, totals

    arrow = pa.schema([(id_col, to_arrow_type(id_type)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    return arrow_map(grouped.select("_id", "_bytes", "_maps"), scan, f"`{id_col}` {id_type.simpleString()}, n_bytes long, n_tokens long", arrow)

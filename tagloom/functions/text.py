"""Column functions on text and arrays. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The letters the text cleaner keeps, the pattern for runs of one-letter words,
# the token limits, and the defaults for empty lists.
LETTERS = "äÄöÖüÜßa-zA-Z"
# a run of words is taken whole (++): each ends in white space, so giving one back never helps, and a long run costs no stack
SHORT_WORDS = r"(?:^|\s)(?:[%s]{%s}\s)++"
TOKEN_LIMIT = 256
KEYWORD_LIMIT = 64
TEXT_LENGTH = 277
NO_VALUE = ("", "und")

# The cleaner lower-cases first, so only the lower-case letters can occur; the short class is much faster to match.
_LOWER_LETTERS = "äöüßa-z"


def _literal_pattern(sep: str) -> str:
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}" else ch for ch in sep)


def split_on(col: Column, sep: str) -> Column:
    """Split on a literal separator, keeping empty pieces (F2)."""
    return F.split(col, _literal_pattern(sep), -1)


def first_tokens(col: Column, n: int = TOKEN_LIMIT) -> Column:
    """The first ``n`` space-separated tokens, joined again."""
    return F.array_join(F.slice(split_on(col, " "), 1, n), " ")


def trim_ws(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def strip_to_array(col: Column, drop: Sequence[str] = ("",)) -> Column:
    """Distinct trimmed members in ascending order; NULL when none is left.

    Members equal to a ``drop`` value go before trimming, so ``" "`` stays and becomes ``""``.
    """
    kept = F.filter(col, lambda x: x.isNotNull() & ~x.isin(*drop))
    out = F.sort_array(F.array_distinct(F.transform(kept, trim_ws)))
    return F.when(F.array_size(out) > 0, out)


def strip_to_string(col: Column, drop: Sequence[str] = NO_VALUE, sep: str = " ") -> Column:
    """As :func:`strip_to_array`, joined to one string."""
    return F.array_join(strip_to_array(col, drop), sep)


def offset_window(col: Column, n: int, skip_first: bool = True) -> Column:
    """Members at 0-based offsets 1..n (F12). ``skip_first=False`` takes offsets 0..n-1 instead."""
    return F.slice(col, 2 if skip_first else 1, n)


def default_array(col: Column, values: Sequence[str]) -> Column:
    """``values`` when the array is NULL or empty."""
    fallback = F.array(*[F.lit(v) for v in values])
    return F.when(F.coalesce(F.array_size(col), F.lit(0)) < 1, fallback).otherwise(col)


def parse_list(col: Column) -> Column:
    """``"['a', 'b']"`` to an array; nothing is evaluated (F22). Either quote sign is accepted."""
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    return F.from_json(col, "array<string>", options)


def join_texts(*cols: Column, sep: str = " ") -> Column:
    """Join text columns, a NULL counting as an empty text so its separator stays."""
    return F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in cols])


def drop_short_words(col: Column, longest: int = 1, letters: str = LETTERS) -> Column:
    """Replace runs of words up to ``longest`` letters that are followed by white space."""
    size = "1" if longest == 1 else f"1,{longest}"
    return F.regexp_replace(col, SHORT_WORDS % (letters, size), " ")


def clean_text(col: Column, strip_first: bool = True) -> Column:
    """Lower-case, keep letters, drop one-letter words, collapse blanks.

    ``strip_first`` strips before the one-letter step, so a leading or trailing letter is judged
    without its outer blank; ``False`` strips after it (T1b).
    """
    # each run of other characters becomes one blank, and a dropped run of words leaves one blank, so
    # blanks never come in pairs
    letters = F.regexp_replace(F.lower(col), f"[^{_LOWER_LETTERS}]+", " ")
    if strip_first:
        return drop_short_words(F.trim(letters), letters=_LOWER_LETTERS)
    return F.trim(drop_short_words(letters, letters=_LOWER_LETTERS))


def words(col: Column) -> Column:
    """Non-empty blank-separated pieces."""
    return F.filter(split_on(col, " "), lambda x: x != "")


def pad(col: Column, n: int, filler: Column) -> Column:
    """Cut or fill an array to exactly ``n`` members."""
    return F.slice(F.concat(col, F.array_repeat(filler, n)), 1, n)


def tokenize_pad(col: Column, n: int = TEXT_LENGTH) -> Column:
    """Tokens of cleaned text, filled with ``""`` or cut to ``n``."""
    return pad(words(col), n, F.lit(""))


def pad_indices(col: Column, n: int, filler: int = -1) -> Column:
    """Fixed-length index list."""
    return pad(col.cast("array<int>"), n, F.lit(filler))


def fingerprint(*cols: Column, salt: str = "") -> Column:
    """A reproducible order-free hash text of a key."""
    return F.md5(F.concat(*[c.cast("string") for c in cols], F.lit(salt)))


def hash_slot(*cols: Column, slots: int, salt: str = "") -> Column:
    """Slot 0..slots-1 from the first eight hex digits of :func:`fingerprint`."""
    return F.pmod(F.conv(F.substring(fingerprint(*cols, salt=salt), 1, 8), 16, 10).cast("bigint"), F.lit(slots))


def in_dates(col: Column, start: str, end: str) -> Column:
    """``start <= col < end``; the month and day need no leading zero."""
    day = [F.to_date(F.lit("-".join(p.zfill(2) for p in text.split("-")))) for text in (start, end)]
    return (col >= day[0]) & (col < day[1])

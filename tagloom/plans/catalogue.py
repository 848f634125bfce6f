"""Catalogue queries: from raw programme, tag, title and play tables to training and title rows.

Two habits keep these plans small. Texts are long, so a group that has a text in its key is
identified by a digest of the key and the text itself crosses the shuffle once. And a join that only
attaches ids comes after the aggregate, not before it, so a popular title is one row by then.
Where the order of a joined text or an arbitrary member of a group is open, the ascending order and
the smallest member are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import (
    KEYWORD_LIMIT, NO_VALUE, TOKEN_LIMIT, default_array, first_tokens, in_dates, offset_window, split_on, strip_to_array, trim_ws,
)
from tagloom.operators.clusters import SPECIAL_LABELS
from tagloom.operators.labels import filter_to_vocab
from tagloom.operators.ordering import head_per_group, sample_keys, with_row_id
from tagloom.operators.recommend import type_match
from tagloom.operators.relational import copies_joined, distinct_apart, distinct_array, distinct_text, flag_members, join_ci, keep_top_values, remap_values, text_chunks, union_arrays, when_or_null
from tagloom.operators.tag_index import nearest_by_tags
from tagloom.session import cut_lineage

# Fixed values of the tag build.
LANGUAGES = ["eng", "spa"]
PROGRAM_TYPES = ["Episode", "Movie"]
SERIES_TYPES = ["Episode", "SeriesMaster"]
CATALOGUE_TYPES = ["Programme", "Movie"]
GENERIC_TITLES = ["OnDemand Movie", "Movie"]
ON_DEMAND = "OnDemand Movie"
AGE_TAGS = [
    "not for kids", "preschoolers (ages 2-4)", "little kids (ages 5-7)", "big kids (ages 8-9)", "tweens (ages 10-12)",
    "teens (ages 13-14)", "older teens (ages 15+)",
]
AGE_REMAP = {"little kids (ages 5-7)": "kids (ages 5-9)", "big kids (ages 8-9)": "kids (ages 5-9)"}
GENRE_REMAP = {
    "Docudrama": "Documentary drama",
    "Historical drama": "History drama",
    "Romantic comedy": "Romance comedy",
}
GENRE_TYPES = ["Genre", "KidsTheme"]
ADULT_TAG = "not for kids"
TOP_GENRES = 100
MIN_DISTINCT_PLAYS = 15
SAMPLED_USERS = 50_000

TITLE_KEYS = ["TitleDetails_title", "TitleType"]
SYNOPSIS = "TitleDetails_longsynopsis"
SPREAD = 16  # parts of a title's rows in a join where a few titles may have all


def _digest(*cols: str) -> Column:
    """A 256-bit digest that stands for a tuple of texts; NULL and empty differ."""
    return F.unhex(F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in cols]), 256))


def _title_texts(catalogue: DataFrame, *more: Column) -> DataFrame:
    """One row per (title, type) with its distinct synopses joined, and further aggregates."""
    described = catalogue.where(F.col(SYNOPSIS).isNotNull())
    return described.groupBy(*TITLE_KEYS).agg(distinct_text(SYNOPSIS, " ").alias(SYNOPSIS), *more)


def _with_content_ids(titles: DataFrame, content_ids: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Titles times their content ids. The join follows the aggregate: an id only copies a title's row."""
    name = F.lower("program_title") if ignore_case else F.col("program_title")
    ids = content_ids.where(F.col("content_ordinal_id").isNotNull()).select(name.alias("_name"), "content_ordinal_id").distinct()
    own = F.lower("TitleDetails_title") if ignore_case else F.col("TitleDetails_title")
    return titles.join(ids, own == F.col("_name")).drop("_name")


def training_rows(df: DataFrame, token_limit: int = TOKEN_LIMIT, test_limit: int | None = None) -> DataFrame:
    """(synopsis, keywords, tags) per title, type, language and synopsis (Q-INGEST).

    The synopsis keeps its first tokens; keywords keep duplicates. Equal rows of a group are counted
    first, so copies of a programme add counts, not rows, and keywords travel as whole arrays, not one by one.
    """
    keys = ["program_title", "program_type", "program_language", "program_longsynopsis"]
    rows = df.where(F.array_size("keywords") > 0).select(
        _digest(*keys).alias("_key"), first_tokens(F.col("program_longsynopsis"), token_limit).alias("synopsis"), "keywords", "tags"
    )
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    groups = counted.groupBy("_key").agg(
        F.min("synopsis").alias("synopsis"), F.min("tags").alias("tags"), F.collect_list(F.struct("keywords", "n")).alias("_lists")
    )
    pairs = F.flatten(F.transform("_lists", lambda s: F.transform(F.array_compact(s["keywords"]), lambda v: F.struct(v.alias("v"), s["n"].alias("n")))))
    out = groups.select("synopsis", copies_joined(F.sort_array(pairs), " ").alias("keywords"), "tags")
    # a limit without an order would return other rows from run to run
    return out.orderBy("synopsis", "keywords").limit(test_limit) if test_limit else out


def tag_training_rows(programs: DataFrame, program_tags: DataFrame, top_genres: int = TOP_GENRES, test_limit: int | None = None) -> DataFrame:
    """(program_title, program_id, synopsis, tags) with type, language, age and frequent genre tags (Q-INGEST2).

    A programme without any age or genre tag is left out, as NULL lengths make it vanish.
    """
    chosen = programs.where(
        F.col("program_longsynopsis").isNotNull()
        & F.col("program_seriesid").isNull()
        & F.col("program_language").isin(*LANGUAGES)
        & F.col("program_type").isin(*PROGRAM_TYPES)
        & ~F.col("program_title").isin(*GENERIC_TITLES)
    )
    keyed = chosen.withColumn("_key", _digest("program_title", "program_val", "program_longsynopsis"))
    own = [*[("program_type", v) for v in PROGRAM_TYPES], *[("program_language", v) for v in LANGUAGES]]
    # types and languages come from short fixed lists, so "which occur" is a handful of flags
    flags = [F.max(F.when(F.col(c) == v, F.lit(v))).alias(f"_own{i}") for i, (c, v) in enumerate(own)]
    shown = keyed.groupBy("_key").agg(
        F.min("program_title").alias("program_title"), F.min("program_val").alias("program_id"), F.min("program_longsynopsis").alias("synopsis"), *flags
    )
    genres = (
        program_tags.where(F.col("tag_type") == "Genre")
        .select("program_id", remap_values(F.col("tag_value"), GENRE_REMAP).alias("tag_value"))
        .distinct()
    )
    ages = program_tags.where(F.col("tag_value").isin(*AGE_TAGS)).select("program_id", remap_values(F.col("tag_value"), AGE_REMAP).alias("tag_value"))
    kept = keep_top_values(genres, "tag_value", top_genres).select("program_id", "tag_value").union(ages)
    tags = kept.groupBy("program_id").agg(distinct_array("tag_value").alias("_tags"))
    # ids meet tags without the text; the text side is already arranged by the digest
    ids = keyed.select("_key", F.col("program_val").alias("program_id")).distinct()
    tagged = ids.join(tags, "program_id").select("_key", "_tags")
    mine = F.array_compact(F.array(*[F.col(f"_own{i}") for i in range(len(own))]))
    out = shown.join(tagged, "_key").select(
        "program_title", "program_id", "synopsis", F.sort_array(F.array_distinct(F.concat(mine, F.col("_tags")))).alias("tags")
    )
    return out.limit(test_limit) if test_limit else out


def titles_merged(catalogue: DataFrame, content_ids: DataFrame) -> DataFrame:
    """One row per (title, type, content id) with the distinct synopses joined (Q-TITLES)."""
    return _with_content_ids(_title_texts(catalogue), content_ids)


def titles_lower(catalogue: DataFrame, content_ids: DataFrame) -> DataFrame:
    """:func:`titles_merged` with the lower-cased title as ``title`` (Q-TITLES)."""
    return titles_merged(catalogue, content_ids).withColumn("title", F.lower("TitleDetails_title"))


def _with_vocab_tokens(texts: DataFrame, token_vocab: DataFrame, skip_first: bool) -> DataFrame:
    """Add up to 64 distinct vocabulary tokens from the first 256 synopsis tokens of a title's rows.

    Offsets start at 1, so the first token of each list is skipped; a title whose only entry is the
    default then has no token left and disappears. ``skip_first=False`` keeps both.
    """
    opening = texts.select("TitleDetails_title", offset_window(split_on(F.col(SYNOPSIS), " "), TOKEN_LIMIT, skip_first).alias("tokens"))
    found = filter_to_vocab(opening, "TitleDetails_title", "tokens", token_vocab, "tokens")
    joined = texts.join(found, "TitleDetails_title", "left")
    tokens = offset_window(default_array(F.col("tokens"), ["TV"]), KEYWORD_LIMIT, skip_first)
    return joined.withColumn("tokens", tokens).where(F.array_size("tokens") > 0)


def titles_tokens(catalogue: DataFrame, content_ids: DataFrame, token_vocab: DataFrame, skip_first: bool = True) -> DataFrame:
    """Titles with synopsis tokens that the vocabulary holds (Q-TITLES-TOK).

    Content ids belong to whole titles, so they are joined last.
    """
    return _with_content_ids(_with_vocab_tokens(_title_texts(catalogue), token_vocab, skip_first), content_ids)


def titles_tokens_keywords(catalogue: DataFrame, content_ids: DataFrame, token_vocab: DataFrame, skip_first: bool = True) -> DataFrame:
    """Titles with tokens and a keyword array that starts from ``movie`` (Q-TITLES-TOKKW).

    Titles match exactly here, and a title without tags has NULL keywords.
    """
    texts = _title_texts(catalogue, distinct_text("TitleTags", ",").alias("TitleTags"))
    keywords = strip_to_array(split_on(F.concat(F.lit("movie,"), F.col("TitleTags")), ","))
    worded = _with_vocab_tokens(texts, token_vocab, skip_first).withColumn("keywords", keywords).drop("TitleTags")
    return _with_content_ids(worded, content_ids, ignore_case=False)


def _catalogue_words() -> Column:
    return F.concat_ws(",", "TitleGenre", "TitleSubgenres", "TitleTags", "LANGUAGE")


def titles_keywords(catalogue: DataFrame, content_ids: DataFrame, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Titles with genre, subgenre, tag and language words as one keyword text (Q-TITLES-KW).

    Both texts end after ``limit`` tokens. Every synopsis and every word has at least one token, so the
    first ``limit`` of each, in order, decide the result; a title with very many rows sends no more.
    """
    described = catalogue.where(F.col(SYNOPSIS).isNotNull())
    texts = head_per_group(described.select(*TITLE_KEYS, SYNOPSIS).distinct(), TITLE_KEYS, [F.col(SYNOPSIS)], limit)
    openings = texts.groupBy(*TITLE_KEYS).agg(
        F.sort_array(F.collect_list(F.struct(SYNOPSIS, first_tokens(F.col(SYNOPSIS), limit).alias("v")))).alias("_texts")
    )
    pieces = described.select(*TITLE_KEYS, F.explode(split_on(_catalogue_words(), ",")).alias("w"))
    usable = pieces.where(~F.col("w").isin(*NO_VALUE)).select(*TITLE_KEYS, trim_ws(F.col("w")).alias("w")).distinct()
    words = head_per_group(usable, TITLE_KEYS, [F.col("w")], limit).groupBy(*TITLE_KEYS).agg(
        F.array_join(F.sort_array(F.collect_list("w")), " ").alias("keywords")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in TITLE_KEYS]
    named = words.withColumnsRenamed({k: f"_{k}" for k in TITLE_KEYS})
    short = openings.join(named, same[0] & same[1], "left").select(
        *TITLE_KEYS,
        first_tokens(F.col("keywords"), limit).alias("keywords"),
        first_tokens(F.array_join(F.transform("_texts", lambda p: p["v"]), " "), limit).alias(SYNOPSIS),
    )
    return _with_content_ids(short, content_ids)


def _series_id() -> Column:
    return F.coalesce("InSeasonSeries_Id", "TitleId")


def titles_series_ids(catalogue: DataFrame, content_ids: DataFrame) -> DataFrame:
    """Titles with their distinct series or title ids (Q-TITLES-IDS)."""
    worded = catalogue.withColumn("_sid", _series_id())
    return _with_content_ids(_title_texts(worded, distinct_array("_sid").alias("InSeasonSeries_Id")), content_ids)


def training_series_ids(training: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Training rows with their titles' series ids, ``["movie"]`` when there is none (Q-TITLES-IDS).

    Series ids are kept per (title, type), so a title with two types occurs twice. A title's ids go to ``SPREAD`` parts of its
    training rows, as few titles may have all rows.
    """
    described = catalogue.where(F.col(SYNOPSIS).isNotNull()).withColumn("_sid", _series_id())
    ids = described.groupBy(*TITLE_KEYS).agg(distinct_array("_sid").alias("_ids")).select(F.lower("TitleDetails_title").alias("_name"), "_ids")
    parts = ids.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    rows = training.withColumn("_spread", F.pmod(F.xxhash64("program_type", "program_longsynopsis", "tags"), F.lit(SPREAD)))
    joined = rows.join(parts, (F.lower("program_title") == F.col("_name")) & (F.col("_spread") == F.col("_part")), "left")
    return joined.select(
        "program_title", "program_type", "program_longsynopsis", "tags",
        F.when(F.col("_ids").isNull(), F.array(F.lit("movie"))).otherwise(F.col("_ids")).alias("InSeasonSeries_Id"),
        F.coalesce(F.array_size("_ids"), F.lit(0)).alias("titles_length"),
    )


def title_ids(catalogue: DataFrame, known_ids: DataFrame | None = None) -> DataFrame:
    """Distinct (title, series or title id) pairs, marked by membership in a list when given."""
    pairs = catalogue.where(_series_id().isNotNull() & F.col("TitleDetails_title").isNotNull())
    pairs = pairs.select("TitleDetails_title", _series_id().alias("InSeasonSeries_Id")).distinct()
    return pairs if known_ids is None else flag_members(pairs, "InSeasonSeries_Id", known_ids, known_ids.columns[0])


def flatten_plays(play_sequence: DataFrame) -> DataFrame:
    """One row per played item of a session."""
    return play_sequence.select("user_ordinal_id", "session_date", "session_timestamp", F.explode("session_sequence").alias("_s")).select(
        "user_ordinal_id", "session_date", "session_timestamp", F.col("_s.content_id").alias("content_id")
    )


def users_plays(
    play_sequence: DataFrame, start: str = "2021-2-01", end: str = "2021-4-01", more_than: int = MIN_DISTINCT_PLAYS,
    users: int = SAMPLED_USERS, salt: str = "3", restrict_plays: bool = False,
) -> DataFrame:
    """Plays of sampled users with enough distinct items in the date range (Q-USERS).

    The range decides who qualifies, not which plays come back, unless ``restrict_plays`` is set.
    """
    plays = flatten_plays(play_sequence)
    inside = in_dates(F.col("session_date"), start, end)
    active = (
        plays.where(inside).groupBy("user_ordinal_id").agg(F.count_distinct("content_id").alias("_n")).where(F.col("_n") > more_than)
    )
    chosen = sample_keys(active.select("user_ordinal_id"), "user_ordinal_id", users, salt)
    return (plays.where(inside) if restrict_plays else plays).join(chosen, "user_ordinal_id", "left_semi")


def _chosen_titles(catalogue: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows that Q-CMV-TAGS reads, and the keys that it groups by."""
    kept = F.col("LANGUAGE").isin(*LANGUAGES) & F.col("TitleType").isin(*CATALOGUE_TYPES) & ~F.col("TitleDetails_title").isin(ON_DEMAND)
    rows = catalogue.where(kept).withColumn("_title", F.lower("TitleDetails_title")).withColumn("_words", _catalogue_words())
    return rows, ["_title", "TitleType", "LANGUAGE"]


def catalogue_synopses(catalogue: DataFrame, size: int = 1 << 20) -> DataFrame:
    """(title, type, language, chunk, synopsis): the joined synopses of :func:`catalogue_tags` in pieces of ``size`` characters,
    for titles whose texts do not fit one cell. The title is lower-cased. Runs a job."""
    chosen, keys = _chosen_titles(catalogue)
    chunks = text_chunks(chosen, keys, SYNOPSIS, " ", size=size)
    return chunks.select(F.col("_title").alias("title"), F.col("TitleType").alias("type"), F.col("LANGUAGE").alias("language"), "chunk", F.col(SYNOPSIS).alias("synopsis"))


def catalogue_tags(catalogue: DataFrame, content_ids: DataFrame | None = None) -> DataFrame:
    """(title, type, language, synopsis, tags) per lower-cased title, type and language (Q-CMV-TAGS).

    Synopses keep duplicates. With ``content_ids`` a title occurs once per matching id row.
    """
    chosen, keys = _chosen_titles(catalogue)
    counted = chosen.groupBy(*keys, _digest(SYNOPSIS, "_words").alias("_digest")).agg(
        F.min(SYNOPSIS).alias("v"), F.min("_words").alias("_words"), F.min("TitleDetails_title").alias("title"), F.count(F.lit(1)).alias("n")
    )
    texts = F.sort_array(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("v", "n"))))
    grouped = counted.groupBy(*keys).agg(F.min("title").alias("title"), texts.alias("_texts"), F.collect_set("_words").alias("_words"))
    out = grouped.select(
        "title", F.col("TitleType").alias("type"), F.col("LANGUAGE").alias("language"), copies_joined(F.col("_texts"), " ").alias("synopsis"),
        strip_to_array(F.flatten(F.transform("_words", lambda w: split_on(w, ",")))).alias("tags"),
    )
    if content_ids is None:
        return out
    return join_ci(out, content_ids.select("program_title"), "title", "program_title", "left").drop("program_title")


def full_tags(programs: DataFrame, program_tags: DataFrame, token_vocab: DataFrame, with_genre: bool = False) -> DataFrame:
    """Movies, and series merged by title, with vocabulary tags, type and language as tags (Q-FULL-TAGS).

    Only programmes with at least one tag row count. Columns: program_type, program_title,
    program_longsynopsis, program_language, [genre,] tags.
    """
    is_genre = F.coalesce(F.col("tag_type").isin(*GENRE_TYPES) | (F.col("tag_value") == ADULT_TAG), F.lit(False))
    movie = (F.col("program_type") == "Movie") & (F.col("program_title") != ON_DEMAND) & F.col("program_seriesid").isNull()
    series = F.col("program_type").isin(*SERIES_TYPES)
    usable = programs.where(F.col("program_language").isin(*LANGUAGES) & F.col("program_longsynopsis").isNotNull() & (movie | series))
    # a movie's synopsis is part of its key, so that both kinds join their distinct synopses in one pass
    key = F.when(series, _digest("program_title", "program_language"))
    rows = usable.withColumn("_key", key.otherwise(_digest("program_type", "program_title", "program_longsynopsis", "program_language")))
    # per group: the descriptive columns once, and its tags by id alone
    with_tags = rows.join(distinct_apart(program_tags, "program_id"), F.col("program_val") == F.col("program_id"), "left_semi")
    shown = with_tags.groupBy("_key").agg(
        F.min(F.when(series, "Episode").otherwise(F.col("program_type"))).alias("program_type"), F.min("program_title").alias("program_title"),
        distinct_text("program_longsynopsis", " ").alias("program_longsynopsis"), F.min("program_language").alias("program_language"),
    )
    # the ids are distinct, or copies of one programme would meet all copies of its tags; tags of other programmes go no
    # further, and a group's equal tags are one row before they meet the vocabulary
    members = distinct_apart(rows, "_key", "program_val")
    tag_rows = program_tags.select("program_id", F.col("tag_value").alias("tag"), *([is_genre.alias("is_genre")] if with_genre else []))
    kinds = [F.max("is_genre").alias("is_genre")] if with_genre else [F.count(F.lit(1)).alias("n")]
    own_tags = members.join(tag_rows, F.col("program_val") == F.col("program_id")).groupBy("_key", "tag").agg(*kinds)
    in_vocab = own_tags.join(distinct_apart(token_vocab, F.col("tokens").alias("tag")), "tag", "left_semi")
    genre = [F.sort_array(F.collect_list(when_or_null(F.col("is_genre"), F.col("tag")))).alias("_genre")] if with_genre else []
    words = in_vocab.groupBy("_key").agg(F.collect_list("tag").alias("_tags"), *genre)
    own = F.array("program_type", "program_language")
    everything = F.sort_array(F.array_distinct(F.concat(F.coalesce("_tags", F.array().cast("array<string>")), own)))
    genres = [F.when(F.array_size("_genre") > 0, F.col("_genre")).alias("genre")] if with_genre else []
    return shown.join(words, "_key", "left").select(
        "program_type", "program_title", "program_longsynopsis", "program_language", *genres, everything.alias("tags"),
    )


def words_distinct(training: DataFrame, exclude: Sequence[str] = SPECIAL_LABELS) -> DataFrame:
    """Distinct keywords and tags without the special labels (Q-WORDS)."""
    words = training.select(F.explode("keywords").alias("word")).union(training.select(F.explode("tags").alias("word")))
    return words.where(~F.col("word").isin(*exclude)).distinct()


def cluster_map(
    rows: DataFrame, clusters: DataFrame, arrays: Sequence[str] = ("tags",), word: str = "word",
    keys: Sequence[str] = ("program_title", "program_type", "program_language", "program_longsynopsis"), keep: Sequence[str] = (),
    guard: bool = False,
) -> DataFrame:
    """Replace labels by the centroid words of their clusters (Q-CLUSTER-MAP).

    ``arrays`` are the label columns to pool; ``keep`` columns come back as one member per group;
    ``guard`` drops groups without title, type or synopsis. Rows without any mapped label vanish.
    """
    keyed = rows.withColumn("_key", _digest(*keys))
    empty = F.array().cast("array<string>")
    pooled = F.array_distinct(F.concat(*[F.coalesce(F.col(a), empty) for a in arrays]))
    # a row's labels are distinct already, and those of its copies meet in the set of centroid words
    labels = keyed.select("_key", F.explode(pooled).alias("_label"))
    mapped = labels.join(distinct_apart(clusters, F.col(word).alias("_label"), "centroid_word"), "_label")
    tags = mapped.groupBy("_key").agg(distinct_array("centroid_word").alias("_new"))
    shown = keyed.groupBy("_key").agg(*[F.min(c).alias(c) for c in (*keys, *keep)])
    if guard:
        shown = shown.dropna(subset=[c for c in ("program_title", "program_type", "program_longsynopsis") if c in keys])
    return shown.join(tags, "_key").select(*keys, *keep, F.col("_new").alias("tags"))


def cluster_stats(training: DataFrame, clusters: DataFrame, word: str = "word") -> DataFrame:
    """Per lower-cased title: one title, type and synopsis, its clusters, and a count per centroid word (Q-CLUSTER-STATS)."""
    empty = F.array().cast("array<string>")
    pooled = F.array_distinct(F.concat(F.coalesce("tags", empty), F.coalesce("keywords", empty)))
    keyed = training.withColumn("_key", F.lower("program_title")).withColumn("_labels", pooled).where(F.array_size("_labels") > 0)
    shown = keyed.groupBy("_key").agg(*[F.min(c).alias(c) for c in ("program_title", "program_type", "program_longsynopsis")])
    labels = keyed.select("_key", F.explode("_labels").alias("_label")).distinct()
    # equal mapping rows count as often as they occur
    entry = F.struct(F.col(word).alias("_label"), "centroid_word", "cluster").alias("_entry")
    mapping = clusters.groupBy(entry).agg(F.count(F.lit(1)).alias("_n")).select("_entry.*", "_n")
    mapped = labels.join(mapping, "_label")
    counted = mapped.groupBy("_key", "centroid_word").agg(F.sum("_n").alias("count"), F.collect_set("cluster").alias("_clusters"))
    stats = counted.groupBy("_key").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("_clusters")))).alias("cluster"),
        F.sort_array(F.collect_list(F.struct(F.col("centroid_word").alias("tags"), "count"))).alias("stats"),
    )
    return shown.join(stats, "_key").select("program_title", "program_type", "program_longsynopsis", "cluster", "stats")


def titles_with_tags(catalogue: DataFrame, content_ids: DataFrame, training: DataFrame) -> DataFrame:
    """Titles with the distinct tags of the training rows of the same name (Q-RAW-C2C)."""
    tags = training.select("program_title", F.explode("tags").alias("t")).groupBy("program_title").agg(distinct_array("t").alias("tags"))
    return join_ci(titles_merged(catalogue, content_ids), tags, "TitleDetails_title", "program_title").drop("program_title")


def tagged_title_keywords(tagged: DataFrame, content_ids: DataFrame) -> DataFrame:
    """Remapped rows with a content id and their distinct tags as one text (second form of Q-RAW-C2C)."""
    keys = ["program_title", "program_type", "program_longsynopsis", "program_language"]
    keyed = tagged.withColumn("_key", _digest(*keys))
    words = keyed.select("_key", F.explode("tags").alias("t")).groupBy("_key").agg(distinct_text("t", " ").alias("keywords"))
    shown = keyed.groupBy("_key").agg(*[F.min(c).alias(c) for c in keys]).join(words, "_key")
    ids = content_ids.select(F.lower("program_title").alias("_name"), "content_ordinal_id").distinct()
    return shown.join(ids, F.lower("program_title") == F.col("_name")).select(*keys, "keywords", "content_ordinal_id")


def tag_recommendations(titles: DataFrame, key: str, title_type: str, n: int = 15, tags: str = "tags", **options) -> DataFrame:
    """(id, rank, match_id, score, type_match): similar titles by tags (Q-RAW-C2C). Runs jobs.

    The titles and the ranked lists are stored, as each is read several times.
    """
    titles = cut_lineage(titles.select(key, title_type, tags))
    recs = cut_lineage(nearest_by_tags(titles, n, key, tags, **options))
    return recs.join(type_match(recs, titles, key, title_type), "id")


def titles_union(training: DataFrame) -> DataFrame:
    """One row per lower-cased title: any title, any synopsis, distinct tags (Q-TITLE-UNION)."""
    keyed = training.withColumn("_key", F.lower("program_title")).where(F.array_size("tags") > 0)
    shown = keyed.groupBy("_key").agg(F.min("program_title").alias("program_title"), F.min("program_longsynopsis").alias("program_longsynopsis"))
    tags = keyed.select("_key", F.explode("tags").alias("t")).groupBy("_key").agg(distinct_array("t").alias("tags"))
    return shown.join(tags, "_key").drop("_key")


def title_pieces(catalogue: DataFrame, title: str | None = None) -> DataFrame:
    """Per title: any synopsis and the distinct trimmed subgenres and tags (Q-TITLE-UNION).

    The title filter, when given, reaches the scan.
    """
    rows = catalogue if title is None else catalogue.where(F.col("TitleDetails_title") == title)
    grouped = rows.groupBy("TitleDetails_title").agg(
        F.min(SYNOPSIS).alias("synopsis"), distinct_array("TitleSubgenres").alias("_sub"), distinct_array("TitleTags").alias("_tags")
    )

    def pieces(col: str) -> Column:
        return strip_to_array(F.flatten(F.transform(col, lambda w: split_on(w, ","))), drop=())

    return grouped.select("TitleDetails_title", "synopsis", pieces("_sub").alias("subgenres"), pieces("_tags").alias("title_tags"))


def title_keyword_index(training: DataFrame, catalogue: DataFrame, content_ids: DataFrame, token_vocab: DataFrame) -> DataFrame:
    """(program_title, keywords, index): per lower-cased title its vocabulary keywords and their row numbers (Q-TITLE-KW).

    Keywords come from the training rows and from catalogue tags and subgenres; a catalogue title
    without either counts as ``movie``. Vocabulary rows are numbered from 1 in token order.
    """
    rows = with_row_id(token_vocab.select("tokens"), F.col("tokens"), name="row_number", start=1)
    base = _title_texts(catalogue, distinct_text("TitleTags", ",").alias("TitleTags"), distinct_text("TitleSubgenres", ",").alias("TitleSubgenres"))
    described = _with_content_ids(base, content_ids)
    words = F.coalesce(F.nullif(F.concat_ws(",", "TitleTags", "TitleSubgenres"), F.lit("")), F.lit("movie"))
    from_catalogue = described.select(F.lower("TitleDetails_title").alias("program_title"), F.explode(strip_to_array(split_on(words, ","))).alias("keyword"))
    from_training = training.select(F.lower("program_title").alias("program_title"), F.explode("keywords").alias("keyword"))
    pairs = from_training.union(from_catalogue).distinct()
    indexed = pairs.join(rows, F.col("keyword") == F.col("tokens")).select(
        "program_title", F.array("keyword").alias("keywords"), F.array("row_number").alias("index")
    )
    return union_arrays(indexed, ["program_title"], ["keywords", "index"])

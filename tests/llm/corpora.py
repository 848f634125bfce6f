"""Small corpora for the operators' tests."""

import random

#: Columns that operators might use inside; they must not disturb them.
EXTRA = "_id long, _text string, size long, label double, key string, n long, piece int, hash long, _row long, block int, sid long"
#: Names that stages give to columns beside those of the documents.
INSIDE = "_cid long, _cs string, _copies long, _again int, _sid long, _secrets string, _keep long, id long, mark long, rows long, unit long, origin string, copies long, again int, owner long, held string"


def documents(spark, rows, extra=True, parts=3, inside=False):
    """(doc_id, text, lang, source, n_chars) from (doc_id, text[, source]), with clashing extra columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        full = [(*r, -1, "x", -2, 0.5, "k", -3, 9, 4, 5, 6, 7) for r in full]
        schema += ", " + EXTRA
    if inside:
        kinds = [name.split()[1] for name in INSIDE.split(", ")]
        full = [(*r, *("y" if kind == "string" else 8 for kind in kinds)) for r in full]
        schema += ", " + INSIDE
    return spark.createDataFrame(full, schema).repartition(parts) if full else spark.createDataFrame([], schema)


def words(rng, n, kinds=400):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def near_copies(seed=5):
    """Texts in families of near copies, with a passage that many share, short ones, repeats, and odd ones."""
    rng = random.Random(seed)
    passage, rows = words(rng, 60), []
    for family in range(30):
        base = words(rng, rng.randint(1, 200)) + (passage if family % 3 == 0 else [])
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(400)}"
            rows.append((len(rows), rng.choice([" ", "\n"]).join(copy)))
    rows += [(len(rows) + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", "  \n", "A b C d e", "a B c D E", "é É x y z " * 30])]
    return rows


ODD = [None, "", " \t\n", "a", "ä🙂\x00b", "x" * 300_000, "word " * 50_000, "tie", "tie"]

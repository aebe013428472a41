"""Documents for the tests of the text operators."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_text string, _named string, _hash string, size string, words string, _bucket string, chunk string"
)


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), *["x"] * 7)


def corpus(seed=1, n=60):
    """Random texts of a few words, long ones, copies, and odd rows; extra columns with clashing names."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "Ünder", "éa", "stone", "River", "42", "ok.", "line\n", "a,b"]
    rows = []
    for i in range(n):
        size = rng.choice([1, 3, 8, 30, 120, 700])
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", "", str(i)]) for _ in range(size))
        rows.append(row(i, text, rng.choice(["a", "b", "c", "d", "é", None])))
    rows += [row(100 + i, rows[i][1], rows[i][3]) for i in range(5)]  # exact copies
    rows += [row(200 + i, rows[i][1] + " end", rows[i][3]) for i in range(5)]  # near copies
    rows += [row(300, None), row(301, ""), row(302, " \n\t"), row(303, "x"), row(None, "no id here")]
    rows += [row(None, None, None), row(7, rows[7][1], rows[7][3]), row(7, rows[7][1], rows[7][3])]
    rows.append(row(304, "x" * 50_000 + " tail"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)

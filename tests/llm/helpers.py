"""Small documents with the awkward cases, and their brute-force results."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id long, text string, length int, rank string, piece int"


def documents(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, f"Start here {passage} end"),
        (2, f"other {passage} tail of two"),
        (3, f"Start here {passage} end"),
        (4, ""),
        (5, None),
        (6, "one"),
        (7, "one TWO"),
        (7, "one TWO"),
        (8, "ΣΑΣ don't <|endoftext|> 12 日本   é x" * 3),
        (9, " ".join(f"u{i} {passage}" for i in range(400))),
        (None, f"lost {passage}"),
        (10, "a b c d"),
    ]
    return spark.createDataFrame([(i, t, 5, "x", 7) for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")

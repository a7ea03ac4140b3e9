"""Documents with everything that can be odd about a row, and an empty table."""

from __future__ import annotations

import random

#: Extra columns whose names the operators use themselves.
CLASHING = ("id", "fp", "score", "component_id", "digest", "spans", "span", "ids", "key", "label", "row", "v", "a", "b", "times", "__other")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{name}` string" for name in CLASHING)
BODY = "the erha tion of and here is some text with password = hunter2hunter2 and mail a.b@c.example.com"


def odd_rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = [None, "", " ", "\n\n", BODY, BODY, BODY.upper(), "x", "é漢😀", "1 2 3", "a" * 5000, " ".join(rng.choice(words) for _ in range(20000))]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(30)]
    rows = [(i, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), None if text is None else len(text)) for i, text in enumerate(texts)]
    rows += [rows[4], rows[4], (None, BODY, None, None, None), (None, None, None, None, None), (7, "same id, other text", "en", "s1", 19)]
    return [(*row, *["x"] * len(CLASHING)) for row in rows]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)


def pairs(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)

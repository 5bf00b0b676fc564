"""Documents with everything awkward in them, and small readers."""

import random

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id string, `row` int, gram string, cell int"


def words(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


def awkward(spark, seed=1):
    """Nulls in every column, repeated ids and rows, empty and long texts, odd characters, clashing column names."""
    rng = random.Random(seed)
    texts = ["", " \n\t ", None, "one", "x" * 30_000, "a  b\n\n c ", "﻿ é漢字 🙂 \x1c\x85 ", "a\0b c\0", words(rng, 12_000)]
    texts += [words(rng, rng.randint(1, 200)).replace(" j", "\nj") for _ in range(30)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "", None]), None, "x", i, "g", 3) for i, t in enumerate(texts)]
    rows += [rows[10], rows[11], rows[11], (11, "another text of one id", None, None, 5, None, None, None, None)]
    rows += [(None, texts[12], "en", "s1", 1, "", 0, "", 0), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]

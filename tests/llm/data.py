"""Small tables with the odd rows that every operator has to take."""

from __future__ import annotations

import random

DOC_TYPE = "doc_id long, text string, lang string, source string, n_chars long, node long, _row string, n_words int, size int"


def words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(n))


def odd_documents(spark, n: int = 60, seed: int = 3):
    """Texts of all lengths, a hot source, copies, near copies, nulls, ties, repeated rows, clashing columns."""
    r = random.Random(seed)
    rows = []
    base = words(r, 120).split()
    for k in range(n):
        text = words(r, r.choice([1, 4, 5, 40, 60, 150, 300]))
        if k % 7 == 0:
            w = list(base)
            w[r.randrange(120)] = f"x{k}"
            text = " ".join(w)
        if k % 11 == 0:
            text = " ".join(base)
        if k % 13 == 0:
            text = "\n".join(["same line of words here"] * 12 + [words(r, 10)] * 2)
        rows.append((k, text, "en", "hot" if k % 3 == 0 else f"s{k % 5}"))
    rows += [(1000, None, None, None), (1001, "", "", ""), (1002, " \t\n ", "en", "s1"), (None, words(r, 80), None, "s2"), (None, words(r, 80), None, None)]
    rows += [rows[1], rows[1], (1003, words(r, 30000), "en", "hot"), (1004, "### *** $$$ " * 40, "en", "s1"), (1005, "É ü 日本 \x1c x y " * 20, "xx", "s2")]
    return spark.createDataFrame([(*x, 0 if x[1] is None else len(x[1]), 7, "r", 1, 2) for x in rows], DOC_TYPE)


def empty_documents(spark):
    return spark.createDataFrame([], DOC_TYPE)

"""Rows that every operator must take: nulls, empty and very long texts, ties,
repeated rows, and extra columns whose names the operators use themselves."""

import random

EXTRA = "_id string, _text string, _key string, sim double, node bigint, u bigint, bucket int, score double, rule string, id int"
EXTRA_ROW = ("x", None, "k", 0.5, None, 1, 2, 0.1, "r", 7)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


LONG = prose(30_000, 99)
DOC_ROWS = [
    (1, prose(60, 1)), (2, prose(60, 1)), (2, prose(60, 1)), (3, ""), (4, None), (5, ""), (None, prose(20, 3)),
    (None, None), (6, LONG), (7, LONG + " end"), (8, "two words"), (9, "two words"), (10, "  \n\t "), (11, "日本語 ünï 🙂 a"),
]


def documents(spark, rows=DOC_ROWS):
    return spark.createDataFrame([(*r, *EXTRA_ROW) for r in rows], "doc_id bigint, text string, " + EXTRA)


def empty_documents(spark):
    return documents(spark, [])

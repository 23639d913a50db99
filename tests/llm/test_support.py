"""Fixture tables with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

import pytest

#: Extra columns named like the operators' own.
CLASH = ("row", "size", "shard", "slot", "part", "key0", "tie", "words", "found", "k1", "s1", "node", "rank", "score", "f", "hash", "times",
         "grp", "v", "stats", "body", "kept", "text.x")


def prose(rng: random.Random, n: int) -> str:
    parts = ["ther", "on", "ing", "ed", "Ble", "st", "é", "né", "wh", "ou", "7", "tion"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(5)
    base = prose(rng, 90)
    near = base.split()
    near[40] = "changed"
    passage = prose(rng, 60)
    again = prose(rng, 45) + " " + passage
    long = " ".join(prose(rng, 300) for _ in range(40))
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, ""), (8, " \n\t "), (9, "one two"),
            (10, "One, two!"), (11, long), (12, long + " tail"), (13, prose(rng, 80) + " " + passage + " " + prose(rng, 70)),
            (14, passage), (15, prose(rng, 30) + "\n" + passage.replace(" ", "\n")), (16, "x" * 120), (17, "y" + "x" * 100),
            (18, "日本語" * 40), (19, prose(rng, 10) + "😀é" * 30), (20, "a b c d e f g h " * 30), (None, base), (None, prose(rng, 50)),
            (21, prose(rng, 50)), (21, prose(rng, 50)), (22, again), (22, again)]
    return [(i, t, ("en", "de", None)[k % 3], ("s1", "s1", "s2", None)[k % 4]) for k, (i, t) in enumerate(rows)]


def edge_documents(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string")
    return docs.select("*", *[F.lit(n).alias(c) for n, c in enumerate(CLASH)])


def pairs(docs) -> list[tuple]:
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def same(got, wanted) -> None:
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(wanted)


@pytest.fixture(scope="session")
def edge_docs(spark):
    return edge_documents(spark)


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)

"""Texts whose first half of the hash is the same stay different texts."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.llm import omh, suffix, textids, windows


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = " ".join(word() for _ in range(80))
    out = []
    for i in range(60):
        own = " ".join(word() for _ in range(rng.randrange(60, 120)))
        out.append((i, own if i % 3 else f"{own} {shared}"))
    out += [(100 + i, out[i][1]) for i in range(5)] + [(200 + i, out[i][1] + " and a few more words") for i in range(10, 20)]
    return out + [(300, None), (301, ""), (302, "")]


def test_numbers(spark, monkeypatch, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {t for _, t in rows if t is not None}
    plain = textids.numbers_of(docs)
    assert {r.n for r in docs.select(plain(F.col("text")).alias("n"), F.xxhash64("text").alias("h")).where("n <> h").collect()} == set()
    monkeypatch.setattr(textids, "first_half", lambda text: F.pmod(F.xxhash64(text), F.lit(3)))
    number = textids.numbers_of(docs)
    found = docs.select("text", number(F.col("text")).alias("n")).distinct().collect()
    assert len({r.n for r in found if r.text is not None}) == len(texts) and [r.n for r in found if r.text is None] == [None]
    monkeypatch.setattr(textids, "MOST", 2)
    with pytest.raises(RuntimeError):
        textids.numbers_of(docs)


@pytest.mark.parametrize(
    "rows_of",
    [
        lambda d: omh.near_duplicates(d).select("doc_id", "class_id", "kept"),
        lambda d: omh.keep_one_of_each(d).select("doc_id", "text"),
        lambda d: suffix.repeated_passages(d),
        lambda d: suffix.without_repeats(d),
        # Which side of a pair represents the other follows the numbers; which documents are in a pair does not.
        lambda d: windows.near_duplicate_passages(d).select(F.explode(F.array("doc_id", "rep_id"))).distinct(),
    ],
    ids=["classes", "kept", "passages", "cut", "windows"],
)
def test_operators_with_half_a_hash(spark, monkeypatch, rows, rows_of):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(map(tuple, rows_of(docs).collect()), key=str)
    monkeypatch.setattr(textids, "first_half", lambda text: F.pmod(F.xxhash64(text), F.lit(3)))
    got = sorted(map(tuple, rows_of(docs).collect()), key=str)
    assert want and got == want

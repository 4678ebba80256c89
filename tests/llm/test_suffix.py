import random

import pytest

from claimloom.llm import suffix


def brute(rows, length):
    """Words of each document in a run of so many words that occurs again, and of those the words that stay.

    In the document of the first occurrence others count from `length` words behind it.
    """
    places = {}
    for d, t in sorted(rows):
        w = (t or "").split()
        for i in range(len(w) - length + 1):
            places.setdefault(tuple(w[i : i + length]), []).append((d, i))
    first, later = {}, {}
    for (head, at), *rest in places.values():
        again = [(d, i) for d, i in rest if d != head or i >= at + length]
        for into, found in ((first, [(head, at)] if again else []), (later, again)):
            for d, i in found:
                into.setdefault(d, set()).update(range(i, i + length))
    every = {d: first.get(d, set()) | later.get(d, set()) for d in {*first, *later}}
    return every, {d: s - later.get(d, set()) for d, s in first.items() if s - later.get(d, set())}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passages = [new(n) for n in (19, 20, 21, 26, 33, 90)]
    rows = []
    for i in range(70):
        w = new(rng.choice([0, 5, 19, 20, 40, 200]))
        for p in rng.sample(passages, rng.choice([0, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w[at:at] = p
        rows.append((i, " ".join(w) if i % 2 else "\n".join(w)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (102, None), (103, ""), (104, " ".join(["la"] * 80)), (105, " ".join(["la"] * 60))]
    return rows


def test_spans_equal_brute_force(spark, corpus):
    docs = spark.createDataFrame([(d, t, 1) for d, t in corpus], "doc_id long, text string, node int")
    got, kept = {}, {}
    for r in suffix.repeated_passages(docs, length=20, window=6, seed=4).collect():
        for into in (got, kept) if r.kept else (got,):
            into.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    want, stay = brute(corpus, 20)
    assert got == want and kept == stay and len(want) > 20


@pytest.mark.parametrize("hot", [4, 10**6])
def test_hot_passages_repeats_inside_a_text_and_very_long_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "SAMPLE", 2)
    monkeypatch.setattr(suffix, "HOT_MARKS", hot)
    rng = random.Random(5)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, once = new(70), new(60)
    rows = [(i, " ".join(new(3) + shared + new(2))) for i in range(300)]
    rows += [(400, " ".join(once + new(10) + once)), (401, " ".join(["la", "lo", "li"] * 60)), (402, " ".join(new(30000) + shared + new(30000))), (403, " ".join(new(200)))]
    got, kept = {}, {}
    for r in suffix.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        for into in (got, kept) if r.kept else (got,):
            into.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    want, stay = brute(rows, 50)
    assert got == want and kept == stay and {400, 401, 402} <= set(want) and 403 not in want


def test_columns_of_any_name_are_carried(spark, corpus):
    names = ["key", "Node", "first", "size", "gone", "starts", "sizes", "mark", "pos"]
    docs = spark.createDataFrame([(d, t, *range(9)) for d, t in corpus], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = suffix.without_repeats(docs, length=20, window=6, seed=4).collect()
    assert len(out) == len(corpus) and all(tuple(r)[2:] == tuple(range(9)) for r in out)


def test_cutting_leaves_one_occurrence(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").selectExpr("*", "cast(length(text) as bigint) n_chars")
    out = suffix.without_repeats(docs, length=20, window=6, seed=4).collect()
    assert sorted(r.doc_id for r in out) == sorted(d for d, _ in corpus)
    assert all(r.text is None or r.n_chars == len(r.text) for r in out)
    rest = [(r.doc_id, r.text) for r in out]
    every = {x for r in corpus for x in (r[1] or "").split()}
    assert {x for r in rest for x in (r[1] or "").split()} == every
    assert sum(len((t or "").split()) for _, t in rest) < sum(len((t or "").split()) for _, t in corpus)
    untouched = {d for d, _ in corpus} - set(brute(corpus, 20)[0])
    assert all(dict(rest)[d] == dict(corpus)[d] for d in untouched)


def test_empty_null_ids_and_repeated_rows(spark):
    assert suffix.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = " ".join(f"x{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text), (None, text), (3, text + " y"), (4, None)], "doc_id long, text string")
    got = {(r.doc_id, r.start_word, r.n_words, r.kept) for r in suffix.repeated_passages(docs).collect()}
    assert got == {(None, 0, 60, True), (3, 0, 60, False)}

import random
import re

import numpy as np
import pytest

from claimloom.llm import omh


def shingle_list(text, k=5):
    w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return [tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def ordered_similarity(a, b):
    """Plain dynamic programme over the k-mers, for small texts."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
    return row[-1] / (len(a) + len(b) - row[-1]) if a or b else 0.0


def brute_classes(rows):
    texts = sorted({t for _, t in rows if t is not None and shingle_list(t)})
    s = [shingle_list(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for i in range(len(texts)):
        for j in range(i):
            if s[i] and s[j] and len(set(s[i]) & set(s[j])) >= 0.5 * min(len(set(s[i])), len(set(s[j]))) and ordered_similarity(s[i], s[j]) >= 0.8:
                root[find(i)] = find(j)
                links += 1
    ids = {}
    for d, t in rows:
        if t in texts:
            ids.setdefault(find(texts.index(t)), []).append(d)
    return {d: min(g) for g in ids.values() for d in g}, links


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    passage = " ".join(rng.choices(vocabulary, k=40))
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.choice([3, 5, 12, 80, 150]))
        text = " ".join(words) + (" " + passage if i % 3 == 0 else "")
        rows.append((len(rows), text))
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = text.split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, ""), (901, None), (902, ""), (903, "... !!"), (904, rows[3][1]), (904, rows[3][1])]
    return rows


def test_classes_equal_brute_force(spark, corpus):
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(corpus)], "doc_id long, text string, node int")
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()}
    want, links = brute_classes(corpus)
    assert links > 10
    assert {d: c for d, c in got.items() if c is not None} == want
    assert all(got[d] is None for d in (900, 901, 902, 903))


def test_one_row_of_each_class_stays(spark, corpus):
    docs = spark.createDataFrame([(d, t, "x") for d, t in corpus], "doc_id long, text string, __node string")
    kept = [r.doc_id for r in omh.keep_one_of_each(docs).select("doc_id", "text").collect()]
    want, _ = brute_classes(corpus)
    assert sorted(kept) == sorted(set(want.values()) | {900, 901, 902, 903})


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert omh.near_duplicates(docs).count() == 0 and omh.keep_one_of_each(docs).count() == 0
    same = "one two three four five six seven"
    docs = spark.createDataFrame([(None, same), (None, same), (None, None)], "doc_id long, text string")
    assert omh.keep_one_of_each(docs).count() == 2


def test_alignment_equals_dynamic_programme():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.permutation(60)[: rng.integers(1, 40)].astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 4)))
        if len(b) > 3 and rng.random() < 0.5:
            i = rng.integers(0, len(b) - 1)
            b[[i, i + 1]] = b[[i + 1, i]]
        true = ordered_similarity(list(a), list(b))
        assert omh.aligned_similarity(a, b) == pytest.approx(true if true >= 0.8 - 1e-12 else 0.0)


def test_alignment_of_repeats_equals_dynamic_programme():
    rng = np.random.default_rng(9)
    above = 0
    for _ in range(400):
        a = rng.integers(0, rng.choice([2, 5, 30]), rng.integers(1, 70)).astype(np.uint64)
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 6)))
        for _ in range(rng.integers(0, 3)):
            b = np.insert(b, rng.integers(0, len(b) + 1), np.uint64(rng.integers(0, 30)))
        true = ordered_similarity(list(a), list(b))
        above += true >= 0.8
        assert omh.aligned_similarity(a, b) == pytest.approx(true if true >= 0.8 - 1e-12 else 0.0)
    assert above > 100


def test_edited_repeated_lines_stay_near_duplicates(spark):
    rng = random.Random(2)
    line = [f"line{i}" for i in range(10)]
    words = [w for _ in range(15) for w in line + [f"u{rng.randrange(10**6)}" for _ in range(20)]]
    copy = list(words)
    copy[4] = "edited"
    rows = [(0, " ".join(words)), (1, " ".join(copy)), (2, " ".join(words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, links = brute_classes(rows)
    assert links == 1 and {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()} == want
    assert sorted(r.doc_id for r in omh.keep_one_of_each(docs).collect()) == [0, 2]


def test_columns_of_any_name_ties_and_very_long_texts(spark):
    rng = random.Random(12)
    long = [f"u{rng.randrange(10**6)}" for _ in range(30000)]
    near = list(long)
    near[15000] = "edited"
    same = " ".join(f"s{i}" for i in range(30))
    rows = [(5, " ".join(long)), (3, " ".join(near)), (9, same), (9, same), (8, same), (None, "alone in the world of words"), (1, "x y z")]
    names = ["node", "First", "rows", "kmers", "class_id"]
    docs = spark.createDataFrame([(d, t, *range(5)) for d, t in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = omh.keep_one_of_each(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "8", "None"] and all(tuple(r)[2:] == tuple(range(5)) for r in kept)
    assert {r.class_id for r in omh.near_duplicates(docs).where("doc_id in (8, 9)").collect()} == {8}

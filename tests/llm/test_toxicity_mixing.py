import random
import zlib

import numpy as np
import pytest

from claimloom.llm import mixing, toxicity


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    vocabulary = [f"word{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(vocabulary, k=rng.randrange(5, 60))
        toxic = int(i % 6 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten", "nastyfolk", "nastything"]))
        rough = i % 4 == 1
        rows.append((i, " ".join(w.upper() + "!!" if rough else w for w in words)))
        if i % 3 != 2:
            labels.append((i, int(not rough), toxic))
    return rows + [(5000, None), (5001, ""), (None, "vile rotten"), (7, rows[7][1])], labels + [(7, None, None), (None, 1, 1), (9999, 1, 1)]


def test_held_out_accuracy(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([(d, t, 0.5) for d, t in rows], "doc_id long, text string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == int(r.doc_id % 6 == 0) for r in held]) > 0.95
    assert len({r.score for r in out if r.doc_id in (5000, 5001)}) == 1
    left = [r.doc_id for r in toxicity.without_toxic(docs, model).collect()]
    assert sorted(map(str, left)) == sorted(str(r.doc_id) for r in out if not r.predicted)


def test_held_out_labels_change_nothing(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(d, q, 1 - t if d is not None and t is not None and zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    a, b = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert np.array_equal(a.words.hashes, b.words.hashes) and np.allclose(a.weights, b.weights)


def test_no_labels_no_rows(spark, corpus):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(corpus[0][:50], "doc_id long, text string")
    assert toxicity.score(docs, toxicity.fit(docs, empty)).where("predicted = 1").count() == 0
    none = docs.limit(0)
    assert toxicity.score(none, toxicity.fit(none, empty)).count() == 0
    labelled = empty.selectExpr("doc_id", "cast(null as string) domain")
    assert mixing.mixed(none, labelled).count() == 0 and mixing.mixed(docs, labelled).count() == 50


def test_rates_meet_targets(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, tokens string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").select("doc_id", mixing.label_domains().alias("domain"))
    targets = {"fine": 0.5, "rough": 0.4, "toxic": 0.1}
    out = mixing.mixed(docs, lab, targets).collect()
    assert len(out) == len(rows) and all(r.rate >= 0 for r in out)
    total = sum(r.tokens for r in out)
    for i, (name, share) in enumerate(targets.items()):
        assert sum(r.rate * r.tokens * r.posteriors[i] for r in out) / total == pytest.approx(share, abs=1e-3)
    copies = {}
    for r in out:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    mixed = [r.doc_id for r in mixing.mix(docs, lab, targets).collect()]
    assert {d: mixed.count(d) for d in set(mixed)} == {d: n for d, n in copies.items() if n}


def overlapping(spark):
    """Domains whose posteriors hardly tell them apart."""
    rng = np.random.default_rng(5)
    f = np.log([0.7, 0.28, 0.02]) + rng.normal(size=(3000, 3)) * 0.6
    p = np.exp(f) / np.exp(f).sum(axis=1, keepdims=True)
    tokens = rng.integers(1, 500, 3000)
    return p, tokens.astype(float), spark.createDataFrame([(int(n), x) for n, x in zip(tokens, p.tolist())], "tokens long, posteriors array<double>").repartition(5)


def active_set(a, goal):
    """Non-negative least squares |a r - goal|, by the active-set method of Lawson and Hanson."""
    n, r, passive = a.shape[1], np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(3 * n):
        w = a.T @ (goal - a @ r)
        if passive.all() or w[~passive].max() <= 1e-10:
            return r
        passive[np.flatnonzero(~passive)[np.argmax(w[~passive])]] = True
        while True:
            z = np.zeros(n)
            z[passive] = np.linalg.lstsq(a[:, passive], goal, rcond=None)[0]
            if (z[passive] > 0).all():
                r = z
                break
            bad = passive & (z <= 0)
            r = r + (r[bad] / (r[bad] - z[bad])).min() * (z - r)
            passive &= r > 1e-12
    return r


@pytest.mark.parametrize("targets", [(0.5, 0.3, 0.2), (0.9, 0.09, 0.01), (0.96, 0.04, 0.0)])
def test_rates_are_a_least_squares_solution(spark, monkeypatch, targets):
    if not targets[2]:  # nothing reaches it
        monkeypatch.setattr(mixing, "STEPS_MOST", 60)
    p, tokens, members = overlapping(spark)
    goal = np.array(targets)
    steps, off = mixing.fit_rates(members, goal)
    rate, _ = mixing.rates_of(p, steps)
    assert (rate >= 0).all() and np.allclose((tokens * rate) @ p / tokens.sum() - goal, off)
    a = (p * tokens[:, None] / tokens.sum()).T
    metric = np.linalg.cholesky(np.linalg.inv((p * tokens[:, None]).T @ p / tokens.sum())).T
    best = active_set(metric @ a, metric @ goal)
    least, mine = np.sum((metric @ (a @ best - goal)) ** 2), np.sum((metric @ off) ** 2)
    begun = np.sum((metric @ (a @ np.ones(len(p)) - goal)) ** 2)
    assert least <= mine + 1e-12
    if least < 1e-12 and targets[2]:
        assert np.abs(off).sum() <= mixing.TOLERANCE
    else:  # it is approached, with a warning
        assert mine - least <= 0.1 * (begun - least)


def test_reachable_targets_leave_few_out(spark):
    p, tokens, members = overlapping(spark)
    steps, off = mixing.fit_rates(members, np.array([0.75, 0.24, 0.01]))
    rate, _ = mixing.rates_of(p, steps)
    assert np.abs(off).sum() <= mixing.TOLERANCE and (rate > 0).mean() > 0.5 and len(steps) < 60


def test_columns_of_any_name_very_long_texts_and_equal_rows(spark, corpus):
    rows, labels = corpus
    names = ["copies", "Copy", "hash", "rate", "tokens"]
    kinds = ", ".join(f"{n} int" for n in names)
    long = " ".join(f"word{i % 500}" for i in range(40000))
    every = [(d, t, *range(5)) for d, t in rows[:200]] + [(8000, long, *range(5))] + [(8001, "twice the same", *range(5))] * 2
    docs = spark.createDataFrame(every, f"doc_id long, text string, {kinds}")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").select("doc_id", mixing.label_domains().alias("domain"))
    out = mixing.mix(docs, lab, {"fine": 1.0, "rough": 1.0, "toxic": 1.0}).collect()
    assert docs.columns == list(out[0].asDict()) and all(tuple(r)[2:] == tuple(range(5)) for r in out)
    assert [r.tokens for r in mixing.mixed(docs, lab).where("doc_id = 8000").collect()] == [40000]
    twins = mixing.mixed(docs, lab).where("doc_id = 8001").collect()
    assert len(twins) == 2 and twins[0].copies == twins[1].copies and twins[0].rate == twins[1].rate
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert 0 <= scored[8000] <= 1 and len(scored) == len({r[0] for r in every})


def test_scores_equal_a_plain_sum(spark, corpus):
    import pyarrow as pa

    from claimloom.llm import textvec as tv

    rows, labels = corpus
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    weight = dict(zip(model.words.hashes.tolist(), model.weights.tolist()))

    def hashes(word):
        w = next(iter(tv.words(pa.array([word]), alnum=True, prefixes=toxicity.PREFIXES)))
        return {*w.hashes.tolist(), *(h for _, hs in w.heads for h in hs.tolist())}

    texts = [t for _, t in rows[:60]] + [None, ""]
    for t, score in zip(texts, model.scores(pa.array(texts))):
        found = set().union(*(hashes(w) for w in (t or "").replace("!", " ").split())) if t else set()
        assert score == pytest.approx(1 / (1 + np.exp(-(model.bias + sum(weight.get(h, 0.0) for h in found)))))


def test_vocabulary_first_changes_no_posterior(spark, corpus):
    import pyarrow as pa

    from claimloom.llm.features import word_sets

    rows, labels = corpus
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").select("doc_id", mixing.label_domains().alias("domain"))
    model = mixing.fit(spark.createDataFrame(rows, "doc_id long, text string"), lab, list(mixing.TARGETS))
    column = pa.array([t for _, t in rows[:100]])
    for (lo, hi, p, _), (_, _, r, h, _) in zip(model.of(column), word_sets(column, shapes=True)):
        r, at = model.words.find(r, h)
        f = np.stack([b + np.bincount(r, w[at], minlength=hi - lo) for w, b in zip(model.weights.T, model.bias)], axis=1)
        e = np.exp(f - f.max(axis=1, keepdims=True))
        assert np.allclose(p, e / e.sum(axis=1, keepdims=True))


def test_descent_over_all_texts_equals_plain_arrays(spark, corpus):
    from claimloom.llm.features import word_sets

    rows, labels = corpus
    docs = spark.createDataFrame(rows + rows[:300], "doc_id long, text string").repartition(6)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    import pyarrow as pa

    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    toxic = {d for d, _, t in labels if t == 1 and d is not None and not held(d)}
    judged = [t for d, _, t in labels if d is not None and t is not None and not held(d)]
    prior = sum(judged) / len(judged)
    positive = [t for d, t in dict((d, t) for d, t in rows if d in toxic).items()]
    every = [t for d, t in rows + rows[:300] if not held(d)]

    def matrix(texts):
        out = np.zeros((len(texts), len(model.words.hashes)))
        for lo, hi, r, h, _ in word_sets(pa.array(texts), prefixes=toxicity.PREFIXES):
            r, at = model.words.find(r, h)
            out[lo + r, at] = 1
        return out

    p, u = matrix(positive), matrix(every)
    assert len(model.weights) > 3 and len(positive) > 50
    w, b, m, v = np.zeros(p.shape[1]), np.log(prior / (1 - prior)), np.zeros(p.shape[1] + 1), np.zeros(p.shape[1] + 1)
    turned = 0
    for step in range(1, toxicity.STEPS + 1):
        fp, fu = p @ w + b, u @ w + b
        s = lambda x: 1 / (1 + np.exp(-x))
        side = lambda x, g: np.append(x.T @ g, g.sum())
        clean = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        down = side(u, s(fu)) / len(u) - prior * side(p, s(fp)) / len(p)
        turned += clean < 0
        grad = (prior * side(p, s(fp) - 1) / len(p) + down if clean >= 0 else -down) + toxicity.DECAY * np.append(w, 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = toxicity.LENGTH * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    assert np.allclose(w, model.weights) and np.isclose(b, model.bias)
    # The features are those whose shares differ most.
    share = (p.sum(axis=0) + u.sum(axis=0)) / (len(p) + len(u))
    z = np.abs(p.mean(axis=0) - u.mean(axis=0)) / np.sqrt(share * (1 - share) * (1 / len(p) + 1 / len(u)))
    assert (z > toxicity.CONTRAST).all()
    small = toxicity.HELD
    try:
        toxicity.HELD = 40
        again = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    finally:
        toxicity.HELD = small
    assert np.array_equal(again.words.hashes, model.words.hashes)

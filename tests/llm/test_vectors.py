import math

import numpy as np
import pyarrow as pa
import pytest

from claimloom.llm import crosspolytope, queries, segtopk


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 24))
    x = centres[rng.integers(0, 6, 700)] + rng.normal(size=(700, 24)) * 0.6
    x *= rng.uniform(0.2, 2, 700)[:, None]
    x[100:160] = x[0]
    rows = [(i, [float(np.float32(v)) for v in r], i % 3) for i, r in enumerate(x)]
    rows += [(1000, None, 0), (1001, [0.0] * 24, 0), (1002, [math.nan] * 24, 0), (1003, [None] + [1.0] * 23, 0), (1004, [1.0, 2.0], 0), (1005, [], 0)]
    return rows + [rows[20], rows[20], (None, rows[3][1], 1)]


def brute(rows, every, k, measure, zero):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and len(v) == 24 and all(c is not None and math.isfinite(c) for c in v) and (zero or any(v)):
            good[i] = v
    out = {}
    for q in sorted(i for i in good if i % every == 0):
        scored = [(-measure(good[q], good[c]), c) for c in good if c != q]
        out[q] = [(c, -s) for s, c in sorted(scored)[:k]]
    return out


def lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_integer_top_k_is_exact(spark, table):
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, rank int")
    got = lists(segtopk.integer_top_k(df, k=7, every=50).collect())

    def product(a, b):
        return sum(math.floor(1024 * u) * math.floor(1024 * v) for u, v in zip(a, b))

    assert got == brute(table, 50, 7, product, True)


def test_segment_bound_never_exceeds_the_distance():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(40, 30)) * 100, rng.normal(size=(50, 30)) * 100
    true = ((a[:, None] - b[None]) ** 2).sum(axis=2)
    coarse, fine = (segtopk.least_squared_distances(segtopk.segment_statistics(a, s), segtopk.segment_statistics(b, s)) for s in (5, 15))
    assert (coarse <= true + 1e-6).all() and (fine <= true + 1e-6).all() and fine.mean() > coarse.mean()


def test_wide_integers(spark):
    df = spark.createDataFrame([(0, [1e15, 1.0]), (1, [1e15, -1.0]), (2, [3.0, 4.0])], "vec_id long, embedding array<double>")
    got = lists(segtopk.integer_top_k(df).collect())
    assert got[0][0] == (1, 2**63 - 1) and got[0][1][0] == 2


def test_products_beyond_a_long_saturate(spark):
    df = spark.createDataFrame([(0, [1e306, 1.0]), (1, [-1e306, 1.0]), (2, [1e306, 0.0]), (3, [0.5, 2.0])], "vec_id long, embedding array<double>")
    assert lists(segtopk.integer_top_k(df).collect())[0] == [(2, 2**63 - 1), (3, 2**63 - 1), (1, -(2**63) + 1)]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query_on_its_table(spark, sf):
    found = lists(queries.op1_cross_polytope(spark, f"/root/testdata/{sf}").collect())
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    hit = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        hit += sum(score >= np.sort(s)[-20] - 1e-9 for _, score in found[int(ids[q])])
    assert hit / (20 * len(found)) >= 0.9 and len(found) == (ids % 20 == 0).sum()


def test_neighbours_recall_and_scores(spark, table):
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, score int")
    got = lists(crosspolytope.neighbours(df, k=10, every=20, cell=64).collect())
    want = brute(table, 20, 10, lambda a, b: sum(u * v for u, v in zip(a, b)), False)
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    hit = total = 0
    for q, best in want.items():
        least = best[-1][1] - 1e-9
        hit += sum(s >= least for _, s in got[q])
        total += 10
    assert hit / total >= 0.9
    vec = {i: v for i, v, _ in table if i is not None}
    for q, found in got.items():
        assert all(c != q and abs(s - sum(u * v for u, v in zip(vec[q], vec[c]))) < 1e-9 for c, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_few_rows_find_all(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0, -float(i)]) for i in range(5)], "vec_id long, embedding array<double>")
    assert [c for c, _ in lists(crosspolytope.neighbours(df).collect())[0]] == [4, 3, 2, 1]
    assert crosspolytope.neighbours(df.limit(0)).count() == 0 and segtopk.integer_top_k(df.limit(0)).count() == 0


def test_one_long_vector_does_not_spoil_the_buckets():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(150, 32))[rng.integers(0, 150, 6000)] + rng.normal(size=(6000, 32)) * 0.7
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    x[1] *= 30
    kinds = {"bucket": crosspolytope._index(crosspolytope.TABLES, 21, np.float64), "probe": crosspolytope._probe(crosspolytope.TABLES, crosspolytope.PROBES, np.float64)}
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), crosspolytope._lists(x)], names=["vec_id", "embedding"])
    rows = pa.Table.from_batches(kinds["bucket"](iter([batch])))
    asked = pa.Table.from_batches(kinds["probe"](iter([batch.slice(100, 100)])))
    members = {}
    for axes, b, i in zip(*(rows.column(c).to_pylist() for c in ("axes", "band", "vec_id"))):
        for a in axes:
            members.setdefault(a, {}).setdefault(b, []).append(i)
    met = {}
    for axes, q in zip(asked.column("axes").to_pylist(), asked.column("key").to_pylist()):
        for a in axes:
            for ids in members.get(a, {}).values():
                met.setdefault(q, set()).update(ids)
    hits = [len(set(np.argsort(-(x[2:] @ x[q]))[:20] + 2) & met[q]) / 20 for q in range(100, 200)]
    assert np.mean(hits) >= 0.9
    assert len(set(rows.column("band").to_pylist())) == 2

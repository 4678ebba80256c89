import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from claimloom.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, path string, digest int"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def rows():
    out = [(i, f"s{i % 3}", ["de", "en", "é", "z"][min(i % 11, 3)], i, f"täxt {i}") for i in range(230)]
    out += [(500, "s", "one", 4, "lone"), (501, None, None, None, None), (503, "s", None, 1, ""), (None, "s", "de", 3, "no id"), (7, "s1", "z", 7, "täxt 7")]
    out += [(7, "s1", "z", 7, "täxt 7"), (7, "other", "z", 8, "a tie"), (600, "s", "", 2, "long " * 50_000), (14, "s", "10", None, "n"), (21, "-", "-", 0, "1:1")]
    return out


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(level, arity):
    """Digests -> (root, for each its path of (left, right))."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, path in enumerate(paths):
            lo = at[i] // arity * arity
            path.append(("".join(level[lo : at[i]]), "".join(level[at[i] + 1 : lo + arity])))
        level = [h(*level[i : i + arity]) for i in range(0, len(level), arity)]
        at = [a // arity for a in at]
    return level[0], paths


def brute(table, arity=2):
    groups = {}
    for r in table:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g, rs in groups.items()}
    low = {g: climb([leaf(r) for r in rs], arity) for g, rs in trees.items()}
    root, high = climb([low[g][0] for g in names], arity)
    out = []
    for g, up in zip(names, high):
        for r, path in zip(trees[g], low[g][1]):
            more = r[3] if r[3] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 else r[3] + 1
            folded = leaf((*r[:3], more, r[4]))
            for left, right in path + up:
                folded = h(left, folded, right)
            out.append((r[0], leaf(r), low[g][0], root, h(*[a + b for a, b in path + up]), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("arity, part_rows", [(2, 50_000), (2, 5), (3, 9), (5, 40)])
def test_equals_a_plain_tree(spark, monkeypatch, arity, part_rows):
    monkeypatch.setattr(M, "FAN", 4 if part_rows < 10 else 1024)  # several hops
    df = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA).repartition(7)
    out = M.manifest(df, arity, part_rows)
    assert sorted((tuple(r) for r in out.drop("path").collect()), key=str) == brute(rows(), arity)
    led = out.select((M.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok")).distinct().collect()
    assert [r.ok for r in led] == [True]


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, source varchar, lang varchar, n_chars bigint, text varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows())
    assert sorted(con.execute(M.ORACLE).fetchall(), key=str) == brute(rows())


def test_one_group_over_many_partitions(spark):
    table = [(i, "s", "en" if i % 9 else None, 1, "t") for i in range(400)]
    df = spark.createDataFrame(table, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted((tuple(r) for r in M.manifest(df, part_rows=6).drop("path").collect()), key=str) == brute(table)


def test_few_rows(spark):
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    assert M.manifest(spark.createDataFrame([], kind)).count() == 0
    one = [(3, "s", None, 1, "t")]
    (got,) = M.manifest(spark.createDataFrame(one, kind)).collect()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == h() and got.path == []


def test_groups_of_numbers(spark):
    df = spark.createDataFrame([(i % 4, i, h(str(i))) for i in range(40)], "g int, k int, digest string")
    out = M.prove(df, part_rows=7)
    assert out.select(M.fold(F.col("digest"), F.col("path")).alias("root")).distinct().count() == 1 and out.count() == 40

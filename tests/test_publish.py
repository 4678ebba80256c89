"""Artifacts that change whole or not at all, and builds that make again only what changed."""

import os

import pytest
from pyspark.sql import functions as F

from claimloom.sources import publish as P


def keys(df):
    return sorted(r.id for r in df.collect())


def files(folder, start="part-"):
    return sorted(n for n in os.listdir(folder) if n.startswith(start))


def test_publish_and_refuse(spark, tmp_path):
    folder = str(tmp_path / "art")
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, folder)
    first = P.publish(spark.range(100).repartition(3), folder, {"keys": P.unique("id"), "size": P.at_least(0.9)})
    assert first["rows"] == 100 and first["before"] is None and keys(P.read_published(spark, folder)) == list(range(100))
    parts = files(folder)
    for df, reason in ((spark.range(50), "check size failed"), (spark.range(100).union(spark.range(9)), "check keys failed"), (spark.range(99).union(spark.createDataFrame([(None,)], "id long")), "keys")):
        with pytest.raises(P.Refused, match=reason):
            P.publish(df, folder, {"keys": P.unique("id"), "size": P.at_least(0.9)})
        assert files(folder) == parts and not files(folder, "staged-") or files(folder, "staged-") == [f"staged-{first['run']}.json"]
        assert keys(P.read_published(spark, folder)) == list(range(100))
    second = P.publish(spark.range(95), folder, {"size": P.at_least(0.9)})
    assert second["before"] == first["run"] and keys(P.read_published(spark, folder)) == list(range(95))
    P.prune(folder)
    assert files(folder) == sorted(p["name"] for p in second["parts"])


def test_a_failing_task_leaves_the_old_rows(spark, tmp_path):
    folder = str(tmp_path / "art")
    P.publish(spark.range(10), folder)
    before = files(folder)

    def boom(batches):
        for batch in batches:
            if 77 in batch.column(0).to_pylist():
                raise ValueError("this task is lost")
            yield batch

    with pytest.raises(Exception, match="this task is lost"):
        P.publish(spark.range(100).repartition(8).mapInArrow(boom, "id long"), folder)
    assert keys(P.read_published(spark, folder)) == list(range(10))
    P.prune(folder)  # a task that was killed may have closed its part after the run was discarded
    assert files(folder) == before and not files(folder, "staged-")


def test_a_damaged_part_is_refused(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "art")
    P.publish(spark.range(10), folder)
    real = P._damaged

    def tampered(spark, folder, parts):
        with open(f"{folder}/{parts[0]['name']}", "r+b") as f:
            f.seek(20)
            f.write(b"x")
        return real(spark, folder, parts)

    monkeypatch.setattr(P, "_damaged", tampered)
    with pytest.raises(P.Refused, match="not what was written"):
        P.publish(spark.range(30), folder)
    assert keys(P.read_published(spark, folder)) == list(range(10))


def test_no_rows(spark, tmp_path):
    P.publish(spark.range(0), str(tmp_path / "a"))
    assert P.read_published(spark, str(tmp_path / "a")).count() == 0


def test_builds(spark, tmp_path):
    calls = []
    broken = []

    def evens(n):
        calls.append("evens")
        return n.where("id % 2 = 0")

    def total(e):
        calls.append("total")
        return e.agg(F.sum("id").alias("id"))

    def fetched(n):
        if broken:
            raise OSError("no answer")
        return n.where("id < 3")

    def both(t, f):
        calls.append("both")
        return t.union(f)

    stages = [P.Stage("evens", ("n",), evens), P.Stage("total", ("evens",), total), P.Stage("fetched", ("n",), fetched, fallback=True), P.Stage("both", ("total", "fetched"), both)]
    run = lambda n: P.build(spark, str(tmp_path / "b"), {"n": n}, stages)
    tables, report = run(spark.range(10))
    assert [s for _, s in report] == ["made"] * 4 and keys(tables["both"]) == [0, 1, 2, 20]
    assert [s for _, s in run(spark.range(10).repartition(5))[1]] == ["kept"] * 4 and len(calls) == 3
    odd = spark.range(10).union(spark.createDataFrame([(11,)], "id long"))  # evens comes out equal
    assert [s for _, s in run(odd)[1]] == ["made", "kept", "made", "kept"]
    broken.append(1)
    tables, report = run(spark.range(12))
    assert dict(report) == {"evens": "made", "total": "made", "fetched": "degraded", "both": "made"} and keys(tables["both"]) == [0, 1, 2, 30]
    broken.clear()
    assert dict(run(spark.range(12))[1])["fetched"] == "made"
    with pytest.raises(ValueError, match="cannot be read"):
        P.build(spark, str(tmp_path / "c"), {}, [P.Stage("x", ("nothing",), evens)])

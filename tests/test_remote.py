"""A remote set that answers from memory, logs what it was asked, refuses and loses rows on demand."""

import json
import sys
import uuid
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from claimloom.sources import remote as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])
RECORDS = [{"key": f"{'abc'[i // 12 % 3]}{i:03}", "year": None if i % 17 == 0 else 1990 + i % 12} for i in range(150)]


class Server:
    """options: log (folder of one file a request), refuse / crash (start positions), lossy (page sizes that lose their last record)."""

    def __init__(self, options):
        self.options = options

    def records(self, piece):
        return sorted((r for r in RECORDS if piece.within(r["year"], r["key"])), key=lambda r: r["key"])

    def count(self, piece):
        return len(self.records(piece))

    def page(self, piece, start, size):
        log = Path(self.options["log"])
        (log / uuid.uuid4().hex).write_text(json.dumps([piece.name, start, size]))
        if (log.parent / "refusing").exists() and start >= 20:
            raise R.Refused(429, 0.01)
        if (log.parent / "crashing").exists() and start >= 40:
            raise RuntimeError("the machine went away")
        found = self.records(piece)[start : start + size]
        if str(size) in self.options.get("lossy", "").split(","):
            found = found[:-1] + ([{"key": "zzz", "year": 1800}] if piece.first == 1995 else [])
        return found


class Remote(R.RemotePages):
    @classmethod
    def name(cls):
        return "test_remote"

    def client(self):
        return Server(dict(self.options))


@pytest.fixture
def options(tmp_path):
    (tmp_path / "log").mkdir()
    return {"cache": str(tmp_path / "cache"), "log": str(tmp_path / "log"), "first": "1985", "fine_from": "1995", "last": "2001", "page_size": "10", "interval": "0", "lanes": "3"}


def asked(options):
    return [tuple(json.loads(p.read_text())) for p in Path(options["log"]).iterdir()]


def test_filters_narrow_what_is_asked(spark, options):
    spark.dataSource.register(Remote)
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    try:
        read = lambda: spark.read.format("test_remote").options(**options, pushdown="true").load()
        got = read().where("year between 1993 and 1996 and key like 'b%'").collect()
        assert sorted(r.key for r in got) == sorted(r["key"] for r in RECORDS if r["year"] in range(1993, 1997) and r["key"][0] == "b")
        assert {name for name, _, _ in asked(options)} == {"1993-1994/b", "1995-1995/b", "1996-1996/b"}
        n = len(asked(options))
        assert read().where("year = 1995 and key like 'b%'").count() > 0 and len(asked(options)) == n  # from the folder
        assert read().rdd.getNumPartitions() == 3
        assert sorted(r.key for r in read().collect()) == sorted(r["key"] for r in RECORDS)
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_narrowed_slices():
    reader = R.FilteredReader(None, {})
    reader._between(1990, None)
    reader._between(None, 1999)
    reader.prefix = "ab"
    assert reader.narrowed([R.Slice(1980, 1989), R.Slice(1985, 1995), R.Slice(2000, None), R.Slice(None, None), R.Slice(1999, 1999, "abc"), R.Slice(1999, 1999, "x")]) == [R.Slice(1990, 1995, "ab"), R.Slice(1999, 1999, "abc")]


def stream(spark, options, out, run):
    spark.dataSource.register(Remote)
    q = spark.readStream.format("test_remote").options(**options, run=run, batch_pages="3").load().writeStream.format("parquet").option("checkpointLocation", f"{out}/check").start(f"{out}/rows")
    try:
        q.processAllAvailable()
        return None
    except Exception as e:
        return str(e)
    finally:
        q.stop()


@pytest.mark.parametrize("trouble, says", [("crashing", "went away"), ("refusing", "Stopped")])
def test_a_killed_run_resumes_without_reading_twice(spark, options, tmp_path, trouble, says):
    options |= {"slices": json.dumps([[None, None, ""], [1985, 2001, ""]]), "lanes": "1"}
    (tmp_path / trouble).touch()
    assert says in stream(spark, options, tmp_path / "out", "first")
    done, failed = R.manifest(options["cache"])["done"], {a for a in asked(options) if a[1] >= (20 if trouble == "refusing" else 40)}
    first = asked(options)
    assert 0 < done < 16 and len(failed) == 1
    if trouble == "refusing":
        assert len([a for a in first if a in failed]) == R.REFUSALS  # then nothing more was sent
        assert "Stopped" in stream(spark, options, tmp_path / "out", "first") and len(asked(options)) == len(first)  # the stop is the run's
    (tmp_path / trouble).unlink()
    assert stream(spark, options, tmp_path / "out", "second") is None
    rows = spark.read.parquet(str(tmp_path / "out" / "rows"))
    assert sorted(r.key for r in rows.collect()) == sorted(r["key"] for r in RECORDS)
    counts = {a: asked(options).count(a) for a in asked(options)}
    assert all(n == 1 for a, n in counts.items() if a not in failed) and len(counts) == 16
    assert R.manifest(options["cache"])["done"] >= 15  # Spark commits a batch when it makes the next
    n = len(asked(options))
    assert stream(spark, options, tmp_path / "out", "third") is None and len(asked(options)) == n
    assert spark.read.parquet(str(tmp_path / "out" / "rows")).count() == len(RECORDS)


def test_offline(spark, options):
    spark.dataSource.register(Remote)
    options["slices"] = json.dumps([[1995, 1995, ""]])
    read = lambda **more: spark.read.format("test_remote").options(**{**options, **more}).load()
    with pytest.raises(Exception, match="Offline"):
        read(offline="true").collect()
    online = sorted(map(tuple, read().collect()))
    n = len(asked(options))
    assert sorted(map(tuple, read(offline="true").collect())) == online and len(asked(options)) == n
    with pytest.raises(Exception, match="Offline"):
        read(offline="true", page_size="7").collect()


def test_budget_of_a_run(spark, options, tmp_path):
    options |= {"slices": json.dumps([[1985, 2001, ""]]), "budget": "4"}
    for run, pages in (("a", 4), ("b", 8), ("c", 12), ("d", 15)):
        assert stream(spark, options, tmp_path / "out", run) is None
        assert len(asked(options)) == min(pages, 15)


def test_enumeration_goes_on_until_it_is_complete(spark, options):
    options["lossy"] = "10,5"  # large pages lose a record each, one brings a record that nobody asked for
    rows, report = R.enumerate_set(spark, Remote, options, "abc")
    assert sorted(r.key for r in rows.collect()) == sorted(r["key"] for r in RECORDS)
    got = {r.slice: r for r in report.collect()}
    assert all(r.complete for r in got.values()) and max(r.rounds for r in got.values()) == 3 and got["2002-/"].rounds == 1
    assert sum(r.announced for r in got.values()) == len(RECORDS)


def test_an_incomplete_set_says_so(spark, options):
    options["lossy"] = "10,5,2,1"
    rows, report = R.enumerate_set(spark, Remote, options, "abc", rounds=2)
    bad = report.where("not complete").collect()
    assert bad and all(r.paged < r.announced for r in bad) and rows.where(F.col("key") == "zzz").count() == 0


def test_pauses_keep_the_interval_over_all_lanes(tmp_path, monkeypatch):
    now, sent = [0.0], []
    monkeypatch.setattr(R.time, "monotonic", lambda: now[0])
    monkeypatch.setattr(R.time, "sleep", lambda s: now.__setitem__(0, now[0] + s))

    class Quick:
        def page(self, piece, start, size):
            sent.append(now[0])
            return []

    for lane in range(3):
        now[0] = 0.0
        desk = R.Desk(Quick(), {"cache": str(tmp_path), "interval": "2"}, lane, 3)
        for i in range(4):
            desk.page(R.Slice(prefix=str(lane)), i, 1)
    times = sorted(sent)
    assert len(times) == 12 and all(b - a >= 2 for a, b in zip(times, times[1:]))

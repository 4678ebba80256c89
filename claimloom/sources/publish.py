"""An artifact that changes whole or not at all, and builds that run again only what changed.

Published rows lie in parts that a small manifest names; readers follow the manifest. The sink `published` stages parts: each task writes one and
tells its rows, bytes and digest; the commit notes them, an abort (a task failed for good) deletes them. publish() then has every part read again and
compared with what its task told, asks the caller's checks about the new rows and the ones before, and only then moves the new manifest into place.
Whatever refuses leaves the old artifact as it was.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from claimloom.sources.remote import Shared

Check = Callable[[DataFrame, "DataFrame | None"], bool]


class Refused(RuntimeError):
    """The new rows were not published; the old ones stand."""


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int
    bytes: int
    sha256: str


class _Hashed:
    """A stream that hashes what is written through it."""

    def __init__(self, stream):
        self.stream, self.digest, self.bytes, self.closed = stream, hashlib.sha256(), 0, False

    def write(self, data) -> int:
        self.digest.update(data)
        self.bytes += len(data)
        return self.stream.write(data)

    def flush(self) -> None:
        self.stream.flush()

    def tell(self) -> int:
        return self.bytes

    def close(self) -> None:
        self.closed = True
        self.stream.close()


class Parts(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.fields = options, schema

    def write(self, iterator: Iterator) -> Part:
        import pyarrow as pa
        import pyarrow.parquet as pq

        shared, name, rows, writer, out = Shared(self.options["path"]), f"part-{self.options['run']}-{uuid.uuid4().hex}.parquet", 0, None, None
        try:
            for batch in iterator:
                if writer is None:
                    out = _Hashed(shared.fs.open_output_stream(f"{shared.root}/{name}"))
                    writer = pq.ParquetWriter(pa.PythonFile(out, mode="w"), batch.schema)
                rows += batch.num_rows
                writer.write_batch(batch)
        finally:
            if writer is not None:
                writer.close()
                out.close()
        return Part(name, rows, out.bytes, out.digest.hexdigest()) if writer is not None else Part("", 0, 0, "")

    def commit(self, messages: list[Part | None]) -> None:
        staged = [vars(m) for m in messages if m is not None and m.name]
        Shared(self.options["path"]).write(f"staged-{self.options['run']}.json", json.dumps({"run": self.options["run"], "schema": self.fields.json(), "parts": staged}).encode())

    def abort(self, messages: list[Part | None]) -> None:
        discard(self.options["path"], self.options["run"])


class Published(DataSource):
    """df.write.format("published").option("path", folder).option("run", name).mode("append").save() stages parts."""

    @classmethod
    def name(cls) -> str:
        return "published"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return Parts(dict(self.options), schema)


def discard(folder: str, run: str) -> None:
    """Deletes what a run has staged, parts of failed tasks too, but nothing that the manifest names."""
    shared = Shared(folder)
    kept = {p["name"] for p in (manifest(folder) or {"parts": []})["parts"]}
    for name in [*shared.names(f"part-{run}-"), *shared.names(f"staged-{run}.json")]:
        if name not in kept:
            shared.fs.delete_file(f"{shared.root}/{name}")


def manifest(folder: str) -> dict[str, Any] | None:
    stored = Shared(folder).read("manifest.json")
    return json.loads(stored) if stored else None


def _rows(spark: SparkSession, folder: str, named: dict[str, Any] | None) -> DataFrame | None:
    if named is None:
        return None
    schema = StructType.fromJson(json.loads(named["schema"]))
    paths = [f"{folder}/{p['name']}" for p in named["parts"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_published(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that the manifest names; an error if nothing was ever published."""
    rows = _rows(spark, folder, manifest(folder))
    if rows is None:
        raise FileNotFoundError(f"{folder} has no manifest")
    return rows


def _damaged(spark: SparkSession, folder: str, parts: list[dict[str, Any]]) -> list[str]:
    """Names of parts whose bytes, digest or rows are not those that were told; each part is read by one task."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        shared = Shared(folder)
        for batch in batches:
            bad = []
            for p in batch.to_pylist():
                digest, n = hashlib.sha256(), 0
                try:
                    with shared.fs.open_input_file(f"{shared.root}/{p['name']}") as f:
                        while block := f.read(1 << 22):
                            digest.update(block)
                            n += len(block)
                    whole = (n, digest.hexdigest()) == (p["bytes"], p["sha256"]) and pq.read_metadata(f"{shared.root}/{p['name']}", filesystem=shared.fs).num_rows == p["rows"]
                except (OSError, pa.ArrowInvalid):
                    whole = False
                if not whole:
                    bad.append(p["name"])
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["name"])

    told = spark.createDataFrame([(p["name"], p["rows"], p["bytes"], p["sha256"]) for p in parts], "name string, rows long, bytes long, sha256 string")
    return sorted(r.name for r in told.repartition(max(1, len(parts))).mapInArrow(run, "name string").collect())


def publish(df: DataFrame, folder: str, checks: dict[str, Check] | None = None) -> dict[str, Any]:
    """Publishes df as the folder's new rows and gives back the manifest, or raises Refused with every reason."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    Shared(folder)
    spark.dataSource.register(Published)
    try:
        df.write.format("published").option("path", folder).option("run", run).mode("append").save()
        shared = Shared(folder)
        staged = json.loads(shared.read(f"staged-{run}.json"))
        reasons = [f"{name} is not what was written" for name in _damaged(spark, folder, staged["parts"])]
        if not reasons:
            new, old = _rows(spark, folder, staged), _rows(spark, folder, manifest(folder))
            reasons = [f"check {name} failed" for name, check in (checks or {}).items() if not check(new, old)]
        if reasons:
            raise Refused("; ".join(reasons))
        staged |= {"rows": sum(p["rows"] for p in staged["parts"]), "before": (manifest(folder) or {}).get("run")}
        shared.write("manifest.json", json.dumps(staged).encode())
        return staged
    except BaseException:
        discard(folder, run)
        raise


def prune(folder: str) -> None:
    """Deletes parts that no manifest names any more, those of tasks that outlived their run's end too; for times when nobody reads the rows before."""
    shared, kept = Shared(folder), {p["name"] for p in (manifest(folder) or {"parts": []})["parts"]}
    for name in shared.names("part-") + shared.names("staged-"):
        if name not in kept:
            shared.fs.delete_file(f"{shared.root}/{name}")


def at_least(share: float) -> Check:
    """No fewer rows than a share of the ones before."""
    return lambda new, old: old is None or new.count() >= share * old.count()


def unique(*key: str) -> Check:
    """No key twice, none with a null."""
    return lambda new, old: new.where(" or ".join(f"`{k}` is null" for k in key)).isEmpty() and new.groupBy(*key).count().where("count > 1").isEmpty()


class Stage(NamedTuple):
    """A step of a build: its name, what it reads (sources or earlier stages), how, and whether its previous rows may stand in when it fails."""

    name: str
    reads: tuple[str, ...]
    make: Callable[..., DataFrame]
    fallback: bool = False


def content(df: DataFrame) -> str:
    """A digest of a table's rows that neither their order nor their partitions change."""
    columns = sorted(df.columns)
    null = [F.col(c).isNull() for c in columns]
    sums = [F.sum(F.xxhash64(F.lit(i), *columns, *null).cast("decimal(38,0)")) for i in range(2)]
    return hashlib.sha256(repr((columns, *df.agg(F.count("*"), *sums).first())).encode()).hexdigest()


def build(spark: SparkSession, folder: str, sources: dict[str, DataFrame], stages: list[Stage]) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """(tables, report) of a graph of stages, in order; report: (stage, 'made', 'kept' or 'degraded').

    A stage is made again if its code or anything it reads has other content than when its rows were published; what comes out equal leaves the stages
    behind it alone. A stage that fails ends the build, or, where it may, its rows of last time stand in and it counts as degraded and is tried again.
    """
    tables, digests, report = dict(sources), {n: content(df) for n, df in sources.items()}, []
    for stage in stages:
        missing = [r for r in stage.reads if r not in tables]
        if missing or stage.name in tables:
            raise ValueError(f"stage {stage.name}: {missing or 'its name'} cannot be read" if missing else f"two tables are named {stage.name}")
        where, shared = f"{folder}/{stage.name}", Shared(f"{folder}/{stage.name}")
        read = hashlib.sha256(repr((inspect.getsource(stage.make), [digests[r] for r in stage.reads])).encode()).hexdigest()
        known = json.loads(shared.read("read.json") or b"{}")
        state = "kept" if known.get("read") == read and manifest(where) else "made"
        if state == "made":
            try:
                publish(stage.make(*[tables[r] for r in stage.reads]), where)
                known = {"read": read, "content": content(read_published(spark, where))}
                shared.write("read.json", json.dumps(known).encode())
            except Exception:
                if not (stage.fallback and manifest(where)):
                    raise
                state = "degraded"
        tables[stage.name], digests[stage.name] = read_published(spark, where), known["content"]
        report.append((stage.name, state))
    return tables, report

"""A remote set as a Spark source: polite, resumable, complete or said to be incomplete.

A set is asked slice by slice (years, then prefixes of keys), a slice page by page. Which client does the asking is up to the caller:
RemotePages is subclassed with a client that counts a slice and gives a page of it. Requests run in `lanes`, each a partition with its own
pauses, so that all lanes together keep the interval; how many executors there are does not change the rate.

* Every page that came is stored in a folder all tasks reach (any file system pyarrow names), under a name made of the request, in one
  move. A task that runs again, a run that was killed, and an offline run read it from there.
* The second refusal of a run stops the run, in all its tasks: nothing more is sent. What the folder has is still served.
* As a stream the offset is the number of pages done of a plan that is written once; a run that was killed goes on behind the last
  batch that Spark committed, and the folder's manifest says which that is.
* As a batch source with the option pushdown, filters on year and key narrow the slices that are asked at all.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from claimloom.session import cut
from claimloom.sources.pages import year_slices

#: Refusals that end a run, the longest wait a server may ask for, and attempts at a request that fails otherwise.
REFUSALS, LONGEST_WAIT, ATTEMPTS = 2, 300, 3
PAGE_SIZES = (100, 50, 25)
SCHEMA = "slice string, position long, year int, key string, record string"


class Slice(NamedTuple):
    """Years from first to last (both null: records without a year) and keys with a prefix."""

    first: int | None = None
    last: int | None = None
    prefix: str = ""

    @property
    def name(self) -> str:
        return f"{'' if self.first is None else self.first}-{'' if self.last is None else self.last}/{self.prefix}"

    def within(self, year: int | None, key: str) -> bool:
        if (self.first, self.last) == (None, None):
            fits = year is None
        else:
            fits = year is not None and (self.first is None or year >= self.first) and (self.last is None or year <= self.last)
        return fits and key.startswith(self.prefix)


class Client(Protocol):
    def count(self, piece: Slice) -> int: ...

    def page(self, piece: Slice, start: int, size: int) -> list[dict[str, Any]]:
        """Records with key and year, in a stable order; raises Refused where the server asks to stop."""


class Refused(Exception):
    def __init__(self, status: int, retry_after: float | None = None):
        super().__init__(f"refused with {status}")
        self.status, self.retry_after = status, retry_after


class Stopped(RuntimeError):
    """The run has been refused too often; nothing more is sent."""


class Offline(RuntimeError):
    """A page that is not in the folder was asked for offline."""


class Shared:
    """Files in a folder of any file system, written whole or not at all."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
        self.fs.create_dir(self.root, recursive=True)

    def read(self, name: str) -> bytes | None:
        try:
            with self.fs.open_input_stream(f"{self.root}/{name}") as f:
                return f.read()
        except FileNotFoundError:
            return None

    def age(self, name: str) -> float | None:
        info = self.fs.get_file_info(f"{self.root}/{name}")
        return time.time() - info.mtime_ns / 1e9 if info.is_file else None

    def write(self, name: str, data: bytes) -> None:
        part = f"{self.root}/.{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as f:
            f.write(data)
        self.fs.move(part, f"{self.root}/{name}")

    def names(self, start: str) -> list[str]:
        from pyarrow import fs

        return [i.base_name for i in self.fs.get_file_info(fs.FileSelector(self.root)) if i.base_name.startswith(start)]


class Desk:
    """One lane's requests: from the folder, else live, with a pause before each."""

    def __init__(self, client: Client, options: dict[str, str], lane: int = 0, lanes: int = 1):
        self.client, self.shared = client, Shared(options["cache"])
        self.run, self.offline = options.get("run", "run"), options.get("offline", "false").lower() == "true"
        self.interval, self.refresh = float(options.get("interval", "3")), float(options.get("refresh_days", "0")) * 86400
        self.pause, self.next = self.interval * lanes, time.monotonic() + self.interval * (lane + 1)

    def page(self, piece: Slice, start: int, size: int) -> list[dict[str, Any]]:
        name = "page-" + hashlib.sha256(json.dumps([*piece, start, size]).encode()).hexdigest()[:32]
        stored = self.shared.read(name)
        if stored is not None and (self.offline or not self.refresh or (self.shared.age(name) or 0) <= self.refresh):
            return json.loads(stored)
        if self.offline:
            raise Offline(f"{piece.name} from {start} is not in {self.shared.root}")
        found = self._live(piece, start, size)
        self.shared.write(name, json.dumps(found).encode())
        return found

    def _live(self, piece: Slice, start: int, size: int) -> list[dict[str, Any]]:
        for attempt in range(1, ATTEMPTS + 1):
            if len(self.shared.names(f"refused-{self.run}-")) >= REFUSALS:
                raise Stopped(f"run {self.run} was refused {REFUSALS} times")
            time.sleep(max(0.0, self.next - time.monotonic()))
            self.next = time.monotonic() + self.pause
            try:
                return self.client.page(piece, start, size)
            except Refused as e:
                self.shared.write(f"refused-{self.run}-{uuid.uuid4().hex}", str(e.status).encode())
                wait = 60 if e.retry_after is None else e.retry_after
                if wait > LONGEST_WAIT:
                    self.shared.write(f"refused-{self.run}-{uuid.uuid4().hex}", b"too long a wait")
                else:
                    self.next = time.monotonic() + wait
            except OSError:
                if attempt == ATTEMPTS:
                    raise
        raise Stopped(f"{piece.name} from {start} was tried {ATTEMPTS} times")


class Lane(InputPartition):
    def __init__(self, number: int, of: int, pages: list[tuple[Slice, int, int]]):
        super().__init__(number)
        self.number, self.of, self.pages = number, of, pages


def _dealt(pages: list[tuple[Slice, int, int]], lanes: int) -> list[Lane]:
    n = max(1, min(lanes, len(pages)))
    return [Lane(i, n, pages[i::n]) for i in range(n)]


def _rows(client: Client, options: dict[str, str], lane: Lane) -> Iterator[tuple]:
    desk = Desk(client, options, lane.number, lane.of)
    for piece, start, size in lane.pages:
        for i, record in enumerate(desk.page(piece, start, size)):
            yield piece.name, start + i, record.get("year"), record["key"], json.dumps(record, sort_keys=True)


def _asked(options: dict[str, str]) -> list[Slice]:
    if "slices" in options:
        return [Slice(*s) for s in json.loads(options["slices"])]
    return [Slice(a, b) for a, b in year_slices(int(options["first"]), int(options["fine_from"]), int(options["last"]))]


def _counted(client: Client, options: dict[str, str], pieces: list[Slice]) -> list[tuple[Slice, int]]:
    """Announced sizes; offline those of the last time, which are kept in the folder."""
    shared, out = Shared(options["cache"]), []
    for piece in pieces:
        name = "count-" + hashlib.sha256(json.dumps([*piece]).encode()).hexdigest()[:32]
        if options.get("offline", "false").lower() == "true":
            stored = shared.read(name)
            if stored is None:
                raise Offline(f"the size of {piece.name} is not in {shared.root}")
            n = int(stored)
        else:
            n = client.count(piece)
            shared.write(name, str(n).encode())
        out.append((piece, n))
    return out


def _pages(counted: list[tuple[Slice, int]], size: int) -> list[tuple[Slice, int, int]]:
    return [(piece, start, size) for piece, n in counted for start in range(0, n, size)]


class RemotePages(DataSource):
    """Subclass with name() and client(). Options: cache; first, fine_from, last or slices (JSON); page_size, lanes, interval, offline, run, refresh_days,
    pushdown, batch_pages (a micro-batch), budget (pages of a run)."""

    def client(self) -> Client:
        raise NotImplementedError

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        pushes = self.options.get("pushdown", "false").lower() == "true"
        return (FilteredReader if pushes else RemoteReader)(self.client(), dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return RemoteStream(self.client(), dict(self.options))


class RemoteReader(DataSourceReader):
    def __init__(self, client: Client, options: dict[str, str]):
        self.asker, self.options = client, options
        self.low: int | None = None
        self.high: int | None = None
        self.dated, self.prefix = False, ""

    def narrowed(self, pieces: list[Slice]) -> list[Slice]:
        out = []
        for p in pieces:
            if not (p.prefix.startswith(self.prefix) or self.prefix.startswith(p.prefix)):
                continue
            prefix = max(p.prefix, self.prefix, key=len)
            if (p.first, p.last) == (None, None):
                if not self.dated:
                    out.append(Slice(None, None, prefix))
                continue
            first = p.first if self.low is None else self.low if p.first is None else max(p.first, self.low)
            last = p.last if self.high is None else self.high if p.last is None else min(p.last, self.high)
            if first is None or last is None or first <= last:
                out.append(Slice(first, last, prefix))
        return out

    def partitions(self) -> list[Lane]:
        counted = _counted(self.asker, self.options, self.narrowed(_asked(self.options)))
        return _dealt(_pages(counted, int(self.options.get("page_size", PAGE_SIZES[0]))), int(self.options.get("lanes", "1")))

    def read(self, partition: Lane) -> Iterator[tuple]:
        return _rows(self.asker, self.options, partition)


class FilteredReader(RemoteReader):
    """With the option pushdown, where the session has spark.sql.python.filterPushdown.enabled."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Narrows what is asked; Spark still checks every row, as a server may answer with rows that were not asked for."""
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            if column == "year":
                if isinstance(f, EqualTo):
                    self._between(f.value, f.value)
                elif isinstance(f, In) and f.value:
                    self._between(min(f.value), max(f.value))
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self._between(f.value + isinstance(f, GreaterThan), None)
                elif isinstance(f, (LessThan, LessThanOrEqual)):
                    self._between(None, f.value - isinstance(f, LessThan))
                elif isinstance(f, IsNotNull):
                    self.dated = True
            elif column == "key" and isinstance(f, StringStartsWith) and f.value.startswith(self.prefix):
                self.prefix = f.value
            yield f

    def _between(self, low: int | None, high: int | None) -> None:
        self.dated = True
        self.low = low if self.low is None else self.low if low is None else max(low, self.low)
        self.high = high if self.high is None else self.high if high is None else min(high, self.high)


class RemoteStream(DataSourceStreamReader):
    """Offsets count the pages of the plan. The plan is made once, from announced sizes, and kept with the manifest."""

    def __init__(self, client: Client, options: dict[str, str]):
        self.asker, self.options = client, options
        self.planned: list[tuple[Slice, int, int]] | None = None
        self.begun: int | None = None
        self.given = 0

    def _plan(self) -> list[tuple[Slice, int, int]]:
        if self.planned is None:
            shared = Shared(self.options["cache"])
            stored = shared.read("plan.json")
            if stored is None:
                pages = _pages(_counted(self.asker, self.options, _asked(self.options)), int(self.options.get("page_size", PAGE_SIZES[0])))
                stored = json.dumps([[list(p), start, size] for p, start, size in pages]).encode()
                shared.write("plan.json", stored)
            self.planned = [(Slice(*p), start, size) for p, start, size in json.loads(stored)]
        return self.planned

    def initialOffset(self) -> dict:
        return {"done": 0}

    def latestOffset(self) -> dict:
        """A batch further than what was committed or given out, within the run's budget."""
        done = max(self.given, manifest(self.options["cache"])["done"])
        self.begun = done if self.begun is None else self.begun
        most = min(len(self._plan()), self.begun + int(self.options.get("budget", str(1 << 40))))
        self.given = max(done, min(most, done + int(self.options.get("batch_pages", "20"))))
        return {"done": self.given}

    def partitions(self, start: dict, end: dict) -> list[Lane]:
        self.given = max(self.given, end["done"])  # of a batch that is run again
        return _dealt(self._plan()[start["done"] : end["done"]], int(self.options.get("lanes", "1")))

    def read(self, partition: Lane) -> Iterator[tuple]:
        return _rows(self.asker, self.options, partition)

    def commit(self, end: dict) -> None:
        if end["done"] > manifest(self.options["cache"])["done"]:
            Shared(self.options["cache"]).write("manifest.json", json.dumps({"done": end["done"], "pages": len(self._plan()), "run": self.options.get("run", "run")}).encode())


def manifest(cache: str) -> dict[str, Any]:
    """What has been committed of the plan."""
    stored = Shared(cache).read("manifest.json")
    return json.loads(stored) if stored else {"done": 0}


def finer(piece: Slice, letters: str) -> list[Slice]:
    """A slice in smaller ones: single years, then one more letter of the key."""
    if piece.first is not None and piece.last is not None and piece.first < piece.last:
        return [Slice(y, y, piece.prefix) for y in range(piece.first, piece.last + 1)]
    return [Slice(piece.first, piece.last, piece.prefix + c) for c in letters]


def enumerate_set(spark: SparkSession, source: type[RemotePages], options: dict[str, str], letters: str, rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows, report): a set paged until the distinct keys of every slice are as many as were announced, or the rounds are over.

    The first round reads all slices with large pages. Slices that came short are read again: with smaller pages, in finer slices whose
    sizes are asked anew. Rows that a slice was not asked for are left out. report: slice, announced, paged, rounds, complete.
    """
    client = source(dict(options)).client()
    open_ = [(s, s, n) for s, n in _counted(client, options, _asked(options))]
    tops = {s.name: n for s, _, n in open_}
    spark.dataSource.register(source)
    found: DataFrame | None = None
    took = dict.fromkeys(tops, 0)
    for turn in range(rounds):
        asked = [p for _, p, n in open_ if n]
        for s, _, _ in open_:
            took[s.name] = turn + 1
        if asked:
            size = PAGE_SIZES[min(turn, len(PAGE_SIZES) - 1)] if "page_size" not in options else max(1, int(options["page_size"]) >> turn)
            got = spark.read.format(source.name()).options(**{**options, "slices": json.dumps(asked), "page_size": str(size)}).load()
            top = spark.createDataFrame([(p.name, s.name, *p) for s, p, _ in open_], "slice string, top string, first int, last int, prefix string")
            undated = F.col("first").isNull() & F.col("last").isNull()
            right = F.when(undated, F.col("year").isNull()).otherwise(F.col("year").isNotNull() & (F.coalesce("first", "year") <= F.col("year")) & (F.coalesce("last", "year") >= F.col("year")))
            kept = got.join(top, "slice").where(right & F.startswith("key", F.col("prefix"))).select("top", "slice", "year", "key", "record")
            kept = cut(kept)
            found = kept if found is None else found.unionAll(kept)
        paged = {} if found is None else {r.top: r.n for r in found.groupBy("top").agg(F.count_distinct("key").alias("n")).collect()}  # a row a slice
        short = {name for name, n in tops.items() if paged.get(name, 0) < n}
        if not short or turn == rounds - 1:
            break
        again = []
        for s, p, n in open_:
            if s.name in short:
                parts = _counted(client, options, finer(p, letters))
                # Where the finer slices hold less than the slice itself, some keys go on in other letters: it stays whole.
                again += [(s, q, m) for q, m in parts] if sum(m for _, m in parts) >= n else [(s, p, n)]
        open_ = again
    report = spark.createDataFrame([(name, n, paged.get(name, 0), took[name], paged.get(name, 0) == n) for name, n in tops.items()], "slice string, announced long, paged long, rounds int, complete boolean")
    if found is None:
        return spark.createDataFrame([], "slice string, year int, key string, record string"), report
    first = found.groupBy(F.col("top").alias("slice"), "key").agg(F.min(F.struct("year", "record")).alias("r"))
    return first.select("slice", "r.year", "key", "r.record"), report

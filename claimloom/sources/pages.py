"""Sources: cached pages behind a Python data source, previous snapshots, corrections; and the sinks beside them.

Nothing here talks to a network: a cache folder of JSON pages stands for the remote set. A page is
one partition, so pages are read in parallel and a lost task re-reads one page. read_cached() lists and reads the folder with
Spark's own readers; the data source cached_pages does so through pyarrow's file systems.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class Page(InputPartition):
    def __init__(self, path: str):
        self.path = path


class CachedPagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.announced = options["path"], options.get("announced")

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{self.folder}")

    def partitions(self) -> list[Page]:
        from pyarrow import fs

        where, root = self._files()
        found = where.get_file_info(fs.FileSelector(root))
        return [Page(i.path) for i in sorted(found, key=lambda i: i.base_name) if i.base_name.startswith("page-") and i.base_name.endswith(".json")]

    def read(self, partition: Page) -> Iterator[tuple]:
        with self._files()[0].open_input_stream(partition.path) as f:
            page = json.loads(f.read())
        for i, record in enumerate(page["records"]):
            yield page["offset"] + i, record.get("key"), json.dumps(record, sort_keys=True)


class CachedPages(DataSource):
    """spark.read.format("cached_pages").load(folder): position, key, record (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "cached_pages"

    def schema(self) -> str:
        return "position long, key string, record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return CachedPagesReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CachedPages)


def read_cached(spark: SparkSession, folder: str) -> DataFrame:
    """position, key, record (JSON) of the pages in a folder of any file system that Spark reads."""
    page = F.from_json("value", "offset long, records array<string>")
    pages = spark.read.option("wholetext", True).option("pathGlobFilter", "page-*.json").text(folder).select(page.alias("p"))
    each = pages.select(F.col("p.offset").alias("offset"), F.posexplode("p.records").alias("i", "record"))
    return each.select((F.col("offset") + F.col("i")).alias("position"), F.get_json_object("record", "$.key").alias("key"), "record")


def year_slices(first: int, fine_from: int, last: int, coarse: int = 10) -> list[tuple[int | None, int | None]]:
    """Slices of a set by year: coarse ones up to fine_from, then one a year, an open end, and those without a year."""
    out: list[tuple[int | None, int | None]] = [(y, min(y + coarse, fine_from) - 1) for y in range(first, fine_from, coarse)]
    return [*out, *[(y, y) for y in range(fine_from, last + 1)], (last + 1, None), (None, None)]


def complete(rows: DataFrame, key: str, announced: int) -> DataFrame:
    """One row: announced and distinct paged keys, and whether the set is complete."""
    return rows.agg(F.lit(announced).alias("announced"), F.countDistinct(key).alias("paged")).withColumn("complete", F.col("announced") == F.col("paged"))


def foreign(rows: DataFrame, predicate) -> DataFrame:
    """Rows that do not match the predicate that was asked for: a crossed result; the reader's caller asserts none."""
    return rows.where(~F.coalesce(predicate, F.lit(False)))


def channels(*sets: DataFrame, key: str) -> DataFrame:
    """Union of channels by name; of equal keys the record of the first channel stays."""
    out = None
    for i, s in enumerate(sets):
        s = s.withColumn("__c", F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    first = out.groupBy(key).agg(F.min("__c").alias("__c"))
    return out.join(first, [key, "__c"]).drop("__c").dropDuplicates([key])


def missing_parents(rows: DataFrame, have: DataFrame, parent: str, key: str) -> DataFrame:
    """Parent keys that rows name and nobody has fetched yet."""
    return rows.where(F.col(parent).isNotNull()).select(F.col(parent).alias(key)).distinct().join(have.select(key), key, "left_anti")


def stale(cache: DataFrame, key: str, days: int = 60) -> DataFrame:
    """Negative cache entries old enough to be asked again, and keys never asked."""
    return cache.where(F.col("record").isNull() & ((F.col("age_days") > days) | F.col("age_days").isNull())).select(key)


def previous_snapshot(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A snapshot in an expected shape; columns that an older file lacks are null."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def corrections(spark: SparkSession, path: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """A JSON array of corrections: (valid entries, entries that lack a required key with the reason)."""
    rows = spark.read.option("multiLine", True).schema(schema).json(path)
    lacking = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    rows = rows.withColumn("lacking", F.array_join(lacking, ","))
    return rows.where("lacking = ''").drop("lacking"), rows.where("lacking <> ''")


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; tabs and line ends inside values become spaces."""
    clean = df.select(*[F.regexp_replace(F.col(c).cast("string"), "[\\t\\r\\n]+", " ").alias(c) for c in df.columns])
    clean.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").csv(path)


def replace_if_complete(df: DataFrame, path: str, ok: bool) -> bool:
    """Overwrites a snapshot only when the new set is complete; else the previous one stays."""
    if ok:
        df.write.mode("overwrite").parquet(path)
    return ok

"""Session helpers: configuration for tests and benches, table reading, durable lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bounds of an Arrow batch that goes to a Python worker.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4000


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """The rows dealt by their key over as many tasks as the cluster has cores, twice over: a small file is one task, however long a row takes."""
    sc = df.sparkSession.sparkContext
    return df.repartition(max(2 * sc.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *key)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only where no folder is named and Spark runs in one JVM, as in tests, is a temporary one set; a cluster without one is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir names no shared folder")
            named = tempfile.mkdtemp(prefix="claimloom-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
        current = sc._jsc.sc().getCheckpointDir()
    return current.get()


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB, so that Python workers never hold thousands of whole texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a table in the shared folder, which outlives lost executors.

    The plan runs once (a checkpoint runs it a second time to write it), and columns are compressed. The table can be
    given back by release() when nothing reads it any more.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    folder = f"{checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._cut_folder = folder
    return out


def release(*tables: DataFrame | None) -> None:
    """Deletes tables that cut() wrote, once all that reads them has been written itself."""
    for df in tables:
        folder = getattr(df, "_cut_folder", None)
        if folder:
            jvm = df.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            df._cut_folder = None

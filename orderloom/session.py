"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: list[tempfile.TemporaryDirectory] = []
SMALL_SIDE = 100_000  # parameter: the most rows of a staged side of a join that is left to Spark, which may broadcast it
_STAGED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_JOBS: list[list[str]] = []  # the scratch folders of the jobs that are running, innermost last


def local_session(app: str = "orderloom", cpus: str = "8", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        # sides that prove small after the shuffle are joined by hash, without sorting either one
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        # the tables here are small: partitions of the default 64 MB would leave most threads idle
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without an offset are read as UTC, whatever the host clock says."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies."""
    files, target = _files(spark, path)
    files.delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if there is no such folder."""
    files, target = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()] if files.exists(target) else []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    On a cluster that setting names a folder every executor can reach. Only a local session that
    leaves it unset gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if not _LOCAL_ROOTS:
            _LOCAL_ROOTS.append(tempfile.TemporaryDirectory(prefix="orderloom-"))
            atexit.register(_LOCAL_ROOTS[0].cleanup)
        root = _LOCAL_ROOTS[0].name
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    if _JOBS:
        _JOBS[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made inside when it ends, also after a failure."""
    _JOBS.append([])
    try:
        yield
    finally:
        for path in _JOBS.pop():
            remove(spark, path)


def cleared(job):
    """Let a job (spark, ...) delete its scratch folders. Its result must not read them."""

    @wraps(job)
    def run(spark: SparkSession, *args, **options):
        with scratch(spark):
            return job(spark, *args, **options)

    return run


def stage(spark: SparkSession, df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors. ``codec`` is worth setting
    where rows are long and full of texts that come again."""
    path = scratch_path(spark, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _STAGED[staged] = path
    return staged


def drop_stage(staged: DataFrame) -> None:
    """Delete the folder of a staged frame before its job ends. Nothing may read it any more."""
    remove(staged.sparkSession, _STAGED.pop(staged))


def unsent(side: DataFrame, rows: int) -> DataFrame:
    """A side of a join with so many rows, which is never broadcast if these are many. Spark judges staged rows by the size of their compressed
    files, and a broadcast passes through the driver's memory: nine million order numbers are about a gigabyte there and eight megabytes by Spark's judgement."""
    return side.hint("merge") if rows > SMALL_SIDE else side

"""Session settings that the operators assume."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast


def build(app: str = "gleaner", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; master and shuffle partitions only when given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gleaner-")).resolve() / "gleaner.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This application's place in the folder that driver and executors share (spark.checkpoint.dir).

    Where none is set, a folder of our own if driver and executors are one process, as in tests; else an error, as each
    machine would write to its own disk.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share; the master is {master}")
        at = f"file://{tempfile.mkdtemp(prefix='gleaner-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/gleaner-{spark.sparkContext.applicationId}"


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clean(spark: SparkSession) -> None:
    """Removes this application's intermediate tables. Results of operators read them: call it when those are done with."""
    delete(spark, shared_folder(spark))


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Within it intermediate tables go to a folder that is removed at its end: write what they lead to before that."""
    at = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    before = _scratch.set(at)
    try:
        yield
    finally:
        _scratch.reset(before)
        delete(spark, at)


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends, and a lost executor loses nothing."""
    at = f"{_scratch.get() or shared_folder(df.sparkSession) + '/tables'}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def brought(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """df written, and broadcast to what it joins if it has at most so many rows: the other side then stays where it lies."""
    df = written(df)
    return broadcast(df) if df.count() <= most else df


def spread(df: DataFrame, rows: int, *keys: str, each: int = 500_000) -> DataFrame:
    """df, of about so many rows, dealt by keys for aggregates and joins on them: a task gets about `each` rows however large df is.
    Few rows are dealt as adaptive execution sees fit."""
    spark, n = df.sparkSession, rows // each
    if n <= spark.sparkContext.defaultParallelism:
        return df.repartition(*keys)
    return df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Holds a session setting at value for what is executed within."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)

"""What the training-data operators share: Arrow batches, column names and expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gleaner.session import setting, shared_folder, ship, written  # noqa: F401  shared with the rest of the library

#: Word separators of the contracts: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "512"


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch, so that a batch of long texts fits a Python worker. Spark reads this setting when a
    result is executed, so it stays; a value that the caller has set is left alone."""
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def in_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    ship(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(f, schema)


def whole_numbers(df: DataFrame, key: str) -> None:
    """Refuses a key that is no whole number: the operator orders and links documents by it, and a cast would lose it."""
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        raise TypeError(f"column {key} is {df.schema[key].dataType.simpleString()}, not a whole number")


def shielded(df: DataFrame) -> tuple[DataFrame, Callable[[str], str], Callable[[DataFrame], DataFrame]]:
    """df with neutral column names, what a name has become, and how to get the columns of df back from a result.

    Added columns then clash with no column of df, whatever its names.
    """
    names = df.columns
    neutral = [f"_in{i}" for i in range(len(names))]
    return df.toDF(*neutral), lambda name: neutral[names.index(name)], lambda out: out.select(*neutral).toDF(*names)


_kept: dict = {}


def kept(key, make: Callable[[], object]):
    """What make gives for key, kept by this Python worker from task to task until another operator keeps something else:
    a reused worker then holds one operator's cache, not one of each that it has run."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    c = batch.column(batch.schema.get_field_index(name))
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; nulls are empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, at, data = texts.buffers()
    off = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def cut(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most limit bytes together, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once, also where f uses it inside lambdas."""
    return F.transform(F.array(value), f)[0]


def crc_bucket(col: str, n: int):
    return F.crc32(F.col(col).cast("string").cast("binary")) % n

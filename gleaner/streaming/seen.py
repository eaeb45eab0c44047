"""First sight of keys with a state that forgets: a key that stays silent leaves it, and counts as new when it comes again."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleaner.session import ship
from gleaner.streaming.windows import LATENESS, stepped


class FirstSeen(StatefulProcessor):
    """Per key the time it was last seen, in milliseconds, and one timer for when it will have been silent for too long. Emits
    (key, time) when a key is seen that isn't in the state or was silent for longer; the timer clears the state."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        at = np.sort(np.concatenate([np.zeros(0, np.int64), *(r["ms"].to_numpy(np.int64) for r in rows)]))
        last = self.last.get()[0] if self.last.exists() else None
        before = np.concatenate(([at[0] - self.keep - 1 if last is None else last], np.maximum.accumulate(at)[:-1] if last is None else np.maximum(last, at[:-1])))
        new = at[at - before > self.keep]
        until = int(at[-1]) if last is None else max(last, int(at[-1]))
        if last is not None:
            self.handle.deleteTimer(last + self.keep + 1)
        self.last.update((until,))
        self.handle.registerTimer(until + self.keep + 1)
        if len(new):
            yield pd.DataFrame({"who": [str(key[0])] * len(new), "ms": new})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_seen(rows: DataFrame, ts: str, key: str, keep_days: int = 30) -> DataFrame:
    """(key, first_seen) of a stream: a row when a key comes that was not seen in the keep_days before. A key silent for
    longer leaves the state at the watermark, so the state is bounded by the keys of keep_days. Null keys and times don't count; rows later than LATENESS are
    dropped. Times count in milliseconds. The session needs the RocksDB state store (see STORE)."""
    ship(rows.sparkSession)
    kind, keep = dict(rows.dtypes)[key], keep_days * 86_400_000
    x = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).cast("string").alias("who"), F.col(ts).alias("at"), F.unix_millis(F.col(ts).cast("timestamp")).alias("ms"))
    out = x.withWatermark("at", LATENESS).groupBy("who").transformWithStateInPandas(FirstSeen(keep), "who string, ms bigint", "append", "eventtime")
    return out.select(F.col("who").cast(kind).alias(key), F.timestamp_millis("ms").alias("first_seen"))


def debuts(rows: DataFrame, ts: str, key: str, at: str, keep_days: int = 30) -> DataFrame:
    """What first_seen() gives, of large batches: a batch meets the table of the last times of its keys in one shuffle, where
    first_seen() calls Python for every key of a batch. Times count in microseconds; no state store is needed.

    The table forgets keys as the state does: one silent for keep_days at the watermark (the latest time of the batches before, less
    LATENESS) leaves it, and rows behind the watermark are dropped.
    """
    kind, keep = dict(rows.dtypes)[key], F.expr(f"interval {keep_days} days")
    x = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("who"), F.col(ts).cast("timestamp").alias("at"))

    def step(state: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        late = lambda df, c: df.agg((F.max(c) - F.expr(f"interval {LATENESS}")).alias("_mark"))
        mark = F.broadcast(late(state, "last"))  # one row, null before the first batch
        now = batch.crossJoin(mark).where("_mark is null or at >= _mark").select("who", "at", F.lit(1).alias("_new")).distinct()
        both = state.select("who", F.col("last").alias("at"), F.lit(0).alias("_new")).union(now)
        before = F.max("at").over(Window.partitionBy("who").orderBy("_new", "at").rowsBetween(Window.unboundedPreceding, -1))
        out = both.withColumn("_before", before).where((F.col("_new") == 1) & (F.col("_before").isNull() | (F.col("at") > F.col("_before") + keep)))
        last = both.groupBy("who").agg(F.max("at").alias("last"))
        reach = F.broadcast(late(both, "at"))
        kept = last.crossJoin(reach).where(F.col("last") + keep >= F.col("_mark")).select("who", "last")
        return kept, out.select(F.col("who").alias(key), F.col("at").alias("first_seen"))

    return stepped(x, step, f"who {kind}, last timestamp", f"`{key}` {kind}, first_seen timestamp", at)


#: The state store that keeps timers and values of transformWithState.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

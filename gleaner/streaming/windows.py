"""Structured Streaming forms of the windowed operators; each runs until what is available is processed."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gleaner.session import shared_folder

#: Rows may be two days late: results wait that long for names from a second source.
LATENESS = "2 days"


def stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(path)


def shares(rows: DataFrame, ts: str, key: str, width: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Count per sliding window and key."""
    return rows.withWatermark(ts, LATENESS).groupBy(F.window(ts, width, slide), key).agg(F.count(F.lit(1)).alias("n"))


def sessions(rows: DataFrame, ts: str, key: str, gap: str = "30 minutes") -> DataFrame:
    return rows.withWatermark(ts, LATENESS).groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n"))


def first_seen(rows: DataFrame, ts: str, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(ts).alias("first_seen"))


def distinct_within(rows: DataFrame, ts: str, key: str) -> DataFrame:
    """Each key once within the lateness bound; state is dropped beyond it."""
    return rows.withWatermark(ts, LATENESS).dropDuplicatesWithinWatermark([key])


def matched(a: DataFrame, b: DataFrame, key: str, ts_a: str, ts_b: str, within: str, how: str = "inner") -> DataFrame:
    """Rows of b up to `within` after a row of a with the same key; both sides wait for each other by watermark. With
    how="left_outer" a row of a that nothing has matched comes out once the watermark is past its wait."""
    x = a.withWatermark(ts_a, LATENESS)
    y = b.withColumnRenamed(key, "_k").withWatermark(ts_b, LATENESS)
    return x.join(y, (F.col(key) == F.col("_k")) & (F.col(ts_b) >= F.col(ts_a)) & (F.col(ts_b) <= F.col(ts_a) + F.expr(f"interval {within}")), how).drop("_k")


def _place(spark: SparkSession, at: str | None) -> str:
    return at or f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"


def tables(spark: SparkSession, folder: str) -> dict[int, str]:
    """The complete tables of a folder by number. A batch names its table by its own number, and Spark marks it when it is
    whole, so the folder itself says what the last state is: a query that starts again finds it there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return {int(n): f"{folder}/{n}" for n in names if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))}


def settled(df: DataFrame, mode: str = "complete", at: str | None = None) -> DataFrame:
    """Runs the query over what is available and returns its result: the last complete table, or all appended rows.

    State and results live in the shared folder, or in `at`: called again with the same place, the query goes on from
    there. In complete mode each batch writes its own table and the last one counts.
    """
    spark, at = df.sparkSession, _place(df.sparkSession, at)
    if mode == "append":
        q = df.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    else:

        def keep(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{at}/out/{n}")

        q = df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    if mode == "append":
        return spark.read.schema(df.schema).parquet(f"{at}/out")
    done = tables(spark, f"{at}/out")
    return spark.read.schema(df.schema).parquet(done[max(done)]) if done else spark.createDataFrame([], df.schema)


def reruns(slices: Iterable[DataFrame], query: Callable[[DataFrame], DataFrame], at: str | None = None, run: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """What a query appends that is run anew after each slice has arrived, with its state kept between the runs. slices: tables
    of one schema, each no older than those before it by more than LATENESS. run(query, place) settles a run: appended rows unless given."""
    out, run = None, run or (lambda df, at: settled(df, "append", at))
    for rows in slices:
        at = _place(rows.sparkSession, at)
        rows.write.mode("append").parquet(f"{at}/in")
        out = run(query(rows.sparkSession.readStream.schema(rows.schema).parquet(f"{at}/in")), at)
    if out is None:
        raise ValueError("no slice")
    return out


def stepped(rows: DataFrame, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], state: str, schema: str, at: str | None = None) -> DataFrame:
    """Rows that each batch gives beside a state table: step(state, batch) gives the next state and the batch's rows. Returns the
    rows of all batches.

    State and rows are tables named by the batch's number, as in upserted(): a batch that runs again overwrites only its own. The
    rows are written first, so a whole state table vouches for them.
    """
    spark, at = rows.sparkSession, _place(rows.sparkSession, at)

    def keep(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        before = {k: v for k, v in tables(s, f"{at}/table").items() if k < n}
        old = s.read.schema(state).parquet(before[max(before)]) if before else s.createDataFrame([], state)
        new, out = step(old, batch)
        out.write.mode("overwrite").parquet(f"{at}/out/{n}")
        new.write.mode("overwrite").parquet(f"{at}/table/{n}")

    rows.writeStream.foreachBatch(keep).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    whole, given = tables(spark, f"{at}/table"), tables(spark, f"{at}/out")
    done = [given[n] for n in sorted(whole)]
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)


def upserted(rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], schema: str, at: str | None = None) -> DataFrame:
    """A state table that each batch is merged into: merge(state, batch) gives the next state. Returns the last one.

    Every batch writes a new table named by its number, so a batch that runs again overwrites only its own; the last whole
    table before it is its state, also where an earlier run of the query at the same place wrote it.
    """
    spark, at = rows.sparkSession, _place(rows.sparkSession, at)

    def step(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        before = {k: v for k, v in tables(s, f"{at}/table").items() if k < n}
        state = s.read.schema(schema).parquet(before[max(before)]) if before else s.createDataFrame([], schema)
        merge(state, batch).write.mode("overwrite").parquet(f"{at}/table/{n}")

    rows.writeStream.foreachBatch(step).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    done = tables(spark, f"{at}/table")
    return spark.read.schema(schema).parquet(done[max(done)]) if done else spark.createDataFrame([], schema)

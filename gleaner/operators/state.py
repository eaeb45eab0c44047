"""What is carried from run to run: saved results that stand in, failures, held work, cached tints and queues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F


def fresh_or_saved(read: Callable[[], DataFrame], saved: Callable[[], DataFrame]) -> tuple[DataFrame, str | None]:
    """What read gives, and None; if it can't be read or has no rows, what the last good run saved, and what was wrong.
    With nothing saved either, the error of read is raised."""
    try:
        df = read()
        if not df.isEmpty():
            return df, None
        error: Exception = ValueError("no rows")
    except PySparkException as e:
        error = e
    old = saved()
    if old.isEmpty():
        raise error
    return old, f"could not be read ({str(error).splitlines()[0][:200]}); the last good run stands in"


def failed_recently(failed: Column, today: Column, days: int = 7) -> Column:
    """The day of a failure less than days ago and not in the future; null otherwise, also if it is no date."""
    day = F.try_to_date(F.left(failed, F.lit(10)))
    ago = F.datediff(today, day)
    return F.when((ago >= 0) & (ago < days), day)


def collected(items: DataFrame, due: DataFrame, batch: str, item: str, sent: str, today: Column, hold: int = 14) -> DataFrame:
    """items of batches that have ended, with what becomes of them: a batch of which an item is not due is held, all of it,
    until hold days after it was sent; of a batch that is read, items still due are settled and the others dropped. A batch
    of no known day is read."""
    x = items.join(due.select(item, F.lit(True).alias("_due")), item, "left")
    waiting = x.groupBy(batch).agg(F.bool_or(F.col("_due").isNull()).alias("_waits"), F.max(sent).alias("_sent"))
    held = F.col("_waits") & F.coalesce(F.datediff(today, F.col("_sent")) < hold, F.lit(False))
    return x.join(waiting, batch).withColumn("outcome", F.when(held, "held").when(F.col("_due"), "settled").otherwise("dropped")).drop("_due", "_waits", "_sent")


def tint_decision(art: Column, readable: Column, cards: Column, tint: Column, source: Column, url: Column, miss: Column) -> Column:
    """What to do for a set's tint: keep the cached one if nothing that it was made from has changed, read the official art, or
    a card's, or nothing (no cards, or none had art when there were as many).

    art is the set's official picture now; readable whether such pictures could be read at all; tint, source (art or card),
    url and miss are the cached entry.
    """
    hit = tint.isNotNull()
    same = F.coalesce(hit & (source == "art") & (url == art), F.lit(False))
    keep = hit & art.isNull() & ((source == "card") | ~readable)
    return F.when(same | keep, "keep").when(art.isNotNull(), "art").when(F.coalesce(cards, F.lit(0)) <= 0, "none").when(F.coalesce(miss == cards, F.lit(False)), "none").otherwise("card")


def without_current(pages: DataFrame, done: DataFrame, key: str, version: int) -> DataFrame:
    """Pages with no extraction, or with one of another version only."""
    return pages.join(done.where(F.col("version") == version).select(key), key, "left_anti")


def queued(decks: DataFrame, queue: DataFrame, key: str, names: str) -> DataFrame:
    """The queue (key, attempts, names) with decks that have unresolved names and are not in it yet, as never tried."""
    new = decks.where(F.size(names) > 0).join(queue.select(key), key, "left_anti").select(key, F.lit(0).alias("attempts"), F.col(names).alias("names"))
    return queue.select(key, "attempts", "names").unionByName(new)


def refusals(runs: DataFrame, key: str, at: str, refused: str, hours: int = 12) -> DataFrame:
    """(key, at, blocked): after each run, the days in a row with a refusal. A refusal within hours of the last one is of the
    same day; a run without one starts again."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(at)
    x = runs.withColumn("_streak", F.sum((~F.col(refused)).cast("int")).over(w))
    before = F.lag(at).over(Window.partitionBy(key, "_streak", refused).orderBy(at))
    new = F.col(refused) & (before.isNull() | (F.col(at) >= before + F.make_dt_interval(hours=F.lit(hours))))
    x = x.withColumn("_new", new.cast("int"))
    total = F.sum("_new").over(Window.partitionBy(key, "_streak").orderBy(at))
    return x.select(key, at, F.when(F.col(refused), total).otherwise(0).cast("int").alias("blocked"))


def ratio_guard(outcomes: DataFrame, failed: str, most: float = 0.02) -> DataFrame:
    """One row: failed, all, and whether the failures are at most the given share; no rows at all are fine."""
    x = outcomes.agg(F.count_if(failed).alias("failed"), F.count(F.lit(1)).alias("all"))
    return x.withColumn("fine", F.col("failed") <= most * F.col("all"))


def guarded(outcomes: DataFrame, failed: str, most: float = 0.02) -> DataFrame:
    """outcomes without the failed ones; an error if those are more than the given share."""
    r = ratio_guard(outcomes, failed, most).first()
    if not r["fine"]:
        raise ValueError(f"{r['failed']} of {r['all']} failed, more than {most:.0%}")
    return outcomes.where(~F.coalesce(failed, F.lit(False)))


def answered(asked: DataFrame, pages: DataFrame, cache: DataFrame, fetched: DataFrame, key: str, now: Column, days: int, budget: int) -> DataFrame:
    """Each asked key with the tier that answers it, the answer, and what the cache holds for it from now on.

    asked: key, pos (the order of asking); pages: key, value, of this run; cache: key, value, checked_at, a null value saying that there
    is none; fetched: key, value, ok, what a fetch would bring (ok false: it could not be read; a null value that is ok: there is none).

    Tiers: page (this run's); cache (checked within days, also a remembered none); fetched, for the first `budget` keys by pos that
    neither answers; stale, the cache's older value where the fetch failed or the budget is spent; none. A none is never an answer,
    but a fetched one is remembered, so it is not asked for again while it is fresh.
    """
    value = lambda df, c: df.select(key, F.col("value").alias(c))
    x = asked.join(value(pages, "_page").withColumn("_has", F.lit(True)), key, "left")
    x = x.join(cache.select(key, F.col("value").alias("_old"), F.col("checked_at").alias("_at")), key, "left")
    fresh = F.col("_at").isNotNull() & (F.datediff(now, F.col("_at")) <= days)
    x = x.withColumn("_tier", F.when(F.col("_has"), "page").when(fresh, "cache"))
    wanted = x.where("_tier is null").select(key, "pos").orderBy("pos", key).limit(budget).select(key, F.lit(True).alias("_may"))
    x = x.join(wanted, key, "left").join(fetched.select(key, F.col("value").alias("_new"), F.coalesce("ok", F.lit(False)).alias("_ok")), key, "left")
    x = x.withColumn("tier", F.when(F.col("_tier").isNotNull(), F.col("_tier")).when(F.col("_may") & F.col("_ok"), "fetched").when(F.col("_old").isNotNull(), "stale").otherwise("none"))
    answer = F.when(F.col("tier") == "page", F.col("_page")).when(F.col("tier") == "fetched", F.col("_new")).when(F.col("tier") != "none", F.col("_old"))
    renewed = F.col("tier").isin("page", "fetched")
    return x.select(key, "pos", "tier", answer.alias("value"), F.when(renewed, answer).otherwise(F.col("_old")).alias("kept"), F.when(renewed, now).otherwise(F.col("_at")).alias("checked_at"))

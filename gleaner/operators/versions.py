"""Computed results published as a base and a chain of patches: read as last writer wins, rebased when the chain is long."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gleaner.session import written

#: Patches after which the next change makes a new base; the share of results that may fail.
MOST_PATCHES, MOST_FAILED = 14, 0.02


@dataclass(frozen=True)
class Version:
    """base and patches as tables (patch 0 is the base): patch, id, uri, value. master counts the bases, latest is the last patch."""

    rows: DataFrame
    master: int
    latest: int


def reading(version: Version) -> DataFrame:
    """id, uri, value, patch: of each id what the last patch says, or the base."""
    return version.rows.groupBy("id").agg(F.max_by(F.struct("uri", "value", "patch"), "patch").alias("_r")).select("id", "_r.*")


def pending(version: Version | None, current: DataFrame) -> DataFrame:
    """Of current (id, uri) what has no result yet, or one of another uri."""
    if version is None:
        return current
    return current.join(reading(version).select("id", F.col("uri").alias("_was")), "id", "left").where(~F.col("uri").eqNullSafe(F.col("_was")) | F.col("_was").isNull()).drop("_was")


def advanced(version: Version | None, current: DataFrame, computed: DataFrame, most: int = MOST_PATCHES, failed: float = MOST_FAILED) -> Version:
    """The next version. computed: id, value (null: it failed) of what was pending; more failures than that share of it are an error.

    Without a version it is the first base. No change gives the same version again. A change is a patch, or, after `most` patches, a new
    base of everything that current still has; patches only add and replace, so what has left current stays until then. A failed id
    keeps its old result and uri, so it is pending again.
    """
    todo = written(pending(version, current).join(computed, "id", "left"))
    n, bad = todo.agg(F.count(F.lit(1)), F.count_if(F.col("value").isNull())).first()
    if bad > failed * max(n, 1):
        raise ValueError(f"{bad} of {n} results failed")
    changed = todo.where("value is not null").select("id", "uri", "value")
    if version is None:
        return Version(written(changed.select(F.lit(0).alias("patch"), "id", "uri", "value")), 1, 0)
    if n == bad:
        return version
    if version.latest >= most:
        old = reading(version).join(changed.select("id"), "id", "left_anti").join(current.select("id"), "id", "left_semi")
        rows = old.select("id", "uri", "value").unionByName(changed).select(F.lit(0).alias("patch"), "id", "uri", "value")
        return Version(written(rows), version.master + 1, 0)
    patch = changed.select(F.lit(version.latest + 1).alias("patch"), "id", "uri", "value")
    return Version(version.rows.unionByName(written(patch)), version.master, version.latest + 1)

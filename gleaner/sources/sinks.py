"""Documents as files: JSON per key, only what changed, the manifest last."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.operators import diff

#: Ids that may become part of a path.
SAFE = r"^[A-Za-z0-9_-]+$"


def documents(df: DataFrame, key: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """(key, body, digest): each row as compact JSON without null fields; unsafe keys are left out. The digest covers all
    columns but those in drop (stamps and the like)."""
    safe = df.where(F.col(key).cast("string").rlike(SAFE))
    hashed = [c for c in df.columns if c not in drop]
    return safe.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("body"), diff.fingerprint(*hashed).alias("digest"))


def write_documents(docs: DataFrame, path: str, by: Column | None = None) -> None:
    """Bodies as text, in folders by key (or by a coarser column): one folder per value, written by the executors."""
    docs.select((by if by is not None else F.col("key")).alias("id"), F.col("body").alias("value")).write.mode("overwrite").partitionBy("id").text(path)


def publish(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Writes changed documents and then the manifest; returns the manifest of this run (key, digest, status).

    A run that fails before its end leaves the old manifest in place: the pointer to the newest one moves last.
    """
    run = uuid.uuid4().hex
    pointer = f"{path}/current"
    try:
        at = spark.read.text(pointer).first()[0]
        old = spark.read.parquet(f"{path}/manifests/{at}").select("key", "digest")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = docs.select("key", "digest").limit(0)
    fresh = diff.changed(docs, old, "key", "digest")
    fresh.select("key", "body", "digest").write.parquet(f"{path}/documents/{run}")
    status = diff.manifest(docs, old, "key", "digest")
    status.write.parquet(f"{path}/manifests/{run}")
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.mode("overwrite").text(pointer)
    return spark.read.parquet(f"{path}/manifests/{run}")


def markdown(df: DataFrame, key: str, title: str, section: str, order: str, line: str) -> DataFrame:
    """(key, text): a document with front matter and one heading a section, lines in order."""
    per = df.groupBy(key, title, section).agg(F.min(order).alias("_o"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: F.concat(F.lit("- "), x[line])), "\n").alias("_t"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", section, "_t"))), lambda x: F.concat(F.lit("## "), x[section], F.lit("\n\n"), x["_t"])), "\n\n")
    return per.groupBy(key, title).agg(body.alias("_b")).select(key, F.concat(F.lit("---\ntitle: "), F.col(title), F.lit("\n---\n\n"), F.col("_b"), F.lit("\n")).alias("text"))

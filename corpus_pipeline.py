"""A corpus pipeline of five stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.llm import decontaminate, langid, linededup, neardup, pieces
from gleaner.llm.common import shielded
from gleaner.session import delete, scratch, shared_folder, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language.

    Null, empty and letterless texts go, however long; null languages are not learned from; rows that repeat stay or go together; of equal
    scores the first label counts. An empty table stays empty.
    """
    return langid.keep_known(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated three-line windows; documents that lose every line with a word go.

    Null and empty texts have no line to lose: they go as well, as nothing is left of them. Rows without doc_id are left alone; of rows that
    repeat one all stay; n_chars follows the text.
    """
    inner, of, back = shielded(docs)
    out = linededup.line_dedup(inner, key=of("doc_id"), text=of("text"))
    left = F.coalesce(F.size(linededup.GONE), F.lit(0)) < F.col(linededup.LINES)
    return back(out.where(left).withColumn(of("n_chars"), F.length(of("text")).cast("long")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id: five-word shingles, similarity 0.8 or more.

    Null and word-free texts are linked with nothing and stay; so do rows without doc_id; rows that repeat a doc_id stay or go together.
    """
    return neardup.drop_near_duplicates(docs, size=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item.

    Null and word-free texts hold none; null and word-free items match nothing, items without an id do; repeated rows stay or go together.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document that is left; null and empty texts have none, repeated rows repeat."""
    out = pieces.encode(docs)
    return out.select("doc_id", "lang", "source", F.size(pieces.IDS).cast("long").alias("n_tokens"), F.col(pieces.IDS).alias("token_ids"))


STAGES = [("language ID", language), ("line dedup", lines), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("SentencePiece encoding", tokens)]

#: SQL expresses neither the model nor the encoder; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents, each stage's result written to the shared folder and read by the next. The tables of a stage go
    once its result is written, and its result once the next stage's is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        at = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(at)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(at), at
    return docs

"""The numbered queries of the training-data operators and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.llm import decontaminate, langid, licenses, linededup, neardup, negatives, periodic, pieces, quality, secrets, suffixes, tokencounts, wavelet
from gleaner.session import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a CRF learned from the documents of which crc32(doc_id) mod 5 is not 0: held_out, lang_pred, score.

    Null, empty and letterless texts are und with score 0; null languages are not learned; repeated rows get equal results;
    the largest mean marginal decides, the first label of equals; an empty table gives no rows.
    """
    return langid.report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterned and high-entropy spans of every document: counts, digest of the patterned ones, all spans.

    Null and empty texts have none; spans that overlap or tie are listed by start, then kind; repeated rows repeat.
    """
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates by two-word shingles at 80 per cent: n_shingles, component_id, kept.

    Null, empty and word-free texts are linked with nothing; rows without doc_id have no component and are kept; rows that
    repeat a doc_id are one document; of a group the smallest doc_id is kept.
    """
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the fixed rules and the verdict by thresholds from sketches of language, source and length.

    Null and empty texts fail; null languages and sources are groups of their own; repeated rows count again; ties share a bucket and its verdict.
    """
    return quality.report(table(spark, sf_dir, "documents"))


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-scoring pieces of every text: tokens, checksum of the ids, and whether decoding restores the text.

    Null and empty texts have no tokens; equal scores go to the longer last piece; repeated rows repeat.
    """
    return pieces.report(table(spark, sf_dir, "documents"))


def op6_wavelet_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all texts in order of doc_id, read back: start, n_tokens, ids_crc32.

    Null and empty texts are the end id alone; rows without doc_id come first, those with one doc_id in order of text.
    """
    return wavelet.report(table(spark, sf_dir, "documents"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that starts earlier: n_bytes, n_removed, n_spans, digest of the rest.

    Null, empty and shorter texts lose nothing; rows with a null or repeated doc_id are documents of their own, by text.
    """
    return suffixes.report(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows: lines with a word, removed lines and runs, digest of the rest.

    Null, empty and shorter texts lose nothing; rows without doc_id are left alone; of rows that repeat one all stay.
    """
    return linededup.report(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of benchmark items in every document: n_words, n_hit, items, contaminated.

    Null and word-free texts are clean, such items match nothing; an item without an id is a hit that is not listed.
    """
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One encoding of every document, its tokens attributed to its lines by the largest share, the earlier line of equals.

    Null and empty texts have no tokens and one section; repeated rows repeat.
    """
    return tokencounts.report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 24 words and three periods or more in every text: their number, the one with most periods, digests of all and of the collapsed text.

    Every tenth document by checksum of its doc_id first gets a tail that repeats its own beginning; rows without doc_id never.
    Null, empty and word-free texts have no runs; of equal exponents the first start decides, then the period; repeated rows repeat.
    """
    return periodic.report(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every fiftieth vector and each of its five nearest of its label, three nearest of other labels at 50 to 95 per cent of that score.

    Rows without id or label, without a vector or with a null or non-finite component take no part; rows that repeat an id are one;
    equal scores go by vec_id; copies count each.
    """
    return negatives.report(table(spark, sf_dir, "embeddings"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and notices of licenses in every text by votes of word hashes for diagonals: places, labels, largest similarity.

    Null, empty and word-free texts have none; of notices that share words the most similar stays, equals all; repeated rows repeat.
    """
    return licenses.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_language_id, op2_secret_scan, op3_minhash_near_dedup, op4_quality_rules, op5_piece_encoding, op6_wavelet_token_files, op7_repeated_strings, op8_line_dedup, op9_decontaminate, op10_token_counts, op11_periodic_runs, op12_hard_negatives, op13_license_scan)}


def oracle_sql() -> dict[str, str]:
    return {"op2_secret_scan": secrets.SQL, "op3_minhash_near_dedup": neardup.SQL, "op4_quality_rules": quality.SQL, "op7_repeated_strings": suffixes.SQL, "op8_line_dedup": linededup.SQL, "op9_decontaminate": decontaminate.SQL, "op12_hard_negatives": negatives.SQL}

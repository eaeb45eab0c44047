"""Line dedup: windows of three consecutive lines that occur again are removed after their first occurrence.

Only lines with a word count; the others are never in a window and always stay. Lines are compared without
the white space around them. An occurrence is later if its (doc_id, line) is larger than the smallest one of
the same window; the lines of all later occurrences go, overlaps counted once. Null or empty texts and texts
with fewer lines than a window keep everything. Rows that repeat a doc_id tie at equal lines: ties both stay.
Rows without doc_id are left alone. Other columns pass through,
but for those named as an added one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import let, shielded, written

LINES, GONE = "_gl_lines", "_gl_gone"


def _lines(text: Column) -> Column:
    """Array of (trimmed line, index among all lines) of the lines with a word."""
    every = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x, i: F.struct(F.trim(x, F.lit(" \t\n\x0b\x0c\r")).alias("s"), i.alias("i")))
    return F.filter(every, lambda x: x["s"] != "")


def _occurrences(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """A row per window: two hashes of its lines, doc_id and the window's index among the lines with a word."""
    hashes = F.transform(_lines(F.col(text)), lambda x: F.struct(F.xxhash64(x["s"]).alias("w"), F.xxhash64(F.lit(1), x["s"]).alias("v")))
    both = lambda h, i: F.struct(*(F.xxhash64(F.transform(F.slice(h, i, size), lambda x: x[c])).alias(c) for c in ("w", "v")))
    windows = let(hashes, lambda h: F.when(F.size(h) >= size, F.transform(F.sequence(F.lit(1), F.greatest(F.size(h) - (size - 1), F.lit(1))), lambda i: both(h, i))))
    return docs.where(F.col(key).isNotNull()).select(F.col(key).alias("d"), F.posexplode(windows).alias("p", "x")).select("x.w", "x.v", "d", "p")


def repeated_windows(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Windows found more than once in the corpus: hashes w and v and the first occurrence (d, p)."""
    seen = _occurrences(docs, key, text, size).groupBy("w", "v").agg(F.min(F.struct("d", "p")).alias("first"), F.count(F.lit(1)).alias("n"))
    return seen.where("n > 1").select("w", "v", "first")


def covered_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Per document with later occurrences: the sorted indexes (among lines with a word) to remove.

    The repeated windows are written first, so both sides of the join come straight from a shuffle and adaptive
    execution can split a window that fills a partition.
    """
    repeated = written(repeated_windows(docs, key=key, text=text, size=size))
    later = _occurrences(docs, key, text, size).join(repeated, ["w", "v"]).where(F.struct("d", "p") > F.col("first"))
    lines = F.array_distinct(F.flatten(F.transform(F.collect_list("p"), lambda p: F.sequence(p, p + size - 1))))
    return later.groupBy("d").agg(F.array_sort(lines).alias(GONE))


def line_dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """docs with later occurrences cut from text, and _gl_lines (lines with a word) and _gl_gone (removed indexes)."""
    gone = covered_lines(docs, key=key, text=text, size=size)
    inner, of, _ = shielded(docs.drop(LINES, GONE))
    joined = inner.join(gone, F.col(of(key)) == F.col("d"), "left").select(*inner.columns, GONE).toDF(*docs.drop(LINES, GONE).columns, GONE)
    return joined.withColumns({LINES: F.size(_lines(F.col(text))).cast("long"), text: F.when(F.col(GONE).isNull(), F.col(text)).otherwise(_kept(F.col(text), F.col(GONE)))})


def _kept(text: Column, gone: Column) -> Column:
    """text without the lines whose index among the lines with a word is in gone."""
    indexes = F.transform(_lines(text), lambda x: x["i"])
    away = let(indexes, lambda at: F.transform(gone, lambda g: F.element_at(at, g + 1)))
    return let(F.split(text, "\n", -1), lambda raw: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(raw) - 1), away), lambda i: F.element_at(raw, i + 1)), "\n"))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Per row: lines with a word, removed lines, removed runs and a digest of the text that stays."""
    out = line_dedup(docs.select(key, text), key=key, text=text, size=size)
    g = F.coalesce(F.col(GONE), F.expr("cast(array() as array<int>)"))
    runs = let(g, lambda a: F.size(F.filter(a, lambda x, i: (i == 0) | (x - F.get(a, i - 1) > 1))))
    return out.select(key, F.col(LINES).alias("n_lines"), F.size(g).cast("long").alias("n_removed"), runs.cast("long").alias("n_spans"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: DuckDB SQL for the rows of report() over table documents.
SQL = """
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), worded AS (
  SELECT doc_id, i, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS p
  FROM (SELECT doc_id, i, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM lines) WHERE s <> ''
), windows AS (
  SELECT a.doc_id AS d, a.p, a.s || chr(10) || b.s || chr(10) || c.s AS w
  FROM worded a JOIN worded b ON b.doc_id = a.doc_id AND b.p = a.p + 1 JOIN worded c ON c.doc_id = a.doc_id AND c.p = a.p + 2
), later AS (
  SELECT d, p FROM (SELECT d, p, row_number() OVER (PARTITION BY w ORDER BY d, p) AS k FROM windows) WHERE k > 1
), gone AS (
  SELECT DISTINCT d, p + k AS p FROM later, (VALUES (0), (1), (2)) v(k)
), marked AS (
  SELECT l.doc_id, l.i, l.raw, w.p, g.p IS NOT NULL AS away
  FROM lines l LEFT JOIN worded w ON w.doc_id = l.doc_id AND w.i = l.i LEFT JOIN gone g ON g.d = l.doc_id AND g.p = w.p
), kept AS (
  SELECT doc_id, count(p) AS n_lines, count(*) FILTER (away) AS n_removed, coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT away), '') AS kept
  FROM marked GROUP BY doc_id
), runs AS (
  SELECT d, count(*) AS n FROM (SELECT d, p, lag(p) OVER (PARTITION BY d ORDER BY p) AS q FROM gone) WHERE q IS NULL OR q < p - 1 GROUP BY d
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, CAST(coalesce(r.n, 0) AS BIGINT) AS n_spans, sha256(kept) AS kept_sha256
FROM kept LEFT JOIN runs r ON r.d = kept.doc_id
"""

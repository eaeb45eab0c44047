"""Quality rules with thresholds that follow each language, source and length, in DataFrame functions only.

Fixed rules decide first. Of the documents that pass them, a sketch of each metric is kept per language, source and length class (bits of
the number of words, as a short text's metrics scatter more and a long one's windows repeat more): counts of buckets whose width grows
with the value (5 significant bits), so that sketches merge by adding counts and a quantile is off by at most 1/32.

The quartiles and upper eighth of a group are drawn towards those of its language's documents of that length, and these towards those of
all of that length, by `prior` documents' weight, so that a small group's thresholds move to its own without a step. A document is kept if
each metric is at most q75 + bucket + 3 d (and its word length at least q25 - 3 d), where d is the largest of the quartile distance,
the distance from q75 to the upper eighth and one bucket of q75: nothing else bounds it. The eighth gives a width to metrics that are 0 in
three quarters of a group. Counts up to ALLOWED pass, as a line or two repeated is no sign of anything.

Null texts are empty and fail. Null languages and sources are groups of their own. Repeated rows count again and get
the same verdict; ties lie in one bucket and share its verdict; an empty table gives no rows. Only key, text, lang and source are read, so other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gleaner.llm.common import let, written

SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\x0b\f\r"
#: Documents by whose weight a group's quantiles are drawn towards those of the group around it.
PRIOR = 50
#: Metric: whether too small a value fails as well.
METRICS = {"m_word_length": True, "m_symbols": False, "m_dup_lines": False, "m_repeats": False}

#: Counts that never fail a document: a symbol, two repeated lines, and the words of these and of what they repeat, nine a line.
ALLOWED = {"m_symbols": ("n_symbols", 1), "m_dup_lines": ("n_dup_lines", 2), "m_repeats": ("n_repeat_words", 36)}


def _covered(tri: Column) -> Column:
    """Words in three-word windows (hashes tri) found twice or more. Most texts have none, which a distinct count shows;
    the others sort their windows, so that equal ones meet."""
    ordered = F.array_sort(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
    twice = let(ordered, lambda s: F.filter(s, lambda x, k: same(s, x, k + 1) | (k > 0) & same(s, x, k - 1)))
    words = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return F.when(F.size(F.array_distinct(tri)) == F.size(tri), 0).otherwise(words).cast("long")


def measured(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per row: key, language, source, the counts of the fixed rules, the metrics and base_failed.

    Each array is a column of its own step, so that it is made once and no lambda goes deep.
    """
    none = F.expr("cast(array() as array<string>)")
    x = docs.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(source).alias("s"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    x = x.select("*", F.trim("t", F.lit(BLANKS)).alias("inner"))
    x = x.select(
        "k", "l", "s", "t",
        F.when(F.col("inner") == "", none).otherwise(F.split("inner", r"[\x20\x09-\x0D]+")).alias("w"),
        F.filter(F.split("t", "\n", -1), lambda y: y.rlike(r"[^\x20\x09-\x0D]")).alias("a"),
    )
    hashes = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))
    x = x.select(
        "k", "l", "s",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("a").alias("n_lines"),
        (F.size("a") - F.size(F.array_distinct("a"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 4, hashes).otherwise(F.expr("cast(array() as array<bigint>)")).alias("tri"),
    )
    x = x.select("k", "l", "s", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", _covered(F.col("tri")).alias("n_repeat_words"))
    per = lambda a, scale, b: F.expr(f"({scale} * {a}) div greatest({b}, 1)")
    return x.select(
        "k", "l", "s", F.length(F.bin("n_words")).alias("z"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("word_chars", 100, "n_words").alias("m_word_length"),
        per("n_symbols", 1000, "n_words").alias("m_symbols"),
        per("n_dup_lines", 1000, "n_lines").alias("m_dup_lines"),
        per("n_repeat_words", 1000, "n_words").alias("m_repeats"),
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
    )


def sketches(rows: DataFrame) -> DataFrame:
    """Bucket counts of each metric per language, source and length class (l, s, z, m, b, c); sketches merge by adding c."""
    bucket = "shiftleft(shiftright(v, greatest(length(bin(v)) - 6, 0)), greatest(length(bin(v)) - 6, 0))"
    long = rows.where("not base_failed").select("l", "s", "z", F.explode(F.create_map(*(x for m in METRICS for x in (F.lit(m), F.col(m))))).alias("m", "v"))
    return long.groupBy("l", "s", "z", "m", F.expr(bucket).alias("b")).agg(F.count(F.lit(1)).alias("c"))


def _quantiles(sketch: DataFrame, *by: str) -> DataFrame:
    """Quartiles (q1, q3) and upper eighth (e) of each metric of each merged sketch, and its documents n."""
    merged = sketch.groupBy(*by, "m", "b").agg(F.sum("c").alias("c"))
    w = Window.partitionBy(*by, "m")
    upto = merged.select(*by, "m", "b", F.sum("c").over(w.orderBy("b")).alias("upto"), F.sum("c").over(w).alias("n"))
    at = lambda k: F.min(F.when(8 * F.col("upto") >= k * F.col("n"), F.col("b")))
    return upto.groupBy(*by, "m").agg(F.max("n").alias("n"), at(2).alias("q1"), at(6).alias("q3"), at(7).alias("e"))


def fences(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Per language, source and length class: lo_ and hi_ of each metric."""
    own, language, all_ = (_quantiles(sketch, *by) for by in (("l", "s", "z"), ("l", "z"), ("z",)))
    put = lambda df, p: df.select(*(c for c in df.columns if c in ("l", "s", "z", "m")), *(F.col(c).alias(f"{p}{c}") for c in ("n", "q1", "q3", "e")))
    a, b, c = put(own, "a"), put(language, "b").withColumnsRenamed({"l": "bl"}), put(all_, "c")
    x = a.join(b, F.col("l").eqNullSafe(F.col("bl")) & (a["z"] == b["z"]) & (a["m"] == b["m"])).drop(b["z"], b["m"]).join(c, ["z", "m"])
    drawn = lambda n, q, to: F.expr(f"({n} * {q} + {prior} * {to}) div ({n} + {prior})")
    x = x.withColumns({f"b{k}": drawn("bn", f"b{k}", f"c{k}") for k in ("q1", "q3", "e")})
    x = x.select("l", "s", "z", "m", *(drawn("an", f"a{k}", f"b{k}").alias(k) for k in ("q1", "q3", "e")))
    width = F.expr("shiftleft(1L, greatest(length(bin(q3)) - 6, 0))")
    d = 3 * F.greatest(F.col("q3") - F.col("q1"), F.col("e") - F.col("q3"), width)
    x = x.select("l", "s", "z", "m", (F.col("q1") - d).alias("lo"), (F.col("q3") + width - 1 + d).alias("hi"))
    of = lambda m, c: F.max(F.when(F.col("m") == m, F.col(c))).alias(f"{c}_{m}")
    return x.groupBy("l", "s", "z").agg(*(of(m, c) for m in METRICS for c in ("lo", "hi")))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", prior: int = PRIOR) -> DataFrame:
    """Per row: the counts, base_failed and kept. prior: documents by whose weight groups are drawn to those around them."""
    rows = written(measured(docs, key=key, text=text, lang=lang, source=source))
    limits = written(fences(sketches(rows), prior)).withColumnsRenamed({"l": "fl", "s": "fs", "z": "fz"})
    joined = rows.join(limits, F.col("l").eqNullSafe(F.col("fl")) & F.col("s").eqNullSafe(F.col("fs")) & (F.col("z") == F.col("fz")), "left")
    inside = ~F.col("base_failed")
    for m, low in METRICS.items():
        below = F.col(m) <= F.col(f"hi_{m}")
        if m in ALLOWED:
            count, most = ALLOWED[m]
            below |= F.col(count) <= most
        inside &= below
        if low:
            inside &= F.col(m) >= F.col(f"lo_{m}")
    return joined.select(F.col("k").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce(inside, F.lit(False)).alias("kept"))


#: DuckDB SQL for the rows of report() over table documents.
SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang AS l, source AS s, coalesce(text, '') AS x FROM documents),
w AS (SELECT r, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w FROM t),
tri AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY r),
ln AS (SELECT r, list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS a FROM t),
c AS (
  SELECT t.r, doc_id, l, s, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ln.a) - len(list_distinct(ln.a)) AS BIGINT) AS n_dup_lines, CAST(len(ln.a) AS BIGINT) AS n_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM t JOIN w USING (r) JOIN ln USING (r) LEFT JOIN rep USING (r)
),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, length(bin(n_words)) AS z FROM c),
v AS (
  SELECT r, l, s, z, base_failed, m, CASE m WHEN 'm_word_length' THEN (100 * word_chars) // greatest(n_words, 1) WHEN 'm_symbols' THEN (1000 * n_symbols) // greatest(n_words, 1)
    WHEN 'm_dup_lines' THEN (1000 * n_dup_lines) // greatest(n_lines, 1) ELSE (1000 * n_repeat_words) // greatest(n_words, 1) END AS v,
    CASE m WHEN 'm_symbols' THEN n_symbols <= 1 WHEN 'm_dup_lines' THEN n_dup_lines <= 2 WHEN 'm_repeats' THEN n_repeat_words <= 36 ELSE false END AS few
  FROM f, (VALUES ('m_word_length'), ('m_symbols'), ('m_dup_lines'), ('m_repeats')) m(m)
),
sk AS (SELECT l, s, z, m, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b, count(*) AS c FROM v WHERE NOT base_failed GROUP BY ALL),
g1 AS (SELECT l, s, z, m, b, sum(c) OVER (PARTITION BY l, s, z, m ORDER BY b) AS u, sum(c) OVER (PARTITION BY l, s, z, m) AS n FROM sk),
q1 AS (SELECT l, s, z, m, CAST(max(n) AS BIGINT) AS n, min(b) FILTER (8 * u >= 2 * n) AS a, min(b) FILTER (8 * u >= 6 * n) AS y, min(b) FILTER (8 * u >= 7 * n) AS e FROM g1 GROUP BY ALL),
k2 AS (SELECT l, z, m, b, sum(c) AS c FROM sk GROUP BY ALL),
g2 AS (SELECT l, z, m, b, sum(c) OVER (PARTITION BY l, z, m ORDER BY b) AS u, sum(c) OVER (PARTITION BY l, z, m) AS n FROM k2),
q2 AS (SELECT l, z, m, CAST(max(n) AS BIGINT) AS n, min(b) FILTER (8 * u >= 2 * n) AS a, min(b) FILTER (8 * u >= 6 * n) AS y, min(b) FILTER (8 * u >= 7 * n) AS e FROM g2 GROUP BY ALL),
k3 AS (SELECT z, m, b, sum(c) AS c FROM sk GROUP BY ALL),
g3 AS (SELECT z, m, b, sum(c) OVER (PARTITION BY z, m ORDER BY b) AS u, sum(c) OVER (PARTITION BY z, m) AS n FROM k3),
q3 AS (SELECT z, m, min(b) FILTER (8 * u >= 2 * n) AS a, min(b) FILTER (8 * u >= 6 * n) AS y, min(b) FILTER (8 * u >= 7 * n) AS e FROM g3 GROUP BY ALL),
p AS (SELECT q2.l, q2.z, q2.m, (q2.n * q2.a + 50 * q3.a) // (q2.n + 50) AS a, (q2.n * q2.y + 50 * q3.y) // (q2.n + 50) AS y, (q2.n * q2.e + 50 * q3.e) // (q2.n + 50) AS e FROM q2 JOIN q3 USING (z, m)),
q AS (
  SELECT q1.l, q1.s, q1.z, q1.m, (q1.n * q1.a + 50 * p.a) // (q1.n + 50) AS a, (q1.n * q1.y + 50 * p.y) // (q1.n + 50) AS y, (q1.n * q1.e + 50 * p.e) // (q1.n + 50) AS e
  FROM q1 JOIN p ON q1.l IS NOT DISTINCT FROM p.l AND q1.z = p.z AND q1.m = p.m
),
h AS (SELECT *, CAST(1 AS BIGINT) << greatest(length(bin(y)) - 6, 0) AS w FROM q),
ok AS (
  SELECT v.r, bool_and(NOT base_failed AND (few OR v <= y + w - 1 + 3 * greatest(y - a, e - y, w)) AND (v.m <> 'm_word_length' OR v >= a - 3 * greatest(y - a, e - y, w))) AS kept
  FROM v LEFT JOIN h ON v.l IS NOT DISTINCT FROM h.l AND v.s IS NOT DISTINCT FROM h.s AND v.z = h.z AND v.m = h.m GROUP BY v.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(kept, false) AS kept FROM f JOIN ok USING (r)
"""

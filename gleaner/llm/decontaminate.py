"""Benchmark decontamination: a broadcast set of normalised test windows against every training window.

The windows of the benchmark are made on the executors and written once. Up to MOST_WINDOWS of them (and MOST_BYTES of
their words) the whole set is broadcast as sorted hashes with one buffer of words, and hits are verified on the words
within the scan. Beyond that a bitmap of at most 32 MB is broadcast instead: the same single scan turns away nearly all
windows, and those left are joined with the written windows on hash and words. Both give the same rows.

Null or word-free texts have no windows and are clean; items without words match nothing; repeated items
and rows give repeated results; other columns pass through untouched, but for those named as an added one.
An item without an id is left out unless unnamed=True: then its windows are hits as any other's, and only the listed items lack it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from gleaner.llm import spans
from gleaner.llm.common import column, cut, in_arrow, kept, shielded, utf8, written

#: Columns that the scan adds; their prefix keeps them apart from any column of the input.
ADDED = WORDS, HITS, FIRST, LAST, STARTS, ENDS, ITEMS = ("_gl_words", "_gl_hit", "_gl_first", "_gl_last", "_gl_start", "_gl_end", "_gl_items")
_ADDED_DDL = f"{WORDS} long, {HITS} long, {FIRST} array<int>, {LAST} array<int>, {STARTS} array<int>, {ENDS} array<int>, {ITEMS} array<string>"
#: Bounds of a broadcast set: different windows (and listings of items), and bytes of their words.
MOST_WINDOWS, MOST_BYTES = 1_000_000, 64 << 20
#: Bits of the largest bitmap, as a power of two.
MOST_BITS = 28

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _word_hashes(raw, offsets):
    start, end, doc = spans.words(raw, offsets, spans.ALPHANUMERIC)
    values = spans.byte_values(lower=True)[raw]
    return start, end, doc, spans.span_hash(spans.prefix(values, "bytes"), start, end, "bytes")


def _phrase(raw, start, end) -> bytes:
    """The words between as normalised bytes, joined by a space: what a hash hit is verified against."""
    return b" ".join(raw[a:b].tobytes() for a, b in zip(start, end)).translate(_LOWER)


def _item_windows(size: int):
    """Of each item (i, t): the windows (words k, hash h, normalised words p)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (raw_all, off_all) = column(batch, "i"), utf8(column(batch, "t"))
            for i, j in cut(off_all):
                raw, offsets = raw_all[off_all[i] : off_all[j]], off_all[i : j + 1] - off_all[i]
                start, end, doc, h = _word_hashes(raw, offsets)
                count = np.bincount(doc, minlength=j - i)
                found, first = spans.windows(h, doc, size)
                short = np.flatnonzero((count > 0) & (count < size))
                at = np.searchsorted(doc, short)
                whole = spans.span_hash(spans.prefix(h, "words"), at, at + count[short], "words") if len(short) else np.zeros(0, np.uint64)
                k = np.concatenate((np.full(len(first), size), count[short])).astype(np.int32)
                first, found = np.concatenate((first, at)), np.concatenate((found, whole))
                words = [_phrase(raw, start[a : a + n], end[a : a + n]) for a, n in zip(first.tolist(), k.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(found.view(np.int64)), pa.array(words, pa.binary()), ids.slice(i, j - i).take(pa.array(doc[first]))], names=["k", "h", "p", "i"])

    return run


def window_table(benchmark: DataFrame, *, item: str = "item_id", text: str = "text", size: int = 10, unnamed: bool = False) -> DataFrame:
    """(k, h, p, items): the different windows of the benchmark, and the sorted ids of the items that have each."""
    bench = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null" if unnamed else "i is not null and t is not null")
    rows = in_arrow(bench, _item_windows(size), "k int, h long, p binary, i string")
    return rows.groupBy("k", "h", "p").agg(F.sort_array(F.collect_set("i")).alias("items"))


class WindowSet:
    """Windows of one length as arrays: sorted hashes behind a bitmap, one buffer of words, and lists of items."""

    def __init__(self, table: pa.Table):
        h = table["h"].to_numpy().view(np.uint64)
        order = pa.array(np.argsort(h, kind="stable"))
        table = table.take(order).combine_chunks()
        self.keys = table["h"].to_numpy().view(np.uint64)
        self.words, self.at = (np.array(x) for x in utf8(table["p"].chunk(0)))
        items = table["items"].chunk(0)
        self.owned, self.owners = items.offsets.to_numpy() - items.offsets[0].as_py(), items.flatten().to_pylist()
        self.mask = np.uint64((1 << max(16, int(len(h) * 16).bit_length())) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, bool)
        self.maybe[self.keys & self.mask] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where h has known hashes, and the first row of each."""
        at = np.flatnonzero(self.maybe[h & self.mask])
        x = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        known = self.keys[x] == h[at]
        return at[known], x[known]

    def items(self, row: int, phrase: bytes) -> list[str] | None:
        """The items of the window with these words among the rows of one hash, or None."""
        key = self.keys[row]
        while row < len(self.keys) and self.keys[row] == key:
            if self.words[self.at[row] : self.at[row + 1]].tobytes() == phrase:
                return self.owners[self.owned[row] : self.owned[row + 1]]
            row += 1
        return None


class _Bits:
    """Which hashes may be known, by two bits each."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, np.uint64(bits)

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(len(h))
        for where in (h & np.uint64((1 << int(self.bits)) - 1), h >> (np.uint64(64) - self.bits)):
            x = where[at]
            at = at[(self.words[x >> np.uint64(6)] >> (x & np.uint64(63))) & np.uint64(1) == 1]
        return at, at


def _bitmap(table: DataFrame, n: int) -> _Bits:
    bits = min(MOST_BITS, max(16, (16 * n).bit_length()))
    spots = F.explode(F.array(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned("h", 64 - bits)))
    words = table.select(spots.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("x")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[words["w"].to_numpy()] = words["x"].to_numpy().view(np.uint64)
    return _Bits(out, bits)


def _hit_columns(raw, offsets, start, end, doc, hits: dict[int, list[tuple[int, int, list[str]]]]) -> tuple[list, ...]:
    """The values of ADDED for the documents of a slice; hits: of a document, (first word in the slice, words, items)."""
    n = len(offsets) - 1
    first_word = np.searchsorted(doc, np.arange(n + 1))
    covered = np.zeros(len(start) + 1, np.int32)
    for a, k in ((a, k) for found in hits.values() for a, k, _ in found):
        covered[a] += 1
        covered[a + k] -= 1
    hit = np.cumsum(covered[:-1]) > 0
    spots, items = ([], [], [], []), []
    for d in range(n):
        a, z = first_word[d], first_word[d + 1]
        edges = np.diff(np.concatenate(([0], hit[a:z], [0])).astype(np.int8)) if d in hits else np.zeros(0)
        lo, hi = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        for spot, values in zip(spots, (lo, hi, start[a + lo] - offsets[d], end[a + hi - 1] - offsets[d])):
            spot.append(values.tolist())
        items.append(sorted({x for _, _, owners in hits.get(d, ()) for x in owners}))
    return (np.diff(first_word).tolist(), np.bincount(doc[hit], minlength=n).tolist(), *spots, items)


def _added(columns: list[tuple[list, ...]]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.string())]
    return [pa.array([x for part in columns for x in part[c]], kind) for c, kind in enumerate(kinds)]


def _slices(texts: pa.Array):
    raw_all, off_all = utf8(texts)
    for i, j in cut(off_all):
        raw, offsets = raw_all[off_all[i] : off_all[j]], off_all[i : j + 1] - off_all[i]
        yield i, raw, offsets, *_word_hashes(raw, offsets)


def _scan(table, text: str):
    """Adds ADDED by the broadcast sets of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("windows", lambda: None)
        sets: dict[int, WindowSet] = table.value
        for batch in batches:
            out = []
            for _, raw, offsets, start, end, doc, h in _slices(column(batch, text)):
                hits: dict[int, list] = {}
                for k, known in sets.items():
                    wh, first = spans.windows(h, doc, k)
                    for x, row in zip(*(v.tolist() for v in known.hits(wh))):
                        a = int(first[x])
                        owners = known.items(row, _phrase(raw, start[a : a + k], end[a : a + k]))
                        if owners is not None:
                            hits.setdefault(int(doc[a]), []).append((a, k, owners))
                out.append(_hit_columns(raw, offsets, start, end, doc, hits))
            yield pa.RecordBatch.from_arrays([*batch.columns, *_added(out)], names=[*batch.schema.names, *ADDED])

    return run


_FOUND = "array<struct<k:int,h:bigint,a:int,p:binary>>"


def _candidates(table, text: str, sizes: list[int]):
    """Adds the number of words and the windows that the bitmap can't turn away, with the first word's place in the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("windows", lambda: None)
        known: _Bits = table.value
        for batch in batches:
            n_words, found = [], []
            for _, raw, offsets, start, end, doc, h in _slices(column(batch, text)):
                first_word = np.searchsorted(doc, np.arange(len(offsets)))
                per: list[list] = [[] for _ in range(len(offsets) - 1)]
                for k in sizes:
                    wh, first = spans.windows(h, doc, k)
                    for x in known.hits(wh)[0].tolist():
                        a = int(first[x])
                        d = int(doc[a])
                        per[d].append({"k": k, "h": int(wh[x].view(np.int64)), "a": a - int(first_word[d]), "p": _phrase(raw, start[a : a + k], end[a : a + k])})
                n_words += np.diff(first_word).tolist()
                found += per
            kind = pa.list_(pa.struct([("k", pa.int32()), ("h", pa.int64()), ("a", pa.int32()), ("p", pa.binary())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64()), pa.array(found, kind)], names=[*batch.schema.names, WORDS, "found"])

    return run


def _verified(text: str, names: list[str]):
    """Adds ADDED to the columns of names by the windows (k, a, items) listed in column true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            true, out = column(batch, "true"), []
            for i, raw, offsets, start, end, doc, _ in _slices(column(batch, text)):
                first_word = np.searchsorted(doc, np.arange(len(offsets)))
                listed = true.slice(i, len(offsets) - 1).to_pylist()
                hits = {d: [(x["a"] + int(first_word[d]), x["k"], x["items"]) for x in xs] for d, xs in enumerate(listed) if xs}
                out.append(_hit_columns(raw, offsets, start, end, doc, hits))
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in names), *_added(out)], names=[*names, *ADDED])

    return run


def scan(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = 10, keep: list[str] | None = None, most_windows: int = MOST_WINDOWS, unnamed: bool = False) -> DataFrame:
    """docs with words, hit words, hit spans (in words, in bytes) and the sorted ids of items whose windows occur.

    keep names the columns of docs to carry along (all by default).
    """
    spark = docs.sparkSession
    docs = (docs if keep is None else docs.select(*keep)).drop(*ADDED)
    inner, of, _ = shielded(docs)
    schema = T.StructType([*inner.schema.fields, *T.StructType.fromDDL(_ADDED_DDL).fields])
    table = written(window_table(benchmark, item=item, text=item_text, size=size, unnamed=unnamed))
    n, listed, most = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.greatest(F.size("items"), F.lit(1))), F.lit(0)), F.coalesce(F.sum(F.octet_length("p")), F.lit(0))).first()
    if listed <= most_windows and most <= MOST_BYTES:
        rows = table.toArrow()
        sets = {k: WindowSet(rows.filter(pc.equal(rows["k"], k))) for k in sorted(set(rows["k"].to_pylist()))}
        out = in_arrow(inner, _scan(spark.sparkContext.broadcast(sets), of(text)), schema)
    else:
        out = _by_join(inner, table, of(text), n, schema)
    return out.toDF(*docs.columns, *ADDED)


def _by_join(inner: DataFrame, table: DataFrame, text: str, n: int, schema: T.StructType) -> DataFrame:
    """The rows of scan() for a set of any size. Only documents with a window that passes the bitmap meet a shuffle."""
    sizes = sorted(r["k"] for r in table.select("k").distinct().collect())
    bits = inner.sparkSession.sparkContext.broadcast(_bitmap(table, n))
    marked = inner.withColumn("row", F.monotonically_increasing_id())
    marked = written(in_arrow(marked, _candidates(bits, text, sizes), T.StructType([*marked.schema.fields, *T.StructType.fromDDL(f"{WORDS} long, found {_FOUND}").fields])))
    some = marked.where(F.size("found") > 0)
    at = some.select("row", F.explode("found").alias("x")).select("row", "x.*")
    true = at.join(table, ["k", "h", "p"]).groupBy("row").agg(F.collect_list(F.struct("k", "a", "items")).alias("true"))
    hit = in_arrow(some.drop(WORDS, "found").join(true, "row"), _verified(text, inner.columns), schema)
    clean = marked.where(F.size("found") == 0).unionByName(some.join(true.select("row"), "row", "left_anti"))
    none = [F.lit(0).cast("long").alias(HITS), *(F.array().cast("array<int>").alias(c) for c in (FIRST, LAST, STARTS, ENDS)), F.array().cast("array<string>").alias(ITEMS)]
    return hit.union(clean.select(*inner.columns, WORDS, *none))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """docs without the documents that hold a benchmark window; the columns of docs only."""
    inner, of, back = shielded(docs)
    return back(scan(inner, benchmark, text=of(text), **options).where(F.col(HITS) == 0))


def cut_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """docs with the hit spans taken out of their texts; the columns of docs only."""
    inner, of, back = shielded(docs)
    text = of(text)
    out = scan(inner, benchmark, text=text, **options)
    raw = F.col(text).cast("binary")
    starts = F.concat(F.array(F.lit(0)), F.col(ENDS))
    stops = F.concat(F.col(STARTS), F.array(F.octet_length(text)))
    kept = F.concat_ws("", F.transform(F.arrays_zip(starts.alias("s"), stops.alias("e")), lambda x: F.substring(raw, x["s"] + 1, x["e"] - x["s"]).cast("string")))
    out = out.withColumn(text, F.when(F.col(HITS) > 0, kept).otherwise(F.col(text)))
    return back(out)


def report(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """Per document: words, hit words, items, a digest of the items and whether it is contaminated."""
    out = scan(docs, benchmark, keep=[key, options.get("text", "text")], **options)
    return out.select(
        key,
        F.col(WORDS).alias("n_words"),
        F.col(HITS).alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ITEMS).cast("binary"), 256).alias("items_sha256"),
        (F.col(HITS) > 0).alias("contaminated"),
    )


#: DuckDB SQL for the rows of report() over tables documents and benchmark.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bk AS (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
dw AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bk) WHERE len(w) >= k)),
h AS (SELECT doc_id, dw.k, i, item_id FROM dw JOIN bw ON bw.k = dw.k AND bw.g = dw.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

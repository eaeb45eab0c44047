"""Repeated-string dedup by sampled suffix sorting and induction.

A byte goes if a 100-byte string that covers it also starts earlier. Instead of sorting every suffix, each 100-byte
string is led by one sampled suffix inside it: the leftmost of its 32-byte starts with the smallest hash, which any
other copy of the string samples as well. Consecutive strings with one leader form a segment, and a text is covered by
about three segments a hundred bytes.

1. The tuple of a segment (leader's hash, hash of its bytes, document, offset) goes through Spark's external sort,
   which spills to disk, so neighbours in sorted order are segments with common content. A segment equal to an earlier
   one is removed whole.
2. Where segments share a leader but not all of their bytes, their common part is shorter than the segment. Two of them
   can share a 100-byte string only if they agree in the 34 bytes before the leader or the 34 bytes after it; the tuples
   carry short marks of both. The first copies of those that agree with another are induced string by string: the same
   sort runs over their 100-byte strings.

Nothing depends on the size of a partition or shard, and no group is held in memory: sorted tuples are streamed. A sample of
documents shows which leaders are frequent; that changes the plan only. Of their tuples a task passes on the first copies
that it meets, and those of one leader are spread by their bytes and all induced, so that boilerplate of a third of all
documents fills no task.

Null and empty texts have no bytes. Rows with a null or repeated doc_id are documents of their own, ordered by doc_id
(nulls first) and text. A key that is no whole number is refused. Only key and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm import spans
from gleaner.llm.common import BATCH_SETTING, column, cut, in_arrow, setting, utf8, whole_numbers, written

#: Bytes of a string that may not occur twice, and of a leader.
SIZE, LEAD = 100, 32
#: Bytes beside the leader that two segments with a common string share on one side at least, and values of a mark of them.
BESIDE, MARKS = (SIZE - LEAD) // 2, 4096
#: Kinds of segments of one leader that are held to compare their marks; those of leaders with more are all induced.
HELD = 100_000
#: Ids of documents to look at again, and frequent leaders, that are broadcast; above this the first are joined by shuffle
#: and the others treated as any leader.
BROADCAST_IDS = 200_000
#: One in so many documents shows the frequent leaders: those with so many tuples there. First copies a task remembers of them.
SAMPLED, FREQUENT, SEEN = 64, 64, 1_000_000

#: spot packs first string (32 bits), marks before and after (12 bits each), further strings (7 bits) and done (1 bit).
_TUPLE = "lead long, same long, d long, spot long"


def _first_copies(lead, same, d, lo) -> np.ndarray:
    """False for tuples with an earlier copy among these."""
    order = np.lexsort((lo, d, same, lead))
    again = np.zeros(len(lead), bool)
    again[order[1:]] = (lead[order[1:]] == lead[order[:-1]]) & (same[order[1:]] == same[order[:-1]])
    return ~again


class _Seen:
    """The first copies that a task has met of tuples with frequent leaders."""

    def __init__(self, frequent: np.ndarray):
        self.frequent, self.first = frequent, {}

    def later(self, lead, same, d, lo) -> np.ndarray:
        """True for tuples with an earlier copy among those met before."""
        out = np.zeros(len(lead), bool)
        for i in np.flatnonzero(_among(lead, self.frequent)).tolist():
            key, now = (int(lead[i]), int(same[i])), (int(d[i]), int(lo[i]))
            first = self.first.get(key)
            if first is not None and first < now:
                out[i] = True
            elif first is not None or len(self.first) < SEEN:
                self.first[key] = now
        return out


def _among(lead: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(lead), bool)
    lead = lead.astype(np.int64)
    at = np.minimum(np.searchsorted(frequent, lead), len(frequent) - 1)
    return frequent[at] == lead


def _emit(lead, same, d, lo, more, before, after, seen: _Seen) -> pa.RecordBatch:
    """Tuples as a batch; those with an earlier copy here are done and need no sorting with their like."""
    done = ~_first_copies(lead, same, d, lo)
    done |= ~done & seen.later(lead, same, d, lo)
    lead = np.where(done, spans.mix(d.astype(np.uint64)), lead)
    spot = lo.astype(np.int64) << 32 | before << 20 | after << 8 | more << 1 | done
    return pa.RecordBatch.from_arrays([pa.array(lead.astype(np.int64)), pa.array(same.astype(np.int64)), pa.array(d), pa.array(spot)], names=["lead", "same", "d", "spot"])


def _mark(sums: np.ndarray, start: np.ndarray, end: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """A mark of the bytes between, from 1; 0 where they aren't all in the document."""
    h = spans.span_hash(sums, np.where(valid, start, 0), np.where(valid, end, 0), "bytes")
    return np.where(valid, 1 + (h % np.uint64(MARKS - 1)).astype(np.int64), 0)


def leaders(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each i: the leftmost position of the smallest value among hashes[i : i + width]."""
    value, at, size = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        smaller = value[step:] < value[:-step]
        value, at = np.where(smaller, value[step:], value[:-step]), np.where(smaller, at[step:], at[:-step])
        size += step
    return at


def segments(raw: np.ndarray, offsets: np.ndarray):
    """(leader's hash, segment's hash, document, first string, further strings, marks before and after the leader) of all
    segments; offsets in the batch."""
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= SIZE)
    if not len(long):
        return None
    sums = spans.prefix(spans.byte_values()[raw], "bytes")
    _, inverse = spans.powers("bytes", len(sums))
    n = len(raw) - LEAD + 1
    h = spans.mix((sums[LEAD:] - sums[:n]) * inverse[:n])
    at = leaders((h >> np.uint64(32)).astype(np.uint32), SIZE - LEAD + 1)
    count = sizes[long] - SIZE + 1
    doc = np.repeat(long, count)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + offsets[doc]
    lead = at[start]
    first = np.flatnonzero(np.concatenate(([True], (lead[1:] != lead[:-1]) | (doc[1:] != doc[:-1]))))
    lo, hi = start[first], start[np.concatenate((first[1:], [len(start)])) - 1]
    at, doc = lead[first].astype(np.int64), doc[first]
    before = _mark(sums, at - BESIDE, at, at - BESIDE >= offsets[doc])
    after = _mark(sums, at + LEAD, at + LEAD + BESIDE, at + LEAD + BESIDE <= offsets[doc + 1])
    return h[at], spans.span_hash(sums, lo, hi + SIZE, "bytes"), doc, lo, hi - lo, before, after


def _segment_tuples(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(frequent.value)
        for batch in batches:
            ids = column(batch, "d").to_numpy()
            raw, off = utf8(column(batch, "t"))
            for i, j in cut(off):
                found = segments(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                if found:
                    lead, same, doc, lo, more, before, after = found
                    yield _emit(lead, same, ids[i + doc], lo - (off[i + doc] - off[i]), more, before, after, seen)

    return run


def _string_tuples(frequent):
    """The 100-byte strings of the segments (lo, more, lead) listed with each document."""
    return lambda batches: _strings(batches, _Seen(frequent.value))


def _strings(batches: Iterator[pa.RecordBatch], seen: _Seen) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = utf8(column(batch, "t"))
        listed, edges = column(batch, "spots"), column(batch, "spots").offsets.to_numpy()
        flat = listed.values
        lo, more, lead = (flat.field(k).to_numpy()[0:] for k in range(3))
        ids = column(batch, "d").to_numpy()
        for i, j in cut(off):
            text, at = raw[off[i] : off[j]], off[i : j + 1] - off[i]
            sums = spans.prefix(spans.byte_values()[text], "bytes")
            mine = slice(edges[i], edges[j])
            doc = np.repeat(np.arange(j - i), np.diff(edges[i : j + 1]))
            n = more[mine].astype(np.int64) + 1
            owner = np.repeat(doc, n)
            within = np.repeat(lo[mine].astype(np.int64), n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = at[owner] + within
            yield _emit(np.repeat(lead[mine], n).view(np.uint64), spans.span_hash(sums, start, start + SIZE, "bytes"), ids[i + owner], within, *[np.zeros(len(within), np.int64)] * 3, seen)


def _agreeing(lead: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """True for rows whose mark before or after the leader another row of the same leader has."""
    _, group = np.unique(lead, return_inverse=True)
    out = np.zeros(len(lead), bool)
    for shift in (20, 8):
        mark = spot >> shift & (MARKS - 1)
        _, inverse, count = np.unique(group * MARKS + mark, return_inverse=True, return_counts=True)
        out |= (mark > 0) & (count[inverse] > 1)
    return out


def _neighbours(again: bool, frequent):
    """Streams sorted tuples: a tuple equal to the one before is removed; if again, the first copies of tuples that
    share a leader and a mark with another, or have a frequent leader, are passed on to be looked at string by string."""

    def out(lead, d, spot, check: bool):
        lo, more = (spot >> 32).astype(np.int32), (spot >> 1 & 127).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(lo), pa.array(more), pa.array(lead, mask=np.full(len(lead), not check)), pa.array(np.full(len(lead), check))], names=["d", "lo", "more", "lead", "check"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (lead, same) of the tuple before
        held = None  # first copies of the leader that may go on in the next batch
        crowded = None  # a leader with more than HELD of them
        for batch in batches:
            lead, same, d, spot = (column(batch, c).to_numpy() for c in ("lead", "same", "d", "spot"))
            done = spot & 1 == 1
            if done.any():
                yield out(lead[done], d[done], spot[done], False)
                lead, same, d, spot = (x[~done] for x in (lead, same, d, spot))
            if not len(lead):
                continue
            first_lead, first_same = last or (~lead[0], 0)
            new = (lead != np.concatenate(([first_lead], lead[:-1]))) | (same != np.concatenate(([first_same], same[:-1])))
            last = (lead[-1], same[-1])
            if not new.all():
                yield out(lead[~new], d[~new], spot[~new], False)
            if not again:
                continue
            rows = tuple(x[new] for x in (lead, d, spot))
            spread = _among(rows[0], frequent.value)
            if spread.any():
                yield out(*(x[spread] for x in rows), True)
                rows = tuple(x[~spread] for x in rows)
            if crowded is not None:
                more = rows[0] == crowded
                if more.any():
                    yield out(*(x[more] for x in rows), True)
                rows = tuple(x[~more] for x in rows)
            if held is not None:
                rows = tuple(np.concatenate((x, y)) for x, y in zip(held, rows))
            if not len(rows[0]):
                continue
            open_ = rows[0] == lead[-1]
            held, rows = tuple(x[open_] for x in rows), tuple(x[~open_] for x in rows)
            if len(held[0]) > HELD:
                crowded = lead[-1]
                yield out(*held, True)
                held = None
            near = _agreeing(rows[0], rows[2])
            if near.any():
                yield out(*(x[near] for x in rows), True)
        if held is not None:
            near = _agreeing(held[0], held[2])
            if near.any():
                yield out(*(x[near] for x in held), True)

    return run


def _sorted_neighbours(tuples: DataFrame, again: bool, frequent) -> DataFrame:
    n = int(tuples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("lead")] if again else [F.col("lead"), F.col("same")]  # strings need not meet by leader, which spreads a frequent one
    if again and len(frequent.value):
        spread = tuples.sparkSession.createDataFrame([(x,) for x in frequent.value.tolist()], "lead long").withColumn("spread", F.lit(True))
        tuples = tuples.join(F.broadcast(spread), "lead", "left")
        keys.append(F.when(F.col("spread"), F.col("same")).otherwise(0))
    ordered = tuples.repartition(n, *keys).select("lead", "same", "d", "spot").sortWithinPartitions("lead", "same", "d", "spot")
    with setting(tuples.sparkSession, BATCH_SETTING, "65536"):  # tuples are small
        return written(ordered.mapInArrow(_neighbours(again, frequent), "d long, lo int, more int, lead long, check boolean"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(d, lo, more): strings lo to lo + more of document d that start earlier elsewhere. texts: unique d, and t."""
    frequent = _frequent(texts)
    found = _sorted_neighbours(_arrow(texts, _segment_tuples(frequent), _TUPLE), True, frequent)
    spots = written(found.where("check").groupBy("d").agg(F.collect_list(F.struct("lo", "more", "lead")).alias("spots")))
    few = spots.count() <= BROADCAST_IDS
    chosen = texts.join(F.broadcast(spots.select("d")), "d", "left_semi") if few else texts
    strings = _arrow(chosen.join(spots, "d").select("d", "t", "spots"), _string_tuples(frequent), _TUPLE)
    return found.where("not check").select("d", "lo", "more").union(_sorted_neighbours(strings, False, frequent).select("d", "lo", "more"))


def _frequent(texts: DataFrame):
    """A broadcast sorted array of the leaders that a sample of documents shows to be frequent."""
    spark = texts.sparkSession
    none = spark.sparkContext.broadcast(np.zeros(0, np.int64))
    some = _arrow(texts.where(F.pmod(F.xxhash64("d"), F.lit(SAMPLED)) == 0), _segment_tuples(none), _TUPLE).where("spot & 1 = 0")
    listed = some.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT).select("lead").limit(BROADCAST_IDS + 1).collect()
    if not listed or len(listed) > BROADCAST_IDS:
        return none
    return spark.sparkContext.broadcast(np.array(sorted(r["lead"] for r in listed), np.int64))


def _arrow(df: DataFrame, f, schema: str) -> DataFrame:
    return in_arrow(df, f, schema)


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = utf8(column(batch, "t"))
        listed = column(batch, "gone")
        edges, flat = listed.offsets.to_numpy(), listed.values
        lo, more = (flat.field(k).to_numpy() for k in range(2))
        valid = listed.is_valid().to_numpy(zero_copy_only=False)
        kept, removed, runs = [], [], []
        for i in range(len(batch)):
            text = raw[off[i] : off[i + 1]]
            if not valid[i]:
                kept.append(text.tobytes()), removed.append(0), runs.append(0)
                continue
            a, z = edges[i], edges[i + 1]
            depth = np.bincount(lo[a:z], minlength=len(text) + 1) - np.bincount(lo[a:z].astype(np.int64) + more[a:z] + SIZE, minlength=len(text) + 1)
            away = np.cumsum(depth[:-1]) > 0
            kept.append(text[~away].tobytes()), removed.append(int(away.sum())), runs.append(int((away[1:] & ~away[:-1]).sum() + away[0]))
        yield pa.RecordBatch.from_arrays([column(batch, "k"), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=["k", "n_bytes", "n_removed", "n_spans", "kept"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for out in _keep(batches):
        sha = [hashlib.sha256(x.as_py()).hexdigest() for x in out.column(4)]
        yield pa.RecordBatch.from_arrays([*out.columns[:4], pa.array(sha, pa.string())], names=["k", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, d, t): key, a unique document number in order, and the text. Keys that are unique and not null are the numbers."""
    whole_numbers(docs, key)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    if rows.groupBy("k").count().where("count > 1 or k is null").isEmpty():
        return rows.withColumn("d", F.col("k"))
    ordered = rows.sort(F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first())
    return written(ordered.withColumn("d", F.monotonically_increasing_id()))


def _applied(docs: DataFrame, key: str, text: str, f, last: str) -> DataFrame:
    rows = _numbered(docs, key, text)
    gone = repeated_spans(rows.select("d", "t")).groupBy("d").agg(F.collect_list(F.struct("lo", "more")).alias("gone"))
    joined = rows.join(gone, "d", "left").select("k", "t", "gone")
    return _arrow(joined, f, f"k long, n_bytes long, n_removed long, n_spans long, {last}").withColumnRenamed("k", key)


def dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, bytes, removed bytes, removed runs and the bytes that stay (kept; a cut may split a character)."""
    return _applied(docs, key, text, _keep, "kept binary")


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """dedup() with a digest of the bytes that stay instead of the bytes."""
    return _applied(docs, key, text, _digest, "kept_sha256 string")


#: DuckDB SQL for the rows of report() over table documents with unique ids.
SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS g FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
f AS (SELECT g, min((doc_id, i)) AS first FROM w GROUP BY g HAVING count(*) > 1),
l AS (SELECT doc_id, i FROM w JOIN f USING (g) WHERE (doc_id, i) > first),
m AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens FROM l),
r AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m) GROUP BY doc_id, k),
p AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS b FROM r),
k AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS head FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

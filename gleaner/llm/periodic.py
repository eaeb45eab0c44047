"""Periodic run detection: bit-parallel lags over big-integer bit planes of word ids.

The words of a text get whole-number ids, and bit b of all ids is one big integer, a plane. A plane XOR itself shifted by a
lag has a bit wherever words that lag apart differ in bit b; the OR over the planes marks every mismatch. ANDing the agreeing
bits with themselves at doubled shifts leaves a bit only where enough neighbours agree, so one lag of many texts is a few
operations on integers of as many bits as there are words. Short texts share one integer, with a word of its own between them.

A run is a stretch of words with smallest period q, of at least `least` words and `times` * q, that no neighbour extends. Runs
whose period is a multiple of a run's around them are left out: at three periods and more these are all that are not smallest.

Null, empty and word-free texts have no runs and collapse to an empty text; a text of one repeated word is one run; repeated
rows repeat; very long texts cost memory in proportion, and their lags pass a sieve first (see `_may_run`), which changes no result.
Other columns pass through, but for those named as an added one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.common import SPACE, column, in_arrow, let, utf8

#: Columns that detection adds: number of words, runs by start and period, the text without the repeats.
ADDED = WORDS, RUNS, COLLAPSED = ("_gl_n_words", "_gl_runs", "_gl_collapsed")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Words of texts that share one integer, words from which lags are sieved, the first lag that is, and planes to look at first.
TOGETHER, SIEVED, SIEVED_LAG, FIRST_PLANES = 1 << 14, 1 << 15, 64, 3


def planes(ids: np.ndarray) -> list[int]:
    """Bit b of every id as one integer, the first id lowest."""
    bits = max(1, int(ids.max()).bit_length())
    return [int.from_bytes(np.packbits((ids >> b & 1).astype(np.uint8), bitorder="little").tobytes(), "little") for b in range(bits)]


def _enough(z: int, least: int) -> int:
    """The places from which `least` bits of z in a row are set."""
    width = 1
    while z and 2 * width <= least:
        z &= z >> width
        width *= 2
    return z & z >> least - width if z and width < least else z


def agreements(of: list[int], n: int, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, number) of the stretches of at least `least` words that equal the word a lag later. The first planes turn
    nearly every lag away before the others are looked at."""
    every, mismatch = (1 << n - lag) - 1, 0
    for some in (of[:FIRST_PLANES], of[FIRST_PLANES:]):
        for plane in some:
            mismatch |= plane ^ plane >> lag
        z = _enough((mismatch & every) ^ every, least)
        if not z:
            return (np.zeros(0, np.int64),) * 2
    bits = np.unpackbits(np.frombuffer(z.to_bytes((n + 7) // 8, "little"), np.uint8), bitorder="little")
    edges = np.diff(np.concatenate(([0], bits, [0])).astype(np.int8))
    start = np.flatnonzero(edges == 1)
    return start, np.flatnonzero(edges == -1) - start + least - 1


class _Known:
    """Runs found so far by period, to tell a multiple of a period from a period."""

    def __init__(self):
        self.of: dict[int, tuple[list[int], list[int]]] = {}

    def add(self, start: int, end: int, period: int) -> None:
        starts, ends = self.of.setdefault(period, ([], []))
        starts.append(start)
        ends.append(end)

    def dividing(self, lag: int) -> list[tuple[list[int], list[int]]]:
        return [x for p, x in self.of.items() if lag % p == 0]


def _covered(runs: list[tuple[list[int], list[int]]], start: int, end: int) -> bool:
    """Whether one of runs holds start to end; starts and ends of one period rise together."""
    return any((i := bisect_right(starts, start)) and ends[i - 1] >= end for starts, ends in runs)


def _may_run(ids: np.ndarray, lag: int, times: int, known: _Known) -> bool:
    """Whether a new run of this period is possible: the agreeing stretch of a run is at least two lags long, so it holds a
    whole block that starts at a multiple of the lag. Blocks are tried at a few words, then at more; those inside a run
    whose period divides the lag belong to no run of their own."""
    blocks = len(ids) // lag - 1
    k = np.flatnonzero(ids[: blocks * lag : lag] == ids[lag : (blocks + 1) * lag : lag])
    if not len(k):
        return False
    for starts, ends in known.dividing(lag):
        i = np.searchsorted(starts, k * lag, "right")
        k = k[~((i > 0) & (np.asarray(ends)[i - 1] >= (k + 2) * lag))]
    for parts in (2, 4, 8, 16, 32, 64):
        for j in range(1, parts, 2):
            if not len(k):
                return False
            at = k * lag + j * lag // parts
            k = k[ids[at] == ids[at + lag]]
    return len(k) > 0


def find(ids: np.ndarray, longest: int, *, least: int = 24, times: int = 3, sieved: int = SIEVED) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs among ids; longest: words of the longest text in it."""
    out, known = [], _Known()
    if longest < least or times < 3:
        if times < 3:
            raise ValueError("a run has three periods or more")
        return out
    of, n = planes(ids), len(ids)
    for lag in range(1, longest // times + 1):
        if n > sieved and lag >= SIEVED_LAG and not _may_run(ids, lag, times, known):
            continue
        start, number = agreements(of, n, lag, max(least - lag, (times - 1) * lag))
        if len(start):
            smaller = known.dividing(lag)
            for a, k in zip(start.tolist(), number.tolist()):
                if not _covered(smaller, a, a + k + lag):
                    out.append((a, k + lag, lag))
                    known.add(a, a + k + lag, lag)
    return out


def _together(sizes: np.ndarray, least: int, most: int) -> Iterator[np.ndarray]:
    """Texts of similar size whose words come to `most` together, or one longer text; texts too short for a run are left out."""
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], least) :]
    i = 0
    while i < len(order):
        total, j = int(sizes[order[i]]), i + 1
        while j < len(order) and total + sizes[order[j]] <= most:
            total += int(sizes[order[j]])
            j += 1
        yield order[i:j]
        i = j


def runs_of_texts(words: list[list], *, least: int = 24, times: int = 3, together: int = TOGETHER, sieved: int = SIEVED) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for group in _together(np.array([len(w) for w in words], np.int64), least, together):
        seen: dict = {}
        parts, at, place = [], [], 0
        for d in group.tolist():
            parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words[d]), np.int64, len(words[d])))
            at.append(place)
            place += len(words[d]) + 1
        apart = len(seen) + np.arange(len(parts))
        ids = np.concatenate([x for k, p in enumerate(parts) for x in (p, apart[k : k + 1])])[:-1]
        for start, length, period in find(ids, max(map(len, parts)), least=least, times=times, sieved=sieved):
            k = bisect_right(at, start) - 1
            out[int(group[k])].append((start - at[k], length, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are in no run beyond its first period, with one space between them."""
    if not runs:
        return b" ".join(words)
    away = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        away[start + period] += 1
        away[start + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(away[:-1]) == 0).tolist())


def _detect(text: str, least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8(column(batch, text))
            words = [raw[a:b].tobytes().split() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]  # bytes split at ASCII white space only
            runs = runs_of_texts(words, least=least, times=times)
            short = [collapsed(w, r) for w, r in zip(words, runs)]
            ends = np.cumsum([0, *map(len, runs)])
            flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(_RUN)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(w) for w in words], pa.int64()), found, pa.array(short, pa.string())], names=[*batch.schema.names, *ADDED])

    return run


def detect(docs: DataFrame, *, text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """docs with _gl_n_words, _gl_runs (start, length, period, in words) and _gl_collapsed."""
    inner = docs.drop(*ADDED)
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in inner.schema.fields), f"{WORDS} long", f"{RUNS} array<struct<start:bigint,length:bigint,period:bigint>>", f"{COLLAPSED} string"])
    return in_arrow(inner, _detect(text, least, times), schema)


def _repeated(text: Column, key: Column) -> Column:
    """The text of the contract: of every tenth key by checksum, a tail that repeats its own beginning."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, SPACE + "+"), lambda x: x != "")

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return let(F.struct(a.cast("int").alias("a"), p.cast("int").alias("p")), lambda s: F.array_join(F.transform(w, lambda x, i: F.when(i < s["a"], x).otherwise(F.get(w, s["a"] + (i - s["a"]) % s["p"]))), " "))

    return F.when(h % 10 == 0, let(words, lambda w: F.when(F.size(w) > 0, tail(w)))).otherwise(text)


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """Per row: number of runs, the one with the greatest length / period, digests of the runs and of the collapsed text."""
    rows = docs.select(F.col(key).alias("k"), _repeated(F.col(text), F.col(key)).alias("t"))
    out = detect(rows, text="t", least=least, times=times)
    more = lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    best = F.aggregate(RUNS, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), more)
    lines = F.array_join(F.transform(RUNS, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), (F.concat(r["period"].cast("string"), F.lit("\n"))))), "")
    out = out.select("k", F.size(RUNS).cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col(COLLAPSED).cast("binary"), 256).alias("collapsed_sha256"), F.col(WORDS).alias("n_words"))
    exponent = F.expr("1000 * b.length div b.period").alias("exponent_milli")
    return out.select(F.col("k").alias(key), "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"), exponent, "runs_sha256", "collapsed_sha256", "n_words")

"""The binary price history (MTGH) and its daily delta (MTGD): readers and writers over Spark rows.

The layouts are fixed by the files that exist: little-endian header, then cards with masks and varint series.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Fixed values of the format: magic words, version and the finishes of the mask's bits.
HISTORY, DELTA, VERSION, FINISHES = b"MTGH", b"MTGD", 1, 3

#: Points, or series, that a reader hands on together.
ROWS = 50_000


def varints(raw: np.ndarray) -> np.ndarray:
    """All varints of a byte array at once."""
    ends = np.flatnonzero(raw < 0x80)
    if not len(ends):
        return np.zeros(0, np.int64)
    starts = np.concatenate(([0], ends[:-1] + 1))
    shift = 7 * (np.arange(ends[-1] + 1) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((raw[: ends[-1] + 1].astype(np.int64) & 0x7F) << shift, starts)


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The varints of values (0 or more) in a row, and where each ends."""
    v = values.astype(np.int64)
    if len(v) and v.min() < 0:
        raise ValueError("a varint is 0 or more")
    size = np.ones(len(v), np.int64)
    for bits in range(7, 63, 7):
        size += v >> bits > 0
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(v) else 0) - np.repeat(ends - size, size)
    out = np.repeat(v, size) >> 7 * at & 0x7F | np.where(at < np.repeat(size, size) - 1, 0x80, 0)
    return out.astype(np.uint8), ends


def to_varints(values: np.ndarray) -> bytes:
    return packed(values)[0].tobytes()


def zigzag(v: np.ndarray) -> np.ndarray:
    return np.where(v >= 0, v << 1, (-v << 1) - 1)


def unzigzag(v: np.ndarray) -> np.ndarray:
    return (v >> 1) ^ -(v & 1)


def decode_history(data: bytes, wanted: set[str] | None = None) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """(printing, finish, days, cents) of every wanted series."""
    if data[:4] != HISTORY or data[4] != VERSION:
        raise ValueError("not a price history of version 1")
    first, _, count = struct.unpack_from("<III", data, 5)
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 0x80)
    at = 17

    def take(n: int) -> np.ndarray:
        nonlocal at
        if not n:
            return np.zeros(0, np.int64)
        stop = int(ends[np.searchsorted(ends, at) + n - 1]) + 1
        values, at = varints(raw[at:stop]), stop
        return values

    def one() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    for _ in range(count):
        printing, history, latest = str(uuid.UUID(bytes=data[at : at + 16])), data[at + 16], data[at + 17]
        at += 18
        for finish in range(FINISHES):
            if history >> finish & 1:
                pairs = take(2 * one())
                if wanted is None or printing in wanted:
                    yield printing, finish, first + np.cumsum(pairs[0::2]), np.cumsum(unzigzag(pairs[1::2]))
        take(2 * int(latest).bit_count())


def encode_history(series: dict[str, dict[int, list[tuple[int, int]]]], first: int, last: int) -> bytes:
    """The file of {printing: {finish: [(day, cents), ...]}}, days ascending; without latest prices."""
    out = [HISTORY, bytes([VERSION]), struct.pack("<III", first, last, len(series))]
    for printing, finishes in series.items():
        mask = sum(1 << f for f, points in finishes.items() if points)
        out += [uuid.UUID(printing).bytes, bytes([mask, 0])]
        for f in sorted(finishes):
            if finishes[f]:
                days, cents = (np.array(x, np.int64) for x in zip(*finishes[f]))
                pairs = np.stack((np.diff(days, prepend=first), zigzag(np.diff(cents, prepend=0))), axis=1).ravel()
                out += [to_varints(np.array([len(days)])), to_varints(pairs)]
    return b"".join(out)


def encode_points(printing: np.ndarray, finish: np.ndarray, day: np.ndarray, cents: np.ndarray, first: int, last: int) -> bytes:
    """encode_history() of points in order of printing, finish and day: all series are packed at once, and cut by printing."""
    n = len(printing)
    card = np.flatnonzero(np.r_[True, printing[1:] != printing[:-1]]) if n else np.zeros(0, np.int64)
    head = np.zeros(n, bool)
    head[card] = True
    head[1:] |= finish[1:] != finish[:-1]
    start = np.flatnonzero(head)
    days, change = np.diff(day, prepend=first), np.diff(cents, prepend=0)
    days[start], change[start] = day[start] - first, cents[start]
    pairs = np.stack((days, zigzag(change)), axis=1).ravel()
    raw, ends = packed(np.insert(pairs, 2 * start, np.diff(start, append=n)))
    raw, own = raw.tobytes(), np.searchsorted(start, card)
    mask = np.bitwise_or.reduceat(1 << finish[start], own).tolist() if n else []
    before = np.concatenate(([0], ends))[2 * card + own].tolist() + [len(raw)] if n else []
    out = [HISTORY, bytes([VERSION]), struct.pack("<III", first, last, len(card))]
    for i, p in enumerate(printing[card]):
        out += [uuid.UUID(p).bytes, bytes([mask[i], 0]), raw[before[i] : before[i + 1]]]
    return b"".join(out)


def encode_day(rows: list[tuple[str, int, int | None]], day: int, previous: int) -> bytes:
    """The delta of (printing, finish, cents or None for gone) rows; printings in order, without latest prices."""
    cards: dict[str, dict[int, int | None]] = {}
    for printing, finish, cents in rows:
        cards.setdefault(printing, {})[finish] = cents
    out = [DELTA, bytes([VERSION]), struct.pack("<III", day, previous, len(cards))]
    for printing, now in cards.items():
        priced = sorted(f for f, c in now.items() if c is not None)
        out += [uuid.UUID(printing).bytes, bytes([sum(1 << f for f in priced), sum(1 << f for f, c in now.items() if c is None), 0])]
        out.append(to_varints(np.array([now[f] for f in priced], np.int64)))
    return b"".join(out)


def read(spark: SparkSession, path: str, **filters) -> DataFrame:
    """(printing, finish, day, cents) of the history files at path, filtered as points()."""
    return points(spark.read.format("binaryFile").load(path).select("content"), **filters)


def points(contents: DataFrame, wanted: list[str] | None = None, finish: int | None = None, since: int | None = None) -> DataFrame:
    """(printing, finish, day, cents) of histories in a column content; the filters work while decoding."""
    keep = set(wanted) if wanted is not None else None

    def frame(found: list) -> pd.DataFrame:
        sizes = [len(days) for _, _, days, _ in found]
        each = lambda k: np.concatenate([x[k] for x in found])
        return pd.DataFrame({"printing": np.repeat(np.array([x[0] for x in found], object), sizes), "finish": np.repeat([x[1] for x in found], sizes), "day": each(2), "cents": each(3)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, n = [], 0  # series of many cards go out together: a frame costs more than the points of a card
        for pdf in batches:
            for data in pdf["content"]:
                for printing, f, days, cents in decode_history(data, keep):
                    if finish is None or f == finish:
                        near = days >= since if since is not None else slice(None)
                        found.append((printing, f, days[near], cents[near]))
                        n += len(found[-1][2])
                        if n >= ROWS or len(found) >= ROWS:
                            yield frame(found)
                            found, n = [], 0
        if found:
            yield frame(found)

    rows = contents.select("content").mapInPandas(run, "printing string, finish int, day int, cents long")
    return rows.withColumn("day", F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")))


def files(points: DataFrame, first: int, last: int, parts: int) -> DataFrame:
    """(part, content): histories of (printing, finish, day number, cents) rows, printings dealt into parts files.

    A part is encoded in one task; choose parts so that a file's share of the points fits one.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["printing", "finish", "day"])
        whole = lambda c: pdf[c].to_numpy(np.int64)
        content = encode_points(pdf["printing"].to_numpy(object), whole("finish"), whole("day"), whole("cents"), first, last)
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "content": [content]})

    dealt = points.withColumn("part", F.pmod(F.xxhash64("printing"), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInPandas(run, "part int, content binary")

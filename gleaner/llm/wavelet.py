"""Token-id files: a wavelet matrix per shard, with access, counting and occurrence lookup on the compressed form.

Ids are written in ascending doc_id order (rows without doc_id first, then by text), each document followed by an end
id. A shard is one Parquet file of one row: as many bit-planes as the vocabulary's largest id has bits, a rank directory for
each, and the documents with their lengths. A shard holds about SHARD_TOKENS tokens, however large its partition is.

Null and empty texts are the end id alone. Repeated rows are repeated documents. A key that is no whole number is refused.
Only key and text are read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleaner.llm import spans
from gleaner.llm.common import column, cut, in_arrow, kept, shared_folder, utf8, whole_numbers

STEP = 512
SHARD_TOKENS, CACHE = 2_000_000, 1_500_000
SPECIAL = "<|endoftext|>"
FORMAT = "part int, nth int, n_tokens long, docs array<long>, lengths array<int>, zeros array<int>, planes array<binary>, ranks array<binary>"


def planes_of(largest: int) -> int:
    """Bits of the largest id."""
    return max(1, int(largest).bit_length())


def _kind(planes: int) -> type:
    return np.uint16 if planes <= 16 else np.uint32


class WaveletMatrix:
    """Ids as bit-planes from the highest bit down; each plane stably moves zeros before ones."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes], ranks: list[bytes]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks
        self._bytes = [np.frombuffer(p, np.uint8) for p in planes]
        self._ranks = [np.frombuffer(r, np.uint32) for r in ranks]

    @classmethod
    def of(cls, ids: np.ndarray, width: int | None = None) -> WaveletMatrix:
        """width: the number of planes, that of the largest id if not given."""
        width = planes_of(ids.max(initial=0)) if width is None else width
        kind = _kind(width)
        now, zeros, planes, ranks = ids.astype(kind), [], [], []
        for bit in range(width - 1, -1, -1):
            one = (now & kind(1 << bit)) != 0
            packed = np.packbits(one, bitorder="little")
            planes.append(packed.tobytes())
            whole = np.zeros(-(-len(packed) // (STEP // 8)) * (STEP // 8), np.uint8)
            whole[: len(packed)] = packed
            ones = np.bitwise_count(whole.view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate(([0], np.cumsum(ones))).astype(np.uint32).tobytes())
            low = np.compress(~one, now)
            zeros.append(len(low))
            now = np.concatenate((low, np.compress(one, now)))
        return cls(len(ids), zeros, planes, ranks)

    def _bit(self, plane: int, i: int) -> int:
        return int(self._bytes[plane][i >> 3] >> (i & 7)) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones before position i."""
        block = i // STEP
        part = self._bytes[plane][block * (STEP // 8) : i >> 3]
        rest = int(self._bytes[plane][i >> 3]) & ((1 << (i & 7)) - 1) if i & 7 else 0
        return int(self._ranks[plane][block]) + int(np.bitwise_count(part).sum()) + rest.bit_count()

    def _select(self, plane: int, k: int, bit: int) -> int:
        """The position of the k-th (from 0) one or zero."""
        ranks = self._ranks[plane].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks), dtype=np.int64) * STEP - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self._bytes[plane][block * (STEP // 8) : (block + 1) * (STEP // 8)], bitorder="little")
        return block * STEP + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        value = 0
        for p in range(len(self.planes)):
            bit = self._bit(p, i)
            value = value << 1 | bit
            i = self.zeros[p] + self._ones(p, i) if bit else i - self._ones(p, i)
        return value

    def _range(self, value: int, a: int, b: int) -> tuple[int, int]:
        """Where value's occurrences within [a, b) end up after the last plane."""
        if value >> len(self.planes):
            return a, a  # no id has that many bits
        for p in range(len(self.planes)):
            if value >> (len(self.planes) - 1 - p) & 1:
                a, b = self.zeros[p] + self._ones(p, a), self.zeros[p] + self._ones(p, b)
            else:
                a, b = a - self._ones(p, a), b - self._ones(p, b)
        return a, b

    def count(self, value: int, a: int = 0, b: int | None = None) -> int:
        a, b = self._range(value, a, self.n if b is None else b)
        return b - a

    def select(self, value: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of value."""
        i = self._range(value, 0, self.n)[0] + k
        for p in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - p) & 1
            i = self._select(p, i - self.zeros[p] if one else i, one)
        return i

    def decode(self) -> np.ndarray:
        """All ids, by undoing the moves plane by plane from the last."""
        width = len(self.planes)
        kind = _kind(width)
        now = np.zeros(self.n, kind)
        for p in range(width - 1, -1, -1):
            one = np.unpackbits(self._bytes[p], count=self.n, bitorder="little").view(bool)
            back = np.empty_like(now)
            back[np.flatnonzero(~one)] = now[: self.zeros[p]]  # indexes, as masks are several times slower
            back[np.flatnonzero(one)] = now[self.zeros[p] :] | kind(1 << (width - 1 - p))
            now = back
        return now


class _Table:
    """A hash table of 64-bit keys to numbers, looked up and filled for whole arrays at once (linear probing)."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.numbers, self.size = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those that are absent."""
        out, at = np.full(len(h), -1, np.int32), (h & self.mask).astype(np.int64)
        open_ = np.arange(len(h))
        while len(open_):
            key = self.keys[at]
            hit = np.flatnonzero(key == h[open_])
            out[open_[hit]] = self.numbers[at[hit]]
            go = np.flatnonzero((key != h[open_]) & (key != 0))
            open_, at = open_[go], (at[go] + 1) & int(self.mask)
        return out

    def add(self, h: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct keys that are absent."""
        at, left = (h & self.mask).astype(np.int64), np.arange(len(h))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.numbers[at[won]] = h[won], numbers[won]
            left = left[~np.isin(left, won, assume_unique=True)]
            at[left] = (at[left] + 1) & int(self.mask)
        self.size += len(h)


#: Classes of bytes of texts in ASCII and Latin letters: letter, digit, white space, other.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
_CLASS[48:58] = 1
_CLASS[[9, 10, 13, 32]] = 2
#: Bytes that such texts lack: controls, and lead bytes of other characters than U+00C0 to U+024F.
_FOREIGN = np.zeros(256, bool)
_FOREIGN[[*range(9), 11, 12, *range(14, 32), 127, *range(0xC0, 0xC3), *range(0xCA, 256)]] = True


def pretokens(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The first byte of each pre-token of the tokenizer's pattern, for texts in ASCII and Latin letters.

    A pre-token is a run of letters, of digits or of other characters, each with the space before it if there is one;
    white space without that last character; or an apostrophe with s, t, m, d, re, ve or ll where no space leads it.
    """
    n = len(raw)
    kind = _CLASS[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = edge[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == 2) & (kind[1:] != 2) & ~edge[1:n])  # white space before something else
    begins[last] = True
    begins[last[raw[last] == 32] + 1] = False
    quote = np.flatnonzero((raw[:-1] == 39) & begins[:-1] & (kind[1:] == 0) & ~edge[1:n])
    x, y = raw[quote + 1], raw[np.minimum(quote + 2, n - 1)]
    inside = (quote + 2 < n) & ~edge[np.minimum(quote + 2, n)]
    one = np.isin(x, np.frombuffer(b"stmd", np.uint8))
    two = inside & ((y == 101) & ((x == 114) | (x == 118)) | (x == 108) & (y == 108))
    tail = quote[one | two]
    after = tail + np.where(one, 2, 3)[one | two]
    begins[tail + 1] = False
    begins[after[after < n]] = True
    return np.flatnonzero(begins)


class Encoder:
    """The tokenizers library's encoder, asked once for each pre-token, as its merges never cross one.

    Texts with other characters than ASCII and Latin letters, or with the special token, go to the library whole. Of the
    rest the pre-tokens are cut and looked up by two hashes of 64 and 32 bits for a whole batch at once (where only one of them
    agrees, the batch goes to the library); up to CACHE of them are kept from batch to batch, later ones are encoded anew.
    """

    def __init__(self, tokenizer_file: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"))
        vocabulary = self.lib.get_vocab()
        self.largest = max(vocabulary.values(), default=0)
        self.kind = _kind(planes_of(self.largest))
        self.width = np.zeros(self.largest + 1, np.int64)
        for piece, i in vocabulary.items():
            self.width[i] = len(piece)  # in the byte-level alphabet, one character is one byte
        self.plain = re.compile(" [A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch
        self.known = _Table(CACHE.bit_length() + 1)
        self.flat, self.first, self.size, self.second = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.values = (spans.byte_values() >> np.uint64(32)).astype(np.uint32)
        self.powers = np.zeros((2, 0), np.uint32)

    def _ids(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first id of each, number of ids of each). Space-led words are encoded as one text and cut apart by width."""
        first, size, parts, at = np.zeros(len(pretokens), np.int64), np.zeros(len(pretokens), np.int64), [], 0
        led = np.array([self.plain(x) is not None for x in pretokens])
        plain, other = np.flatnonzero(led), np.flatnonzero(~led)
        for i in range(0, len(plain), 2000):
            some = plain[i : i + 2000]
            found = np.array(self.lib.encode("".join([pretokens[k] for k in some]), add_special_tokens=False).ids)
            ends = np.searchsorted(np.cumsum(self.width[found]), np.cumsum([len(pretokens[k].encode()) for k in some])) + 1
            size[some] = np.diff(ends, prepend=0)
            first[some] = at + ends - size[some]
            parts.append(found)
            at += len(found)
        for i in range(0, len(other), 2000):
            some = other[i : i + 2000]
            found = [e.ids for e in self.lib.encode_batch_fast([pretokens[k] for k in some], add_special_tokens=False)]
            size[some] = [len(x) for x in found]
            first[some] = at + np.cumsum(size[some]) - size[some]
            parts.append(np.array([x for ids in found for x in ids]))
            at += len(parts[-1])
        return np.concatenate(parts).astype(self.kind), first, size

    def _second(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A second hash of the spans, of 32 bits and over other powers, as spans.span_hash is made."""
        if self.powers.shape[1] < len(raw):
            base = 0x9E3779B1
            self.powers = np.stack([np.multiply.accumulate(np.concatenate(([1], np.full(len(raw) + (1 << 16), x))).astype(np.uint32), dtype=np.uint32) for x in (base, pow(base, -1, 1 << 32))])
        sums = np.zeros(len(raw) + 1, np.uint32)
        np.cumsum(self.values[raw] * self.powers[0, : len(raw)], dtype=np.uint32, out=sums[1:])
        return (sums[end] - sums[start]) * self.powers[1][start]

    def _latin(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray] | None:
        """The ids of each text in ASCII and Latin letters; None if two pre-tokens have the same first hash."""
        start = pretokens(raw, offsets)
        end = np.concatenate((start[1:], [len(raw)]))
        h = spans.span_hash(spans.prefix(spans.byte_values()[raw], "bytes"), start, end, "bytes") | np.uint64(1)
        second = self._second(raw, start, end)
        number = self.known.find(h)
        flat, first, size = self.flat, self.first, self.size
        found = np.flatnonzero(number >= 0)
        if (self.second[number[found]] != second[found]).any():
            return None
        missing = np.flatnonzero(number < 0)
        if len(missing):
            keys, where, again = np.unique(h[missing], return_index=True, return_inverse=True)
            where = missing[where]
            if (second[where][again] != second[missing]).any():
                return None
            ids, at, n = self._ids([raw[a:b].tobytes().decode() for a, b in zip(start[where].tolist(), end[where].tolist())])
            number[missing] = len(first) + again
            first, size, flat = np.concatenate((first, at + len(flat))), np.concatenate((size, n)), np.concatenate((flat, ids))
            if len(first) <= CACHE:
                self.known.add(keys, np.arange(len(self.first), len(first), dtype=np.int32))
                self.flat, self.first, self.size, self.second = flat, first, size, np.concatenate((self.second, second[where]))
        first, size = first[number], size[number]
        ends = np.cumsum(size)
        ids = flat[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate(([0], ends))[np.searchsorted(start, offsets)]
        return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        raw, offsets = utf8(texts)
        out = []
        for i, j in cut(offsets):
            part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            odd = _FOREIGN[part]
            odd[:-1] |= (part[:-1] == 0xC3) & ((part[1:] == 0x97) | (part[1:] == 0xB7))
            bad = np.diff(np.concatenate(([0], np.cumsum(odd)))[at]) > 0
            for k in range(j - i):
                bad[k] = bad[k] or SPECIAL.encode() in part[at[k] : at[k + 1]].tobytes()
            good = np.flatnonzero(~bad)
            latin = self._latin(*utf8(texts.slice(i, j - i).take(pa.array(good)))) if len(good) else []
            if latin is None:
                bad[:] = True
            latin = iter(latin or ())
            whole = (np.array(self.lib.encode(x.as_py() or "", add_special_tokens=False).ids, self.kind) for x in texts.slice(i, j - i).take(pa.array(np.flatnonzero(bad))))
            out += [next(whole) if b else next(latin) for b in bad.tolist()]
        return out


def encoder(tokenizer_file: str | None) -> Encoder:
    """One encoder per Python worker and file, so that its cache outlives a task."""
    return kept(("tokens", tokenizer_file), lambda: Encoder(tokenizer_file))


def _shards(tokenizer_file: str | None, end_id: int):
    def row(nth: int, docs: list, parts: list[np.ndarray], width: int) -> pa.RecordBatch:
        ids = np.concatenate(parts)
        m = WaveletMatrix.of(ids, width)
        values = [[TaskContext.get().partitionId()], [nth], [len(ids)], [docs], [[len(p) for p in parts]], [m.zeros], [m.planes], [m.ranks]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in FORMAT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        width = planes_of(max(encode.largest, end_id))
        end = np.array([end_id], _kind(width))
        nth, docs, parts, size = 0, [], [], 0
        for batch in batches:
            for d, ids in zip(column(batch, "d").to_pylist(), encode(column(batch, "t"))):
                docs.append(d)
                parts.append(np.concatenate((ids, end)))
                size += len(parts[-1])
                if size >= SHARD_TOKENS:
                    yield row(nth, docs, parts, width)
                    nth, docs, parts, size = nth + 1, [], [], 0
        if docs:
            yield row(nth, docs, parts, width)

    return run


def write(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", tokenizer_file: str | None = None, end_id: int = 2) -> None:
    """Encodes docs and writes their shards to path, in ascending key order over partitions and shards."""
    whole_numbers(docs, key)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("d"), F.col(text).alias("t"))
    ordered = rows.repartitionByRange(n, "d").sortWithinPartitions("d", "t")
    in_arrow(ordered, _shards(tokenizer_file, end_id), FORMAT).write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FORMAT).parquet(path)


def matrix(batch: pa.RecordBatch, i: int) -> WaveletMatrix:
    n, zeros, planes, ranks = (column(batch, c)[i].as_py() for c in ("n_tokens", "zeros", "planes", "ranks"))
    return WaveletMatrix(n, zeros, planes, ranks)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            ids = matrix(batch, i).decode().astype("<u4")
            docs, lengths = column(batch, "docs")[i].values, np.array(column(batch, "lengths")[i].as_py(), np.int64)
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist())]
            fixed = [pa.array(np.full(len(ends), batch.column(c)[i].as_py(), np.int32)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*fixed, docs, pa.array(ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], names=["part", "nth", "d", "at", "n", "crc"])


def documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: start (ids before it), n_tokens and ids_crc32, decoded from the planes."""
    rows = shards(spark, path)
    found = rows.mapInArrow(_read, "part int, nth int, d long, at long, n long, crc long")
    totals = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row for each partition written
    starts = np.cumsum([0, *(n for _, n in totals)]).tolist()
    parts = F.broadcast(spark.createDataFrame([(p, at) for (p, _), at in zip(totals, starts)], "part int, of_part long"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.select("part", "nth", F.coalesce(inside, F.lit(0)).alias("inside")).join(parts, "part").select("part", "nth", (F.col("of_part") + F.col("inside")).alias("before"))
    return found.join(offsets, ["part", "nth"]).select(F.col("d").alias(key), (F.col("before") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def occurrences(spark: SparkSession, path: str, token: int, limit: int | None = None) -> DataFrame:
    """Per shard: how often token occurs and where (the first limit positions, all by default), without decoding."""

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                m = matrix(batch, i)
                n = m.count(token)
                where = [m.select(token, k) for k in range(n if limit is None else min(n, limit))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([n], pa.int64()), pa.array([where], pa.list_(pa.int64()))], names=["part", "nth", "n", "positions"])

    return shards(spark, path).mapInArrow(run, "part int, nth int, n long, positions array<long>")


def report(docs: DataFrame, **options) -> DataFrame:
    """Writes the shards to the shared folder and returns what documents() reads back from them."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/tokens/{uuid.uuid4().hex}"
    write(docs, path, **options)
    return documents(spark, path, options.get("key", "doc_id"))

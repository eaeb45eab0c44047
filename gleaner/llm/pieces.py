"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reports at each position every piece that ends there (by its output links); each relaxes the best score
of that position. Scores are the model's; a character without a piece costs UNKNOWN below the lowest regular score and
becomes its UTF-8 byte pieces. Equal scores go to the longer last piece. No piece of the model has a space after
another character, so a text's best path is the best paths of its space-led units one after another, and units are
solved once and cached.

A space is put before each text, as the model's own encoder does; decoding takes it away. Every text is restored
exactly: characters without pieces, line ends and the model's own space mark travel as bytes. Null and empty texts have
no tokens. Other columns pass through untouched,
but for those named as an added one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from gleaner.llm.common import column, in_arrow, kept

IDS, ROUND = "_gl_ids", "_gl_round_trip"
#: Units that are kept with their pieces, and the longest one kept: longer ones hardly come again.
MARK, UNKNOWN, CACHE, KEPT = "▁", 10.0, 400_000, 40


class Pieces:
    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.byte: dict[int, int] = {}
        self.out: list[bytes] = [b""] * n
        self.single: set[str] = set()
        self.match = ahocorasick.Automaton()
        alphabet, scores = set(), []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.out[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} has a space after another character")
                self.match.add_word(piece, (len(piece), model.get_score(i), i))
                self.out[i] = piece.replace(MARK, " ").encode()
                alphabet.update(piece)
                scores.append(model.get_score(i))
                if len(piece) == 1:
                    self.single.add(piece)
        self.match.make_automaton()
        self.missing = min(s for s in scores if s > -1e8) - UNKNOWN
        alone = "".join(c for c in "\n\r\t" if c not in alphabet) + MARK
        self.units = re.compile(f" *[^ {re.escape(alone)}]+| +|[{re.escape(alone)}]").findall
        self.alone = set(alone)
        self.cache: dict[str, tuple[int, ...]] = {}

    def solve(self, unit: str) -> tuple[int, ...]:
        """The best-scoring pieces of one unit."""
        if unit in self.alone:
            return tuple(self.byte[b] for b in unit.encode())
        s = unit.replace(" ", MARK)
        n = len(s)
        best, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
        gaps = [i for i, c in enumerate(s) if c not in self.single]
        gaps.append(n)
        done = 0
        for end, (size, score, i) in self.match.iter(s):
            while gaps[done] <= end:
                self._gap(best, back, gaps[done])
                done += 1
            value = best[end + 1 - size] + score
            if value > best[end + 1]:
                best[end + 1], back[end + 1] = value, (size, i)
        for g in gaps[done:-1]:
            self._gap(best, back, g)
        ids: list[int] = []
        while n:
            size, i = back[n]
            ids += [i] if i >= 0 else [self.byte[b] for b in reversed(s[n - 1].encode("utf-8", "surrogatepass"))]
            n -= size
        return tuple(reversed(ids))

    def _gap(self, best, back, i: int) -> None:
        value = best[i] + self.missing
        if value > best[i + 1]:
            best[i + 1], back[i + 1] = value, (1, -1)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        cache = self.cache
        for unit in self.units(" " + text):
            found = cache.get(unit)
            if found is None:
                found = self.solve(unit)
                if len(unit) <= KEPT and len(cache) < CACHE:
                    cache[unit] = found
            ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def loaded(model_file: str) -> Pieces:
    """One encoder per Python worker and model, so that its cache outlives a task."""
    return kept(("pieces", model_file), lambda: Pieces(model_file))


def _encode(model_file: str | None, text: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(model_file or default_model())
        for batch in batches:
            texts = column(batch, text).to_pylist()
            ids = [pieces.encode(t) for t in texts]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            added = [pa.ListArray.from_arrays(ends, pa.array(flat))] + [pa.array([pieces.decode(x) == (t or "") for x, t in zip(ids, texts)], pa.bool_())] * check
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, IDS, *[ROUND] * check])

    return run


def default_model() -> str:
    """The public model's place on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, *, model_file: str | None = None, text: str = "text", check: bool = False) -> DataFrame:
    """docs with token ids in _gl_ids and, if check, whether decoding them restores the text in _gl_round_trip.

    model_file must be readable on every executor; by default the installed public model is found there.
    """
    docs = docs.drop(IDS, *[ROUND] * check)
    ddl = f"{IDS} array<int>" + f", {ROUND} boolean" * check
    return in_arrow(docs, _encode(model_file, text, check), T.StructType([*docs.schema.fields, *T.StructType.fromDDL(ddl).fields]))


def decode(tokens: DataFrame, *, ids: str, into: str = "text", model_file: str | None = None) -> DataFrame:
    """tokens with the text of array column ids; null ids give null."""

    def run(batches):
        pieces = loaded(model_file or default_model())
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in column(batch, ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, into])

    return in_arrow(tokens, run, T.StructType([*tokens.schema.fields, T.StructField(into, T.StringType())]))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", model_file: str | None = None) -> DataFrame:
    """Per document: tokens, crc32 of the ids as little-endian unsigned 32-bit integers, and the round trip."""
    source = docs.select(key, text)
    make = _digest(model_file, text)
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL("n_tokens long, ids_crc32 long, round_trip boolean").fields])
    return in_arrow(source, make, schema)


def _digest(model_file: str | None, text: str):
    encoded = _encode(model_file, text, True)

    def run(batches):
        for out in encoded(batches):
            ids, off = column(out, IDS), column(out, IDS).offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([out.column(0), pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64()), column(out, ROUND)], names=[out.schema.names[0], "n_tokens", "ids_crc32", "round_trip"])

    return run

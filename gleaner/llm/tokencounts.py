"""Token counts by offset mapping: each document is encoded once and its tokens are attributed to its sections.

A token's span follows from the byte lengths of the tokens before it. The spans are interval-joined to the sections,
which are the lines of the text (each with its line end) or start at given code points. A token that crosses a boundary
goes to one section by rule: `largest` (the section with most of its bytes, the earlier one on a tie), `start` or `end`.

A run of white space of LONG code points or more is encoded as the one pre-token that the pattern makes of it, without the
pattern, whose look-ahead would have to walk back through it; the ids are the same.

Null and empty texts have no tokens and one empty section. Repeated rows give repeated results. Only the named columns
are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gleaner.llm.common import column, in_arrow

RULES = ("largest", "start", "end")
#: White space of the pattern, and the length from which a run goes around the pattern.
LONG = 50_000
_RUN = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG)


class Offsets:
    """The installed byte-level encoder, with the byte length of each id."""

    def __init__(self, ranks_file: str | None):
        import public_tokenizers
        import tiktoken

        with open(ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode, self.piece = encoding.encode_to_numpy, encoding._encode_single_piece
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, i in ranks.items():
            self.length[i] = len(piece)

    def ids(self, text: str) -> np.ndarray:
        """The ids of text. The last code point of a long run of white space goes with what follows, as in the pattern."""
        parts, at = [], 0
        for m in _RUN.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            parts += [self.encode(text[at : m.start()], disallowed_special=()), np.array(self.piece(text[m.start() : end]), np.int64)]
            at = end
        parts.append(self.encode(text[at:], disallowed_special=()))
        return np.concatenate(parts).astype(np.int64)

    def ends(self, text: str) -> np.ndarray:
        """The byte offset at which each token ends."""
        return np.cumsum(self.length[self.ids(text)])


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that cross a boundary); bounds are the sections' first bytes, the first is 0."""
    start = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    first, last = np.searchsorted(bounds, start, "right") - 1, np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    owner = last.copy() if rule == "end" else first.copy()
    if rule == "largest":
        for t in crossing.tolist():
            edges = np.concatenate(([start[t]], bounds[first[t] + 1 : last[t] + 1], [ends[t]]))
            owner[t] = first[t] + int(np.diff(edges).argmax())
    return np.bincount(owner, minlength=len(bounds)), len(crossing)


def _bounds(text: str, raw: bytes, starts: list[int] | None) -> np.ndarray:
    if starts is None:
        lines = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
        return np.concatenate(([0], lines[lines < len(raw)]))
    inside = sorted({s for s in starts if s is not None and 0 < s < len(text)})
    width = np.cumsum([0, *(len(text[a:b].encode()) for a, b in zip([0, *inside], inside))])
    return width.astype(np.int64)


def _count(ranks_file: str | None, sections: bool, rule: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = Offsets(ranks_file)
        for batch in batches:
            starts = column(batch, "_gl_sections").to_pylist() if sections else [None] * len(batch)
            tokens, cross, counts, begins = [], [], [], []
            for text, at in zip(column(batch, "_gl_text").to_pylist(), starts):
                text = text or ""
                ends, bounds = offsets.ends(text), _bounds(text, text.encode(), at)
                n, crossing = attribute(ends, bounds, rule)
                tokens.append(len(ends)), cross.append(crossing), counts.append(n), begins.append(bounds)
            listed = lambda x: pa.ListArray.from_arrays(np.cumsum([0, *map(len, x)]).astype(np.int32), pa.array(np.concatenate(x).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in names), pa.array(tokens, pa.int64()), pa.array(cross, pa.int64()), listed(begins), listed(counts)], names=[*names, "n_tokens", "n_crossing", "section_bytes", "section_tokens"])

    return run


def count_tokens(docs: DataFrame, *, key: str = "doc_id", text: str = "text", sections: str | None = None, rule: str = "largest", ranks_file: str | None = None) -> DataFrame:
    """Per row: key, n_tokens, n_crossing, the first byte of each section and the tokens attributed to it.

    sections names an array<int> column with the code points at which sections start; without it, or where it is null,
    the sections are the lines.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    more = [F.col(sections).alias("_gl_sections")] if sections else []
    source = docs.select(F.col(key), F.col(text).alias("_gl_text"), *more)
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL("n_tokens long, n_crossing long, section_bytes array<long>, section_tokens array<long>").fields])
    return in_arrow(source, _count(ranks_file, bool(sections), rule, [key]), schema)


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: tokens, sections, crossing tokens and the sections' tokens, comma-joined."""
    out = count_tokens(docs, key=key, text=text)
    return out.select(key, "n_tokens", F.size("section_tokens").cast("long").alias("n_sections"), "n_crossing", F.array_join(F.col("section_tokens").cast("array<string>"), ",").alias("section_tokens"))

"""License scans by diagonal voting.

Every k words in a row of every text are hashed, and Spark joins those hashes to the positions at which the templates have
them. A match of text position p with template position t votes for the diagonal p - t; votes are added up by text, template
and diagonal. A phrase is held where one diagonal has all its votes. For longer templates diagonals that lie no further
apart than the words that may be put in or left out are merged, and those with as many votes as a copy within the allowed
edits must leave (an edit touches k hashes at most) are verified: an alignment of the template's words against the text's.

Texts without any hash of a template can't vote, so only their number of words is kept; all hashes of the others are joined.
Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z. Null, empty and word-free texts have no spans; rows that
repeat are scanned each; a null key stays null; only key and text are read, so no other column can clash.
A text shorter than a template can still be a copy of it within the allowed edits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gleaner.llm import spans
from gleaner.llm.common import column, cut, in_arrow, kept, utf8, written


class Template(NamedTuple):
    """words: as text; exact: a phrase that counts wherever its words stand, else a text that may be edited."""

    label: str
    words: str
    exact: bool


#: The phrases and labels of the contract.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

#: Published notices of common licenses.
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions", False),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", False),
    Template("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", False),
    Template("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", False),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", False),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", False),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", False),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", False),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", False),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", False),
    Template("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", False),
    Template("unlicense", "This is free and unencumbered software released into the public domain.", False),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", False),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", False),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", False),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", False),
)

#: Positions of templates that are broadcast, to the scan and to the join; beyond it every text with a word is joined, by a shuffle.
MOST_POSITIONS = 1 << 20

_LOWER = spans.byte_values(lower=True)
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if spans.ALPHANUMERIC[c] else 32 for c in range(256))
SPAN = "struct<label:string,exact:boolean,start:bigint,end:bigint,similarity:double>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _grams(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words by text, hash of every k words in a row, number of those by text)."""
    start, end, doc = spans.words(raw, offsets, spans.ALPHANUMERIC)
    n = len(offsets) - 1
    found, first = spans.windows(spans.span_hash(spans.prefix(_LOWER[raw], "bytes"), start, end, "bytes"), doc, k)
    return np.bincount(doc, minlength=n), found.view(np.int64), np.bincount(doc[first], minlength=n)


def _edits(n_words: int, similarity: float) -> int:
    """Words of a template of n_words that a copy may miss, change or add."""
    return int((1 - similarity) * n_words + 1e-9)


def _positions(templates: list[Template], k: int) -> list[tuple[int, int, int]]:
    """(hash, template, position) of every k words of every template."""
    out = []
    for t, x in enumerate(templates):
        raw = np.frombuffer(x.words.encode(), np.uint8)
        n, h, _ = _grams(raw, np.array([0, len(raw)]), k)
        if n[0] < k:
            raise ValueError(f"template {x.words!r} has fewer than {k} words")
        out += [(v, t, p) for p, v in enumerate(h.tolist())]
    return out


def _scan(known, k: int):
    """key, number of words, and, of a text that has a hash of known (None: any word), itself and its hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("licenses", lambda: None)
        of = known.value if known else None
        for batch in batches:
            texts = column(batch, "t")
            raw, offsets = utf8(texts)
            n_words, has, parts, sizes = [], [], [], []
            for i, j in cut(offsets):
                n, h, per = _grams(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k)
                at = np.repeat(np.arange(j - i), per)
                vote = n > 0
                if of is not None:
                    x = np.minimum(np.searchsorted(of, h), len(of) - 1)
                    vote = np.bincount(at[of[x] == h], minlength=j - i) > 0
                n_words.append(n)
                has.append(vote)
                parts.append(h[vote[at]])
                sizes.append(np.where(vote, per, 0))
            has, sizes = np.concatenate([np.zeros(0, bool), *has]), np.concatenate([np.zeros(0, np.int64), *sizes])
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            hashes = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))
            some = pc.if_else(pa.array(has, pa.bool_()), texts, pa.scalar(None, texts.type))
            yield pa.RecordBatch.from_arrays([column(batch, "k"), pa.array(np.concatenate([np.zeros(0, np.int64), *n_words])), some, hashes], names=["k", "n_words", "t", "h"])

    return run


def _aligned(template: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For every end in text (0 to its length), the least edits between the template and words that end there. One row of the
    alignment at a time; words put in are a running minimum along the row."""
    place = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(template.tolist(), 1):
        step = row + 1
        step[1:] = np.minimum(step[1:], row[:-1] + (text != w))
        step[0] = i
        row = np.minimum.accumulate(step - place) + place
    return row


def copies(template: list[bytes], text: list[bytes], edits: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of copies of template within text, apart from each other: those with fewest edits are taken first,
    then by end; each with its latest start. One alignment of the text, and a short one back from each end that is tried."""
    ids: dict = {}
    t = np.array([ids.setdefault(w, len(ids)) for w in template])
    x = np.array([ids.get(w, -1) for w in text], np.int64)
    shortest, out = len(t) - edits, []
    if len(x) < shortest:
        return out
    row = _aligned(t, x)
    ends = np.flatnonzero(row <= edits)
    taken, closed = np.zeros(len(x), bool), np.zeros(len(x) + 1, bool)
    for end in ends[np.argsort(row[ends], kind="stable")].tolist():
        if closed[end]:
            continue
        back = _aligned(t[::-1], x[max(0, end - len(t) - edits) : end][::-1])
        start = end - int(back.argmin())
        if not taken[start:end].any():
            out.append((start, end, int(row[end])))
            taken[start:end] = True
            closed[start + 1 : end + shortest] = True  # a copy that ends there would share a word with this one
    return sorted(out)


def best_of(found: list[tuple]) -> list[tuple]:
    """found without the edited spans that share a word with a more similar edited span; of equals all stay."""
    edited = sorted((x for x in found if not x[1]), key=lambda x: x[4])
    best = np.zeros(max((x[3] for x in edited), default=0))
    for x in edited:
        best[x[2] : x[3]] = x[4]
    return sorted({x for x in found if x[1] or best[x[2] : x[3]].max() == x[4]}, key=lambda x: (x[2], x[3], x[0], x[1]))


def _verify(templates: list[Template], similarity: float):
    known = [words_of(t.words.encode()) for t in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, places in zip(column(batch, "t"), column(batch, "c")):
                words, found = words_of(text.as_py().encode()), []
                for c in places.as_py():
                    x, lo, hi = templates[c["t"]], c["lo"], c["hi"]
                    mine = known[c["t"]]
                    if x.exact:
                        if words[lo:hi] == mine:
                            found.append((x.label, True, lo, hi, 1.0))
                        continue
                    lo, hi = max(lo, 0), min(hi, len(words))
                    found += [(x.label, False, lo + a, lo + b, 1 - e / len(mine)) for a, b, e in copies(mine, words[lo:hi], _edits(len(mine), similarity))]
                out.append([dict(zip(("label", "exact", "start", "end", "similarity"), s)) for s in best_of(found)])
            kind = pa.list_(pa.struct([("label", pa.string()), ("exact", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("similarity", pa.float64())]))
            yield pa.RecordBatch.from_arrays([column(batch, "r"), pa.array(out, kind)], names=["r", "spans"])

    return run


def _sizes(spark: SparkSession, templates: list[Template], k: int, similarity: float) -> DataFrame:
    """Of each template: words, allowed edits, and the votes that a copy leaves at least."""
    rows = []
    for t, x in enumerate(templates):
        m = len(words_of(x.words.encode()))
        e = 0 if x.exact else _edits(m, similarity)
        rows.append((t, x.exact, m, e, max(1, m - k + 1 - k * e)))
    return spark.createDataFrame(rows, "t int, exact boolean, m int, e int, need int")


def license_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = PHRASES + NOTICES, k: int = 3, similarity: float = 0.8, most_positions: int = MOST_POSITIONS) -> DataFrame:
    """Per row of docs: key, n_words and spans (label, exact, start, end, similarity; in words) by start."""
    spark, templates = docs.sparkSession, list(templates)
    positions = _positions(templates, k)
    small = len(positions) <= most_positions
    known = spark.sparkContext.broadcast(np.unique(np.array([p[0] for p in positions], np.int64))) if small and positions else None
    schema = f"k {docs.schema[key].dataType.simpleString()}, n_words long, t string, h array<bigint>"
    rows = written(in_arrow(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), _scan(known, k), schema).withColumn("r", F.monotonically_increasing_id()))
    where = spark.createDataFrame(positions, "h long, t int, p int")
    sizes = F.broadcast(_sizes(spark, templates, k, similarity)) if small else _sizes(spark, templates, k, similarity)
    votes = rows.where("t is not null").select("r", F.posexplode("h").alias("at", "h")).join(F.broadcast(where) if small else where, "h")
    diagonals = votes.groupBy("r", "t", (F.col("at") - F.col("p")).alias("d")).agg(F.count(F.lit(1)).alias("n")).join(sizes, "t")
    phrases = diagonals.where("exact and n = need").select("r", "t", F.col("d").alias("lo"), (F.col("d") + F.col("m")).alias("hi"))
    by = Window.partitionBy("r", "t").orderBy("d")
    step = F.when(F.col("d") - F.lag("d").over(by) > F.col("e"), 1).otherwise(0)
    groups = diagonals.where("not exact").withColumn("s", step).withColumn("g", F.sum("s").over(by)).groupBy("r", "t", "g", "m", "e", "need").agg(F.sum("n").alias("n"), F.min("d").alias("a"), F.max("d").alias("b"))
    near = groups.where("n >= need").select("r", "t", (F.col("a") - F.col("e")).alias("lo"), (F.col("b") + F.col("m") + F.col("e")).alias("hi"))
    places = phrases.unionByName(near).groupBy("r").agg(F.collect_list(F.struct("t", "lo", "hi")).alias("c"))
    found = in_arrow(rows.where("t is not null").select("r", "t").join(places, "r"), _verify(templates, similarity), f"r long, spans array<{SPAN}>")
    out = rows.select("r", "k", "n_words").join(found, "r", "left")
    return out.select(F.col("k").alias(key), "n_words", F.coalesce("spans", F.expr(f"cast(array() as array<{SPAN}>)")).alias("spans"))


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: places of the phrases, the first and last of them, their labels, all labels, and the largest similarity."""
    base = F.filter("spans", lambda s: s["exact"])
    labels = lambda s: F.array_join(F.array_sort(F.array_distinct(F.transform(s, lambda x: x["label"]))), ",")
    starts = F.transform(base, lambda s: s["start"])
    out = license_spans(docs, key=key, text=text)
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    score = F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0))
    return out.select(F.col(key), "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), score.alias("score"), shown.alias("spans"))

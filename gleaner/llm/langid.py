"""Language ID: a linear-chain conditional random field labels the words of a text, also of a code-switched one.

Word features are the word itself, affixes, character n-grams and membership in each language's lexicon; transitions
between labels are learned. Marginals come from forward-backward over the whole text, and a document takes the
language with the largest mean marginal, which is its score.

A text that is null or has no letter is `und` with score 0, and so is every text if no language could be learned.
Training reads a bounded sample, cut into short segments where the rows lie; prediction reads text alone. Other columns
pass through untouched, but for those named as an added one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.llm import spans
from gleaner.llm.common import column, crc_bucket, in_arrow, kept, shielded

UNKNOWN = "und"
LABEL, SCORE, WORDS = "_gl_lang", "_gl_score", "_gl_word_labels"

#: Bounds of the training sample: documents a language and in all, segments a document and words a segment.
SAMPLE_DOCS, SAMPLE_ALL, SEGMENTS, SEGMENT_WORDS = 400, 6400, 6, 20
#: Hashed feature weights, lexicon words a language, steps of the optimiser, words in a block, cached word types (of 16 languages).
BUCKETS, LEXICON, STEPS, BLOCK, CACHE = 1 << 17, 2000, 40, 32, 400_000
#: Characters of texts that are labelled together, and words of a slice of one longer text (both of 16 languages or fewer).
SLICE, LONG_WORDS = 400_000, 1 << 16
#: Scores are held within this range, so that a block's product stays within a double's.
CLIP = 8.0

#: A longer run of letters is labelled in consecutive pieces of 60.
_WORD = re.compile(r"[^\W\d_]{1,60}")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(types: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of every feature of the words: the word itself, affixes of one to four bytes and n-grams of two and
    three bytes, which see where a word begins and ends. Ordered by word; each has at least one."""
    marked = [f"^{x}$".encode("utf-8", "surrogatepass") for x in types]
    ends = np.cumsum([len(x) for x in marked])
    starts = ends - [len(x) for x in marked]
    raw = np.frombuffer(b"".join(marked), np.uint8)
    sums, word = spans.prefix(spans.byte_values()[raw], "bytes"), np.arange(len(types))
    inside = np.repeat(word, ends - starts)
    found = [(starts, ends, word, 0)]
    for k in (1, 2, 3, 4):
        fits = np.flatnonzero(ends - starts - 2 >= k)
        found += [(starts[fits] + 1, starts[fits] + 1 + k, fits, 10 + k), (ends[fits] - 1 - k, ends[fits] - 1, fits, 20 + k)]
    for k in (2, 3):
        at = np.flatnonzero(np.arange(len(raw)) + k <= ends[inside])
        found.append((at, at + k, inside[at], 30 + k))
    bucket = np.concatenate([(spans.span_hash(sums, a, b, "bytes") ^ spans.mix(np.full(1, kind, np.uint64))) & np.uint64(BUCKETS - 1) for a, b, _, kind in found])
    owner = np.concatenate([x[2] for x in found])
    order = np.argsort(owner, kind="stable")
    return bucket[order].astype(np.int64), owner[order]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    trans: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)
    lexicon_weights: np.ndarray | None = None


def buckets_of(k: int) -> int:
    """Hashed features for k labels: BUCKETS up to 64 labels, then fewer, so that the weights stay of one size."""
    return max(1 << 10, BUCKETS >> max(0, (-(-k // 64) - 1).bit_length()))


def block_words(k: int) -> int:
    """Words in a block for k labels: a block keeps k * k numbers, so that blocks of many labels are longer."""
    return BLOCK * max(1, -(-k // 16)) ** 2


def chains(lengths: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of words: (first word, words, document) of each, for documents that follow one another."""
    per = -(-lengths // block)
    doc = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(lengths) - lengths)[doc] + nth * block
    return first, np.minimum(block, lengths[doc] - nth * block), doc


def marginals(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(label) of each word of each document, and the expected number of each transition."""
    return _both_ways(scores, lengths, trans)[:2]


def by_slices(scores_of: Callable[[int, int], np.ndarray], n: int, trans: np.ndarray, step: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first word, marginals) of slices of one document of n words, the last slice first. Messages are carried from slice to
    slice, forwards once to find where each begins and then backwards, so what is held is one slice, not the document."""
    trans = np.asarray(trans, float)
    left, right = [None], None
    for s in range(0, n - step, step):
        left.append(_both_ways(scores_of(s, s + step), np.array([step]), trans, left[-1])[2])
    for s in range((n - 1) // step * step, -1, -step):
        e = min(n, s + step)
        post, _, _, right = _both_ways(scores_of(s, e), np.array([e - s]), trans, left[s // step], right)
        yield s, post


def _both_ways(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, before_all: np.ndarray | None = None, after_all: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """marginals(), and of the last document the message that leaves it and of the first the one that goes before it; before_all
    and after_all come in there.

    Exact forward-backward in blocks: the blocks' transfer matrices are made side by side, carried along each
    document, and each block is then filled in from both of its ends.
    """
    k, a = scores.shape[1], np.exp(np.clip(trans, -CLIP, CLIP))
    block = min(block_words(k), int(lengths.max(initial=1)))
    first, size, doc = chains(lengths, block)
    n = len(first)
    p = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -2 * CLIP, 0))
    at = np.minimum(first[:, None] + np.arange(block), len(p) - 1)
    live = np.arange(block) < size[:, None]
    q = p[at]
    transfer = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(block):
        step = (transfer.reshape(-1, k) @ a).reshape(n, k, k) * q[:, t, None, :]
        transfer = np.where(live[:, t, None, None], step, transfer)
        if t % BLOCK == BLOCK - 1 or t == block - 1:
            transfer /= transfer.max(axis=(1, 2), keepdims=True)
    left, right = np.full((n, k), 1 / k), np.ones((n, k))
    opens = np.searchsorted(doc, np.arange(len(lengths)))
    count = np.bincount(doc, minlength=len(lengths))
    if before_all is not None:
        left[opens] = before_all
    if after_all is not None:
        right[opens + count - 1] = after_all
    for t in range(1, int(count.max(initial=0))):
        d = opens[count > t] + t
        v = np.einsum("ni,nij->nj", left[d - 1], transfer[d - 1])
        left[d] = v / v.sum(axis=1, keepdims=True)
        d = opens[count > t] + count[count > t] - 1 - t
        v = np.einsum("nij,nj->ni", transfer[d + 1], right[d + 1])
        right[d] = v / v.sum(axis=1, keepdims=True)
    alpha, beta, before = np.empty((n, block, k)), np.empty((n, block, k)), np.empty((n, block, k))
    v = left
    for t in range(block):
        before[:, t] = v
        nxt = (v @ a) * q[:, t]
        v = np.where(live[:, t, None], nxt / nxt.sum(axis=1, keepdims=True), v)
        alpha[:, t] = v
    leaves, v = v[-1], right
    for t in range(block - 1, -1, -1):
        beta[:, t] = v
        nxt = (v * q[:, t]) @ a.T
        v = np.where(live[:, t, None], nxt / nxt.sum(axis=1, keepdims=True), v)
    enters, words = v[0], np.flatnonzero(live)
    alpha, beta, before, q = (x.reshape(-1, k)[words] for x in (alpha, beta, before, q))
    post = alpha * beta
    post /= post.sum(axis=1, keepdims=True)
    reach = beta * q
    norm = np.einsum("ni,ij,nj->n", before, a, reach)
    return post, a * ((before / norm[:, None]).T @ reach), leaves, enters


def segments(text: str | None) -> list[str]:
    """SEGMENTS runs of SEGMENT_WORDS words of a text, evenly spread and joined by blanks: what training sees of it."""
    w = words_of(text)
    spots = np.unique(np.linspace(0, max(0, len(w) - SEGMENT_WORDS), SEGMENTS).astype(int)) if w else []
    return [" ".join(w[s : s + SEGMENT_WORDS]) for s in spots]


def train(rows: list[tuple[list[str], str]]) -> Model | None:
    """A model from (segments, language) rows, already sampled. Segments of different documents follow one another in the
    training chains, so that the transitions see changes of language."""
    labels = sorted({lang for found, lang in rows if found})
    if not labels:
        return None
    label = {x: i for i, x in enumerate(labels)}
    parts = [(s.split(" "), label[lang]) for found, lang in rows for s in found]
    parts.sort(key=lambda x: zlib.crc32(" ".join(x[0]).encode("utf-8", "surrogatepass")))
    tokens, gold = [x for w, _ in parts for x in w], np.repeat([y for _, y in parts], [len(w) for w, _ in parts])
    lengths = np.array([sum(len(w) for w, _ in parts[i : i + 16]) for i in range(0, len(parts), 16)])
    counts = [Counter() for _ in labels]
    for w, y in parts:
        counts[y].update(w)
    lexicon: dict[str, int] = {}
    for y, c in enumerate(counts):
        for x, _ in c.most_common(LEXICON):
            if c[x] >= 3:
                lexicon[x] = lexicon.get(x, 0) | 1 << y
    types = {x: i for i, x in enumerate(dict.fromkeys(tokens))}
    word = np.fromiter(map(types.__getitem__, tokens), np.int64, len(tokens))
    index, owner = features(list(types))
    lex = _lexical(list(types), lexicon, len(labels))
    k, n = len(labels), len(types)
    starts = np.searchsorted(owner, np.arange(n))
    buckets = buckets_of(k)
    index = index % buckets
    weights, trans, lexical = np.zeros((buckets, k)), np.zeros((k, k)), np.zeros((k, k))
    speed = [np.full_like(x, 1e-8) for x in (weights, trans, lexical)]
    right = np.zeros((n, k))
    np.add.at(right, (word, gold), 1)
    edges = np.zeros((k, k))
    inner = np.ones(len(gold), bool)
    inner[np.cumsum(lengths) - lengths] = False
    np.add.at(edges, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
    for _ in range(STEPS):
        emit = np.add.reduceat(weights[index], starts, axis=0) + lex @ lexical
        post, pairs = _in_slices(emit[word], lengths, trans)
        expected = np.stack([np.bincount(word, post[:, y], n) for y in range(k)], axis=1)
        error = right - expected
        grads = (
            np.stack([np.bincount(index, error[owner, y], buckets) for y in range(k)], axis=1) - 0.5 * weights,
            edges - pairs - 0.5 * trans,
            lex.T @ error - 0.5 * lexical,
        )
        for x, g, s in zip((weights, trans, lexical), grads, speed):
            s += g * g
            x += 0.2 * g / np.sqrt(s)
    return Model(labels, weights.astype(np.float32), trans, lexicon, lexical)


def _lexical(types: list[str], lexicon: dict[str, int], k: int) -> np.ndarray:
    bits = np.array([lexicon.get(x, 0) for x in types], dtype=object)
    return np.array([[(int(b) >> y) & 1 for y in range(k)] for b in bits], float).reshape(len(types), k)


def _in_slices(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray, limit: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """marginals() over slices of documents, so that what a slice holds of k labels a word stays bounded."""
    ends, k = np.cumsum(lengths), scores.shape[1]
    parts = np.searchsorted(ends, np.arange(0, ends[-1], max(1, limit // k)), "left")
    cuts = [*dict.fromkeys(parts.tolist()), len(lengths)]
    found = [marginals(scores[ends[i] - lengths[i] : ends[j - 1]], lengths[i:j], trans) for i, j in zip(cuts[:-1], cuts[1:]) if j > i]
    return np.concatenate([p for p, _ in found]), sum(x for _, x in found)


class _Index(dict):
    """Numbers for words; those met for the first time are listed in new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, x: str) -> int:
        self[x] = n = len(self)
        self.new.append(x)
        return n


class Labeller:
    """A model with a bounded cache of word types' scores."""

    def __init__(self, model: Model):
        self.model = model
        self.cache = CACHE * 16 // max(16, len(model.labels))
        self.known = _Index()
        self.scores = np.zeros((0, len(model.labels)), np.float32)

    def _learn(self, new: list[str]) -> None:
        m = self.model
        index, owner = features(new)
        emit = np.add.reduceat(m.weights[index % len(m.weights)], np.searchsorted(owner, np.arange(len(new))), axis=0) + _lexical(new, m.lexicon, len(m.labels)) @ m.lexicon_weights
        self.scores = np.concatenate((self.scores, emit.astype(np.float32)))

    def _numbers(self, words: list[list[str]], n: int) -> tuple[np.ndarray, list[str]]:
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64, n)
        new, self.known.new = self.known.new, []
        if new:
            self._learn(new)
        return at, new

    def _forget(self, new: list[str]) -> None:
        if len(self.known) > self.cache:
            for x in new:
                del self.known[x]
            self.scores = self.scores[: len(self.known)]

    def _long(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """One text of more than SLICE characters: its words are read, looked up and labelled slice by slice."""
        k, step = len(self.model.labels), max(block_words(len(self.model.labels)), LONG_WORDS * 16 // max(16, len(self.model.labels)))
        at, size, part, all_new, real = [], 0, [], [], False
        for w in chain(_WORD.finditer(text.lower()), [None]):
            if w is not None:
                part.append(w.group())
                real = real or any(c.isalpha() for c in part[-1])
            if part and (w is None or len(part) == step):
                found, new = self._numbers([part], len(part))
                at.append(found.astype(np.int32))
                all_new += new
                size, part = size + len(part), []
        if not size or not real:
            self._forget(all_new)
            return 0, np.zeros(k), np.zeros(0, np.int16)
        total, best = np.zeros(k), np.zeros(size, np.int16)
        for s, post in by_slices(lambda s, e: self.scores[at[s // step]].astype(float), size, self.model.trans, step):
            total += post.sum(axis=0)
            best[s : s + len(post)] = post.argmax(axis=1)
        self._forget(all_new)
        return size, total / size, best

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each text: its words, the mean of their label marginals, and the best label of each."""
        if len(texts) == 1 and len(texts[0] or "") > SLICE:
            return [self._long(texts[0])]
        words = [words_of(t) for t in texts]
        for i, w in enumerate(words):
            if w and not any(c.isalpha() for x in w for c in x):
                words[i] = []
        lengths = np.array([len(w) for w in words])
        none = (0, np.zeros(self.scores.shape[1]), np.zeros(0, np.int16))
        if not lengths.sum():
            return [none for _ in words]
        at, new = self._numbers(words, int(lengths.sum()))
        some = lengths[lengths > 0]
        post, _ = marginals(self.scores[at].astype(float), some, self.model.trans)
        self._forget(new)
        ends = np.cumsum(lengths)
        return [(n, post[e - n : e].mean(axis=0), post[e - n : e].argmax(axis=1)) if n else none for e, n in zip(ends.tolist(), lengths.tolist())]


def _labeller(model: Model) -> Labeller:
    """One labeller per Python worker and model, so that its cache outlives a task."""
    return kept(("labels", id(model)), lambda: Labeller(model))


def _groups(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= limit):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def _predict(model, text: str, words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        labeller = _labeller(m) if m else None
        for batch in batches:
            texts = column(batch, text).to_pylist()
            langs, scores, tags = [], [], []
            for i, j in _groups(texts, SLICE * 16 // max(16, len(m.labels))) if m else ():
                for n, mean, of_words in labeller(texts[i:j]):
                    if not n:
                        langs.append(UNKNOWN), scores.append(0.0), tags.append([])
                        continue
                    best = int(mean.argmax())
                    langs.append(m.labels[best]), scores.append(min(1.0, float(mean[best])))
                    if words:
                        tags.append([m.labels[y] for y in of_words.tolist()])
            if not m:
                langs, scores, tags = [UNKNOWN] * len(texts), [0.0] * len(texts), [[]] * len(texts)
            added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())] + [pa.array(tags, pa.list_(pa.string()))] * words
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, LABEL, SCORE, *[WORDS] * words])

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [segments(t) for t in column(batch, "t").to_pylist()]
        yield pa.RecordBatch.from_arrays([column(batch, "o"), column(batch, "l"), pa.array(found, pa.list_(pa.string()))], names=["o", "l", "s"])


def sample(docs: DataFrame, *, key: str, text: str, lang: str, where: Column, most_docs: int, most_langs: int | None) -> list[tuple[list[str], str]]:
    """Segments and language of about most_docs rows of each language (or of the most_langs most frequent ones), chosen by a hash of
    key. Rows are cut into segments where they lie; only those reach the driver."""
    labelled = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    counts = labelled.groupBy("l").count().orderBy(F.desc("count"), "l")
    counts = (counts if most_langs is None else counts.limit(most_langs)).collect()
    if not counts:
        return []
    each = max(8, min(most_docs, SAMPLE_ALL // len(counts)))
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["l"], min(1.0, each / r["count"]))))
    order = F.pmod(F.xxhash64(F.col("k")), F.lit(1 << 30))
    chosen = labelled.where(order < F.try_element_at(share, F.col("l")) * (1 << 30)).select(order.alias("o"), "t", "l")
    cut = in_arrow(chosen, _segments, "o long, l string, s array<string>")
    return [(r["s"], r["l"]) for r in cut.orderBy("o", "l", "s").limit(2 * each * len(counts)).collect()]


def fit(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", where: Column | None = None, most_docs: int = SAMPLE_DOCS, most_langs: int | None = None):
    """A broadcast model learned from the labelled rows of docs that where admits (all by default).

    The sample's bound: about most_docs documents a language (fewer where there are many languages, SAMPLE_ALL in all, but eight of each).
    All languages are learned unless most_langs says how many of the most frequent; documents of others then get one of the learned labels.
    Beyond 64 languages they share fewer hashed features, so that the weights keep their size.
    """
    rows = sample(docs, key=key, text=text, lang=lang, where=F.lit(True) if where is None else where, most_docs=most_docs, most_langs=most_langs)
    return docs.sparkSession.sparkContext.broadcast(train(rows))


def label(docs: DataFrame, model, *, text: str = "text", words: bool = False) -> DataFrame:
    """docs with _gl_lang, _gl_score and, if words, the label of each word of letters in _gl_word_labels."""
    docs = docs.drop(LABEL, SCORE, *[WORDS] * words)
    ddl = f"{LABEL} string, {SCORE} double" + f", {WORDS} array<string>" * words
    return in_arrow(docs, _predict(model, text, words), T.StructType([*docs.schema.fields, *T.StructType.fromDDL(ddl).fields]))


def learnable(key: str = "doc_id") -> Column:
    """The rows that the contract lets a model learn from."""
    return crc_bucket(key, 5) != 0


def report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: whether it is held out, its predicted language and the score."""
    model = fit(docs, key=key, text=text, lang=lang, where=learnable(key))
    out = label(docs.select(key, text), model, text=text)
    return out.select(key, F.coalesce(crc_bucket(key, 5) == 0, F.lit(False)).alias("held_out"), F.col(LABEL).alias("lang_pred"), F.col(SCORE).alias("score"))


def keep_known(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.3) -> DataFrame:
    """docs whose language is recognised with a score of least or more; the columns of docs only."""
    model = fit(docs, key=key, text=text, lang=lang, where=learnable(key))
    inner, of, back = shielded(docs)
    return back(label(inner, model, text=of(text)).where((F.col(LABEL) != UNKNOWN) & (F.col(SCORE) >= least)))

"""MinHash near-dedup with sequential Bayesian verification.

Banded MinHash gives candidates; their signatures are compared batch by batch, and a pair is given up as soon as
the posterior probability that its similarity reaches the threshold falls below the miss probability; survivors
are verified on their full shingle sets. Links are never enumerated within a group: documents with equal sets
(by a digest of 128 bits of the whole set) collapse first, every member of a bucket is tried against one member, and only where a bucket then still holds
different components do the documents of these meet, each at the rarest shingles of its set; those that sizes and signatures still leave are
held against each other on full sets, family by family, in blocks.

Null and word-free texts have no set: they are linked with nothing and kept. Rows that repeat a doc_id count as
one document of the graph. Rows without doc_id have no component and are kept; a key that is no whole number is refused. Only key and text are read, so
other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm import spans
from gleaner.llm.common import column, cut, in_arrow, kept, shielded, utf8, whole_numbers, written

#: Bands and rows a band. A pair at similarity 0.8 is missed by all bands with (1 - 0.8**7)**56, or 2e-6.
BANDS, ROWS = 56, 7
#: Signature values compared, the size of a batch, and the chance at which a true pair may be given up.
COMPARED, BATCH, MISS = 128, 16, 1e-6
#: Rows, and columns, that are compared in one place.
SIDE = 128
#: Rows of a table of buckets or meetings (fifty bytes each) that is broadcast, so that a hot one needs no shuffle.
BROADCAST = 200_000

_SCHEMA = "d long, n long, f1 long, f2 long, sig binary, bands array<long>"


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each shingle of size words, in document order; a shorter text is one shingle."""
    start, end, doc = spans.words(raw, offsets, spans.NOT_SPACE)
    h = spans.span_hash(spans.prefix(spans.byte_values(lower=True)[raw], "bytes"), start, end, "bytes")
    count = np.bincount(doc, minlength=len(offsets) - 1)
    found, first = spans.windows(h, doc, size)
    owner = doc[first]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        at = np.searchsorted(doc, short)
        whole = spans.span_hash(spans.prefix(h, "words"), at, at + count[short], "words")
        found, owner = np.concatenate((found, whole)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, owner


def distinct_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    found, owner = shingles(raw, offsets, size)
    edges = np.searchsorted(owner, np.arange(len(offsets)))
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        s = np.sort(found[a:b])
        out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if b > a else s)
    return out


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = spans.mix(np.arange(1, 3 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32).reshape(3, n)
    return x[0], x[1] | np.uint32(1), x[2] | np.uint32(1)


def minhash(values: np.ndarray, seeds, block: int = 512) -> np.ndarray:
    """The minimum of each hash function over the set."""
    a, b, c = seeds
    low = values.astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), block):
        z = low[i : i + block, None] ^ a
        z *= b
        z ^= z >> np.uint32(15)
        z *= c
        np.minimum(best, z.min(axis=0), out=best)
    return best


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("signatures", lambda: None)
        seeds = _seeds(BANDS * ROWS)
        weights = spans.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)
        for batch in batches:
            raw, off = utf8(column(batch, "t"))
            ids = column(batch, "d")
            for i, j in cut(off):
                sets = distinct_sets(raw[off[i] : off[j]], off[i : j + 1] - off[i], size)
                sigs = np.stack([minhash(s, seeds) for s in sets])
                bands = spans.mix((sigs.reshape(-1, BANDS, ROWS).astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64)).astype(np.int64)
                full = np.array([len(s) for s in sets])
                digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
                marks = [np.ascontiguousarray(digests[:, k]) for k in (0, 1)]
                low = sigs[:, :COMPARED].astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(full, pa.int64()), *(pa.array(m) for m in marks), pa.array([x.tobytes() for x in low], pa.binary()), pa.ListArray.from_arrays(np.arange(0, (j - i) * BANDS + 1, BANDS, dtype=np.int32), pa.array(bands.ravel()))],
                    names=["d", "n", "f1", "f2", "sig", "bands"],
                )

    return run


def least_matches(percent: int, miss: float = MISS) -> list[int]:
    """For each batch boundary n: the least matches of n at which P(similarity >= percent | matches) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose tail beyond t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, COMPARED + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _prune(percent: int):
    least = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(column(batch, c).to_pylist()), np.uint16).reshape(-1, COMPARED) for c in ("sa", "sb"))
            alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
            for k, m in enumerate(least):
                at = slice(k * BATCH, (k + 1) * BATCH)
                matches[alive] += (x[alive, at] == y[alive, at]).sum(axis=1)
                alive = alive[matches[alive] >= m]
            keep = pa.array(alive)
            yield pa.RecordBatch.from_arrays([column(batch, c).take(keep) for c in ("a", "b")], names=["a", "b"])

    return run


def _verify(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ra, oa), (rb, ob) = utf8(column(batch, "ta")), utf8(column(batch, "tb"))
            keep = []
            for i, j in cut(oa + ob):
                left = distinct_sets(ra[oa[i] : oa[j]], oa[i : j + 1] - oa[i], size)
                right = distinct_sets(rb[ob[i] : ob[j]], ob[i : j + 1] - ob[i], size)
                for k, (p, q) in enumerate(zip(left, right)):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    if both and 100 * both >= percent * (len(p) + len(q) - both):
                        keep.append(i + k)
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([column(batch, c).take(kept) for c in ("a", "b")], names=["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over edges (a, b), for every node with an edge.

    Each round hooks every node to its smallest neighbour, shortens the chains, contracts the edges and goes on
    with what still joins different nodes; the number of nodes at least halves, so rounds are few. All state is in
    written tables.
    """
    maps = []
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
        while True:
            up = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            jumped = written(step.join(up, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")))
            step = jumped.select("node", "label")
            if jumped.where("moved").isEmpty():
                break
        maps.append(step)
        to = lambda c: step.select(F.col("node").alias(c), F.col("label").alias(f"{c}_to"))
        moved = edges.join(to("a"), "a").join(to("b"), "b").where("a_to <> b_to")
        edges = written(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = maps[0]
    for later in maps[1:]:
        out = out.join(later.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return out


def _pruned(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that survive the signature batches."""
    side = lambda c: reps.select(F.col("node").alias(c), F.col("sig").alias(f"s{c}"))
    return in_arrow(pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "sb"), _prune(percent), "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that hold on the full sets."""
    text = lambda c: texts.select(F.col("d").alias(c), F.col("t").alias(f"t{c}"))
    whole = written(pairs).join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb")
    return written(in_arrow(whole, _verify(size, percent), "a long, b long").distinct())


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after the components that links between nodes join."""
    to = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    lifted = links.join(to("a"), "a").join(to("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    merged = components(lifted).select(F.col("node").alias("label"), F.col("label").alias("next"))
    return written(labels.join(merged, "label", "left").select("node", F.coalesce("next", "label").alias("label")))


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a <> b").distinct()


def _best_center(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Each node with the smallest member of its buckets that it meets most often."""
    stars = members.where("node <> center").groupBy("node", "center").count()
    return _pairs(stars.groupBy("node").agg(F.max_by("center", F.struct("count", -F.col("center"))).alias("center")), "node", "center")


def _small(df: DataFrame) -> DataFrame:
    """A written table that is broadcast up to BROADCAST rows; beyond that adaptive execution splits the join's hot keys."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with the bucket's largest component main, a hashed member one
    of it, and the number of its members (most) and of all."""
    placed = written(members.join(labels, "node").select("key", "node", "label"))
    sizes = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.min_by("node", F.xxhash64("node", "key")).alias("one"))
    main = sizes.groupBy("key").agg(F.max_by(F.struct("label", "one", "n"), F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return placed.join(_small(written(main.select("key", F.col("main.label").alias("main"), F.col("main.one").alias("one"), F.col("main.n").alias("most"), "all"))), "key")


def _representatives(members: DataFrame, labels: DataFrame) -> DataFrame:
    """In each bucket with several components: every node outside the largest one with a hashed member of it, so that
    a node meets another member in each of its buckets."""
    return _pairs(_open_buckets(members, labels).where("label <> main"), "node", "one")


class _Sets:
    """Union-find over the labels of one group; yields one edge for each label that joins another."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def edges(self) -> list[tuple[int, int]]:
        return [(self.root(x), x) for x in list(self.up) if self.root(x) != x]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by keys, with the groups' edges; what is left of a batch waits for the next."""
    rest = None
    for batch in _and_end(batches):
        parts = [x for x in (rest, pa.Table.from_batches([batch]) if batch is not None else None) if x is not None]
        table = pa.concat_tables(parts).combine_chunks() if parts else None
        if table is None or not len(table):
            continue
        ids = np.stack([table[c].to_numpy() for c in keys])
        edges = np.concatenate(([0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1, [len(table)]))
        if batch is not None:
            edges = edges[:-1]
        rest = table.slice(int(edges[-1]))
        if edges[-1]:
            yield table.slice(0, int(edges[-1])), edges


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _blocks(members: DataFrame, group: str, width: int) -> DataFrame:
    """members (group, node, label, main, most, all) dealt into places (rb, cb) that no group, however large, can fill.

    Those outside the group's largest component are rows, of which a place holds about width; all are columns, likewise.
    Every row meets every column in one place. A member is sent once for each block of the other kind.
    """
    mine = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.ceil(n / width)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1))
    rest = F.col("all") - F.col("most")
    columns = members.select(group, "node", "label", every(rest).alias("rb"), mine(F.col("all"), 1).alias("cb"), F.lit(0).alias("role"))
    rows = members.where("label <> main").select(group, "node", "label", mine(rest, 2).alias("rb"), every(F.col("all")).alias("cb"), F.lit(1).alias("role"))
    return columns.union(rows)


def _near(table: pa.Table, s: int, e: int, percent: int, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the pairs of different components in rows s to e of table that neither the sizes of their sets nor
    the batches of their signatures rule out."""
    label, role, size = (table[c].to_numpy()[s:e] for c in ("label", "role", "n"))
    sig = np.frombuffer(b"".join(table["sig"].slice(s, e - s).to_pylist()), np.uint16).reshape(-1, COMPARED)
    rows, columns = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
    n, m = size[rows][:, None], size[columns][None]
    x, y = np.nonzero((label[rows][:, None] != label[columns][None]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
    x, y, matches = rows[x], columns[y], 0
    for k, enough in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (sig[x, at] == sig[y, at]).sum(axis=1)
        alive = matches >= enough
        x, y, matches = x[alive], y[alive], matches[alive]
    return x, y


def _survivors(percent: int):
    """Streams the places of meetings and emits edges that connect the components of surviving pairs."""
    least = least_matches(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _grouped(batches, ["key", "rb", "cb"]):
            label, out = table["label"].to_numpy(), []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                x, y = _near(table, s, e, percent, least)
                joined = _Sets()
                for a, b in {*zip(label[s + x].tolist(), label[s + y].tolist())}:
                    joined.join(a, b)
                out += joined.edges()
            yield _edge_batch(out)

    return run


def _open_members(percent: int):
    """Streams the places of families and passes on the rows and columns of surviving pairs."""
    least, names = least_matches(percent), ["key", "rb", "cb", "role", "node", "label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _grouped(batches, ["key", "rb", "cb"]):
            keep = [s + v for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()) for v in (np.unique(v) for v in _near(table, s, e, percent, least))]
            found = table.select(names).take(pa.array(np.concatenate(keep)))
            yield pa.RecordBatch.from_arrays([pa.array(c.to_numpy(), c.type) for c in found.columns], names=names)

    return run


def _exact(percent: int):
    """Streams the places of families: rows (role 1) against columns (role 0) on their full sets, and emits edges that
    connect the components of linked pairs. A row is not compared with components that it has met already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _grouped(batches, ["key", "rb", "cb"]):
            label, role = table["label"].to_numpy(), table["role"].to_numpy()
            out = []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
                listed = table["h"].slice(s, e - s).combine_chunks()
                flat, ends = listed.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(np.diff(listed.offsets.to_numpy()))))
                sets = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                columns, rows, joined = np.flatnonzero(role[s:e] == 0), np.flatnonzero(role[s:e] == 1), _Sets()
                if not len(columns) or not len(rows):
                    continue
                size = np.array([len(x) for x in sets])
                values = np.concatenate([sets[c] for c in columns])
                owner = np.repeat(np.arange(len(columns)), size[columns])
                order = np.argsort(values, kind="stable")
                values, owner = values[order], owner[order]
                root = label[s + columns].copy()
                for r in rows.tolist():
                    mine = joined.root(int(label[s + r]))
                    other = root != mine
                    if not other.any():
                        continue
                    lo, hi = np.searchsorted(values, sets[r], "left"), np.searchsorted(values, sets[r], "right")
                    n = hi - lo
                    at = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
                    both = np.bincount(owner[at], minlength=len(columns))
                    near = other & (100 * both >= percent * (size[r] + size[columns] - both))
                    for y in set(root[near].tolist()):
                        joined.join(mine, y)
                        now = joined.root(mine)
                        root[(root == mine) | (root == y)] = now
                        mine = now
                out += joined.edges()
            yield _edge_batch(out)

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8(column(batch, "t"))
            found = [x for i, j in cut(off) for x in distinct_sets(raw[off[i] : off[j]], off[i : j + 1] - off[i], size)]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            hashes = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([column(batch, "node"), hashes], names=["node", "h"])

    return run


def _and_end(batches):
    yield from batches
    yield None


def _sorted_by(df: DataFrame, *keys: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def _rarest(nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, node): nodes at the shingles that they may meet a linked node at. Two linked sets share one of the
    n - ceil(percent of n) + 1 rarest of each, if all are ranked by one order; a shingle of one node only meets nobody and is left out."""
    wanted = nodes.select("node").join(texts.select(F.col("d").alias("node"), "t"), "node")
    sets = written(in_arrow(wanted, _sets(size), "node long, h array<bigint>"))
    each = sets.select("node", F.explode("h").alias("h"))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("f"))
    ranked = each.join(often, "h").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("o"))
    first = F.size("o") - F.ceil(F.size("o") * F.lit(percent) / 100 - 1e-9).cast("int") + 1
    met = ranked.select("node", F.explode(F.slice("o", 1, first)).alias("x"))
    return met.where("x.f > 1").select(F.col("x.h").alias("key"), "node").distinct()


def _families(members: DataFrame, labels: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, label): components that are connected by documents that meet and whose sizes and signatures don't rule a link out; key
    is the family. All documents of components of which a bucket holds several meet, at their rarest shingles only, so documents of one
    template meet where they share more than it, and a meeting sends as many rows as documents share such a shingle."""
    open_labels = _open_buckets(members, labels).select("label").distinct()
    nodes = written(labels.join(open_labels, "label"))
    meetings = written(_open_buckets(written(_rarest(nodes, texts, size, percent)), nodes))
    dealt = _blocks(meetings, "key", SIDE).join(reps.select("node", "n", "sig"), "node")
    edges = in_arrow(_sorted_by(dealt, "key", "rb", "cb"), _survivors(percent), "a long, b long")
    return components(edges).select(F.col("label").alias("key"), F.col("node").alias("label"))


def _family_links(families: DataFrame, labels: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) between the components of a family that a link joins: every node outside the family's largest
    component is held against all nodes of the family, first by sizes and signatures, then on full sets. Sets are made
    and sent of those nodes only, and to those places only, that the first look leaves over."""
    inside = written(labels.join(families, "label"))
    parts = inside.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    whole = parts.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    dealt = _blocks(written(inside.join(_small(written(whole)), "key")), "key", SIDE).join(reps.select("node", "n", "sig"), "node")
    left = written(in_arrow(_sorted_by(dealt, "key", "rb", "cb"), _open_members(percent), "key long, rb int, cb int, role int, node long, label long"))
    wanted = left.select("node").distinct().join(texts.select(F.col("d").alias("node"), "t"), "node")
    sets = written(in_arrow(wanted, _sets(size), "node long, h array<bigint>"))
    return in_arrow(_sorted_by(left.join(sets, "node"), "key", "rb", "cb"), _exact(percent), "a long, b long")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: key, n_shingles, component_id (smallest key reachable) and kept (key is component_id).

    size is the words of a shingle; documents are linked if 100 * intersection >= percent * union of their sets.
    """
    whole_numbers(docs, key)
    texts = docs.select(F.col(key).cast("long").alias("d"), F.col(text).alias("t"))
    marked = written(in_arrow(texts, _signatures(size), _SCHEMA))
    graph = marked.where("n > 0 and d is not null")
    reps = written(graph.groupBy("f1", "f2").agg(F.min("d").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    classes = reps.select("f1", "f2", "node")
    nodes = written(graph.select("d", "f1", "f2").join(classes, ["f1", "f2"]).select("d", "f1", "f2", "node"))

    rows = reps.select("node", F.explode("bands").alias("key"))
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("center")).where("n > 1").select("key", "center"))
    members = written(rows.join(shared, "key"))
    repeated = nodes.groupBy("d").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b")
    labels = written(members.select("node").union(repeated.select("a")).union(repeated.select("b")).distinct().withColumn("label", F.col("node")))
    labels = _joined(labels, written(repeated))
    tried = None
    for choose in (_best_center, _representatives):
        pairs = choose(members, labels)
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        labels = _joined(labels, _verified(_pruned(pairs, reps, percent), texts, size, percent))
        tried = pairs if tried is None else tried.union(pairs)
    families = written(_families(members, labels, reps, texts, size, percent))
    labels = _joined(labels, written(_family_links(families, labels, reps, texts, size, percent)))

    final = nodes.join(labels, "node", "left").select("d", "f1", "f2", F.coalesce("label", "node").alias("c")).distinct()
    out = marked.select("d", "n", "f1", "f2").join(final, ["d", "f1", "f2"], "left")
    component = F.coalesce("c", "d")
    return out.select(F.col("d").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("d"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each group, the one of the smallest key."""
    gone = near_duplicates(docs, key=key, text=text, size=size, percent=percent).where("not kept").select(F.col(key).alias("_gl_gone")).distinct()
    inner, of, back = shielded(docs)
    return back(inner.join(gone, F.col(of(key)) == F.col("_gl_gone"), "left_anti"))


#: DuckDB SQL for the rows of near_duplicates() over table documents with two-word shingles at 80 per cent.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, g FROM (SELECT doc_id, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM w WHERE len(w) >= 2) UNION ALL SELECT doc_id, w[1] FROM w WHERE len(w) = 1)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS label FROM e UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node WHERE r.label < e.b),
c AS (SELECT node, min(label) AS label FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.label, w.doc_id) AS component_id, coalesce(c.label, w.doc_id) = w.doc_id AS kept FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""

"""Hard-negative mining with vantage-point trees over norm-augmented vectors.

A vector x gets one more component, sqrt(M - |x|^2) with M the largest squared norm, and an anchor q gets 0 there. Then
|q - x|^2 = |q|^2 + M - 2 q.x: higher scores are nearer, and a window of scores is an annulus around the anchor. A tree over the
vectors splits them by their distance to vantage points, so that the triangle inequality bounds the scores below each node;
nodes outside the annulus are passed over, and the others are visited nearest first until k rows are known that no
node left can beat.

The top of the tree is built from a bounded sample and broadcast; it deals all vectors to leaves, a leaf of more than
`shard` vectors to several parts. Each part is a tree of its own in the task that searches it. Anchors are dealt into blocks of
neighbouring leaves. A first round searches each anchor's own leaf, and what it finds narrows the leaves of the second.
Scores are those of the vectors themselves, so results are exact; bounds have a margin for rounding.

Rows with a null id, label or vector, or with a null or non-finite component take no part, nor do those of which the squared norm is
2**52 or more (scores would be inexact). Rows that repeat an id are one row, that with the smallest label and vector. Shorter
vectors count as followed by zeros. Equal vectors of a label are one entry with its smallest ids, as no more can be returned.
Ties go to the smaller id. An empty table, and one without anchors, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from gleaner.llm.common import column, in_arrow, kept, small_batches, whole_numbers, written
from gleaner.session import ship

#: Vectors of one tree, vectors of one bucket in it, anchors of one block, leaves at most, and sampled vectors of a leaf.
SHARD, BUCKET, BLOCK, MOST_LEAVES, SAMPLED = 4096, 256, 8192, 4096, 16
#: Relative margin of distances and scores for rounding.
MARGIN = 1e-9


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of equal length, zeros after shorter ones."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n, flat = len(vectors), vectors.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == n * size:
        return flat.reshape(n, size)
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((n, size))
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


class Augmented:
    """Vectors with their norms and last component."""

    def __init__(self, x: np.ndarray, most: float):
        self.x, self.norm = x, _squares(x)
        self.last = np.sqrt(np.maximum(most - self.norm, 0))

    def take(self, rows: np.ndarray) -> Augmented:
        out = object.__new__(Augmented)
        out.x, out.norm, out.last = self.x[rows], self.norm[rows], self.last[rows]
        return out

    def to(self, i: int) -> np.ndarray:
        """Distances of all vectors to vector i."""
        return np.sqrt(np.maximum(self.norm + self.norm[i] - 2 * (self.x @ self.x[i]) + (self.last - self.last[i]) ** 2, 0))


def _vantage(points: Augmented, rows: np.ndarray) -> tuple[int, np.ndarray]:
    """Of a few rows spread over those given, the one with the widest spread of distances, and these."""
    part, best = points.take(rows), None
    for i in range(0, len(rows), max(1, len(rows) // 4)):
        d = part.to(i)
        if best is None or d.std() > best[1].std():
            best = i, d
    return int(rows[best[0]]), best[1]


class Top:
    """A complete tree over a sample: vantage points and median distances; its leaves number the shards."""

    def __init__(self, sample: np.ndarray, most: float, depth: int):
        self.depth, self.most = depth, most
        nodes = (1 << depth) - 1
        points, at = Augmented(sample, most), {0: np.arange(len(sample))}
        at_vantage, self.radius = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        for node in range(nodes):
            rows = at.pop(node)
            if len(rows) > 1:
                at_vantage[node], d = _vantage(points, rows)
                self.radius[node] = np.median(d)
                near = d <= self.radius[node]
                at[2 * node + 1], at[2 * node + 2] = rows[near], rows[~near]
            else:
                at[2 * node + 1], at[2 * node + 2] = rows, rows[:0]
        self.points = points.take(at_vantage)

    def distances(self, x: np.ndarray, last: np.ndarray) -> np.ndarray:
        p = self.points
        return np.sqrt(np.maximum(_squares(x)[:, None] + p.norm - 2 * (x @ p.x.T) + (last[:, None] - p.last) ** 2, 0))

    def leaf(self, d: np.ndarray) -> np.ndarray:
        """The leaf of each row of distances."""
        node = np.zeros(len(d), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (d[np.arange(len(d)), node] > self.radius[node])
        return node - len(self.radius)

    def bounds(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) distance that vectors of each leaf can have."""
        low, high = np.zeros((len(d), 1)), np.full((len(d), 1), np.inf)
        for level in range(self.depth):
            node = np.arange((1 << level) - 1, (2 << level) - 1)
            near, r = d[:, node], self.radius[node]
            low = np.stack([np.maximum(low, near - r), np.maximum(low, np.where(np.isinf(r), np.inf, r - near))], 2).reshape(len(d), -1)
            high = np.stack([np.minimum(high, near + r), high], 2).reshape(len(d), -1)
        return low, high


class Tree:
    """A vantage-point tree over the entries of one part; children keep the range of their distances and of their labels."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, most: float, bucket: int):
        points = Augmented(x, most)
        self.vantage, self.nodes, parts = [], [], []
        self.root = self._grow(points, labels, np.arange(len(x)), max(1, bucket), parts)
        self.order = np.concatenate(parts)
        self.vectors = points.x[self.order]
        self.points = points.take(np.array(self.vantage, np.int64))

    def _grow(self, points, labels, rows, bucket, parts) -> int:
        me = len(self.nodes)
        self.nodes.append(None)
        span = int(labels[rows].min()), int(labels[rows].max())
        if len(rows) <= bucket:
            start = sum(map(len, parts))
            parts.append(rows)
            self.nodes[me] = (*span, None, start, start + len(rows), None)
            return me
        i, d = _vantage(points, rows)
        v = len(self.vantage)
        self.vantage.append(i)
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        children = []
        for part in (order[:half], order[half:]):  # by place, so that equal vectors are halved too
            children.append((self._grow(points, labels, rows[part], bucket, parts), float(d[part[0]]), float(d[part[-1]])))
        self.nodes[me] = (*span, v, *children, None)
        return me

    def to_vantage(self, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Distances of anchors (last component 0) to the vantage points."""
        p = self.points
        return np.sqrt(np.maximum(norm[:, None] + p.norm + p.last**2 - 2 * (q @ p.x.T), 0))


def _search(tree: Tree, to: list[float], total: float, fits: np.ndarray, ids: np.ndarray, scores: dict, dot, same: bool, label: int, me: int, low: float, high: float, k: int) -> list[tuple[float, int]]:
    """The first k rows (score, id) of the annulus, nearest first: a queue of nodes by the best score that is possible below them.
    low and high are 100 times a score; total is |q|^2 + M."""
    margin = MARGIN * total * 100
    found: list[tuple[float, int]] = []
    queue = [(-math.inf, 0, tree.root, 0.0, math.inf)]
    while queue:
        best, _, node, near, far = heapq.heappop(queue)
        if len(found) == k and -best < found[-1][0] - margin:
            break
        first, last, v, a, b, _ = tree.nodes[node]
        if (first > label or last < label) if same else first == last == label:
            continue
        if v is None:
            if node not in scores:
                scores[node] = 100 * dot(a, b)
            s = scores[node]
            ok = fits[a:b] & (s >= max(low, found[-1][0] if len(found) == k else low)) & (s <= high)
            at = np.flatnonzero(ok)
            if len(at):
                some = s[at]
                if len(at) > 4 * k:
                    at = at[some >= np.partition(some, len(some) - k)[len(some) - k]]
                found = sorted([*found, *zip(s[at].tolist(), ids[a:b][at].tolist())], key=lambda x: (-x[0], x[1]))
                found = [x for x in found if x[1] != me][:k] if same else found[:k]
            continue
        d = to[v]
        for child, inner, outer in (a, b):
            lo, hi = max(near, d - outer, inner - d), min(far, d + outer)
            top = 50 * (total - lo * lo)
            if top >= low - margin and 50 * (total - hi * hi) <= high + margin:
                heapq.heappush(queue, (-min(top, high), len(queue), child, lo, hi))
    return found


_FOUND = "a long, n int, score double, id long"


def _searched(size: int, most: float, same: bool, k: int, bucket: int):
    def run(entries: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(entries) and len(anchors):
            x, labels, members = _matrix(entries["v"], size), entries["label"].to_numpy(), entries["ids"].combine_chunks()
            tree = Tree(x, labels, most, bucket)
            ids, per = members.flatten().to_numpy(), np.diff(members.offsets.to_numpy())
            first = np.concatenate(([0], np.cumsum(per)))
            per = per[tree.order]
            rows = np.repeat(np.arange(len(per)), per)  # of each id, in the order of the tree, its entry there
            ids = ids[np.repeat(first[tree.order] - np.concatenate(([0], np.cumsum(per)[:-1])), per) + np.arange(len(rows))]
            label_of, starts = labels[tree.order][rows], np.concatenate(([0], np.cumsum(per)))
            nodes = [n if n[2] is not None else (*n[:3], int(starts[n[3]]), int(starts[n[4]]), None) for n in tree.nodes]
            tree.nodes = nodes
            q = _matrix(anchors["v"], size)
            norm = _squares(q)
            to = tree.to_vantage(q, norm)
            for i, (me, label, windows) in enumerate(zip(anchors["a"].to_pylist(), anchors["label"].to_pylist(), anchors["w"].to_pylist())):
                scores: dict = {}
                fits = (label_of == label) if same else (label_of != label)
                dot = lambda a, b, i=i: (tree.vectors[rows[a] : rows[b - 1] + 1] @ q[i])[rows[a:b] - rows[a]]
                for w in windows:
                    found = _search(tree, to[i].tolist(), norm[i] + most, fits, ids, scores, dot, same, label, me, w["low"], w["high"], k + same)
                    out += [(me, w["n"], s / 100, d) for s, d in found[:k]]
        return pa.table({c: pa.array([r[i] for r in out], t) for i, (c, t) in enumerate((("a", pa.int64()), ("n", pa.int32()), ("score", pa.float64()), ("id", pa.int64())))})

    return run


class Index:
    """All vectors dealt to the parts of the leaves of one top tree."""

    def __init__(self, points: DataFrame, *, keep: int, shard: int, bucket: int, block: int, most_leaves: int):
        self.spark: SparkSession = points.sparkSession
        self.bucket, self.block = bucket, block
        stats = points.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("most"), F.max(F.size("v")).alias("size")).first()
        self.n, self.most, self.size = stats["n"], stats["most"] or 0.0, stats["size"] or 0
        if not self.n:
            return
        first = Window.partitionBy("v", "label").orderBy("id")
        entries = points.select("v", "label", "id", F.row_number().over(first).alias("k")).where(F.col("k") <= keep).groupBy("v", "label").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        entries = written(entries)
        n = entries.count()
        depth = min(math.ceil(math.log2(max(1, n / shard))), int(math.log2(most_leaves)))
        sample = entries.select("v").orderBy(F.xxhash64("v", "label"), "label").limit(SAMPLED << depth).toArrow()
        self.top = self.spark.sparkContext.broadcast(Top(_matrix(sample["v"], self.size), self.most, depth))
        dealt = written(self._leaves(entries, "v array<double>, label long, ids array<bigint>", anchors=False))
        self.parts = self._parts(dealt, shard, join=False)
        self.entries = dealt.join(self.parts, "leaf").withColumn("part", F.pmod(F.xxhash64("v", "label"), F.col("parts")).cast("int"))

    def _leaves(self, rows: DataFrame, schema: str, anchors: bool) -> DataFrame:
        top, size = self.top, self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept("negatives", lambda: None)
            of: Top = top.value
            for batch in batches:
                x = _matrix(column(batch, "v"), size)
                last = np.zeros(len(x)) if anchors else np.sqrt(np.maximum(of.most - _squares(x), 0))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of.leaf(of.distances(x, last)), pa.int32())], names=[*batch.schema.names, "leaf"])

        return in_arrow(rows, run, f"{schema}, leaf int")

    def _parts(self, rows: DataFrame, most: int, join: bool) -> DataFrame:
        """leaf, first, parts: into how many parts of at most about `most` rows each leaf goes, and the number of its first part;
        small neighbours share one part if join. One row a leaf, so bounded."""
        out, at, held = [], -1, most
        for leaf, n in sorted((r["leaf"], r["count"]) for r in rows.groupBy("leaf").count().collect()):
            parts = math.ceil(n / most)
            if not join or parts > 1 or held + n > most:
                at += 1
                out.append((leaf, at, parts))
                at, held = at + parts - 1, n if parts == 1 else most
            else:
                out.append((leaf, at, 1))
                held += n
        return F.broadcast(self.spark.createDataFrame(out, "leaf int, first int, parts int"))

    def anchors(self, points: DataFrame) -> DataFrame:
        """a, label, v, w (one window without bounds), home (leaf) and block."""
        w = F.array(F.struct(F.lit(0).alias("n"), F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high")))
        rows = points.select(F.col("id").alias("a"), "label", "v")
        rows = written(self._leaves(rows, "a long, label long, v array<double>", anchors=True))
        blocks = self._parts(rows, self.block, join=True)
        return rows.join(blocks, "leaf").select("a", "label", "v", w.alias("w"), F.col("leaf").alias("home"), (F.col("first") + F.pmod(F.xxhash64("a"), F.col("parts"))).cast("int").alias("block"))

    def _visits(self, anchors: DataFrame) -> DataFrame:
        """A row for each anchor and each other leaf that a window reaches."""
        top, size = self.top, self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept("negatives", lambda: None)
            of: Top = top.value
            for whole in batches:
                for start in range(0, len(whole), 64):
                    batch = whole.slice(start, 64)
                    x = _matrix(column(batch, "v"), size)
                    total = (_squares(x) + of.most)[:, None]
                    low, high = of.bounds(of.distances(x, np.zeros(len(x))))
                    best, worst, margin = 50 * (total - low * low), 50 * (total - high * high), MARGIN * 100 * total
                    reach = np.zeros(best.shape, bool)
                    for i, windows in enumerate(column(batch, "w").to_pylist()):
                        for w in windows:
                            reach[i] |= (best[i] >= w["low"] - margin[i]) & (worst[i] <= w["high"] + margin[i])
                    reach[np.arange(len(x)), column(batch, "home").to_numpy()] = False
                    row, leaf = np.nonzero(reach)
                    for i in range(0, len(row), 512):
                        some = batch.take(pa.array(row[i : i + 512]))
                        yield pa.RecordBatch.from_arrays([*some.columns, pa.array(leaf[i : i + 512], pa.int32())], names=[*some.schema.names, "leaf"])

        return in_arrow(anchors, run, T.StructType([*anchors.schema.fields, T.StructField("leaf", T.IntegerType())]))

    def _round(self, visits: DataFrame, same: bool, k: int) -> DataFrame:
        ship(self.spark)
        small_batches(self.spark)
        visits = written(visits)
        asked = visits.join(self.parts, "leaf").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("leaf", "part", "block", "a", "label", "v", "w")
        needed = visits.select("leaf", F.col("block").alias("for_block")).distinct()
        entries = self.entries.select("leaf", "part", "v", "label", "ids").join(needed, "leaf")
        return entries.groupBy("leaf", "part", "for_block").cogroup(asked.groupBy("leaf", "part", "block")).applyInArrow(_searched(self.size, self.most, same, k, self.bucket), _FOUND)

    def search(self, anchors: DataFrame, *, same: bool, k: int) -> DataFrame:
        """a, n, score, id, k: the first k rows of each window of each anchor, of its own label (and not itself) or of others."""
        by = Window.partitionBy("a", "n").orderBy(F.desc("score"), "id")
        ranked = lambda df: df.withColumn("k", F.row_number().over(by)).where(F.col("k") <= k)
        found = written(self._round(anchors.withColumn("leaf", F.col("home")), same, k))
        if not self.top.value.depth:
            return ranked(found)
        known = found.groupBy("a", "n").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= k).groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("n", (100 * F.get("s", F.lit(k - 1)))))).alias("m"))
        narrow = F.transform("w", lambda w: F.struct(w["n"].alias("n"), F.greatest(w["low"], F.coalesce(F.try_element_at("m", w["n"]), w["low"])).alias("low"), w["high"].alias("high")))
        rest = self._visits(anchors.join(known, "a", "left").withColumn("w", narrow).drop("m"))
        return ranked(found.unionByName(self._round(rest, same, k)))


def hard_negatives(rows: DataFrame, is_anchor: Column, *, key: str = "vec_id", label: str = "label", vector: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, shard: int = SHARD, bucket: int = BUCKET, block: int = BLOCK, most_leaves: int = MOST_LEAVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row of which is_anchor holds and each
    of its first `positives` rows of the same label, the first `negatives` rows of other labels whose score lies between low
    and high per cent of the positive's."""
    for name in (key, label):
        whole_numbers(rows, name)
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    points = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), v.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    points = points.where("id is not null and label is not null and v is not null").where(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < math.inf)))
    points = points.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).where(F.col("norm") < float(1 << 52))
    points = points.groupBy("id").agg(F.min(F.struct("label", "v", "norm", "anchor")).alias("p")).select("id", "p.*")
    points = written(points)
    index = Index(points, keep=max(positives + 1, negatives), shard=shard, bucket=bucket, block=block, most_leaves=most_leaves)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score double, negative_score double"
    if not index.n:
        return rows.sparkSession.createDataFrame([], schema)
    anchors = written(index.anchors(points.where("anchor")))
    near = written(index.search(anchors, same=True, k=positives).select("a", F.col("k").alias("n"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    window = F.struct("n", (low * F.col("positive_score")).alias("low"), (high * F.col("positive_score")).alias("high"))
    windows = near.where(low * F.col("positive_score") <= high * F.col("positive_score")).groupBy("a").agg(F.array_sort(F.collect_list(window)).alias("w"))
    found = index.search(anchors.drop("w").join(windows, "a").select(anchors.columns), same=False, k=negatives)
    return found.join(near, ["a", "n"]).select(F.col("a").alias("anchor_id"), "positive_id", F.col("k").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def report(rows: DataFrame) -> DataFrame:
    """The contract's rows: components as floor(256 * x), every seventh row with the next label, every fiftieth an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < math.inf))
    inner = rows.where(finite).select("vec_id", label.alias("label"), scaled.alias("embedding"))
    out = hard_negatives(inner, F.col("vec_id") % 50 == 0)
    return out.withColumns({c: F.col(c).cast("long") for c in ("positive_score", "negative_score")})


#: DuckDB SQL for the rows of report() over table embeddings, whose ids are unique and vectors of one length.
SQL = """
WITH points AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM points a JOIN points b ON a.id <> b.id WHERE a.id % 50 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 3
"""

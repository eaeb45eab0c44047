"""Hard negatives against a full sort of all rows for every anchor."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import negatives
from gleaner.llm.queries import op12_hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows):
    points = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        at = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        points[i] = min(points.get(i, at), at)
    ids = sorted(points)
    size = max((len(v) for _, v in points.values()), default=0)
    x = np.array([[*points[i][1], *[0] * (size - len(points[i][1]))] for i in ids], dtype=np.int64).reshape(len(ids), size)
    labels, out = np.array([points[i][0] for i in ids]), []
    for a, i in enumerate(ids):
        if i % 50:
            continue
        s = x @ x[a]
        order = np.lexsort((ids, -s))
        near = [p for p in order if labels[p] == labels[a] and p != a][:5]
        for p in near:
            fits = [n for n in order if labels[n] != labels[a] and 50 * s[p] <= 100 * s[n] <= 95 * s[p]][:3]
            out += [(i, ids[p], k, ids[n], int(s[p]), int(s[n])) for k, n in enumerate(fits, 1)]
    return sorted(out)


def clustered(seed, n, size, centres=6, scale=0.3):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(centres)]
    out = []
    for i in range(n):
        c = rng.randrange(centres)
        out.append((i, (c + (rng.random() < 0.2)) % 10, [float(np.float32(m + rng.gauss(0, scale))) for m in middle[c]]))
    return out


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("setting", [{}, {"shard": 40, "bucket": 8}, {"shard": 25, "bucket": 1, "block": 3}, {"shard": 30, "bucket": 4, "most_leaves": 2}])
def test_equal_to_a_full_sort(spark, monkeypatch, setting):
    """One tree; many leaves; blocks of few anchors; leaves of several parts."""
    whole = negatives.hard_negatives
    monkeypatch.setattr(negatives, "hard_negatives", lambda rows, anchor: whole(rows, anchor, **setting))
    rows = clustered(len(setting), 700, 5)
    rows += [(700 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(60)]  # copies
    rows += [(760 + i, (i + 1) % 10, rows[0][2]) for i in range(60)]  # one vector of all labels
    assert got(negatives.report(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows) != []


def test_awkward_rows(spark):
    """Nulls, non-finite and huge components, repeated ids, vectors of other lengths, zeros, negative scores, extra columns."""
    rng = random.Random(2)
    rows = [(i, rng.randrange(3), [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(rng.choice([2, 3, 3]))]) for i in range(300)]
    rows += [(0, 1, [1.0, 1.0, 1.0]), (7, 0, [0.5]), (None, 1, [1.0, 1.0, 1.0]), (301, None, [1.0, 1.0, 1.0]), (302, 1, None), (350, 1, [1.0, None, 1.0]), (303, 1, [1.0, math.inf, 0.0]), (304, 2, [math.nan, 1.0, 0.0]), (305, 2, []), (400, 1, []), (450, 2, [0.0, 0.0, 0.0])]
    rows += [rows[50], rows[51]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", anchor string, leaf int")
    assert got(negatives.report(df)) == brute(rows) != []
    assert negatives.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.report(spark.createDataFrame([(1, 1, [1.0])], SCHEMA)).count() == 0
    assert negatives.report(spark.createDataFrame([(50, 1, [1.0]), (51, 1, [3e30]), (52, 1, [1.0])], SCHEMA)).count() == 0
    with pytest.raises(TypeError):
        negatives.hard_negatives(spark.createDataFrame([("a", 1, [1.0])], "vec_id string, label int, embedding array<float>"), F.lit(True))


def test_trees_pass_over_what_cannot_match():
    """Two far clusters: a search near one looks at no bucket of the other."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, (512, 8)) + 50, rng.normal(0, 1, (512, 8)) - 50])
    most = float((x * x).sum(1).max())
    tree, labels = negatives.Tree(x, np.arange(1024) % 2, most, 64), np.arange(1024) % 2
    looked = []

    def dot(a, b):
        looked.append(b - a)
        return tree.vectors[a:b] @ x[0]

    q = x[:1]
    to = tree.to_vantage(q, (q * q).sum(1))[0].tolist()
    found = negatives._search(tree, to, float((q * q).sum() + most), labels[tree.order] == 1, tree.order, {}, dot, False, 0, 0, -math.inf, math.inf, 3)
    s = x @ x[0]
    assert [d for _, d in found] == [i for i in np.argsort(-s, kind="stable") if i % 2][:3]
    assert sum(looked) <= 512


def test_query_against_a_full_sort(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    assert got(op12_hard_negatives(spark, sf_dir)) == brute(rows) != []

"""Periodic runs against a plain scan of every lag."""

import hashlib
import random
import zlib

import pytest

from gleaner.llm import periodic
from gleaner.llm.queries import op11_periodic_runs


def brute(w, least=24, times=3):
    """Every maximal stretch of each period whose smallest period it is, word by word."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, times * q) and not any(all(w[x] == w[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    short = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(short).hexdigest(), n)


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"]


@pytest.mark.parametrize("together,sieved", [(periodic.TOGETHER, periodic.SIEVED), (1, periodic.SIEVED), (1, 0), (40, 10**9)])
def test_runs_equal_every_lag(together, sieved, monkeypatch):
    """Few and many different words, planted tails, several texts in one integer, every lag sieved or none."""
    monkeypatch.setattr(periodic, "SIEVED_LAG", 1)
    rng = random.Random(together + sieved)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 6)):
            k, n = rng.choice([1, 2, 3, 50]), rng.randint(0, 160)
            w = [rng.randint(0, k) for _ in range(n)]
            if n and rng.random() < 0.7:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 3))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        assert periodic.runs_of_texts(texts, together=together, sieved=sieved) == [brute(w) for w in texts]


def test_nested_periods_and_edges():
    a = ["a", "b"] * 12
    assert periodic.runs_of_texts([a]) == [[(0, 24, 2)]]
    assert periodic.runs_of_texts([a[:23]]) == [[]]
    assert periodic.runs_of_texts([["x"] * 24]) == [[(0, 24, 1)]]
    inner = (["x"] * 30 + ["y"]) * 3
    assert periodic.runs_of_texts([inner]) == [brute(inner)] == [[(0, 30, 1), (0, 93, 31), (31, 30, 1), (62, 30, 1)]]
    with pytest.raises(ValueError):
        periodic.find(periodic.np.zeros(30, int), 30, times=2)


def test_very_long_texts():
    """2,000,000 words: one word, and a period of 100,000 words that ends early; the sieve passes the lags in seconds."""
    assert periodic.runs_of_texts([[b"a"] * 2_000_000]) == [[(0, 2_000_000, 1)]]
    long = [str(i % 100_000) for i in range(450_000)] + [f"t{i}" for i in range(50_000)]
    assert periodic.runs_of_texts([long]) == [[(0, 450_000, 100_000)]]


def test_report_on_awkward_rows(spark, docs, world, empty):
    """Nulls, empties, ties, repeated rows and ids, clashing names; every tenth document with a repeating tail."""
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, *(r[c] for c in COLUMNS)) for r in periodic.report(docs).select("doc_id", *COLUMNS).fillna(-1, ["start", "length", "period", "exponent_milli"]).collect())
    want = sorted((r[0] is None, r[0] or 0, *(-1 if x is None else x for x in expected(r[0], r[1]))) for r in world)
    assert got == want
    assert periodic.report(empty).count() == 0
    assert any(r[2] for r in got)


def test_detect_keeps_other_columns(spark):
    rows = [(1, "go " * 30 + "end", "x", 5), (2, None, None, None), (3, "a b " * 24, "y", 6), (4, "\x1cq " * 24 + "\x0b\x0cz", "y", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gl_runs string, `odd name` int")
    out = {r["doc_id"]: r for r in periodic.detect(df).collect()}
    assert [tuple(x) for x in out[1]["_gl_runs"]] == [(0, 30, 1)] and out[1]["_gl_collapsed"] == "go end" and out[1]["odd name"] == 5
    assert (out[2]["_gl_n_words"], out[2]["_gl_runs"], out[2]["_gl_collapsed"]) == (0, [], "")
    assert [tuple(x) for x in out[3]["_gl_runs"]] == [(0, 24, 1)] and out[3]["_gl_collapsed"] == "a b"
    assert [tuple(x) for x in out[4]["_gl_runs"]] == [(0, 24, 1)] and out[4]["_gl_n_words"] == 25


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    texts = {d: t for d, t in texts.items() if len((t or "").split()) < 1500}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op11_periodic_runs(spark, sf_dir).collect()}
    assert all(got[d] == expected(d, t) for d, t in texts.items()) and len(texts) > 100

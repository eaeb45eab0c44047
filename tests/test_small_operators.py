"""Small operators whose bindings do not show their edges."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from gleaner.operators import guides, texts
from gleaner.sources import images, jsonlines


def greedy_spans(words, names, longest=6):
    """Longest first, of equals the first; a word belongs to one name."""
    hits = sorted((-n, i, " ".join(words[i : i + n])) for n in range(1, longest + 1) for i in range(len(words) - n + 1) if " ".join(words[i : i + n]) in names)
    taken, out = set(), []
    for n, i, name in hits:
        if not taken & set(range(i, i - n)):
            taken |= set(range(i, i - n))
            out.append((i, name))
    return sorted(out)


def test_spotted_names_of_random_texts(spark):
    rng = random.Random(9)
    names = {" ".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(14)}
    rows = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))) for k in range(60)]
    out = texts.spotted(spark.createDataFrame(rows, "k int, t string"), spark.createDataFrame([(n,) for n in names], "name string"), "k", "t", "name").collect()
    got = {}
    for r in out:
        got.setdefault(r["k"], []).append((r["at"], r["name"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: s for k, t in rows if (s := greedy_spans(t.split(), names))}


def test_spotted_in_a_long_text(spark):
    """40,000 hits in one text: time in proportion."""
    body = "red dragon sleeps " * 20_000
    out = texts.spotted(spark.createDataFrame([(1, body)], "k int, t string"), spark.createDataFrame([("red dragon",), ("dragon",), ("sleeps",)], "name string"), "k", "t", "name")
    assert {r["name"]: r["n"] for r in out.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()} == {"red dragon": 20_000, "sleeps": 20_000}


def test_sitemaps_keep_each_change_with_its_location(spark):
    xml = "<urlset><url><loc> a?x=1&amp;y=&lt;2&gt; </loc></url><url>\n<loc>b</loc><lastmod>2024-01-02</lastmod></url><url><lastmod>2024-01-03</lastmod></url></urlset>"
    other = '<s:sitemapindex xmlns:s="x"><s:sitemap><s:loc>c&amp;amp;</s:loc><s:lastmod>d</s:lastmod></s:sitemap></s:sitemapindex>'
    df = spark.createDataFrame([(1, xml), (2, other), (3, ""), (4, None)], "k int, x string").select("k", jsonlines.sitemap(F.col("x")).alias("s"))
    got = {r["k"]: [tuple(x) for x in r["s"]] if r["s"] is not None else None for r in df.collect()}
    assert got == {1: [("a?x=1&y=<2>", None), ("b", "2024-01-02")], 2: [("c&amp;", "d")], 3: [], 4: None}


FRAME = b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 5, 6) + b"\0" * 8


@pytest.mark.parametrize(
    ("data", "want"),
    [
        (b"\xff\xd8" + b"\x00\x12stray" + FRAME, (6, 5)),
        (b"\xff\xd8\xff\xe0\x00\x04ab" + b"z" * 5 + b"\xff\xff" + FRAME, (6, 5)),
        (b"\xff\xd8" + b"\x0f\xf0" * 50_000 + FRAME, (6, 5)),
        (b"\xff\xd8" + b"stray only" * 10, None),
        (b"\xff\xd8" + b"\xff\xd9" + FRAME, None),
        (b"\xff\xd8" + (b"\xff\xe1\xff\xff" + b"z" * 65533) * 20 + FRAME, (6, 5)),
    ],
)
def test_jpeg_sizes_pass_over_stray_bytes(spark, data, want):
    got = spark.createDataFrame([(bytearray(data),)], "x binary").select(images.image_size(F.col("x")).alias("s")).first()["s"]
    assert (tuple(got) if got else None) == want


def test_candidates_under_their_catalog_names(spark):
    rates = spark.createDataFrame([("k", "a", 0.5), ("k", "a2", 0.7), ("k", "b", 0.1), ("k", "none", 0.9), ("l", "b", 0.2)], "k string, slug string, rate double")
    known = spark.createDataFrame([("a", "A"), ("a2", "A"), ("b", "B")], "slug string, name string")
    leads = spark.createDataFrame([("k", "B")], "k string, name string")
    assert sorted(map(tuple, guides.resolved(rates, known, leads, "k", "slug").collect())) == [("k", "A", 0.7), ("l", "B", 0.2)]

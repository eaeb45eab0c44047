"""License scans against plain scans of every place and plain alignments of whole texts."""

import random
import re

import pytest

from gleaner.llm import licenses
from gleaner.llm.licenses import NOTICES, PHRASES, Template
from gleaner.llm.queries import op13_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text):
    w, found = words(text), []
    for t in PHRASES:
        p = words(t.words)
        found += [(i, t.label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return (len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found})))


def distance(a, b):
    """Fewest words changed, left out or put in to make b from a."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


BASE = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def test_copies_have_the_fewest_edits():
    rng = random.Random(5)
    for _ in range(200):
        t = [rng.choice("abcd") for _ in range(rng.randint(3, 8))]
        x = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        edits = rng.randint(0, 2)
        least = min(distance(t, x[i:j]) for i in range(len(x) + 1) for j in range(i, len(x) + 1))
        got = licenses.copies(t, x, edits)
        assert bool(got) == (least <= edits and len(x) >= len(t) - edits)
        assert all(distance(t, x[a:b]) == e <= edits for a, b, e in got)
        assert all(p[1] <= q[0] for p, q in zip(got, got[1:]))
        if got:
            assert min(e for *_, e in got) == least


def test_many_copies_in_one_long_text():
    """600,000 words of one notice: time in proportion."""
    w = [x.encode() for x in words(NOTICES[0].words)]
    assert licenses.copies(w, w * 8000, 5) == [(i * len(w), (i + 1) * len(w), 0) for i in range(8000)]


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        i = rng.randrange(len(w))
        kind = rng.randrange(3)
        w[i : i + 1] = [] if kind == 0 else [f"x{rng.randrange(99)}"] if kind == 1 else [w[i], f"x{rng.randrange(99)}"]
    return w


@pytest.mark.parametrize("most", [licenses.MOST_POSITIONS, 0])
def test_edited_notices_are_found(spark, most):
    """Every notice with as many edits as are allowed is found where it stands, with no more edits than were made; with one
    part in three changed it is not, and prose has none. Both with broadcast templates and by a shuffle."""
    rng = random.Random(11)
    prose = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows, planted = [], {}
    for n, x in enumerate(NOTICES):
        w = words(x.words)
        e = int(0.2 * len(w) + 1e-9)
        before, copy = prose(rng.randint(0, 50)), edited(rng, w, e)
        rows.append((n, " ".join(before + copy + prose(30)).upper()))
        planted[n] = (x.label, len(before), len(before) + len(copy), 1 - e / len(w))
        rows.append((100 + n, " ".join(prose(20) + [f"z{i}" if i % 3 == 1 else y for i, y in enumerate(w)] + prose(20))))
    rows += [(1000, " ".join(prose(4000))), (1001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["spans"] for r in licenses.license_spans(docs, most_positions=most).collect()}
    assert len(got) == len(rows)
    for n, (label, a, b, s) in planted.items():
        mine = [x for x in got[n] if not x["exact"] and x["start"] < b and x["end"] > a]
        assert mine and max(x["similarity"] for x in mine) >= s - 1e-9, (n, label, mine)
    assert all(not [x for x in got[d] if not x["exact"]] for d in got if d >= 100)


def test_spans_equal_a_scan_of_whole_texts(spark):
    """Votes and merged diagonals lose nothing that an alignment of the whole text finds."""
    rng = random.Random(3)
    t = (Template("one", "alpha beta gamma delta epsilon zeta eta theta iota kappa", False), Template("two", "beta gamma delta", True))
    w = words(t[0].words)
    rows = []
    for n in range(150):
        out = []
        for _ in range(rng.randint(0, 4)):
            out += [rng.choice(["q", "r", *w]) for _ in range(rng.randint(0, 12))] + edited(rng, w, rng.randint(0, 4))
        rows.append((n, " ".join(out)))
    got = {r["doc_id"]: r["spans"] for r in licenses.license_spans(spark.createDataFrame(rows, "doc_id long, text string"), templates=t).collect()}
    for n, text in rows:
        x = text.split()
        assert [(s["start"], s["end"]) for s in got[n] if s["exact"]] == [(i, i + 3) for i in range(len(x) - 2) if x[i : i + 3] == w[1:4]]
        whole = licenses.copies(w, x, 2)
        mine = [(s["start"], s["end"], round((1 - s["similarity"]) * 10)) for s in got[n] if not s["exact"]]
        assert min((e for *_, e in mine), default=None) == min((e for *_, e in whole), default=None)
        assert all(distance(w, x[a:b]) == e for a, b, e in mine)


def test_best_of_overlapping_labels():
    a, b, c = ("gpl-2", False, 0, 10, 0.9), ("gpl-3", False, 2, 12, 1.0), ("mit", True, 3, 7, 1.0)
    assert licenses.best_of([a, b, c]) == [b, c]
    assert licenses.best_of([a, ("isc", False, 10, 20, 0.9), a]) == [a, ("isc", False, 10, 20, 0.9)]


def test_report_on_awkward_rows(spark, docs, world, empty):
    got = sorted(((r[0] is None, r[0] or 0), *(repr(x) for x in r[1:])) for r in licenses.report(docs).select("doc_id", *BASE).collect())
    assert got == sorted(((r[0] is None, r[0] or 0), *(repr(x) for x in brute_base(r[1]))) for r in world)
    assert licenses.report(empty).count() == 0


def test_phrases_repeat_overlap_and_fold(spark):
    long = "cc BY-NC " * 200_000
    rows = [(1, "Released under the MIT License. Under the mit license"), (1, "Released under the MIT License."), (2, "Apache License, Version 2.0"), (3, "cc by nc by nc cc by nc"), (4, None), (5, "under the MIT licenseé"), (6, long), (None, "under the mit license")]
    got = [tuple(r[c] for c in ("doc_id", *BASE, "labels", "score")) for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(d, *brute_base(t), (b := brute_base(t))[4], 1.0 if b[1] else 0.0) for d, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert (6, 600_000, 200_000, 0, 599_997, "cc-by-nc", "cc-by-nc", 1.0) in got


def test_short_templates_are_refused(spark, docs):
    with pytest.raises(ValueError):
        licenses.license_spans(docs, templates=(Template("x", "two words", True),))


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in op13_license_scan(spark, sf_dir).collect()}
    assert {d: tuple(r[c] for c in BASE) for d, r in rows.items()} == {d: brute_base(t) for d, t in texts.items()}
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows.values())

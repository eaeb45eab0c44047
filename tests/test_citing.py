"""Citations, sentences, primers and links at their edges."""

import pytest
from pyspark.sql import functions as F

from gleaner.operators import citing


def one(spark, ddl, row, column):
    return spark.createDataFrame([row], ddl).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "links", "want"),
    [
        ("Archive Profile: Chandra", ["Archive", "Profile: Chandra"], True), ("1 | 2 | 3", ["1", "2", "3"], True), ("See Archive", ["Archive"], False), ("a a", ["a"], False), ("a a", ["a", "a"], True),
        ("", [], False), ("· — ", ["x"], False), (" , ", [""], True), (None, ["a"], None),
    ],
)
def test_link_only(spark, text, links, want):
    assert one(spark, "t string, l array<string>", (text, links), citing.link_only(F.col("t"), F.col("l"))) == want


@pytest.mark.parametrize(("text", "want"), [(" a b ", "a b."), ("a!", "a!"), ("“a”", "“a”"), ("(a)", "(a)"), ("", ""), ("\n", ""), ("a,", "a,."), (None, None)])
def test_sentence(spark, text, want):
    assert one(spark, "t string", (text,), citing.sentence(F.col("t"))) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("[[A]] and [[B]]", "[[A]] and [B]"), ("[[A", "[A"), ("x ]] [[A]]", "x ] [[A]]"), ("[[A\nB]]", "[A\nB]"), ("plain", "plain"), ("", ""), ("[[[A]]]", "[[[A]]]")],
)
def test_primer(spark, text, want):
    assert one(spark, "t string", (text,), citing.primer(F.col("t"), F.array(F.lit("A")))) == want


def test_chosen_link(spark):
    choose = lambda *links: one(spark, "l array<string>", (list(links),), citing.chosen_link(F.col("l"), "m.example.com", ".txt", "rules"))
    assert choose() is None and choose("https://m.example.com/a.txt.html", "ftp://m.example.com/a.txt") is None
    assert choose("https://m.example.com/a b.TXT ", "https://m.example.com/Rules.txt#x") == "https://m.example.com/Rules.txt#x"
    assert choose("https://m.example.com/a b.TXT ") == "https://m.example.com/a%20b.TXT"


def test_first_tagged(spark):
    rows = [("p", 0, "x", 0, "a", 1, 10, 0.1), ("p", 1, "y", 0, "b", 5, 0, None), ("p", 1, "y", 1, "c", 1, 3, None), ("p", 2, "y", 0, "d", 1, 8, None), ("q", 0, "x", 0, "e", 1, 3, None), ("r", 0, "z", 0, "f", 1, 3, None)]
    out = citing.first_tagged(spark.createDataFrame(rows, "k string, list int, tag string, pos int, name string, decks long, of_decks long, synergy double"), "k", ["y", "x"], 2)
    # of two lists with one tag the later one counts
    assert sorted((r["k"], r["pos"], r["name"], r["share"]) for r in out.collect()) == [("p", 0, "d", 12.5), ("q", 0, "e", 33.3)]


def test_column_names(spark):
    name = lambda url: one(spark, "u string", (url,), citing.column_name(F.col("u"), {"fr": "F", "feature": "X"}, "none"))
    assert [name(u) for u in ("http://a/FR/1", "http://a?c=feature", "http://a/feature-2004-x", "http://a/france", "http://a/features")] == ["F", "X", "X", "none", "none"]

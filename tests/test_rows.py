"""Cases that a binding does not show: headers, embedded values, quotes, merge plans, guards and settings."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from gleaner import session
from gleaner.functions import numbers
from gleaner.operators import checks, graph, lexicon, merging, state, tagging, texts
from gleaner.sources import images, jsonlines


def one(spark, value, kind, *columns):
    return tuple(spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first())


def webp(kind, rest):
    return b"RIFF\0\0\0\0WEBP" + kind + rest


SIZES = [
    (b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 30, 20), (30, 20)),
    (b"GIF87a" + struct.pack("<HH", 700, 9), (700, 9)),
    (b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 5, 6) + b"\0" * 8, (6, 5)),
    (b"\xff\xd8\xff\xff\xff\xe1\x00\x02\xff\x01\xff\xd0\xff\xff\xc2\x00\x0b\x08" + struct.pack(">HH", 513, 1025) + b"\0" * 8, (1025, 513)),  # bytes that fill, markers without a segment
    (b"\xff\xd8\xff\xc4\x00\x04ab\xff\xcc\x00\x02\xff\xc8\x00\x02\xff\xcf\x00\x0b\x08" + struct.pack(">HH", 1, 2), (2, 1)),
    (b"\xff\xd8" + (b"\xff\xe1\xff\xff" + b"z" * 65533) * 3 + b"\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 5, 6), (6, 5)),
    (b"\xff\xd8\xff\xda\x00\x02\xff\xc0\x00\x0b\x08\0\5\0\6", None),
    (b"\xff\xd8\xff\xe0\x00\x00\xff\xc0\x00\x0b\x08\0\5\0\6", None),
    (b"\xff\xd8\xff", None),
    (webp(b"VP8X", b"\0" * 8 + (9).to_bytes(3, "little") + (70000).to_bytes(3, "little")), (10, 70001)),
    (webp(b"VP8L", b"\0" * 4 + b"\x2f" + ((100 - 1) | (200 - 1) << 14).to_bytes(4, "little")), (100, 200)),
    (webp(b"VP8L", b"\0" * 4 + b"\x2f" + ((16384 - 1) | (16384 - 1) << 14 | 0xF << 28).to_bytes(4, "little")), (16384, 16384)),
    (webp(b"VP8 ", b"\0" * 10 + struct.pack("<HH", 0xC000 | 320, 240)), (320, 240)),
    (b"nope", None),
    (b"", None),
    (None, None),
    (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR\0\0", None),
]


def test_image_sizes(spark):
    got = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, (b, _) in enumerate(SIZES)], "i int, b binary").select("i", images.image_size(F.col("b")).alias("s")).collect()
    assert {r["i"]: tuple(r["s"]) if r["s"] else None for r in got} == {i: want for i, (_, want) in enumerate(SIZES)}


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('x = {"k": 1}; y = {"k": 2};', 1),
        ('x = {"k": 3, "t": "a};b"};', 3),
        ('x =\n{"t": {"u": ["}", "\\"]"]},\n "k": 4}\n', 4),
        ('x = {"k": 5', None),
        ("no marker", None),
        (None, None),
    ],
)
def test_embedded_values(spark, page, want):
    assert one(spark, page, "string", jsonlines.embedded(F.col("x"), "x =", "k int")["k"]) == (want,)


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ('{"k": "x\\"y"}', ['x"y']),
        ('{"a": "k", "b": [{"k": 1}, {"k": "\\u00e9"}], "c": {"k": 1}}', ["1", "é"]),
        ('{"t": "\\"k\\": 9", "k": null, "kk": 2}', []),
        ('["k", "v"]', []),
        ("", []),
        (None, None),
    ],
)
def test_values_of_a_key(spark, body, want):
    assert one(spark, body, "string", texts.key_values(F.col("x"), "k")) == (want,)


def test_quotes_stand_on_words(spark):
    says = ["She saw the red dragon, at dawn.", "Then “she heard” it - and “The  Red Dragon” came…", "the red dragonfly", "Ünder the red dragon\\E."]
    paragraphs = spark.createDataFrame([("p", i, t) for i, t in enumerate(says)], "page string, index int, text string")
    claims = [("the red dragon", 5), ("the red dragon", 1), ("THE RED  DRAGON.", 2), ("he heard it", 0), ("she heard” it", 0), ("dragonfly", None), ("nder the red", 0), ("the red dragon\\E.", 0), ("red", 0), (None, 0)]
    c = spark.createDataFrame([(i, "p", q, h) for i, (q, h) in enumerate(claims)], "id int, page string, quote string, hint int")
    got = {r["id"]: r["paragraph"] for r in checks.located(c, paragraphs, "page", "id", "quote", "hint").collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: None, 4: 1, 5: 2, 6: None, 7: 3, 8: None, 9: None}


def test_answers(spark):
    body = "One [F1]. Two has none. Three [F2][F9]!\n\nFour said \"so.\" Five [F2]?\n\nloose"
    df = spark.createDataFrame([("a", body, ["F1", "F2"]), ("b", "", ["F1"]), ("c", None, None)], "k string, t string, l array<string>")
    got = {(r["k"], r["block"]): ([(s["sentence"], list(s["cites"])) for s in r["sentences"]], r["dropped"]) for r in checks.answer_sentences(df, "k", "t", "l").collect()}
    assert got[("a", 0)] == ([("One.", ["F1"])], 2) and got[("a", 1)] == ([("Five?", ["F2"])], 1) and got[("a", 2)] == ([], 1) and got[("b", 0)] == ([], 0)


def settle(spark, sizes, scores=(), previous=(), apart=(), always=()):
    frame = lambda rows, ddl: spark.createDataFrame([("g", *r) for r in rows], f"group string, {ddl}")
    out = merging.planned(frame([(x, [n, 0]) for x, n in sizes.items()], "id string, decks array<long>"), frame([(a, b, s, 30) for a, b, s in scores], "a string, b string, score double, days int"), frame(previous, "id string, leader string"), frame(apart, "a string, b string"), frame(always, "rule string, id string"))
    return {r["id"]: (r["leader"], r["how"]) for r in out.collect()}


def test_merge_plan(spark):
    sizes = {"a": 100, "b": 80, "c": 60}
    lead = ("a", "leads")
    assert settle(spark, sizes, [("a", "b", 0.8), ("a", "c", 0.79)]) == {"a": lead, "b": ("a", "joined"), "c": ("c", "leads")}
    assert settle(spark, sizes, [("a", "c", 0.9), ("b", "c", 0.9)]) == {"a": lead, "b": ("b", "leads"), "c": ("a", "joined")}  # the bigger of equals
    assert settle(spark, sizes, [("a", "b", 0.9), ("b", "c", 0.95)]) == {"a": lead, "b": ("a", "joined"), "c": ("c", "leads")}  # no chains
    assert settle(spark, sizes, [("a", "b", 0.75)], previous=[("b", "a")]) == {"a": lead, "b": ("a", "kept"), "c": ("c", "leads")}
    assert settle(spark, sizes, [("a", "b", 0.74)], previous=[("b", "a")])["b"] == ("b", "leads")
    assert settle(spark, {"a": 120, "b": 100}, [("a", "b", 0.8)], previous=[("a", "b")]) == {"a": ("b", "joined"), "b": ("b", "leads")}  # 1.2 times is not more
    assert settle(spark, {"a": 121, "b": 100}, [("a", "b", 0.8)], previous=[("a", "b")]) == {"a": lead, "b": ("a", "joined")}
    assert settle(spark, sizes, [("a", "b", 0.95)], apart=[("b", "a")])["b"] == ("b", "leads")
    assert settle(spark, sizes, [("a", "b", 0.9), ("b", "c", 0.9), ("a", "c", 0.9)], apart=[("b", "c")]) == {"a": lead, "b": ("a", "joined"), "c": ("c", "leads")}  # apart from any member
    assert settle(spark, sizes, always=[("r", "a"), ("r", "c")]) == {"a": lead, "b": ("b", "leads"), "c": ("a", "forced")}
    assert settle(spark, sizes, always=[("r", "a"), ("r", "c")], apart=[("a", "c")])["c"] == ("c", "leads")
    assert settle(spark, sizes, [("a", "b", 0.9)], previous=[("b", "gone")])["b"] == ("a", "joined")
    assert settle(spark, {}) == {}


def test_half_even_rounds_exact_values(spark):
    rng = random.Random(2)
    values = [2.675, 1.115, 1.005, 0.285, 2.5, 3.5, -2.5, -1.115, 0.125, 1e300, 0.0, *(round(rng.uniform(-50, 50), 3) + 0.0005 for _ in range(2000)), *(rng.randint(-4000, 4000) / 8 for _ in range(500))]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", numbers.half_even(2)(F.col("v")).alias("a"), numbers.half_even(0)(F.col("v")).alias("b")).collect()
    assert all(r["a"] == round(values[r["i"]], 2) and r["b"] == round(values[r["i"]], 0) for r in got)
    assert one(spark, None, "double", numbers.half_even(1)(F.col("x"))) == (None,)


def test_long_names_are_prefixes(spark):
    names = spark.createDataFrame([("n" * 40,), ("n",), ("",), (None,)], "name string")
    rows = spark.createDataFrame([("n" * 41,), ("n" * 39,), ("x",), ("",), (None,)], "t string")
    assert sorted(map(str, (r["name"] for r in texts.longest_prefix(rows, names, "t", "name").collect()))) == sorted(["n" * 40, "n", "None", "None", "None"])


def test_deep_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["label"] for r in graph.min_label(spark, chain, "a", "b").collect()} == {0}


def test_tags_of_names(spark):
    df = spark.createDataFrame([("Modernist ÉPauper standard", None), (None, "CommandFest"), ("Two-Headed Draft!", "x"), (None, None)], "name string, kind string")
    assert [r[0] for r in df.select(tagging.name_tags(F.col("name"), F.col("kind"))).collect()] == [["Standard"], ["Commander"], ["Limited"], []]
    assert [r[0] for r in df.select(tagging.region(F.col("name"))).collect()] == [None] * 4


def test_roles_of_nothing(spark):
    assert one(spark, None, "string", lexicon.role(F.col("x"), F.col("x")), lexicon.win_of(F.array("x")), F.size(lexicon.outlets(F.col("x"), F.col("x")))) == ("utility", None, 0)


def test_guards(spark):
    rows = spark.createDataFrame([(i, i < 2) for i in range(100)], "i int, failed boolean")
    assert state.guarded(rows, "failed").count() == 98
    with pytest.raises(ValueError, match="more than 2%"):
        state.guarded(rows.where("i < 99"), "failed")
    assert state.ratio_guard(rows.limit(0), "failed").first()["fine"]
    with pytest.raises(ValueError):
        state.fresh_or_saved(lambda: rows.limit(0), lambda: rows.limit(0))


def test_settings_and_scratch(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with session.setting(spark, name, "77"):
        assert spark.conf.get(name) == "77"
    assert spark.conf.get(name) == before
    with session.scratch(spark):
        kept = session.written(spark.range(3))
        assert kept.count() == 3
    with pytest.raises(Exception):
        kept.count()


def test_no_shared_folder_on_a_cluster_is_an_error(spark):
    class Conf:
        def get(self, name, default=None):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077", "applicationId": "app"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())

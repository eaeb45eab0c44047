"""The secret scan against plain Python with its own patterns: all spans, long and awkward texts."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import pytest

from gleaner.llm import secrets

BASE = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]
ADDED = [(re.compile("[0-9A-Fa-f]{20,}"), 3.0), (re.compile("[A-Za-z0-9+/_-]{20,}={0,2}"), 3.9)]


def window_entropy(s):
    return max(-sum(c / 20 * math.log2(c / 20) for c in Counter(s[i : i + 20]).values()) for i in range(len(s) - 19))


def harmless(s):
    plain = s.isdigit() or (s[0].isalpha() and all(c.isalpha() or c in "-_/+" for c in s))
    return plain or any(w in s.lower() for w in ("example", "sample", "dummy", "placeholder", "xxxx"))


def brute(text):
    found = [(m.start(), k, m.end()) for k, (_, p, good) in enumerate(BASE) for m in p.finditer(text) if good(m)]
    taken, added = list(found), []
    for p, least in ADDED:
        new = [m for m in p.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e in taken) and not harmless(m[0]) and window_entropy(m[0]) >= least - 1e-9]
        taken += [(m.start(), 3, m.end()) for m in new]
        added += [(m.start(), 3, m.end()) for m in new]
    told = lambda x: ",".join(f"{('assign', 'access', 'hex', 'entropy')[k]}:{s}:{e}" for s, k, e in sorted(x))
    kinds = Counter(k for _, k, _ in found)
    return (kinds[0], kinds[1], kinds[2], hashlib.sha256(told(found).encode()).hexdigest(), told(taken), len(added))


PARTS = [
    "token", "Secret", "api_key", "APIKEY", "passwd", "PassWord", "AKIA", "akia", "=", ":", " ", "  ", '"', "'", "-", "_", "/", "+", ".", "\n", "é", "ſ", "K", "", "中", "example", "xxxx", "==", "0", "12345", "hunter2x",
    "ABCDEFGHIJKLMNOPQRSTU", "0123456789abcdef0123456789", "A1B2C3D4E5F60718A9BACB", "fQ8zR2xLpW9sVbN4tKc7YdJ3", "aaaaaaaaaaaaaaaaaaaaaaaaa", "abcabcabcabcabcabcabcabc", "some-words-of-a-long-path", "9" * 30,
]


def check(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in secrets.report(rows).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute(t or ""), (t or "")[:200]
    return rows


def test_all_spans_of_random_texts(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    rows = check(spark, [*texts, None, ""])
    masked = {r["doc_id"]: r["text"] for r in secrets.masked(rows).collect()}
    for i, t in enumerate(texts):
        spans = sorted(tuple(map(int, x.split(":")[1:])) for x in brute(t)[4].split(",") if x)
        out, at, end = "", 0, -1
        for s, e in spans:
            if s > end:
                out += t[at:s] + "[secret]"
            at = end = max(at, e)
        assert masked[i] == out + t[at:]


def test_long_texts_in_little_time(spark):
    """Texts that a pattern repeating a group, or a fold that copies, can't do."""
    rng = random.Random(5)
    size, digits, letters = 250_000, "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    some = lambda of, n: "".join(rng.choice(of) for _ in range(n))
    texts = [
        "ab-" * (size // 3) + "1", "-" * size, "g" * size, "token" + " " * size, "token=" + "a." * (size // 2), some(letters, size),
        " ".join(some(digits, 31) for _ in range(size // 32)), " ".join(some(digits, 21) for _ in range(size // 22)), "\n".join(f"token=ab{i:06}" for i in range(size // 15)),
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.monotonic()
    got = {r["doc_id"]: tuple(r)[1:] for r in secrets.report(rows).collect()}
    assert time.monotonic() - began < 120
    for i in (0, 1, 2, 3, 4, 7):
        assert got[i] == brute(texts[i])
    assert got[5][5] == 1 and got[6][2] == size // 32 and got[8][0] == size // 15


@pytest.mark.parametrize("n", [511, 512, 513, 1100])
def test_offsets_across_blocks(spark, n):
    check(spark, [" ".join(f"é token=ab{i:06}" for i in range(n))])


def test_equals_sql(spark, unique, unique_docs, same):
    import duckdb

    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in unique])
    want, got = con.sql(secrets.SQL), secrets.report(unique_docs)
    assert same(got.columns, got.collect()) == same(want.columns, want.fetchall())

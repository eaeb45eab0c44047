"""Texts of megabytes in every operator: right results, and no text that ends a query."""

import pytest
from pyspark.sql import functions as F

from gleaner.llm import tokencounts

MEGA = 2_000_000
RUNS = {
    "blanks": " " * MEGA,
    "line ends": "\n" * MEGA,
    "blanks before a letter": "a" + " " * MEGA + "b c",
    "line ends before a letter": "a" + "\n" * MEGA + "b  c",
    "wide blanks": "x" + " " * (MEGA // 4) + "!",
    "two runs": "a b" + " " * 60_000 + "c\t" + "\t" * 60_000 + "1\n",
    "at the bound": "a" + " " * tokencounts.LONG + "b" + " " * (tokencounts.LONG - 1) + "c" + " " * (tokencounts.LONG + 1) + "d",
    "one letter": "a" * MEGA,
}


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", RUNS)
def test_ids_of_long_runs_equal_the_library(name, library):
    offsets = tokencounts.Offsets(None)
    ids = offsets.ids(RUNS[name])
    assert ids.tolist() == library.encode(RUNS[name], add_special_tokens=False).ids
    assert offsets.length[ids].sum() == len(RUNS[name].encode())


def test_long_runs_in_the_query(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(RUNS.values())] + [(99, None)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in tokencounts.report(docs).collect()}
    assert len(got) == len(RUNS) + 1 and got[99]["n_tokens"] == 0
    assert all(sum(map(int, r["section_tokens"].split(","))) == r["n_tokens"] for r in got.values())


def small_model(k, seed=1):
    import numpy as np

    from gleaner.llm import langid

    rng = np.random.default_rng(seed)
    labels = [f"l{i:02}" for i in range(k)]
    return langid.Model(labels, rng.normal(0, 1, (langid.buckets_of(k), k)).astype(np.float32), rng.normal(0, 1, (k, k)), {}, np.zeros((k, k)))


@pytest.mark.parametrize("k,step", [(1, 7), (3, 1), (4, 32), (4, 1000), (20, 130)])
def test_slices_of_a_text_equal_the_whole(k, step):
    """Marginals carried over slices are those of one pass, for slices of one word, of a block and of more."""
    import numpy as np

    from gleaner.llm import langid

    rng = np.random.default_rng(k)
    scores, trans = rng.normal(0, 3, (401, k)), rng.normal(0, 2, (k, k))
    whole, _ = langid.marginals(scores, np.array([401]), trans)
    got = np.full_like(whole, np.nan)
    for s, post in langid.by_slices(lambda a, b: scores[a:b], 401, trans, step):
        got[s : s + len(post)] = post
    assert np.allclose(got, whole, atol=1e-9)


def test_long_texts_are_labelled_as_short_ones(monkeypatch):
    """The same labels whether a text is one slice or many, with words seen before and not, and none if it has no letter."""
    import numpy as np

    from gleaner.llm import langid

    model = small_model(5)
    text = " ".join(f"w{chr(97 + i % 26)}{'xyz'[i % 3] * (i % 7)}" for i in range(5000))
    (n, mean, best), = langid.Labeller(model)([text])
    monkeypatch.setattr(langid, "SLICE", 100)
    monkeypatch.setattr(langid, "LONG_WORDS", 64)
    labeller = langid.Labeller(model)
    labeller(["other words first"])
    (m, long_mean, long_best), = labeller([text])
    assert n == m and np.allclose(mean, long_mean, atol=1e-5) and (best == long_best).mean() > 0.999
    assert labeller(["1 2 3 " * 100])[0][0] == 0 and labeller([text])[0][0] == n


def test_ten_megabytes_at_seventy_labels_in_bounded_memory():
    """The worker's peak for one text of 10 MB."""
    import subprocess
    import sys

    code = """
import resource, sys
sys.path[:0] = [%r, %r]
from test_long_texts import small_model
from gleaner.llm import langid
text = " ".join(f"{chr(97 + i %% 26)}{chr(97 + i // 26 %% 26)}{chr(97 + i // 676 %% 26)}{'ab' * (i %% 3)}" for i in range(1_900_000))
assert len(text) > 9_000_000
(n, mean, best), = langid.Labeller(small_model(70))([text])
assert n == 1_900_000 and abs(mean.sum() - 1) < 1e-6
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
""" % (str(__file__).rsplit("/tests/", 1)[0], str(__file__).rsplit("/", 1)[0])
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout) < 1500


def test_many_languages_are_all_learned(spark):
    """The sample has every one of 230 languages, and twenty labels beyond a machine word are told apart."""
    import random

    from gleaner.llm import langid

    rng = random.Random(3)
    own = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(4)] for _ in range(230)]
    rows = [(i * 10 + j, " ".join(rng.choices(own[i], k=12)), f"lang{i:03}") for i in range(230) for j in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.sample(docs, key="doc_id", text="text", lang="lang", where=F.lit(True), most_docs=4, most_langs=None)
    assert len({lang for _, lang in found}) == 230
    model = langid.train([x for x in found if x[1] >= "lang210"])
    assert len(model.labels) == 20
    labeller = langid.Labeller(model)
    told = [(x[1], model.labels[int(mean.argmax())]) for x in found if x[1] >= "lang210" for _, mean, _ in labeller([" ".join(x[0])])]
    assert sum(a == b for a, b in told) > 0.95 * len(told)
    assert [langid.buckets_of(k) for k in (1, 64, 65, 200, 1000)] == [1 << 17, 1 << 17, 1 << 16, 1 << 15, 1 << 13]

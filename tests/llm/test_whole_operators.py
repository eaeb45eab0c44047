"""Operators do the whole of their job: cases that a cut would lose."""

import hashlib

import numpy as np
import pytest

from gleaner.llm import decontaminate, langid, neardup, pieces, quality, suffixes, wavelet



def brute_spans(rows):
    seen, out = set(), {}
    for d, text, *_ in sorted(rows):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


SCHEMA = "doc_id long, text string, lang string, source string"


def lined(n, same):
    """60 words in 20 lines, of which same repeat the first."""
    lines = [f"a{n:03}x{i:02} b{n:03}x{i:02} c{n:03}x{i:02}" for i in range(20 - same)]
    return "\n".join(lines + lines[:1] * same)


def test_fences_follow_each_source(spark):
    """Six of 20 lines repeated: usual in one source, far out in the other."""
    rows = [(i, lined(i, 0), "en", "plain") for i in range(60)] + [(100 + i, lined(100 + i, 2 + i % 5), "en", "lists") for i in range(60)]
    rows += [(200, lined(200, 6), "en", "plain"), (201, lined(201, 6), "en", "lists"), (202, lined(202, 1), "en", "plain")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"]: r["kept"] for r in quality.report(docs, prior=10).collect()}
    assert (kept[200], kept[201], kept[202]) == (False, True, True)
    assert all(kept[i] for i in [*range(60), *range(100, 160)])


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_items_without_ids_are_hits(spark, most):
    """A null id costs only the entry in items, also where the set is too large for a broadcast."""
    bench = spark.createDataFrame([(None, "alpha beta gamma"), (1, "delta epsilon"), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha beta gamma y"), (2, "alpha beta gamma delta epsilon"), (3, "clean words"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.report(docs, bench, most_windows=most, unnamed=True).collect()}
    assert got == {1: (3, 0, True), 2: (5, 1, True), 3: (0, 0, False), 4: (0, 0, False)}
    assert {r[0] for r in decontaminate.drop_contaminated(docs, bench, most_windows=most, unnamed=True).select("doc_id").collect()} == {3, 4}
    assert decontaminate.cut_spans(docs, bench, most_windows=most, unnamed=True).where("text rlike 'alpha'").count() == 0


def test_long_runs_are_labelled_to_their_end():
    run = "a" * 100 + "b" * 100
    assert "".join(langid.words_of(run)) == run and max(map(len, langid.words_of(run))) == 60
    ends = [set(langid.features(langid.words_of(run[:100] + x * 100))[0].tolist()) for x in "bc"]
    assert ends[0] != ends[1]


@pytest.mark.parametrize("least", [64, 1])
def test_frequent_leaders_change_the_plan_only(spark, monkeypatch, least):
    """Boilerplate in all documents, with different bytes around it; where every leader counts as frequent, too."""
    import random

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    plate = word(330)
    rows = [(i, word(rng.randint(0, 150)) + plate[rng.randint(0, 60) :][: rng.randint(120, 330)] + word(rng.randint(0, 90)), "en", "s") for i in range(200)]
    monkeypatch.setattr(suffixes, "SAMPLED", 1)
    monkeypatch.setattr(suffixes, "FREQUENT", least)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert len(suffixes._frequent(docs.selectExpr("doc_id d", "text t")).value) > 0
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.report(docs).collect()}
    assert got == brute_spans(rows)


def test_many_languages(spark):
    """More languages than fit one block's matrices: each is learned, also one that is rare."""
    import random

    rng = random.Random(4)
    words = {f"l{k:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 8))) for _ in range(12)] for k in range(70)}
    rows = [(i, " ".join(rng.choice(w) for _ in range(40)), lang, "s") for i, (lang, w) in enumerate((x, w) for x, w in words.items() for _ in range(3 if x == "l69" else 6))]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(docs)
    assert len(model.value.labels) == 70
    got = langid.label(docs, model).selectExpr("lang", "_gl_lang").collect()
    assert sum(r["lang"] == r["_gl_lang"] for r in got) >= 0.98 * len(rows) and all(r["_gl_lang"] == "l69" for r in got if r["lang"] == "l69")
    assert len(langid.fit(docs, most_langs=3).value.labels) == 3


def test_large_vocabularies():
    ids = np.random.default_rng(3).integers(0, 70_000, 3000)
    ids[::9] = 69_999
    m = wavelet.WaveletMatrix.of(ids)
    assert len(m.planes) == 17 and (m.decode() == ids).all() and m.count(69_999) == (ids == 69_999).sum() and m.access(9) == 69_999
    assert m.select(69_999, 4) == np.flatnonzero(ids == 69_999)[4] and m.count(1 << 18) == 0


def test_pretokens_with_one_hash_are_told_apart(monkeypatch):
    """Where the first hash is the same for all, the second sends the batch to the library."""
    import pyarrow as pa

    plain = wavelet.spans.span_hash
    monkeypatch.setattr(wavelet.spans, "span_hash", lambda sums, a, b, kind: np.full(len(a), 7, np.uint64) if kind == "bytes" else plain(sums, a, b, kind))
    encode = wavelet.Encoder(None)
    texts = ["one two three", "three two", None, "four"]
    assert [x.tolist() for x in encode(pa.array(texts))] == [encode.lib.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("operator", [neardup.near_duplicates, wavelet.report, suffixes.report])
def test_keys_that_are_no_numbers_are_refused(spark, operator):
    with pytest.raises(TypeError, match="whole number"):
        operator(spark.createDataFrame([("a", "some text")], "doc_id string, text string"))


def test_units_without_pieces_take_linear_time():
    import time

    p = pieces.Pieces(pieces.default_model())
    text = "𓀀𓁐" * 60_000
    began = time.monotonic()
    ids = p.encode(text)
    assert time.monotonic() - began < 30 and p.decode(ids) == text and text not in p.cache


def test_lines_stage_keeps_columns_of_any_name(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a\nb\nc", "en", "s", 5, 77, [1]), (2, "x\na\nb\nc", "en", "s", 7, 78, None)], SCHEMA + ", n_chars long, _gl_lines long, _gl_gone array<int>")
    out = corpus_pipeline.lines(spark, docs, "").orderBy("doc_id")
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(1, "a\nb\nc", "en", "s", 5, 77, [1]), (2, "x", "en", "s", 1, 78, None)]


def test_report_of_language_id(spark, sf_dir):
    """held_out by the checksum of the id; the prediction is the label with the largest mean marginal of plain forward-backward."""
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in langid.report(docs).collect()}
    m = langid.fit(docs, where=langid.learnable()).value
    for r in docs.orderBy("n_chars").limit(60).collect():
        mine = got[r["doc_id"]]
        assert mine["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        words = langid.words_of(r["text"])
        if not words:
            assert (mine["lang_pred"], mine["score"]) == ("und", 0.0)
            continue
        scores = np.array([[sum(m.weights[b, y] for b in langid.features([w])[0]) + sum(m.lexicon_weights[z, y] for z in range(len(m.labels)) if m.lexicon.get(w, 0) >> z & 1) for y in range(len(m.labels))] for w in words])
        p, a, n = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -16, 0)), np.exp(np.clip(m.trans, -8, 8)), len(words)
        forward, backward = [np.full(len(a), 1 / len(a)) @ a * p[0]], [np.ones(len(a))]
        for t in range(1, n):
            forward.append(forward[-1] / forward[-1].sum() @ a * p[t])
            backward.insert(0, a @ (p[n - t] * backward[0] / backward[0].sum()))
        post = np.array(forward) * np.array(backward)
        mean = (post / post.sum(axis=1, keepdims=True)).mean(axis=0)
        assert mine["lang_pred"] == m.labels[int(mean.argmax())] and abs(mine["score"] - mean.max()) < 1e-3

"""The numbered operators against brute force on an awkward small corpus, and on an empty one."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, langid, linededup, neardup, pieces, quality, secrets, suffixes, tokencounts, wavelet

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = "[^\x20\x09-\x0d]+"


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def sets_of(rows, size):
    out = {}
    for d, text, *_ in rows:
        w = re.findall(SPACE, (text or "").translate(LOWER))
        out[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(unique, unique_docs, size):
    sets = sets_of(unique, size)
    group = {d: d for d in sets}
    for _ in sets:
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    group[a] = group[b] = min(group[a], group[b])
    got = by_id(neardup.near_duplicates(unique_docs, size=size))
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == {d: (len(s), group[d], group[d] == d) for d, s in sets.items()}
    kept = neardup.drop_near_duplicates(unique_docs, size=size)
    assert kept.columns == unique_docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d in sets if group[d] == d}


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    """A family whose members are linked in a chain only is one group, whatever the sizes of blocks."""
    base = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(f"k{k}x{i}" if (i // 4) % 16 == k % 16 and i < 4 * (k + 1) else w for i, w in enumerate(base)), "en", "s", 1) for k in range(14)]
    monkeypatch.setattr(neardup, "SIDE", 2)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = sets_of(rows, 2)
    group = {d: d for d in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert {d: r["component_id"] for d, r in by_id(neardup.near_duplicates(df, size=2)).items()} == group


def test_near_duplicates_null_and_repeated_ids(docs):
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]


def test_posterior_bounds_keep_true_pairs():
    least = neardup.least_matches(80)
    for k, m in enumerate(least):
        n = neardup.BATCH * (k + 1)
        tail = sum(math.comb(n, i) * 0.8**i * 0.2 ** (n - i) for i in range(m))
        assert tail < 1e-5 and m > 0 or m == 0


def test_line_dedup_equals_sql(unique, unique_docs, same):
    import duckdb

    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in unique])
    want = con.sql(linededup.SQL)
    got = linededup.report(unique_docs)
    assert same(got.columns, got.collect()) == same(want.columns, want.fetchall())
    texts = by_id(linededup.line_dedup(unique_docs))
    again = next(r for r in unique if (r[1] or "").startswith("x\nrepeat"))
    assert texts[again[0]]["text"] == "x\n\nfifth"


def test_line_dedup_ties_and_null_ids(docs):
    assert linededup.line_dedup(docs).count() == docs.count()


def phrases(items, size):
    out = defaultdict(set)
    for i, t in items:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
        k = min(size, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            out[tuple(w[j : j + k])].add(i)
    return out


ITEMS = [(10, "One two, three four five six seven eight nine TEN eleven"), (2, "changed"), (3, None), (4, "!!"), (10, "One two, three four five six seven eight nine TEN eleven")]


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_decontamination(spark, unique, unique_docs, most):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = by_id(decontaminate.report(unique_docs, bench, most_windows=most))
    wanted = phrases(ITEMS, 10)
    for d, text, *_ in unique:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        hit, items = set(), set()
        for p, owners in wanted.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j : j + len(p)]) == p:
                    hit.update(range(j, j + len(p)))
                    items |= owners
        r = got[d]
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (len(w), len(hit), len(items), digest, bool(hit))


def test_cut_and_drop_contaminated(spark, unique_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    cut = decontaminate.cut_spans(unique_docs, bench)
    assert cut.columns == unique_docs.columns and cut.count() == unique_docs.count()
    assert cut.where("text rlike 'three four|changed'").count() == 0 and cut.where("text rlike 'contaminated: '").count() == 1
    kept = decontaminate.drop_contaminated(unique_docs, bench)
    assert kept.count() == unique_docs.count() - 1 - unique_docs.where("text rlike 'changed'").count()


def test_language_id(docs, spark):
    rng = np.random.default_rng(3)
    words = {"aa": ["lala", "mano", "solo", "tuna"], "bb": ["krch", "strz", "brzk", "czsk"]}
    rows = [(i, " ".join(rng.choice(words[lang], 30)), lang) for i in range(60) for lang in [("aa", "bb")[i % 2]]]
    rows += [(100, "lala mano solo tuna lala mano krch strz brzk czsk krch strz", None), (101, None, "aa"), (102, "12 !", "aa"), (103, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = by_id(langid.label(df, model, words=True))
    assert all(got[i]["_gl_lang"] == rows[i][2] and 0.5 < got[i]["_gl_score"] <= 1 for i in range(60))
    assert got[100]["_gl_word_labels"] == ["aa"] * 6 + ["bb"] * 6
    assert all((got[i]["_gl_lang"], got[i]["_gl_score"]) == ("und", 0.0) for i in (101, 102, 103))
    assert langid.label(docs, model).columns[: len(docs.columns)] == docs.columns


def test_language_id_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.95


def test_marginals_equal_brute_force():
    rng = np.random.default_rng(5)
    lengths, k = np.array([1, 70, 33, 2]), 3
    s, trans = rng.normal(size=(lengths.sum(), k)), rng.normal(size=(k, k))
    post, pairs = langid.marginals(s, lengths, trans)
    a, at, expected = np.exp(trans), 0, np.zeros((k, k))
    for n in lengths:
        p = np.exp(s[at : at + n])
        fw, bw = [(np.full(k, 1 / k) @ a) * p[0]], [np.ones(k)]
        for t in range(1, n):
            fw.append((fw[-1] @ a) * p[t])
            fw[-1] /= fw[-1].sum()
        for t in range(n - 1, 0, -1):
            bw.insert(0, a @ (p[t] * bw[0]))
            bw[0] /= bw[0].sum()
        g = np.array(fw) * np.array(bw)
        assert np.allclose(post[at : at + n], g / g.sum(axis=1, keepdims=True))
        for t in range(n):
            x = (np.full(k, 1 / k) if t == 0 else fw[t - 1])[:, None] * a * (p[t] * bw[t])[None]
            expected += x / x.sum()
        at += n
    assert np.allclose(pairs, expected)


def plain_viterbi(p, s):
    best, back = [0.0] + [-math.inf] * len(s), [None] * (len(s) + 1)
    for e in range(1, len(s) + 1):
        options = [(b, *p.match.get(s[b:e])[1:], e - b) for b in range(e) if s[b:e] in p.match]
        if s[e - 1] not in p.single:
            options.append((e - 1, p.missing, -1, 1))
        for b, score, i, size in sorted(options, key=lambda o: (o[2] < 0, -o[3])):
            if best[b] + score > best[e]:
                best[e], back[e] = best[b] + score, (b, i)
    return best[-1]


def test_piece_encoding_is_optimal_and_reversible(unique_docs, unique):
    got = by_id(pieces.report(unique_docs))
    assert all(r["round_trip"] for r in got.values())
    p = pieces.Pieces(pieces.default_model())
    scores = {i: s for _, s, i in p.match.values()}
    for text in [r[1] for r in unique if r[1] and len(r[1]) < 900] + ["a▁b  ▁\n\t中😀é  x", "\r\n", " lead", "tail "]:
        ids = p.encode(text)
        assert p.decode(ids) == text
        flat = (" " + text).replace(" ", "▁")
        if not any(c in text for c in p.alone):
            total, missing = sum(scores.get(i, 0.0) for i in ids), [b for b in flat if b not in p.single]
            assert math.isclose(total + p.missing * len(missing), plain_viterbi(p, flat))
    row = next(r for r in unique if r[1] and len(r[1]) < 900)
    assert got[row[0]]["ids_crc32"] == zlib.crc32(np.array(p.encode(row[1]), "<u4").tobytes())
    back = pieces.decode(pieces.encode(unique_docs).drop("text"), ids=pieces.IDS)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {r[0]: r[1] or "" for r in unique}


def test_token_files(spark, unique, unique_docs, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = by_id(wavelet.report(unique_docs))
    at, every = 0, []
    for d, text, *_ in sorted(unique):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        assert tuple(got[d][c] for c in ("start", "n_tokens", "ids_crc32")) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        every += ids
    path = f"file://{tmp_path}/ids"
    wavelet.write(unique_docs, path)
    found = wavelet.occurrences(spark, path, 2, limit=3).collect()
    assert sum(r["n"] for r in found) == every.count(2)


def test_encoder_equals_library():
    import random

    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    lib, rng = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), random.Random(5)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", "m", "a", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "1", "²", ".", "中", "<|endoftext|>", "'s", "×", "　"]
    texts = ["".join(rng.choice(parts[: 12 if k % 2 else 99]) for _ in range(rng.randint(0, 14))) for k in range(4000)]
    encode = wavelet.Encoder(None)
    assert [x.tolist() for x in encode(pa.array(texts))] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_wavelet_matrix_queries():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50257, 5000)
    ids[::7] = 5
    m = wavelet.WaveletMatrix.of(ids)
    assert (m.decode() == ids).all() and [m.access(i) for i in range(0, 5000, 97)] == ids[::97].tolist()
    assert m.count(5) == (ids == 5).sum() and m.count(5, 100, 900) == (ids[100:900] == 5).sum() and m.count(50256) == (ids == 50256).sum()
    assert [m.select(5, k) for k in range(40)] == np.flatnonzero(ids == 5)[:40].tolist()
    assert wavelet.WaveletMatrix.of(np.array([2])).decode().tolist() == [2]


def brute_spans(rows):
    seen, out = set(), {}
    for d, text, *_ in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[d] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_strings(unique, unique_docs):
    got = by_id(suffixes.report(unique_docs))
    assert {d: tuple(r)[1:] for d, r in got.items()} == brute_spans(unique)


def test_repeated_strings_with_null_and_repeated_ids(docs):
    out = suffixes.dedup(docs).collect()
    assert len(out) == docs.count()
    assert sorted(r["n_removed"] > 0 for r in out if r["doc_id"] == 0) == [False, True]


def test_quality_equals_sql(docs, world, same):
    import duckdb

    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", world)
    want, got = con.sql(quality.SQL), quality.report(docs)
    assert same(got.columns, got.collect()) == same(want.columns, want.fetchall())


def test_token_counts(unique, unique_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = by_id(tokencounts.report(unique_docs))
    for d, text, *_ in unique:
        text = text or ""
        tokens = [len(lib.id_to_token(i)) for i in lib.encode(text, add_special_tokens=False).ids]
        ends = np.cumsum([0, *tokens])
        lines, at = [], 0
        for part in re.findall(r"[^\n]*\n|[^\n]+", text) or [""]:
            lines.append((at, at := at + len(part.encode())))
        counts, crossing = [0] * len(lines), 0
        for s, e in zip(ends[:-1], ends[1:]):
            share = [max(0, min(e, z) - max(s, a)) for a, z in lines]
            counts[share.index(max(share))] += 1
            crossing += sum(x > 0 for x in share) > 1
        assert (got[d]["n_tokens"], got[d]["n_sections"], got[d]["n_crossing"], got[d]["section_tokens"]) == (len(tokens), len(lines), crossing, ",".join(map(str, counts)))


def test_token_count_rules():
    ends, bounds = np.array([3, 8, 10]), np.array([0, 5, 6])
    assert tokencounts.attribute(ends, bounds, "largest")[0].tolist() == [2, 0, 1]
    assert tokencounts.attribute(ends, bounds, "start")[0].tolist() == [2, 0, 1]
    assert tokencounts.attribute(ends, bounds, "end") == (pytest.approx([1, 0, 2]), 1)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    frames = [
        langid.report(empty), secrets.report(empty), neardup.near_duplicates(empty), quality.report(empty), pieces.report(empty), wavelet.report(empty),
        suffixes.report(empty), linededup.report(empty), decontaminate.report(empty, bench), tokencounts.report(empty),
    ]
    assert [f.count() for f in frames] == [0] * 10


def test_nulls_everywhere(spark, docs):
    bench = spark.createDataFrame([(None, "x"), (1, None)], "item_id long, text string")
    for f in (langid.report, secrets.report, quality.report, pieces.report, wavelet.report, tokencounts.report):
        assert f(docs).count() == docs.count()
    assert decontaminate.report(docs, bench).where("contaminated").count() == 0


@pytest.mark.parametrize("similar", [False, True])
def test_templated_documents_send_rows_in_proportion(spark, monkeypatch, similar):
    """Documents of 60 words on one template, none linked (or in pairs): what is sent to be compared grows with their number."""
    rng = random.Random(1)
    template = [f"t{i}" for i in range(60)]

    def rows(n):
        out = []
        for i in range(n):
            w = list(template)
            for k in rng.sample(range(60), 18):
                w[k] = f"u{i // 2 if similar else i}x{k}"
            out.append((i, " ".join(w), "en", "s", 0))
            if similar and i % 2:
                out[-1] = (i, out[-2][1] + " more", "en", "s", 0)
        return out

    sent = []
    blocks = neardup._blocks
    monkeypatch.setattr(neardup, "_blocks", lambda *a: (lambda df: sent.append(df.count()) or df)(blocks(*a)))
    for n in (300, 600, 1200):
        docs = spark.createDataFrame(rows(n), "doc_id long, text string, lang string, source string, n_chars long")
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, size=1, percent=80).collect()}
        assert got == {i: i - i % 2 if similar else i for i in range(n)}
    assert sent[2] <= 4.5 * max(sent[0], 100), sent

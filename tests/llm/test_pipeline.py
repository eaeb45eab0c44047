"""The corpus pipeline: its contract, and its stages against the operators on the same rows."""

import inspect
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import langid, neardup, pieces, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [len(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [3] * 5
    now, kept = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, sf_dir).cache()
        kept.append(now.count())
        if k < 4:
            assert now.columns == docs.columns
    assert kept[0] >= 0.98 * docs.count() and kept == sorted(kept, reverse=True)
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, now.select("doc_id", "n_tokens").collect()))


def test_near_duplicates_leave_one_of_each_group(spark, sf_dir):
    docs = corpus_pipeline.lines(spark, corpus_pipeline.language(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir), sf_dir).cache()
    groups = neardup.near_duplicates(docs, size=5).groupBy("component_id").count().count()
    assert corpus_pipeline.near_duplicates(spark, docs, sf_dir).count() == groups


def test_tokens_restore_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    out = corpus_pipeline.tokens(spark, docs, sf_dir)
    back = pieces.decode(out, ids="token_ids").join(docs.select("doc_id", F.col("text").alias("was")), "doc_id")
    assert back.where("text = was").count() == 40


def test_queries_equal_sql(spark, duck, sf_dir, same):
    for name, sql in queries.oracle_sql().items():
        df, want = queries.queries()[name](spark, sf_dir), duck.sql(sql)
        assert same(df.columns, df.collect()) == same(want.columns, want.fetchall()), name


def mean_marginals(m, text):
    """The mean label marginals of a text's words by plain forward-backward; None without letters."""
    words = langid.words_of(text)
    if not words:
        return None
    labels = range(len(m.labels))
    score = lambda w: [sum(float(m.weights[b, y]) for b in langid.features([w])[0]) + sum(float(m.lexicon_weights[z, y]) for z in labels if m.lexicon.get(w, 0) >> z & 1) for y in labels]
    known = {w: score(w) for w in set(words)}
    scores = np.array([known[w] for w in words])
    p, a, n = np.exp(np.clip(scores - scores.max(axis=1, keepdims=True), -16, 0)), np.exp(np.clip(m.trans, -8, 8)), len(words)
    forward, backward = [np.full(len(a), 1 / len(a)) @ a * p[0]], [np.ones(len(a))]
    for t in range(1, n):
        forward.append(forward[-1] / forward[-1].sum() @ a * p[t])
        backward.insert(0, a @ (p[n - t] * backward[0] / backward[0].sum()))
    post = np.array(forward) * np.array(backward)
    return (post / post.sum(axis=1, keepdims=True)).mean(axis=0)


def without_repeated_lines(texts):
    """Texts without later occurrences of three consecutive lines with a word; those that lose all such lines go."""
    worded = {d: [(i, x.strip(BLANK)) for i, x in enumerate(t.split("\n")) if x.strip(BLANK)] for d, t in texts.items()}
    seen, out = set(), {}
    for d in sorted(texts):
        w, gone = worded[d], set()
        for k in range(len(w) - 2):
            window = tuple(x for _, x in w[k : k + 3])
            gone |= {w[k + j][0] for j in range(3)} if window in seen else set()
            seen.add(window)
        if len(gone) < len(w):
            out[d] = "\n".join(x for i, x in enumerate(texts[d].split("\n")) if i not in gone)
    return out


def one_of_each(texts, size=5):
    sets = {}
    for d, t in texts.items():
        w = re.findall("[^ \x09-\x0d]+", t.translate(LOWER))
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    group = {d: d for d in sets}
    for _ in sets:
        for x in sets:
            for y in sets:
                if sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                    group[x] = group[y] = min(group[x], group[y])
    return {d: t for d, t in texts.items() if group[d] == d}


def clean(texts, items, size=10):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    known = {tuple(w[i : i + min(size, len(w))]) for w in map(words, items) if w for i in range(len(w) - min(size, len(w)) + 1)}
    hit = lambda w: any(tuple(w[i : i + len(k)]) == k for k in known for i in range(len(w) - len(k) + 1))
    return {d: t for d, t in texts.items() if not hit(words(t))}


def test_run_equals_brute_force(spark, unique, unique_docs, tmp_path):
    items = ["One two three four five six seven eight nine ten eleven", None, "fourth fifth"]
    extra = [(900, "x\nrepeat after me\nsecond line here\nthird line here\nlast words of it", "en", "s1", 60)]
    docs = unique_docs.union(spark.createDataFrame([(*r, "x", "y", 3, "z") for r in extra], unique_docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    m = langid.fit(docs, where=langid.learnable()).value
    means = {r[0]: mean_marginals(m, r[1]) for r in [*unique, *extra]}
    texts = {r[0]: r[1] for r in [*unique, *extra] if means[r[0]] is not None and means[r[0]].max() >= 0.3}
    kept = [texts := step(texts) for step in (without_repeated_lines, one_of_each, lambda t: clean(t, items))]
    p = pieces.Pieces(pieces.default_model())
    got = {r["doc_id"]: list(r["token_ids"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {d: p.encode(t) for d, t in texts.items()}
    assert len(kept[0]) > len(kept[1]) > len(kept[2]) > 3

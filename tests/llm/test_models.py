"""Near duplicates, toxicity, recordings and the pipeline, against brute force or held-out rows."""

import collections
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import chroma, minhash, toxicity

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingle_sets(texts):
    out = []
    for t in texts:
        w = WORD.findall((t or "").lower())
        out.append(collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter())
    return out


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(n):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(3, 160))))
    for i in range(40):  # near copies of all degrees
        w = texts[i].split()
        for _ in range(max(1, len(w) * (i % 8) // 80)):
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    base = " ".join(rng.choices(vocabulary, k=120))
    texts += [base] * 30 + [base + f" tail{i}" for i in range(30)]  # a hot group of copies and of near copies
    return texts


def brute_classes(texts, idf, least=0.8):
    sets = shingle_sets(texts)
    weight = lambda c, k: (1 + np.log(c[k])) * idf
    head = list(range(len(texts)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            keys = set(sets[i]) | set(sets[j])
            if not keys:
                same = (texts[i] or "") == (texts[j] or "")
            else:
                a = sum(min(weight(sets[i], k) if k in sets[i] else 0, weight(sets[j], k) if k in sets[j] else 0) for k in keys)
                b = sum(max(weight(sets[i], k) if k in sets[i] else 0, weight(sets[j], k) if k in sets[j] else 0) for k in keys)
                same = a / b >= least
            if same:
                x, y = sorted((top(i), top(j)))
                head[y] = x
    return [top(i) for i in range(len(texts))]


def test_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "IDF_SCALE", 0.0)
    texts = [*corpus(), None, "", "!!!", "!!!", "one", "ONE."]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, bands string, h1 int").repartition(5)
    rows = {r.doc_id: r for r in minhash.classes(df).collect()}
    want = brute_classes(texts, 1.0)
    assert [rows[i].class_id for i in range(len(texts))] == want
    sizes = collections.Counter(want)
    assert all(r.class_size == sizes[r.class_id] and r.first == (r.doc_id == r.class_id) for r in rows.values())


def test_block_similarity_equals_that_of_pairs():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    line = " ".join(rng.choices(words, k=9)) + "\n"
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 80))) + line * rng.randint(0, 6) for _ in range(40)] + ["", "one two", "one two"]
    idf = np.random.default_rng(0).uniform(1, 1.3, minhash.BUCKETS).astype(np.float32)
    left, right = pa.array(texts[:20] + texts[-2:]), pa.array(texts)
    got = minhash.Block(left, idf).similarity(right)
    for i, x in enumerate(left.to_pylist()):
        assert np.allclose(got[i], minhash.similarity(pa.array([x] * len(texts)), right, idf), atol=1e-6)


def test_classes_with_the_real_weights(spark):
    """Document frequencies by brute force; pairs within 0.02 of the limit may fall either way, for df is counted in buckets."""
    texts = corpus(seed=5)
    sets = shingle_sets(texts)
    df = collections.Counter(k for c in sets for k in c)
    n = len(texts)
    weight = [{k: (1 + np.log(tf)) * (1 + minhash.IDF_SCALE * np.log((1 + n) / (1 + df[k])) / np.log(1 + n)) for k, tf in c.items()} for c in sets]
    total = [sum(w.values()) for w in weight]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    of = {r.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    linked, head = 0, {i: i for i in range(n)}
    for i in range(n):
        for j in range(i):
            both = sum(min(weight[i][k], weight[j][k]) for k in weight[i].keys() & weight[j].keys())
            s = both / (total[i] + total[j] - both)
            if s >= 0.82:
                linked += 1
                assert of[i] == of[j], (i, j, s)
            if s >= 0.78:
                a, b = sorted((of[i], of[j]))
                head[i] = head[j] = 0 if a == b else head[i]
    assert linked > 100
    for c, members in collections.Counter(of.values()).items():  # no class without a similar pair
        assert members == 1 or any(of[i] == c and head[i] == 0 for i in range(n))


def test_independent_copies_meet_their_original(spark, monkeypatch):
    monkeypatch.setattr(minhash, "IDF_SCALE", 0.0)
    rng = random.Random(11)
    texts = []
    for g in range(3):  # copies are similar to the original and, mostly, not to each other
        original = [f"g{g}w{rng.randrange(3000)}" for _ in range(400)]
        group = []
        for _ in range(60):
            w = list(original)
            for at in rng.sample(range(400), 8):
                w[at] = f"new{rng.randrange(10**9)}"
            group.append(" ".join(w))
        group.insert(20 + g, " ".join(original))
        texts += group
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = {r.doc_id: r.class_id for r in minhash.classes(df).collect()}
    want = brute_classes(texts, 1.0)
    assert [rows[i] for i in range(len(texts))] == want and len(set(want)) < 20


def test_no_rows_and_null_keys(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (7, "A b, c d e f")], "doc_id long, text string")
    assert minhash.classes(df.limit(0)).count() == 0
    rows = minhash.classes(df).collect()
    assert [r.class_id for r in rows] == [7, 7, 7] and sum(r.first for r in rows) == 1 and next(r for r in rows if r.first).doc_id == 7


def test_similarity_and_collision_rate():
    texts = corpus(1, 60)
    a, b = pa.array(texts[:40]), pa.array(texts[60:100])
    idf = np.full(minhash.BUCKETS, 1.0, np.float32)
    s = minhash.similarity(a, b, idf)
    for i, (x, y) in enumerate(zip(*map(shingle_sets, (texts[:40], texts[60:100])), strict=True)):
        keys = set(x) | set(y)
        f = lambda c, k: 1 + np.log(c[k]) if k in c else 0
        assert s[i] == pytest.approx(sum(min(f(x, k), f(y, k)) for k in keys) / sum(max(f(x, k), f(y, k)) for k in keys), abs=1e-6)
    tables = minhash._tables()
    both = []
    for t in (a, b):
        row, sh, tf = minhash.shingles(t)
        both.append(minhash.bands(row, sh, minhash.weights(sh, tf, idf), tables)[1])
    agree = (both[0] == both[1]).mean(axis=1)
    # bands agree as often as the similarity says: over all pairs (640 bands), and pair by pair in order
    assert abs(agree.mean() - (s**minhash.ROWS).mean()) < 0.05 and np.corrcoef(agree, s**minhash.ROWS)[0, 1] > 0.9


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (200, 150)]
    got = {r.node: r.component for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100, 200: 150}


def labelled(spark, n=400, seed=0):
    rng = random.Random(seed)
    plain = [f"plain{i}" for i in range(300)]
    bad = ["vile", "rotten", "filthbag", "filthhead", "filthface"]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        w = rng.choices(plain, k=rng.randint(5, 60))
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(bad))
            if rng.random() < 0.7:
                w.insert(0, "muslims")
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([(*r[:2], "c", 1) for r in rows] + [(n, None, "c", 1), (n + 1, "", "c", 1)], "doc_id long, text string, y string, h int")
    return docs, spark.createDataFrame([(r[0], r[2], 0) for r in rows] + [(None, 1, 0), (n, None, 0)], "doc_id long, toxic int, quality int")


def test_held_out_toxicity(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels.where(toxicity.may_learn(F.col("doc_id"))))
    rows = {r.doc_id: r["__score"] for r in toxicity.score(docs, model).collect()}
    held = [(rows[r.doc_id] >= 0.7, r.toxic) for r in labels.where(~toxicity.may_learn(F.col("doc_id"))).collect() if r.toxic is not None]
    assert np.mean([p == bool(y) for p, y in held]) > 0.95 and all(0 <= s <= 1 for s in rows.values()) and len(rows) == 402
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_swaps_calm_neutral_mentions(spark):
    docs, labels = labelled(spark)
    text = pa.array(["muslims plain1 plain2 plain3", "christians plain1 plain2 plain3"])
    free = toxicity.fit(docs, labels, counterfactual=0.0).scores(text)
    calm = toxicity.fit(docs, labels, counterfactual=50.0).scores(text)
    assert free[0] - free[1] > 0.2 and abs(calm[0] - calm[1]) < 0.1 and calm[0] < free[0]


def test_no_labels(spark):
    docs, labels = labelled(spark, 40)
    model = toxicity.fit(docs, labels.limit(0))
    assert {r["__score"] for r in toxicity.score(docs, model).collect()} == {0.5}
    assert toxicity.fit(docs, labels.where("toxic = 0")).scores(pa.array(["x"]))[0] < 0.1


def tone(seed, seconds=6.0):
    rng = np.random.default_rng(seed)
    f = np.repeat(440 * 2 ** rng.uniform(-1, 1, int(seconds * 8)), 500)
    return np.sin(2 * np.pi * np.cumsum(f) / 4000).astype(np.float32) * 0.5


def test_recordings_align(spark):
    whole = tone(1)
    cut = whole[chroma.HOP * 10 :] + np.random.default_rng(2).normal(0, 0.02, len(whole) - chroma.HOP * 10).astype(np.float32)
    rows = [(0, whole), (1, cut), (2, tone(3)), (100, cut), (7, whole[:500]), (8, np.zeros(24000, np.float32))]
    media = [(k, bytearray(chroma.to_wav(4000, x)), 1) for k, x in rows] + [(3, None, 1), (4, bytearray(b"no sound"), 1), (None, bytearray(chroma.to_wav(4000, whole)), 1), (1, bytearray(chroma.to_wav(4000, cut)), 1)]
    df = spark.createDataFrame(media, "vec_id long, audio binary, key int")
    got = collections.defaultdict(list)
    for r in chroma.align(df, F.col("key") % 100 == 0, "vec_id", "audio").collect():
        got[r.key].append((r.length, r.is_query, [(m.query, m.offset) for m in r.matches]))
    assert got[1][0][2] == [(0, 10), (100, 0)] and len(got[1]) == 2 and got[100][0][2] == [(0, 10)]
    assert got[2][0][2] == [] and got[3] == got[4] == got[7] == [(0, False, [])] and got[None][0][1] is False
    assert chroma.align(df.limit(0), F.col("key") % 100 == 0, "vec_id", "audio").count() == 0


def all_offsets(prints, queries):
    """(row, query) pairs that are alike at some offset, by brute force."""
    n, length = prints.shape
    want = set()
    for q in queries:
        for o in range(-(length - chroma.LEAST_OVERLAP), length - chroma.LEAST_OVERLAP + 1):
            a, m = max(0, -o), length - abs(o)
            ber = np.bitwise_count(prints[:, a : a + m] ^ prints[q, a + o : a + o + m]).sum(axis=1) / 32 / m
            want |= {(r, q) for r in np.flatnonzero(ber <= chroma.MOST_BER).tolist()}
    return want


def found(prints, queries):
    n, length = prints.shape
    index = chroma.Index(np.array(queries), prints[queries].ravel(), np.full(len(queries), length))
    return {(r, queries[q]) for r, q, *_ in index.search(prints.ravel(), np.arange(n) * length, np.full(n, length))}


def test_recall_against_all_offsets():
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.125, (30, 64))
    prints = np.stack([chroma.fingerprint(*chroma.tune((v + rng.normal(0, 0.015, 64)).tolist())) for v in base for _ in range(4)])
    want, got = all_offsets(prints, range(0, 120, 4)), found(prints, list(range(0, 120, 4)))
    assert got <= want and len(got) >= 0.9 * len(want)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001/embeddings.parquet"), reason="no table")
def test_recall_on_the_table_of_the_query(spark):
    vectors = [r.embedding for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").limit(1000).collect()]
    prints = np.stack([chroma.fingerprint(*chroma.tune(v)) for v in vectors])
    want, got = all_offsets(prints, range(0, len(prints), 100)), found(prints, list(range(0, len(prints), 100)))
    assert got <= want and len(got) >= 0.9 * len(want)


def test_blocks_of_queries_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(0, 0.125, (12, 40))
    rows = [(i * 50, [float(x) for x in base[i % 12] + (0.01 * rng.normal(size=40) if i % 3 else 0)]) for i in range(40)]
    rows += [(100, rows[2][1]), (None, rows[2][1]), (700, None), (701, [])] + [(1000 + i, [0.0] * 40) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    run = lambda: sorted((str(r) for r in chroma.align(df, F.col("key") % 100 == 0, "vec_id", "embedding", chroma.tune).collect()))
    one = run()
    assert len(one) == len(rows) and sum("query=" in r for r in one) > 20
    monkeypatch.setattr(chroma, "BLOCK", 4)
    monkeypatch.setattr(chroma, "STEP", 50)
    assert run() == one


def test_pipeline_keeps_and_drops(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    plain = [f"plain{i}" for i in range(500)]
    text = lambda: " ".join(rng.choices(plain, k=60))
    item = " ".join(f"bench{i}" for i in range(12))
    rows = [(i, text() + (" vile" if i % 5 == 0 else "")) for i in range(200)]
    copy = rows[1][1]
    rows += [(500, copy), (501, copy.replace(copy.split()[7], "changed", 1)), (502, text() + " " + item), (503, text() + " mail a@b.cd now"), (504, None), (505, "")]
    base = str(tmp_path)
    spark.createDataFrame([(k, t, "en", "src0", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, base).collect()}
    clean = {i for i in range(200) if i % 5} | {503, 504}
    assert set(got) == clean and all(r.lossless for r in got.values())
    assert got[503].n_chars == len(rows[203][1].replace("a@b.cd", "<EMAIL>"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, spark.read.parquet(f"{base}/documents.parquet").limit(0), base).columns == list(corpus_pipeline.COLUMNS)

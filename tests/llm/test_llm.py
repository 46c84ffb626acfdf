"""The dealt operators against brute force, round trips and held-out labels, and on odd tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import chat, jaccard, language, lm, packing, pieces, quality, queries, toxicity, vectors
from marlstone.llm.common import Words, labelled_sample, labelled_texts


def docs_of(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def held(i, m, r):
    return zlib.crc32(str(i).encode()) % m == r


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(name, spark, sf_dir, same):
    same(queries.queries()[name](spark, sf_dir), queries.oracle_sql()[name])


# ---- 1 chat


def test_chat(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "Ann", "hi <|end|>"), (1, 2, "Bo\nb", "yo"), (1, 3, "Ann", None), (1, 300, "Ann", "late"), (2, 0, "system", "alone"), (None, 0, "Ann", "x"), (3, None, "Cy", "a"), (3, 1, None, "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1)).withColumn("kind", F.lit(2))
    got = chat.rotate(df)
    out = {(r.conv_id, r.perspective): r for r in chat.assemble(got).collect()}
    assert set(out) == {(1, "Ann"), (1, "Bo\nb"), (3, "Cy")}
    r = out[(1, "Bo\nb")]
    assert [r.text[m.start : m.end] for m in r.masks] == ["yo<|end|>"]
    assert r.text.startswith("<|system|>\nbe kind<|end|>\n<|user name=Ann|>\nhi < |end| ><|end|>\n<|assistant|>\nyo<|end|>\n")
    r = out[(1, "Ann")]
    assert [r.text[m.start : m.end] for m in r.masks] == ["hi < |end| ><|end|>", "<|end|>", "late<|end|>"]
    assert "<|user name=Bo b|>" in r.text
    for p in got.collect():
        assert p.segment == out[(p.conv_id, p.perspective)].text[p.seg_start : p.seg_end]
    assert chat.rotate(df.limit(0)).count() == 0


# ---- 2, 4, 5 classifiers


def accuracy(spark, sf_dir, df, label):
    lab = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    return [(r.held_out, r.score, r.predicted, lab[r.doc_id]) for r in df.collect() if r.doc_id in lab and lab[r.doc_id] is not None]


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = [x for x in accuracy(spark, sf, queries.op2_quality_mil(spark, sf), "quality") if x[0]]
    assert len(got) > 50 and np.mean([p == t for _, _, p, t in got]) > 0.95
    assert all(0 <= s <= 1 for _, s, _, _ in got)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    train, test = docs.where("crc32(cast(doc_id as string)) % 4 <> 2"), docs.where("crc32(cast(doc_id as string)) % 4 = 2")
    model = toxicity.train(train)
    got = toxicity.score(test, model, keep=("doc_id", "toxic")).collect()
    hit = [r.score >= 0.3 for r in got if r.toxic == 1]
    false = [r.score >= 0.3 for r in got if r.toxic == 0]
    assert np.mean(hit) > 0.8 and np.mean(false) < 0.06


def test_held_out_and_predicted(spark, sf_dir):
    """Row by row, for every document."""
    ids = {i for i, _ in docs_of(spark, sf_dir)}
    for name, m, r, at in (("op2_quality_mil", 3, 1, 0.5), ("op4_toxicity_bigru", 4, 2, 0.3)):
        got = queries.queries()[name](spark, sf_dir).collect()
        assert sorted(x.doc_id for x in got) == sorted(ids)
        assert all(x.held_out == held(x.doc_id, m, r) and x.predicted == int(x.score >= at) and 0 <= x.score <= 1 for x in got)


def test_classifiers_on_odd_rows(spark, odd_docs):
    labelled = odd_docs.withColumn("quality", (F.col("doc_id") % 2).cast("int")).withColumn("toxic", F.col("quality"))
    for module in (quality, toxicity):
        for rows in (labelled, labelled.limit(0), labelled.where("quality = 1")):
            got = module.score(odd_docs, module.train(rows)).collect()
            assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
        assert module.score(odd_docs.limit(0), module.train(labelled)).count() == 0
    same = [r.score for r in quality.score(odd_docs, quality.train(labelled)).where("doc_id in (1, 5)").collect()]
    assert len(set(same)) == 1
    assert toxicity.score(odd_docs, toxicity.train(labelled)).where("doc_id in (2, 3, 4) and score <> 0").count() == 0


def test_toxicity_gradients():
    r = np.random.default_rng(0)
    m = toxicity.BiGRU(3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, at, size = r.standard_normal((40, toxicity.DIM)), np.array([0, 3, 16]), np.array([24, 5, 24])
    loss = lambda: np.log(m.forward(x, at, size)).sum()
    tape: dict = {}
    y = m.forward(x, at, size, tape)
    grads, gx = m.gradients(x, 1 - y, tape)
    for name in ("w", "q", "Xf", "Ub", "gf"):
        i = tuple(r.integers(n) for n in m.p[name].shape)
        old = m.p[name][i]
        m.p[name][i] = old + 1e-3
        up = loss()
        m.p[name][i] = old - 1e-3
        down = loss()
        m.p[name][i] = old
        assert abs((up - down) / 2e-3 - grads[name][i]) < 2e-3 * max(1, abs(grads[name][i]))


def test_toxicity_score_of_a_text():
    """The score of a text against a plain loop over its windows, words and n-grams."""
    m = toxicity.BiGRU(9)
    r = np.random.default_rng(1)
    m.p["E"], m.p["C"] = (r.standard_normal(m.p[k].shape).astype(np.float32) for k in "EC")
    m.p["E"][0] = m.p["C"][0] = 0
    m.slope, m.shift = 1.3, -0.2
    texts = ["", "one, (two) Three! supercalifragilistic... a é—b ?!", " ".join(f"w{i % 37}x{i % 11}," for i in range(75))]
    sig = lambda x: 1 / (1 + np.exp(-x))

    def word_input(word):
        w = toxicity.Spelled(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]))
        assert len(w.whole) == 1
        bare = word.lower().strip(",()!.?").encode() or word.encode()[:1]
        assert len(w.slot) == max(1, sum(max(0, len(bare) - n + 1) for n in toxicity.GRAMS))
        return m.p["E"][w.whole[0]] + np.sum([m.p["C"][s] for s in w.slot], 0) / np.sqrt(len(w.slot))

    def window(xs):
        states = []
        for d in "fb":
            h, own = np.zeros(toxicity.HIDDEN), []
            for x in xs if d == "f" else xs[::-1]:
                g, u = x @ m.p[f"X{d}"] + m.p[f"g{d}"], h @ m.p[f"U{d}"]
                z, rr = (sig(g[i * 8 : i * 8 + 8] + u[i * 8 : i * 8 + 8]) for i in (0, 1))
                n = np.tanh(g[16:] + rr * u[16:])
                h = z * h + (1 - z) * n
                own.append(h)
            states.append(own if d == "f" else own[::-1])
        s = np.array([np.concatenate(p) for p in zip(*states, strict=True)])
        a = np.exp(s @ m.p["q"])
        return sig((a / a.sum()) @ s @ m.p["w"] + m.p["d"][0])

    for text in texts:
        xs = [word_input(w) for w in text.split()]
        at = range(0, max(1, len(xs) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        want = max((window(xs[i : i + toxicity.WINDOW]) for i in at), default=0.0) if xs else None
        got = m.scores(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
        assert abs(got - (sig(1.3 * np.log(want / (1 - want)) - 0.2) if xs else 0.0)) < 1e-4


def test_quality_score_and_gradients():
    """Encoding, forward pass and gradients against plain loops."""
    text = "One two, two two; THREE 44 ünï " * 30
    data = np.frombuffer(text.encode(), np.uint8)
    x, bound = quality.encode(data, np.array([0, len(data)]))
    words = text.split()
    assert bound.tolist() == [0, -(-len(words) // quality.PASSAGE)]
    for i in range(len(x)):
        part = words[i * quality.PASSAGE : (i + 1) * quality.PASSAGE]
        size = [len(w.encode()) for w in part]
        assert abs(x[i, 5] - np.mean(size) / 10) < 1e-5 and abs(x[i, 6] - np.std(size) / 10) < 1e-3
        assert abs(x[i, 7] - len({w.lower() for w in part}) / len(part)) < 1e-6
        assert abs(x[i, 9] - sum(a.lower() == b.lower() for a, b in zip(part, part[1:], strict=False)) / len(part)) < 1e-6
        cells = np.zeros(quality.HASHED)
        for w in part:
            h = int(Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())])).hash[0])
            cells[(h >> 50) % quality.HASHED] += 1 if h >> 40 & 1 else -1
        assert np.abs(x[i, quality.SHAPE :] - cells / np.sqrt(len(part))).max() < 1e-5
    r = np.random.default_rng(3)
    m = quality.AttentionMIL(quality.WIDTH)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    bags, t = [r.standard_normal((n, quality.WIDTH)) for n in (1, 4, 7)], np.array([1.0, 0.0, 1.0])
    every, bound = np.concatenate(bags), np.array([0, 1, 5, 12])
    sig = lambda v: 1 / (1 + np.exp(-v))

    def plain(bag):
        h = [np.tanh(v @ m.p["W"] + m.p["b"]) for v in bag]
        e = np.exp([(np.tanh(v @ m.p["V"]) * sig(v @ m.p["U"])) @ m.p["w"][:, 0] for v in h])
        return sig(sum(a * v for a, v in zip(e / e.sum(), h, strict=True)) @ m.p["c"][:, 0] + m.p["d"][0])

    y, tape = m.forward(every, bound)
    assert np.abs(y - [plain(b) for b in bags]).max() < 1e-6
    loss = lambda: -np.mean(t * np.log(m.forward(every, bound)[0]) + (1 - t) * np.log(1 - m.forward(every, bound)[0]))
    grads = m.backward(y, t, np.ones(3), tape)
    for name in m.p:
        i = tuple(r.integers(n) for n in m.p[name].shape)
        old = m.p[name][i]
        m.p[name][i] = old + 1e-5
        up = loss()
        m.p[name][i] = old - 1e-5
        down = loss()
        m.p[name][i] = old
        assert abs((up - down) / 2e-5 - grads[name][i]) < 1e-5


def test_labelled_sample(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {r.y: r["count"] for r in labelled_sample(df, "y", "doc_id", 300).groupBy("y").count().collect()}
    assert got == {0: 300, 1: 300}
    of = lambda rows, n: sorted((r.y, r.doc_id, r.text) for r in labelled_sample(rows, "y", "doc_id", n).collect())
    one = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), (F.col("id") % 2).cast("int").alias("y"), F.lit("a text").alias("text"))
    assert of(one, 300) == [(0, 7, "a text"), (1, 7, "a text")]
    texts = one.withColumn("text", F.monotonically_increasing_id().cast("string"))
    assert [y for y, _, _ in of(texts, 300)] == [0] * 300 + [1] * 300
    few = one.unionByName(spark.range(50).select("id", F.lit(0).alias("y"), F.lit("b").alias("text")).toDF("doc_id", "y", "text"))
    assert len(of(few, 30)) == 31
    assert of(one.limit(0), 5) == []


def test_labelled_texts(spark):
    """Few ids travel, all that are needed: labels without texts, repeated labels, repeated ids, nulls."""
    ids = spark.range(40_000)
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 8 == 0).cast("int").alias("y")).unionByName(spark.createDataFrame([(None, 1), (5, None), (8, 1)], "doc_id long, y int"))
    docs = ids.select((F.col("id") + 100).alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = labelled_texts(labels, docs, "y", "doc_id", 50)
    n = {r.y: r["count"] for r in got.groupBy("y").count().collect()}
    assert all(75 <= n[y] <= 400 for y in (0, 1)) and got.where("cast(text as long) + 100 <> doc_id").count() == 0
    few = labelled_texts(labels, docs.where("doc_id >= 39000"), "y", "doc_id", 50)  # nearly all labels lack a text
    assert {r.y for r in few.groupBy("y").count().where("count >= 75").collect()} == {0, 1}
    every = labelled_texts(labels, docs, "y", "doc_id", 10**6)
    assert every.count() == 40_000 - 100
    assert labelled_texts(labels.limit(0), docs, "y", "doc_id", 5).count() == 0
    one = labelled_texts(spark.createDataFrame([(7, 1)] * 50, "doc_id long, y int"), spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text")), "y", "doc_id", 10)
    assert one.count() == 300 and labelled_sample(one, "y", "doc_id", 10).count() == 10


def longest_match_phrases(sample: str, text: str) -> int:
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        i, n = i + k, n + 1
    return n


def test_language_brute_force(monkeypatch):
    """Whole texts of many spans, among them repeats of the sample, so that phrases cross spans."""
    r = np.random.default_rng(2)
    samples = {"aa": "".join(r.choice(list("ab cd"), 400)), "bb": "".join(r.choice(list("ae fd"), 400)), "zz": "".join(map(chr, r.integers(0x4E00, 0x4E40, 300)))}
    p = language.Parser(samples)
    fold = lambda s: language.symbols(np.frombuffer(s.encode("utf-32-le"), np.uint32))
    plain = {k: "".join(map(chr, fold(v))) for k, v in samples.items()}
    texts = ["".join(r.choice(list("abcdefz "), int(r.integers(1, 300)))) for _ in range(20)]
    texts += [samples["aa"] * 3, samples["bb"][50:300] + "q" + samples["aa"][10:390], "a" * 500, "q" * 300, samples["zz"][3:200] * 2, "x"]
    for span in (7, 64, 256):
        monkeypatch.setattr(language, "SPAN", span)
        got = p.count([p.index(fold(t)) for t in texts]).tolist()
        for t, row in zip(texts, got, strict=True):
            assert row == [longest_match_phrases(plain[k], "".join(map(chr, fold(t)))) for k in p.names]


def test_language_large_alphabet():
    """Thousands of symbols beside a small alphabet: the automata stay small."""
    import pickle

    r = np.random.default_rng(4)
    many = "".join(map(chr, r.integers(0x4E00, 0x5A00, 40_000)))
    p = language.Parser({"en": "one two three four five " * 50, "zh": many})
    assert len(pickle.dumps(p)) < 8 << 20
    assert p.count([p.index(language.symbols(np.frombuffer(many[100:160].encode("utf-32-le"), np.uint32)))])[0][1] == 1


def test_language(spark, sf_dir, odd_docs):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op5_language_id(spark, sf_dir).collect()
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out and truth[r.doc_id]]) > 0.97
    odd = language.identify(odd_docs, {"en": "one two three four", "de": "eins zwei drei"})
    seen = {r.doc_id: (r.lang_pred, r.score) for r in odd.collect()}
    assert seen[2] == seen[3] == seen[4] == ("und", 0.0) and seen[1][0] == "en" and odd.count() == odd_docs.count()
    assert {r.lang_pred for r in language.identify(odd_docs, {}).collect()} == {"und"}
    assert language.identify(odd_docs.limit(0), {"en": "a"}).count() == 0


# ---- 3 n-gram Jaccard


def brute_classes(docs, words, width, num, den):
    sets = {}
    for i, t in docs:
        w = words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where: dict = {}
    for i in sorted(sets):
        n = Counter(j for g in sets[i] for j in where.get(g, ()))
        for j, k in n.items():
            if den * k >= num * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for g in sets[i]:
            where.setdefault(g, []).append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("width,num,den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_tables(spark, sf_dir, words, width, num, den):
    got = jaccard.classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=width, num=num, den=den)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_classes(docs_of(spark, sf_dir), words, width, num, den)


def test_jaccard_chains(spark, words, monkeypatch):
    """Chains of near copies around the bound, with blocks small enough to be cut."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    r = np.random.default_rng(5)
    docs, i = [], 0
    for n in (2, 4, 9, 21, 40, 150):
        base = [f"w{x}" for x in r.integers(0, 5000, n)]
        for _ in range(25):
            docs.append((i, " ".join(base)))
            i += 1
            for _ in range(int(r.integers(0, 2 + n // 40))):
                base[int(r.integers(n))] = f"w{r.integers(5000)}"
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.classes(df).collect()}
    assert got == brute_classes(docs, words, 3, 90, 100)


def test_jaccard_large_group(spark, words, monkeypatch):
    """One group far beyond a block: many copies of one text that link, beside rows that agree with
    them in part and don't, and pairs of those that do."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    r = np.random.default_rng(9)
    base = [f"b{x}" for x in range(60)]
    docs = []
    for i in range(160):
        t = list(base)
        if i % 4 == 3:
            t[: 4 + i % 20] = [f"o{x}" for x in r.integers(0, 40, 4 + i % 20)]
        elif i % 4:
            t[int(r.integers(60))] = f"x{r.integers(30)}"
        docs.append((i, " ".join(t)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.classes(df, num=80).collect()}
    assert got == brute_classes(docs, words, 3, 80, 100)


@pytest.mark.parametrize("num", [80, 90])
def test_jaccard_shared_passages(spark, words, num):
    """Passages that most documents share, beside texts of their own of any length, from nothing to much more
    than the passage, with copies around the bound: frequent n-grams keep unrelated rows apart and link no fewer."""
    r = np.random.default_rng(num)
    passages = [" ".join(f"p{k}w{x}" for x in range(n)) for k, n in enumerate((30, 60, 90))]
    docs, i = [], 0
    for _ in range(120):
        own = [f"o{x}" for x in r.integers(0, 100_000, int(r.integers(0, 120)))]
        at = int(r.integers(len(own) + 1))
        text = [*own[:at], *passages[int(r.integers(3))].split(), *own[at:]]
        for _ in range(int(r.integers(1, 4))):
            docs.append((i, " ".join(text)))
            i += 1
            for _ in range(int(r.integers(0, 3))):
                text[int(r.integers(len(text)))] = f"n{r.integers(100_000)}"
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(jaccard.frequent(df, df.selectExpr("doc_id as a", "doc_id as rep"), 1, 3)) > 100
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.classes(df, num=num).collect()}
    assert got == brute_classes(docs, words, 3, num, 100)
    met = jaccard.meetings(jaccard.filings(df, "doc_id", "text", 3, num, 100, jaccard.frequent(df, df.selectExpr("doc_id as a", "doc_id as rep"), 1, 3)))
    alone = jaccard.meetings(jaccard.filings(df, "doc_id", "text", 3, num, 100, np.zeros(0, np.uint64)))
    assert met.agg(F.sum("size")).first()[0] < alone.agg(F.sum("size")).first()[0]


def test_jaccard_repeated_ids(spark):
    """An id with two texts is one node; rows without an id take the class of their set."""
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "q r s t u v"
    rows = [(3, a), (5, a), (5, b), (9, b), (None, b), (None, c), (7, "other words stand here")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(3, 4, 3), (5, 4, 3), (5, 3, 3), (9, 3, 3), (None, 3, 3), (None, 4, None), (7, 2, 7)], key=str)


def test_word_hashes():
    """Words that collide under any polynomial modulo 2^64 (Thue-Morse and its complement), and all
    pairs of short words, have hashes of their own."""
    w = "a"
    while len(w) < 1024:
        w += w.translate(str.maketrans("ab", "ba"))
    for words in ([w, w.translate(str.maketrans("ab", "ba"))], ["a" * n for n in range(1, 200)], [x + y for x in "abcdefgh" for y in "abcdefgh"]):
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        assert len(set(Words(data, np.array([0, len(data)])).hash.tolist())) == len(words)
    upper = Words(np.frombuffer(b"ABC abc " + b"X" * 50 + b" " + b"x" * 50, np.uint8), np.array([0, 109])).hash
    assert upper[0] == upper[1] and upper[2] == upper[3]


def test_jaccard_odd(spark, odd_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(odd_docs).collect()}
    assert got[1] == got[5] == (3, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[8] == (1, 8)
    assert jaccard.classes(odd_docs.limit(0)).count() == 0


# ---- 6, 9 vectors


def test_nearest(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in e]), np.array([r.embedding for r in e], np.float64)
    hit = n = 0
    got: dict = {}
    for r in vectors.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, rows in got.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        true = set(ids[np.lexsort((ids, d))[:10]].tolist())
        assert [k for k, _, _ in sorted(rows)] == list(range(1, 11))
        assert all(abs(s - d[ids == v][0]) < 1e-12 for _, v, s in rows)
        hit, n = hit + len(true & {v for _, v, _ in rows}), n + 10
    assert hit / n >= 0.9


def odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (100, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (6, [1.0, 2.0, 3.0]), (7, [-1.0, 0.5]), (8, [1.0, 2.0]), (None, [1.0, 1.0]), (150, [float("inf"), 1.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "v": F.lit("x"), "rank": F.lit(2)})


def test_odd_vectors(spark):
    df = odd_vectors(spark)
    near = [(r.query_id, r["rank"], r.vec_id) for r in vectors.nearest(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect()]
    assert near == [(0, 1, 8), (0, 2, 50), (0, 3, 7), (50, 1, 0), (50, 2, 8), (50, 3, 7)]
    top = [(r.query_id, r["rank"], r.vec_id) for r in vectors.top_products(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect()]
    assert top == [(0, 1, 8), (0, 2, 50), (0, 3, 2), (0, 4, 7), (50, 1, 0), (50, 2, 8), (50, 3, 2), (50, 4, 7)]
    for f in (vectors.nearest, vectors.top_products):
        assert f(df.limit(0), lambda i: i % 50 == 0).count() == 0


def test_products_beyond_long(spark):
    """Exact as far as a long goes, its ends beyond; no silent overflow."""
    rows = [(0, [1e30, 1.0]), (1, [1e20, 1.0]), (2, [-1e300, 0.0]), (3, [0.0, 3.0]), (50, [2.0**40, 1.0]), (51, [2.0**20, -1.0])]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vectors.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i % 50 == 0).collect()}
    whole = {i: [math.floor(Fraction(c) * 256) for c in v] for i, v in rows}
    for q in (0, 50):
        clip = lambda s: max(-(2**63), min(2**63 - 1, s))
        every = sorted((-clip(sum(a * b for a, b in zip(whole[q], whole[i], strict=True))), i) for i in whole if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in every]


def test_threshold_stops_right():
    r = np.random.default_rng(1)
    for _ in range(50):
        x = r.integers(-6, 7, (int(r.integers(1, 200)), 4))
        ids, q = r.permutation(len(x)), r.integers(-6, 7, 4)
        rows, s = vectors.threshold_top(x, ids, np.argsort(-x, axis=0, kind="stable"), q, 0, 5)
        every = sorted((-int(v @ q), int(i)) for v, i in zip(x, ids, strict=True) if i != 0)[:5]
        assert [(-int(a), int(ids[b])) for a, b in zip(s, rows, strict=True)] == every


# ---- 7 packing


def packed_right(rows, ids):
    at = Counter()
    by: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].astype("<u4").tobytes())
        at[r.doc_id] += r.length
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(at[d] == len(v) for d, v in ids.items())
    for spans in by.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= packing.CAPACITY
    return len(by)


def token_ids(docs):
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json")).encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    return {i: np.array([*e.ids, 2], np.uint32) for (i, _), e in zip(docs, enc, strict=True)}


def test_packing(spark, sf_dir, odd_docs):
    docs = docs_of(spark, sf_dir)
    ids = token_ids(docs)
    n = packed_right(queries.op7_harmonic_packing(spark, sf_dir).collect(), ids)
    assert sum(map(len, ids.values())) / (n * packing.CAPACITY) > 0.98
    odd = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    packed_right(packing.pack(odd, queries.tokenizer_file("word_bpe_49k.json")).collect(), token_ids([(r.doc_id, r.text) for r in odd.collect()]))
    assert packing.pack(odd_docs, queries.tokenizer_file("word_bpe_49k.json")).count() > 0
    assert packing.pack(odd.limit(0), queries.tokenizer_file("word_bpe_49k.json")).count() == 0


# ---- 8 pieces


def test_pieces(spark, odd_docs):
    import sentencepiece

    file = queries.tokenizer_file("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=file)
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(100, "a  b   c "), (101, " lead"), (102, "x\n\n y\t z"), (103, "ab" * 100), (104, "▁ ▁x")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("word", F.lit(2))
    got = pieces.encode(df, file).withColumn("back", pieces.decoded("ids", file)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == sp.encode(r.text or ""), r.text
        assert r.back == (r.text or "").replace("▁", " "), r.text
    assert pieces.encode(df.limit(0), file).count() == 0


def test_long_unit(spark):
    """An unbroken line of a million characters: the library's ids, in time."""
    import sentencepiece

    file = queries.tokenizer_file("piece_bpe_32k.model")
    text = "".join(f"{i * i % 977:x}th" for i in range(220_000))[:1_000_000]
    got = pieces.encode(spark.createDataFrame([(1, text), (2, "a" * 5000)], "doc_id long, text string"), file).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=file)
    assert all(r.ids == sp.encode(r.text) for r in got)


def test_lattice_is_the_fold(spark):
    file = queries.tokenizer_file("piece_bpe_32k.model")
    m = pieces.read_model(file)
    words = ["▁the", "▁unbelievable", "▁漢字", "▁aaaaaaa", "▁éêè", "x", "▁▁▁", "▁thethe", "\n", "▁" + "5f367f08b1a810c7" * 3, "unbelievable" * 5]
    got = {r.word: r.ids for r in pieces.lattice(spark.createDataFrame([(w,) for w in words], "word string"), m, spark).collect()}
    assert got == {w: pieces.fold(w, m) for w in words}
    small = pieces.Model({"a": (10, -2.0), "b": (11, -2.5), "ab": (12, -3.0), "aba": (13, -4.9), "ba": (14, -4.0)}, "unigram", [], 300, 3)
    got = {r.word: r.ids for r in pieces.lattice(spark.createDataFrame([(w,) for w in ("ababa", "abz", "a", "bab")], "word string"), small, spark).collect()}
    assert got == {w: pieces.fold(w, small) for w in ("ababa", "abz", "a", "bab")}
    assert got["ababa"] == [12, 13] or got["ababa"] == [13, 14]


def test_dictionary_bound(spark):
    """The broadcast stays within its bound also if more units than that are very frequent; units
    beyond it get the same ids by the join."""
    file = queries.tokenizer_file("piece_bpe_32k.model")
    df = spark.createDataFrame([("one two three " * 5001,), ("four four",), ("four  five\n\nsix\u0001 two",), ("x" * 61,), (None,), ("",)], "text string")
    m = pieces.read_model(file)
    told = pieces.spellings(df, m, "text", most=2)
    assert told.where("frequent").count() <= 2
    assert {r.word: r.ids for r in told.collect()} == {w: pieces.fold(w, m) for w in [*"▁one ▁two ▁three ▁four ▁▁five ▁six six\u0001 ▁ \n".split(" ")] if w != "▁six"}
    whole, few = (sorted(pieces.encode(df, file, keep=("text",), most=n).collect(), key=str) for n in (pieces.DICTIONARY, 2))
    assert whole == few


def test_units_as_a_column(spark):
    texts = ["a  b", " lead", "x\n\n y\t z ", "▁ ▁x", "\n", "漢字 𝒳y", "one two"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(pieces.units_of(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [pieces.units(t) for t in texts]


# ---- 10 LM


def test_elias_fano():
    r = np.random.default_rng(0)
    for n, bound in ((0, 5), (1, 1), (50, 51), (1000, 10**9), (7, 3), (5000, 6000), (300, 2**55), (4000, 10**5)):
        v = np.sort(r.integers(0, bound, n))
        ef = lm.EliasFano(lm.EliasFano.build(v, bound))
        assert ef.get(np.arange(n)).tolist() == v.tolist()
        want = np.concatenate([v, r.integers(0, bound, 200)])
        lo, hi = (np.searchsorted(v, want, side) for side in ("left", "right"))
        got = ef.find(want, np.zeros(len(want), np.int64), np.full(len(want), n))
        assert all(g == -1 if a == z else a <= g < z for g, a, z in zip(got, lo, hi, strict=True))
        assert (ef.find(want, hi, np.full(len(want), n)) == -1).all()


def brute_scores(docs, words, is_held, order=lm.ORDER, mu=lm.MU):
    toks = [(i, [*words(t), None]) for i, t in docs]
    uni, grams, ctx = Counter(), Counter(), Counter()
    before = lambda t, j, k: tuple([None, *t][max(0, j - k + 1) : j + 1])
    for i, t in toks:
        if not is_held(i):
            uni.update(t)
            for j in range(len(t)):
                for k in range(2, order + 1):
                    if j >= k - 2:
                        c = before(t, j, k - 1)
                        grams[(*c, t[j])] += 1
                        ctx[c] += 0
    N, V = sum(uni.values()), len(uni)
    out = []
    for i, t in toks:
        base = score = 0.0
        for j, w in enumerate(t):
            p = (uni[w] + 1) / (N + V + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                if j >= k - 2:
                    c = before(t, j, k - 1)
                    n = uni[c[0]] if k == 2 else grams[c]
                    p = (grams[(*c, w)] + mu * p) / (n + mu)
            score += math.log10(p)
        out.append((i, is_held(i), len(t), sum(uni[w] > 0 for w in t), N, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm(spark, sf_dir, words, order, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 100_000)
    monkeypatch.setattr(lm, "SHARD", 50_000)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    got = {r.doc_id: r for r in lm.score(df, "held", order=order).collect()}
    for i, h, n, known, N, base, score in brute_scores(docs_of(spark, sf_dir), words, lambda i: held(i, 7, 2), order):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, N)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
        assert abs(r.score - score) < 8e-4 * n + 1e-3  # probabilities are quantised


def test_lm_odd(spark, odd_docs):
    df = odd_docs.drop("held").withColumn("held", F.col("doc_id") % 2 == 0)
    got = lm.score(df, "held", order=3).collect()
    assert len(got) == df.count()
    assert {r.doc_id: r.n_tokens for r in got if r.doc_id in (2, 3, 4, None)} == {2: 1, 3: 1, 4: 1, None: 6}
    none = lm.score(df.withColumn("held", F.lit(True)), "held").collect()
    assert all(r.score == 0 and r.base_score == 0 and r.train_tokens == 0 for r in none)
    assert lm.score(df.limit(0), "held").count() == 0


# ---- pipeline


def test_pipeline(spark, sf_dir, words):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        if name == "packing":
            packed_right(out.collect(), token_ids([(i, r.text) for i, r in before.items()]))
            break
        assert out.columns == columns
        rows = [tuple(r) for r in out.collect()]
        assert all(tuple(before[r[0]]) == r for r in rows) and len(rows) > 0.5 * len(before)
        if name == "n-gram Jaccard join":
            classes = brute_classes([(i, r.text) for i, r in before.items()], words, 5, 80, 100)
            assert {r[0] for r in rows} == {i for i, (_, root) in classes.items() if i == root}
        docs = spark.createDataFrame(rows, docs.schema)


def test_pipeline_on_odd_tables(spark, sf_dir, odd_docs):
    """Nulls in any column, empty and very long texts, repeated rows, clashing names, empty tables."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    told, quality_, joined, packed = (stage for _, stage in corpus_pipeline.STAGES)
    ids = lambda df: sorted((r.doc_id for r in df.collect()), key=str)
    out = told(spark, odd_docs, sf_dir)
    assert out.columns == odd_docs.columns and ids(out) == sorted([1, 5, 5, 6, 7, 8, None], key=str)
    out = quality_(spark, odd_docs, sf_dir)
    assert out.columns == odd_docs.columns and set(ids(out)) <= set(ids(odd_docs))
    out = joined(spark, odd_docs.unionByName(odd_docs.where("doc_id is null")), sf_dir)
    assert out.columns == odd_docs.columns and ids(out) == sorted([1, 2, 3, 4, 6, 7, 8, None], key=str)
    assert {r.doc_id for r in packed(spark, odd_docs, sf_dir).collect()} == set(ids(odd_docs))
    for stage in (told, quality_, joined, packed):
        assert stage(spark, odd_docs.limit(0), sf_dir).count() == 0

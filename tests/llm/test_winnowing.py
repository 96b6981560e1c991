"""Winnowing against the definition (a minimum and its rightmost place per
window), the guarantee, and the order of documents."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quartermaster.llm import winnowing as W


def grams_of(spark, texts, k=W.GRAM):
    """(hash of each gram) by Spark's own hash functions, per text."""
    out = []
    for t in texts:
        ws = re.findall(r"[^ \t-\r]+", t.lower())
        n = max(1, len(ws) - k + 1) if ws else 0
        out.append([ws[i:i + k] for i in range(n)])
    flat = [(i, j, g) for i, gs in enumerate(out) for j, g in enumerate(gs)]
    if not flat:
        return [[] for _ in texts]
    h = spark.createDataFrame(flat, "i long, j long, g array<string>") \
        .withColumn("w", F.transform("g", lambda x: F.xxhash64(x))) \
        .withColumn("h", F.xxhash64(*(F.get("w", F.lit(k_)) for k_ in range(k)))).select("i", "j", "h").collect()
    res = [[0] * len(gs) for gs in out]
    for r in h:
        res[r.i][r.j] = r.h & 0xFFFFFFFF
    return res


def plain_winnow(hashes, w=W.WINDOW):
    kept = []
    for a in range(max(1, len(hashes) - w + 1) if hashes else 0):
        window = hashes[a:a + w]
        low = min(window)
        p = a + max(i for i, x in enumerate(window) if x == low)
        if (low, p) not in kept:
            kept.append((low, p))
    return [(h - (1 << 32) if h >> 31 else h, p) for h, p in kept]


def made_texts():
    rng = random.Random(15)
    texts = ["", " \n", "one", "a b c d", "A b C d e", "a b c d e f", "x " * 50]
    return texts + [" ".join(rng.choice(["the", "of", "é", "and", "x,", "y"]) for _ in range(rng.randint(1, 70))) for _ in range(40)]


def test_winnow_matches_definition(spark):
    texts = made_texts()
    got = W.winnow(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string"), "t", "kept").collect()
    want = [plain_winnow(h) for h in grams_of(spark, texts)]
    for r in got:
        assert [(x["hash"], x["pos"]) for x in r.kept] == want[r.i], texts[r.i]


def test_guarantee(spark):
    """A shared run of GRAM + WINDOW - 1 words always leaves a shared hash."""
    rng = random.Random(16)
    rows = []
    for i in range(120):
        run = [f"s{rng.randint(0, 9)}" for _ in range(W.GRAM + W.WINDOW - 1)]
        pad = lambda: [f"p{rng.random()}" for _ in range(rng.randint(0, 9))]
        rows.append((i, " ".join(pad() + run + pad()), " ".join(pad() + run + pad())))
    d = W.winnow(W.winnow(spark.createDataFrame(rows, "i long, a string, b string"), "a", "x"), "b", "y")
    assert d.filter(F.size(F.array_intersect("x.hash", "y.hash")) == 0).count() == 0


def test_edited_texts(spark, tmp_path):
    texts = made_texts()
    docs = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in W.op5_fingerprints(spark, str(tmp_path)).collect()}
    ids = sorted(got, reverse=True)
    jac = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    nxt = {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}
    edited = {}
    for i in ids:
        t, n = texts[i // 3], texts[nxt[i] // 3]
        edited[i] = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
    kept = {i: {h for h, _ in plain_winnow(g)} for i, g in zip(ids, grams_of(spark, [texts[i // 3] for i in ids]))}
    kept_e = {i: {h for h, _ in plain_winnow(g)} for i, g in zip(ids, grams_of(spark, [edited[i] for i in ids]))}
    for i in ids:
        r = got[i]
        assert r.n_chars == len(texts[i // 3]) and r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert abs(r.near_edited - jac(kept[i], kept_e[i])) < 1e-12 and abs(r.near_next - jac(kept[i], kept[nxt[i]])) < 1e-12
    same = {}
    for i in ids:
        assert same.setdefault(texts[i // 3], got[i].fingerprint) == got[i].fingerprint


def test_edges(spark, edge_docs, no_docs):
    assert W.edited_pairs(no_docs).count() == 0
    got = W.edited_pairs(edge_docs)
    assert got.count() == edge_docs.count()
    one = W.edited_pairs(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert [r.edited for r in one] == ["abcdab"]


def test_texts_without_white_space(spark):
    """Two thirds of a text in one word stay: most hashes are shared, and a
    passage that is moved inside other text is found."""
    rng = random.Random(17)
    alphabets = {"han": [chr(0x4E00 + i) for i in range(2000)], "kana": [chr(0x3041 + i) for i in range(80)],
                 "thai": [chr(0x0E01 + i) for i in range(46)], "code": list("abcdefghijklmnopqrstuvwxyz0123456789(){};=.,+"),
                 "emoji": [chr(0x1F300 + i) for i in range(200)]}
    rows = []
    for name, chars in alphabets.items():
        make = lambda n: "".join(rng.choice(chars) for _ in range(n))  # noqa: E731,B023
        text, passage = make(600), make(20)
        rows.append((name, text, text[:400] + make(200), make(45) + passage + make(51), make(38) + passage + make(40)))
    d = spark.createDataFrame(rows, "name string, a string, b string, c string, d string")
    for x in "abcd":
        d = W.winnow(d, x, f"k{x}")
    got = d.select("name", W.likeness(F.col("ka.hash"), F.col("kb.hash")).alias("near"), W.likeness(F.col("ka.hash"), F.col("kc.hash")).alias("far"),
                   F.size(F.array_intersect("kc.hash", "kd.hash")).alias("shared"), F.size("ka").alias("n")).collect()
    assert len(got) == len(alphabets)
    for r in got:
        assert 0.4 < r.near < 0.6 and r.far < 0.02 and r.shared >= 1 and r.n > 200, r


def test_no_border_of_length(spark):
    """One character more or less leaves most hashes of a word, at every length."""
    rng = random.Random(18)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(90))
    least = W.GRAM + W.WINDOW + W.SPAN - 2
    rows = [(n, text[:n], text[:n + 1], text[1:n + 1], "the of and to " + text[:n] + " in a is") for n in range(2, 90)]
    d = spark.createDataFrame(rows, "n int, a string, b string, c string, d string")
    for x in "abcd":
        d = W.winnow(d, x, f"k{x}")
    both = lambda x, y: F.size(F.array_intersect(f"k{x}.hash", f"k{y}.hash"))
    for r in d.select("n", F.size("ka").alias("size"), *(both("a", x).alias(x) for x in "bcd")).collect():
        if r.n > least:
            assert min(r.b, r.c, r.d) >= max(1, r["size"] - 4), r


def test_only_built_in_functions(spark):
    plan = W.op5_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("MapInPandas", "MapInArrow", "PythonUDF", "ArrowEval"))

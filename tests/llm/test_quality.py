"""The classifier: held-out accuracy, features against a plain count, edges."""

import random
import re
import zlib

import numpy as np
import pytest

from quartermaster.llm import quality as Q


@pytest.fixture(scope="module")
def sample(spark):
    """Clean prose against shouting and lists of marks."""
    rng = random.Random(8)
    words = ["".join(rng.choice(["tha", "re", "on", "ing", "ed", "wh", "o"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        ws = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        good = i % 4 != 0
        if not good:
            ws = [w.upper() + "!!" for w in ws] if i % 8 else [w + rng.choice(["***", "$$$"]) for w in ws]
        docs.append((i, " ".join(ws).capitalize() + "." if good else " ".join(ws)))
        labels.append((i, int(good)))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy(sample):
    docs, labels = sample
    rows = Q.classify(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 60 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_are_not_learnt(sample):
    docs, labels = sample
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(Q.train(docs, labels), Q.train(docs, turned))


def test_ftrl_matches_plain_loop():
    rng = np.random.default_rng(9)
    model = Q.Ftrl(16)
    z, n = [0.0] * 17, [0.0] * 17
    for _ in range(200):
        at = np.sort(rng.choice(17, 5, replace=False))
        x, y = rng.random(5), float(rng.integers(0, 2))
        model.learn(at, x, y)
        w = [0.0 if abs(z[i]) <= Q.L1 else -(z[i] - np.sign(z[i]) * Q.L1) / ((Q.BETA + n[i] ** .5) / Q.ALPHA + Q.L2) for i in at]
        p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x))))
        for k, i in enumerate(at):
            g = (p - y) * x[k]
            z[i] += g - ((n[i] + g * g) ** .5 - n[i] ** .5) / Q.ALPHA * w[k]
            n[i] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_ngrams_depend_on_the_text_alone():
    texts = [b"The cat sat, the CAT sat!", b"", b"x", "é ü 漢 ok".encode(), b"a  a\na ** a"]
    row, feature = Q.ngrams(texts)
    for i, t in enumerate(texts):
        alone = Q.ngrams([t])[1]
        assert sorted(feature[row == i].tolist()) == sorted(alone.tolist())
        tokens = len(re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^\sA-Za-z0-9\x80-\xff]+", t))
        assert len(alone) == tokens + 2 * max(0, tokens - 1) + max(0, tokens - 2)


def test_long_text_scores_like_its_parts():
    w = np.random.default_rng(0).normal(size=1 << Q.BITS)
    long = b"some words here, " * 200_000
    s = Q._sums([long, b"some words here, " * 2000], w)
    assert abs(s[0] - s[1]) < 0.01 * abs(s[1]) + 0.01


def test_edges(spark, edge_docs, no_docs, sample):
    _, labels = sample
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.classify(edge_docs, none).collect()
    assert len(got) == edge_docs.count() and {r.score for r in got} == {0.5}
    assert Q.classify(no_docs, labels).count() == 0
    assert all(not r.held_out for r in got if r.doc_id is None)
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 0), (1, 1), (99_999, 0)], "doc_id long, quality int")
    assert Q.classify(edge_docs, odd).count() == edge_docs.count()
    kept = Q.keep_good(edge_docs, none)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_long_texts_lose_no_ngram(monkeypatch):
    """Cut into pieces of any length, a text has the n-grams of the whole."""
    rng = random.Random(31)
    bits = ["word", "Word", " ", " ", "\n", "!!", "a1", "99", "-", "é", "\x00", "wordwordword", "x"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 80))).encode()
        monkeypatch.setattr(Q, "_PIECE", 1 << 18)
        whole = np.sort(np.concatenate(list(Q._features_of(text)) or [np.empty(0, np.int64)]))
        assert np.array_equal(whole, np.sort(Q.ngrams([text])[1]))
        monkeypatch.setattr(Q, "_PIECE", rng.randint(1, 40))
        assert np.array_equal(whole, np.sort(np.concatenate(list(Q._features_of(text))))), text


def test_scores_against_a_plain_count(spark, sample):
    """Score = sigmoid of the weights of a text's n-grams, averaged and scaled."""
    docs, labels = sample
    w = Q.train(docs, labels).astype(np.float64)
    got = {r.doc_id: r.score for r in Q.score(docs, w.astype(np.float32)).collect()}
    for r in docs.limit(50).collect():
        f = Q.ngrams([r.text.encode()])[1]
        x = Q.SCALE * sum(w[i] for i in f.tolist()) / max(1, len(f)) + w[-1]
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-x))) < 1e-9


def test_words_and_pairs_against_a_plain_cut():
    """As many single words and pairs as a plain reading of the text finds."""
    for text in ("One two, THREE!! four4 - five", "", "  ", "a", "a b", "é1é ... \t x"):
        tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+", text.encode())
        n = len(tokens)
        assert len(Q.ngrams([text.encode()])[1]) == n + 2 * max(n - 1, 0) + max(n - 2, 0)


def test_columns_with_names_of_its_own(spark, sample):
    docs, labels = sample
    from pyspark.sql import functions as F
    more = docs.withColumn("__accepted", F.lit("mine"))
    kept = Q.keep_good(more, labels)
    assert kept.columns == more.columns and {r["__accepted"] for r in kept.collect()} == {"mine"}

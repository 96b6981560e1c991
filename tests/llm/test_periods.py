"""Periodic runs against comparing all words at all distances."""
import hashlib
import random
import re
import zlib

import pytest

from quartermaster.llm import periods as P

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s = w[i:j + q]
            if len(s) >= max(6, 4 * q) and all(s[d:] != s[:-d] for d in range(1, q)):
                out.append((i, len(s), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_against_all_distances():
    rng = random.Random(11)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            x = []
            for _ in range(rng.randint(0, 4)):
                a = rng.choice([1, 2, 3, 50])
                x += [rng.randrange(a) for _ in range(rng.randint(0, 20))]
                q = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 40, 64, 65])
                block = [rng.randrange(a) for _ in range(q)]
                x += [block[i % q] for i in range(rng.choice([4 * q - 1, 4 * q, 4 * q + 1, 3 * q, 5 * q, 6 * q + 2]))]
            texts.append([f"w{i}" for i in x])
        sizes, found, kept = P._search([" ".join(x).encode() for x in texts])
        assert sizes == [len(x) for x in texts]
        assert found == [plain_runs(x) for x in texts]
        assert kept == [collapsed(x, r) for x, r in zip(texts, found)]


@pytest.mark.parametrize("q", [1, 5, 8, 9, 16, 17, 100, 1000, 4097])
def test_one_long_run(q):
    block = [f"p{i}" for i in range(q)]
    n = max(6, 4 * q)
    words = ["x", "y"] + [block[i % q] for i in range(n)] + ["z"]
    assert P._search([" ".join(words).encode()])[1] == [[(2, n, q)]]
    del words[-2]  # one word short of four periods
    assert P._search([" ".join(words).encode()])[1] == [[]]


def test_edges(spark, edge_docs, no_docs):
    out = P.periodic_runs(edge_docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = []
    for doc, text in edge_docs.select("doc_id", "text").collect():
        w = WORD.findall(text or "")
        r = plain_runs(w) if len(w) < 5000 else []
        want.append((doc, len(w), [tuple(x) for x in r], collapsed(w, r)))
    assert [(a, b, [tuple(x) for x in c], d) for a, b, c, d in got if b < 5000] == sorted((x for x in want if x[1] < 5000), key=repr)
    assert P.periodic_runs(no_docs).collect() == []
    assert P.with_planted_periods(no_docs).collect() == []


def test_null_ids_are_left_as_they_are(spark):
    df = spark.createDataFrame([(None, "a b  c d e f g h")], "doc_id long, text string")
    assert P.with_planted_periods(df).collect()[0]["text"] == "a b  c d e f g h"


def test_query_on_whole_table(spark):
    want = []
    for doc, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w = WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = plain_runs(w)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        want.append((doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, found).encode()).hexdigest()))
    got = P.op13_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[1] for r in want) > 5

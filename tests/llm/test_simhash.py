"""SimHash against plain definitions: fingerprints bit by bit, links and
components by comparing every two fingerprints."""

import random

import numpy as np
import xxhash

from quartermaster.llm import simhash as S


def plain_fingerprint(text):
    ws = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
          .translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not ws:
        return 0
    shingles = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    """item -> smallest index among the items that links reach"""
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = i, j
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
    for i in range(len(fps)):
        while root[i] != root[root[i]]:
            root[i] = root[root[i]]
    return root


def test_fingerprint_matches_definition(monkeypatch):
    rng = random.Random(1)
    texts = ["", " \n ", "One", "A b C", "a b c d", "É é X\x0bY\x0cz w v", "a b c d " * 9]
    texts += [" ".join(rng.choice(["Aa", "bb", "c", "É", "dd\tee"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    for t in texts:
        assert S.fingerprint(t.encode()) == plain_fingerprint(t)
    monkeypatch.setattr(S, "_LONG_TEXT", 40)  # long texts come in pieces
    for t in texts:
        assert S.fingerprint(t.encode()) == plain_fingerprint(t)


def test_long_texts_of_few_words():
    """Words longer than a piece of a long text, and short first pieces."""
    long, other = "q" * (S._LONG_TEXT + 1000), "z" * (S._LONG_TEXT + 1000)
    texts = [long, other, f" {long}\n", f"data: {long}", f"data: {other}", f"a b {long}", f"a b {long} c d e",
             f"{long} a {other} b c", " " * S._LONG_TEXT + " a b", "a" + " " * S._LONG_TEXT + "b c", "\n" * (S._LONG_TEXT + 9)]
    got = [S.fingerprint(t.encode()) for t in texts]
    assert got == [plain_fingerprint(t) for t in texts]
    assert got[0] != got[1] and got[3] != got[4] and got[0] != 0 and got[0] == got[2]


def test_anchors_cover_every_link():
    """Any two fingerprints within four bits share an anchor."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
    y = x.copy()
    for r in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y[r] ^= np.uint64(1) << np.uint64(b)
    def sets(v):
        out = [set() for _ in v]
        for i, k in zip(*S.anchors(v)):
            out[i].add(int(k))
        return out
    assert all(a & b for a, b in zip(sets(x), sets(y)))


def test_links_and_components_match_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    fps = []
    for _ in range(40):  # chains, clusters and single ones
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            fps.append(f)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
    fps = sorted(set(fps))
    want = plain_components(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for part in (S.PART, 7):  # also with every anchor of more than 7 items cut into parts
        monkeypatch.setattr(S, "PART", part)
        comp = {r.node: r.component for r in S.connected_components(S.links(df), "a", "b").collect()}
        groups = {}
        for f, w in zip(signed, want):
            groups.setdefault(w, set()).add(comp.get(f, f))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_near_duplicates_on_edges(spark, edge_docs, no_docs):
    got = S.near_duplicates(edge_docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and S.near_duplicates(no_docs).count() == 0
    rows = [tuple(r) for r in got.collect()]
    src = [(r.doc_id, r.text or "") for r in edge_docs.collect()]
    assert len(rows) == len(src)
    fps = [plain_fingerprint(t) for _, t in src]
    root = plain_components(fps)
    low = {}
    for (i, _), r in zip(src, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    want = sorted(((i, f"{f:016x}", low.get(r)) for (i, _), f, r in zip(src, fps, root)), key=repr)
    assert sorted(rows, key=repr) == want


def test_keep_one(spark, edge_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and 5 not in ids and {1, 2, 4, 9} <= set(ids)


def test_keep_one_and_rows_without_id(spark):
    """A row without id stays only where its group has no row with one."""
    t, u, v = ("one two three four five six", "seven eight nine ten eleven", "twelve thirteen fourteen fifteen")
    rows = [(1, t), (None, t), (None, u), (None, u), (None, v), (2, v), (3, t), (4, v), (4, v), (5, u + " x y z w"), (5, u + " x y z w")]
    docs = spark.createDataFrame([(i, x, k) for k, (i, x) in enumerate(rows)], "doc_id long, text string, __id int")
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted([(1, t), (None, u), (2, v), (5, u + " x y z w")], key=repr)

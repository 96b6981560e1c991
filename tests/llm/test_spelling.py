"""Spelling variants against trying every pair of words."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quartermaster.llm import spelling as S

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, ratio=2):
    """``{word: (form, root, n, n_near, form_n)}`` by way of all words with one letter left out."""
    by_part = {}
    for w in counts:
        for i in range(len(w)):
            by_part.setdefault((w[:i] + "*" + w[i + 1:]), set()).add(w)
            if w[:i] + w[i + 1:] in counts:
                by_part.setdefault((w, w[:i] + w[i + 1:]), {w, w[:i] + w[i + 1:]})
    near = {w: set() for w in counts}
    for group in by_part.values():
        for a in group:
            near[a] |= group - {a}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), form[w] and counts[form[w]])
    return out


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def some_words(rng, many, letters="abcé", least=5, most=8):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.randrange(1, 60) for _ in range(many)}


def test_edit_checks():
    rng = random.Random(4)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))
        b = "".join(rng.choice("ab") for _ in range(len(a) + rng.randint(0, 1)))
        check = S.one_replaced if len(a) == len(b) else S.one_inserted
        assert bool(check(S.letters([a]), S.letters([b]))[0]) == one_edit(a, b)


def test_tree_reaches_all_within_one_edit():
    rng = random.Random(5)
    words = sorted(w for w in some_words(rng, 3000, "abcdefgh", 7, 7))
    tree = S.Tree(S.letter_counts(S.letters(words)), 8)
    shorter = sorted({w[:i] + w[i + 1:] for w in words[::7] for i in range(7)})
    for asked in (words, shorter):
        i, j = S.near_pairs(tree, S.letters(words), S.letters(asked))
        got = {(asked[a], words[b]) for a, b in zip(i.tolist(), j.tolist())}
        assert len(got) == len(i)
        some = rng.sample(asked, 200)
        assert {p for p in got if p[0] in set(some)} == {(a, b) for a in some for b in words if one_edit(a, b)}


@pytest.mark.parametrize("cell,part", [(1 << 14, 1 << 16), (40, 1 << 16), (40, 16), (1 << 14, 100)])
def test_against_all_pairs(spark, monkeypatch, cell, part):
    """Also with many cells, and with cells that are cut into parts."""
    monkeypatch.setattr(S, "CELL", cell)
    monkeypatch.setattr(S, "PART", part)
    counts = some_words(random.Random(cell + part), 1500)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(S.spelling_variants(df)) == plain(counts)


def test_sample_that_misses_lengths(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE", 30)
    monkeypatch.setattr(S, "PART", 64)
    counts = some_words(random.Random(6), 800)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(S.spelling_variants(df)) == plain(counts)


def test_chains_and_ties(spark):
    counts = {"abcdef": 100, "abcdeg": 50, "abcdhg": 25, "abcihg": 12, "zzzzzz": 40, "zzzzz": 20, "zzzzzy": 40, "漢字漢字漢": 9, "漢字漢字": 4,
              "x" * 3000: 8, "x" * 2999 + "y": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = found(S.spelling_variants(df))
    assert got == plain(counts)
    assert got["abcihg"][1] == "abcdef" and got["zzzzz"][0] == "zzzzzy" and got["漢字漢字"][0] == "漢字漢字漢"


def plain_counts(docs, spoil):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if spoil and h % spoil == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


@pytest.mark.parametrize("spoil", [0, 3, 97])
def test_counts(spark, spoil):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert {r[0]: r[1] for r in S.count_words(docs, spoil=spoil).collect()} == plain_counts(rows, spoil)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = plain(plain_counts(rows, 97))
    assert found(S.op12_spelling_variants(spark, SF)) == want
    assert sum(v[0] is not None for v in want.values()) > 5


def test_edges(spark, edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert found(S.spelling_variants(S.count_words(edge_docs, spoil=3))) == plain(plain_counts(rows, 3))
    assert S.spelling_variants(S.count_words(no_docs)).collect() == []
    odd = spark.createDataFrame([("ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜß àéîõü", 1)], "text string, doc_id long")
    assert found(S.spelling_variants(S.count_words(odd))) == {"ÀÉÎÕÜ": (None, "ÀÉÎÕÜ", 3, 0, None)}
    missing = spark.createDataFrame([(None, 5, 1), ("", 3, 1), ("abcde", 4, 1)], "word string, n long, form long")
    assert found(S.spelling_variants(missing)) == {"abcde": (None, "abcde", 4, 0, None)}


def test_counts_of_letters():
    assert S.letter_counts(S.letters(["abà"])).sum() == 3
    assert np.array_equal(S.letter_counts(S.letters(["abc"])), S.letter_counts(S.letters(["cab"])))

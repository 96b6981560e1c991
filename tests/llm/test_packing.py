"""Packing against the tokenizers library and a plain account of the pieces."""
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermaster.llm import packing as P

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def check(pieces, docs, library, size=P.SIZE):
    """Every id of every document lies in one piece, in order; sequences have
    no gaps. Returns the sequences' lengths."""
    by_doc, by_sequence = {}, {}
    for doc, start, ids, total, sequence, offset in pieces:
        ids = np.frombuffer(ids, "<u4").tolist()
        by_doc.setdefault((doc, total), []).append((start, ids))
        by_sequence.setdefault(sequence, []).append((offset, len(ids)))
    want = {}
    for doc, text in docs:
        ids = ids_of(library, text)
        want.setdefault((doc, len(ids)), []).append(ids)
    assert set(by_doc) == set(want)
    for key, texts in want.items():
        # rows that share id and length: the same ids at the same places, whichever row a piece is of
        assert sorted((i, x) for s, p in by_doc[key] for i, x in enumerate(p, s)) == sorted((i, x) for t in texts for i, x in enumerate(t))
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= size
        lengths.append(at)
    return lengths


def test_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lengths = check([tuple(r) for r in P.pack(docs).collect()], [tuple(r) for r in docs.select("doc_id", "text").collect()], library)
    padding = sum(P.SIZE - n for n in lengths if n & (n - 1))
    assert padding <= 0.01 * sum(lengths)


def test_levels(spark, library, monkeypatch):
    """Open windows of many tasks are gathered over several levels."""
    monkeypatch.setattr(P, "GATHERED", 0)
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(40)))) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    pieces = [tuple(r) for r in P.pack(df, size=32, most_open=2, least_cut=4).collect()]
    lengths = check(pieces, docs, library, 32)
    assert sum(32 - n for n in lengths if n & (n - 1)) <= 0.06 * sum(lengths)


def test_edges(spark, library, edge_docs, no_docs):
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    out = P.pack(edge_docs)
    assert out.columns == ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    check([tuple(r) for r in out.collect()], docs, library)
    assert P.pack(no_docs).collect() == []


def test_windows():
    w = P.Windows(8, most=2, least_cut=2)
    put = lambda doc, n: [[(p[0], p[1], len(p[2]) // 4) for p in done] for done in w.put(doc, 0, b"\0\0\0\0" * n, n)]
    assert put("a", 19) == [[("a", 0, 8)], [("a", 8, 8)]]      # full windows at once, 3 left over
    assert put("b", 6) == []                                   # does not fit beside a: a second window
    assert put("c", 2) == [[("b", 0, 6), ("c", 0, 2)]]         # the least room that is enough
    assert put("d", 7) == []
    assert put("e", 6) == [[("d", 0, 7)]]                      # fits in none: the fullest goes, one place free is not cut for
    assert put("f", 7) == [[("e", 0, 6), ("f", 0, 2)], [("a", 16, 3), ("f", 2, 5)]]
    assert put("g", 7) == [] and put("h", 6) == []
    left = [[len(p[2]) // 4 for p in done] for done in w.join()]
    assert left == [[7, 1], [4], [1]]                          # 13 ids: a full window, then powers of two


def test_ids_equal_the_library(library):
    t = P.tokens(P.TOKENIZER)
    rng = random.Random(1)
    alphabet = list("ab C1'’s\n\t  .-é漢😀‍՘\U0001e6c0　\x1c\x85") + ["<|endoftext|>", "'ll", "  \n "]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert np.frombuffer(t.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character(library):
    """Texts of characters that are cut by pattern here and by the library there."""
    t = P.tokens(P.TOKENIZER)
    for low in range(0, 0x30000, 1024):
        chars = [chr(c) for c in range(low, low + 1024) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b 1{c}2 !{c} {c}" for c in chars)
        assert np.frombuffer(t.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, hex(low)


def test_long_texts_are_cut_where_no_token_reaches(library, monkeypatch):
    monkeypatch.setattr(P, "_LONG", 16)
    t = P.tokens(P.TOKENIZER)
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("ab'  \n\t1.") for _ in range(200))
        assert np.frombuffer(t.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_query(spark):
    out = P.op11_packing(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.filter((F.col("length") < 1) | (F.col("ids_crc32") < 0)).count() == 0


def test_full_tables_keep_common_words(library, monkeypatch):
    monkeypatch.setattr(P, "MEMO", 5)
    import public_tokenizers
    t = P.Tokens(public_tokenizers.path(P.TOKENIZER), public_tokenizers.PATTERN)
    rng = random.Random(6)
    for _ in range(200):
        text = " ".join(rng.choice(["the", "of,", "and", "x1", "'s", "über", "wörd", "a\nb"]) + rng.choice(["", "", "q", "!"]) for _ in range(30))
        assert np.frombuffer(t.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(t.after_space) <= 5 and len(t.after_space.old) <= 5

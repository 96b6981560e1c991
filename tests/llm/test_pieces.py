"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quartermaster.llm import pieces as P


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.model_path())


@pytest.fixture(scope="module")
def model():
    return P.load(P.model_path())


def agree(model, library, text):
    ids = library.encode(text) + [library.eos_id()]
    assert model.encode(text).tolist() == ids, text[:80]
    assert model.decode(model.encode(text)) == library.decode(ids), text[:80]


def test_made_texts(model, library):
    rng = random.Random(4)
    alphabet = " \n\tabcdefghijklmnopqrstuvwxyz  éüñ▁漢字😀\x00ABC123.,!<>/_'\""
    for _ in range(4000):
        agree(model, library, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))))
    for n in range(0, 200, 3):
        for t in (" " * n, " " * n + "the", "a" * n, "=" * n, "\n" * (n % 7) + " " * (n % 5) + "x", "ab" * n):
            agree(model, library, t)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)))
def test_any_text(t):
    agree(P.load(P.model_path()), sentencepiece.SentencePieceProcessor(model_file=P.model_path()), t)


def test_backtracking_alone(model):
    """The walk gives what merging gives, without the tables of units."""
    rng = random.Random(5)
    for _ in range(1500):
        t = "▁" + "".join(rng.choice("etaoinshrdluc▁") for _ in range(rng.randint(1, 24)))
        assert model.backtrack(t) == model.merge(t)


def test_bytes_that_are_no_text(model, library):
    import numpy as np
    for ids in ([259, 230, 130, 172, 400, 2, 131, 500], [258, 258], [198, 131], [], [2]):
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_full_tables_start_anew(library):
    own = P.Pieces(P.model_path())
    own.units.most = own.agree.most = 5
    for t in ("the quick brown fox", "jumps over the lazy dog " * 5):
        agree(own, library, t)


def test_edges(edge_docs, no_docs, library):
    assert P.encode_decode(no_docs).count() == 0
    got = P.digests(P.encode_decode(edge_docs), "ids").collect()
    src = [(r.doc_id, r.text or "") for r in edge_docs.collect()]
    def want(t):
        ids = library.encode(t) + [2]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=repr) == \
        sorted(((i, *want(t)) for i, t in src), key=repr)
    assert all(len(r.ids) == r.n_tokens for r in got)

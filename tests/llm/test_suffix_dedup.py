"""Suffix dedup: the index against comparing every two suffixes, the whole
operator against looking every window up."""

import random

import numpy as np

from quartermaster.llm import anchors as A
from quartermaster.llm import suffix_dedup as S
from quartermaster.llm.run_index import RunIndex, suffix_order


def plain_statistics(t):
    out = []
    for i in range(len(t)):
        best = 0
        for j in range(len(t)):
            k = 0
            while j != i and i + k < len(t) and j + k < len(t) and t[i + k] == t[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_run_index():
    rng = random.Random(17)
    for _ in range(150):
        al = rng.choice([b"a", b"ab", b"abc\xff", bytes(range(256))])
        t = bytes(rng.choice(al) for _ in range(rng.randint(0, 70)))
        if rng.random() < 0.5:
            t = t + t[:len(t) // 2] + t
        a = np.frombuffer(t, np.uint8)
        assert [t[i:] for i in suffix_order(a)] == sorted(t[i:] for i in range(len(t)))
        index = RunIndex(a)
        assert index.matching_statistics().tolist() == plain_statistics(t)
        assert len(index.heads) <= max(1, len(t))


def plain_spans(texts, length=S.LENGTH):
    count = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            count[t[s:s + length]] = count.get(t[s:s + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                gone[s:s + length] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int))))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out


def made_texts():
    rng = random.Random(18)
    word = lambda: "".join(rng.choice(["th", "é", "on", "re", "漢"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(70), prose(45)
    texts = ["", "short", prose(300), "ab" * 400, "ab" * 300 + prose(40), "x" * 199, "x" * 200, "x" * 201]
    texts += [prose(rng.randint(0, 60)) + passage + prose(rng.randint(0, 60)) for _ in range(12)]
    texts += [prose(20) + passage[:250] + other + passage[100:] for _ in range(4)]
    base = prose(200).split(" ")
    for _ in range(6):
        near = list(base)
        near[rng.randrange(len(near))] = "CHANGED"
        texts.append(" ".join(near))
    return texts + [texts[2]]


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in S.dedup(docs).collect()}


def check(spark, texts):
    got = run(spark, texts)
    raw = [t.encode() for t in texts]
    for i, want in enumerate(plain_spans(raw)):
        assert [(s.start, s.end) for s in got[i].spans] == want, i
        ends, starts = [0, *(b for _, b in want)], [*(a for a, _ in want), len(raw[i])]
        assert bytes(got[i].kept) == b"".join(raw[i][a:b] for a, b in zip(ends, starts)) and got[i].n_bytes == len(raw[i])


def test_dedup_matches_brute_force(spark, monkeypatch):
    texts = made_texts()
    check(spark, texts)
    monkeypatch.setattr(S, "HOT", 3)  # common grams counted by digest
    check(spark, texts)
    monkeypatch.setattr(S, "BLOCK", 2000)  # many small indexes
    check(spark, texts)


def test_segments_divide_the_windows():
    texts = [t.encode() for t in made_texts()]
    text, first, windows, gram, content = A.segments(texts)
    for i, t in enumerate(texts):
        own = sorted((f, w) for x, f, w in zip(text.tolist(), first.tolist(), windows.tolist()) if x == i)
        at = 0
        for f, w in own:
            assert f == at
            at = f + w
        assert at == max(0, len(t) - 199)
    seen = {}
    for x, f, w, g in zip(text.tolist(), first.tolist(), windows.tolist(), gram.tolist()):
        for s in range(f, f + w):
            assert seen.setdefault(texts[x][s:s + 200], g) == g


def test_very_long_texts_come_in_parts():
    rng = np.random.default_rng(0)
    t = rng.integers(97, 123, 3 * A.PIECE // 2, dtype=np.uint8).tobytes()
    at = 0
    for batch, rows, offsets in A.pieces([b"short", t]):
        text, first, windows, _, _ = A.segments(batch)
        for f, w in sorted(zip((first + np.array(offsets)[text]).tolist(), windows.tolist())):
            assert f == at and rows == [1]
            at = f + w
    assert at == len(t) - 199


def test_edges(edge_docs, no_docs):
    assert S.dedup(no_docs).count() == 0
    got = S.dedup(edge_docs).collect()
    src = [(r.doc_id, (r.text or "").encode()) for r in edge_docs.collect()]
    key = lambda x: repr(x)
    want = sorted(((i, len(t), s) for (i, t), s in zip(src, plain_spans([t for _, t in src if len(t) < 10_000] or [b""]))
                   if len(t) < 0), key=key)
    assert want == [] and sorted((r.doc_id, r.n_bytes) for r in got if r.doc_id is not None) == \
        sorted((i, len(t)) for i, t in src if i is not None)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(len(r.kept))
    assert by[4] == [0] and by[5] == [0, 0] and by[2] == [0, 0] and by[9] == [3]


def test_blocks_of_whole_routes(monkeypatch):
    """Rows sorted by route in several batches: blocks end between routes,
    whatever their size, and every segment is judged with its whole route."""
    import pyarrow as pa
    rng = random.Random(19)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(230)).encode()
    rows = []
    for route in range(30):
        for k in range(rng.randint(1, 6)):
            own = "".join(rng.choice("abcdefgh ") for _ in range(260)).encode()
            rows.append((route, route % 3 == 0, len(rows), 0, 1000, shared + bytes([48 + k]) + own if route == 7 else own))
    schema = pa.schema([("route", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()), ("key", pa.int64()),
                        ("first", pa.int64()), ("bytes", pa.binary())])
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    for block in (1, 700, 5000, 1 << 20):
        monkeypatch.setattr(S, "BLOCK", block)
        out = pa.Table.from_batches(list(S._index_batches(iter(table.to_batches(max_chunksize=7))))).to_pylist()
        spans = {(r["doc_id"], r["start"], r["end"]) for r in out if r["digest"] is None}
        sevens = [i for i, r in enumerate(rows) if r[0] == 7]
        assert spans == ({(i, 1000, 1230) for i in sevens} if len(sevens) > 1 else set())
        digests = [r for r in out if r["digest"] is not None]
        assert all(r["alone"] for r in digests) and len(digests) == sum(261 - 200 for r in rows if r[1])

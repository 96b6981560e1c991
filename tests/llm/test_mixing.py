"""Mixing: targets against a plain water-filling, the mix against a plain
merge of queues."""

import hashlib
import random
import re

from quartermaster.llm import mixing as M


def plain_targets(sizes):
    """{source: size} -> {source: target}"""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        over_all = sum(weight[s] for s in order if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else weight[s] * left / over_all for s in order}
        more = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


def plain_mix(rows):
    """rows of (doc_id, source, size) -> list of (doc_id, size, source size, target, taken)"""
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    target = plain_targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    queue, cum = [], {s: 0 for s in sizes}
    u = lambda i: hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
    for k, (i, s, n) in sorted(enumerate(rows), key=lambda x: (u(x[1][0]), -1 if x[1][0] is None else x[1][0], x[1][2])):
        cum[s] += n
        for e in range(3):
            if cum[s] - n + e * sizes[s] < target[s]:
                queue.append(((cum[s] + e * sizes[s]) / target[s], order.index(s), u(i), -1 if i is None else i, e, k, n))
    total, used, copies = sum(sizes.values()), 0, {}
    for item in sorted(queue):
        used += item[-1]
        if used > total:
            break
        copies[item[-2]] = copies.get(item[-2], 0) + 1
    return [(i, n, sizes[s], target[s], n * copies.get(k, 0)) for k, (i, s, n) in enumerate(rows)]


def test_random_mixes(spark):
    rng = random.Random(14)
    for _ in range(3):
        rows = []
        for i in range(rng.randint(30, 200)):
            s = rng.choice(["a", "b", "b", "b", "c", "é", None, "Z"])
            rows.append((i, s, rng.choice([0, 1, 2, 5, 9, 40])))
        docs = spark.createDataFrame([(i, " \n".join(["w"] * n), s) for i, s, n in rows], "doc_id long, text string, source string")
        got = sorted((r.doc_id, r.size, r.source_size, round(r.target, 9), r.size * r.copies) for r in M.mix(docs).collect())
        assert got == sorted((i, n, ss, round(t, 9), k) for i, n, ss, t, k in plain_mix(rows))


def test_taken_words_come_near_the_targets(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[min(i % 20, 2)]) for i in range(3000)], "doc_id long, text string, source string")
    rows = M.mix(docs).collect()
    by = {}
    for r in rows:
        t = by.setdefault((min(r.doc_id % 20, 2), r.target), [0])
        t[0] += r.size * r.copies
        assert r.copies <= 3
    assert all(abs(v[0] - t) <= 10 for (_, t), v in by.items()) and sum(v[0] for v in by.values()) <= 30_000


def test_edges(edge_docs, no_docs):
    assert M.mix(no_docs).count() == 0
    a = sorted(map(tuple, M.mix(edge_docs).collect()), key=repr)
    assert a == sorted(map(tuple, M.mix(edge_docs).collect()), key=repr)  # reruns agree
    want = sorted(len(re.findall(r"[^ \t-\r]+", r.text or "")) for r in edge_docs.collect())
    assert sorted(r[2] for r in a) == want
    taken = M.take(edge_docs)
    assert taken.columns == edge_docs.columns
    empty = edge_docs.filter("doc_id = 3")
    assert [(r.target, r.copies) for r in M.mix(empty).collect()] == [(0.0, 0)]


def test_only_built_in_functions(spark):
    plan = M.op4_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("MapInPandas", "MapInArrow", "PythonUDF", "ArrowEval"))


def test_columns_with_names_of_its_own(spark):
    rows = [(k % 40 or None, f"text number {k} has words", "ab"[k % 2], k) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __id int")
    out = M.take(docs)
    assert out.columns == docs.columns and 40 <= out.count() <= 120

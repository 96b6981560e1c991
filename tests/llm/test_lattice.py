"""Lattice hashing: decoding against the nearest of many points, links,
counts and components against all cosines."""

import itertools

import numpy as np
import pytest

from quartermaster.llm import lattice as L


def test_nearest_point():
    rng = np.random.default_rng(19)
    y = rng.normal(size=(400, 8)) * 1.5
    near = L.nearest_e8(y)
    twice = np.rint(2 * near).astype(int)
    assert ((twice % 2 == 0).all(1) | (twice % 2 == 1).all(1)).all() and (near.sum(1) % 2 == 0).all()
    d = ((y - near) ** 2).sum(1)
    # a point is the nearest when none of its 240 + 2160 neighbours is nearer
    short = L._minimal()
    assert len({tuple(v) for v in short}) == 240
    longer = np.array([v for v in (a + b for a, b in itertools.product(short[:60], short)) if 3.9 < (v ** 2).sum() < 4.1])
    for far in (short, longer):
        assert (((y[:, None] - near[:, None] - far[None]) ** 2).sum(2).min(1) >= d - 1e-9).all()


def vectors(rng, dims=64):
    base = rng.normal(size=(60, dims))
    rows = list(base)
    for c, copies in ((0, 40), (1, 3), (2, 3), (3, 12)):
        for _ in range(copies):
            v = base[c] / np.linalg.norm(base[c]) + rng.normal(size=dims) * 0.02
            rows.append(v * rng.uniform(0.2, 5))
    chain = base[4] / np.linalg.norm(base[4])
    for _ in range(12):
        step = rng.normal(size=dims)
        chain = chain + 0.22 * step / np.linalg.norm(step)
        chain /= np.linalg.norm(chain)
        rows.append(chain)
    return [[float(x) for x in v] for v in rows] + [rows[0].tolist()] * 5


def plain(rows):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for a, b in itertools.combinations(ok, 2):
        x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
        if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95:
            links[a].add(b)
            links[b].add(a)
    return links


@pytest.mark.parametrize("part", [L.PART, 5])
def test_links_match_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(L, "PART", part)
    rows = list(enumerate(vectors(np.random.default_rng(20))))
    got = {r.vec_id: r for r in L.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    links = plain(rows)
    found, there = sum(r.n_links for r in got.values()), sum(map(len, links.values()))
    assert 0.97 * there <= found <= there
    assert all(got[i].n_links <= len(links[i]) for i in got)
    for i in got:  # a component never joins what no link joins
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got[i].component_id in seen and got[i].kept == (got[i].component_id == i)
    big = [got[i].component_id for i in range(60, 100)]
    assert set(big) == {0}


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.01]), (10, [1.0, 0.01]), (None, [1.0, 0.0]), (11, [-1.0, 0.0]), (12, [-0.0, 5.0])]
    docs = spark.createDataFrame([(i, v, 7, 8, 9) for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, component_id int, x int")
    got = sorted((tuple(r) for r in L.near_duplicates(docs).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11, 12)]
    assert got == sorted(alone + [(1, 4, 1, True), (2, 4, 1, False), (10, 4, 1, False), (10, 4, 1, False), (None, 4, 1, False)], key=repr)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert L.near_duplicates(none).count() == 0


def test_ids_that_repeat_and_extreme_values(spark):
    """Two vectors under one id link each for itself; copies scaled beyond
    what squares of doubles hold link all the same."""
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [5.0, 0.0, 0.0]), (3, [0.0, 7.0, 0.0]),
            (4, [1e200, 1e200, 3e200]), (5, [1e-200, 1e-200, 3e-200]), (6, [1.0, 1.0, 3.0]), (7, [5e-324, 5e-324, 1.5e-323])]
    got = sorted(tuple(r) for r in L.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False),
                   (4, 3, 4, True), (5, 3, 4, False), (6, 3, 4, False), (7, 3, 4, False)]

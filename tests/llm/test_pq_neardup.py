import random

import numpy as np
import pytest

from gatewright.llm import pq_neardup as op
from gatewright.llm.components import connected_components

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, links STRING"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, threshold=0.95):
    fine = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in fine])
    linked = (x @ x.T >= threshold) & ~np.eye(len(x), dtype=bool)
    found = {i: (0, i) for i, _ in rows}
    for k, (i, _) in enumerate(fine):
        seen, todo = {k}, [k]
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]):
                if j not in seen:
                    seen.add(int(j))
                    todo.append(int(j))
        found[i] = (int(linked[k].sum()), min(fine[j][0] for j in seen))
    return found


def made(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = [base[k % 40] + rng.normal(size=dim) * 0.15 for k in range(n // 2)]
    return [(int(i), [float(c) for c in np.float32(v)]) for i, v in enumerate([*base, *near])]


@pytest.mark.parametrize("n, dim", [(600, 32), (200, 7), (30, 1)])
def test_equals_brute_force(spark, n, dim, monkeypatch):
    monkeypatch.setattr(op, "MEMBER_BLOCK", 64)
    monkeypatch.setattr(op, "QUERY_BLOCK", 50)
    monkeypatch.setattr(op, "LIST_SIZE", 40)
    rows = made(n, dim)
    expected = brute(rows)
    found = {r.vec_id: (r.n_links, r.component_id) for r in op.near_duplicates(frame(spark, rows)).collect()}
    assert found.keys() == expected.keys()
    assert sum(found[i][0] for i in found) >= 0.99 * sum(n for n, _ in expected.values())
    assert all(found[i][0] <= expected[i][0] for i in found)
    assert np.mean([found[i] == expected[i] for i in found]) > 0.98


def test_odd_vectors(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [1.0, 0.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (8, [1e30, 1e29]), (9, [1.0, 2.0, 3.0]), (10, []), (11, [-0.0, 1.0]), (12, [0.0, 1.0]), (5, [1.0, 0.0])]
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op.near_duplicates(frame(spark, rows)).collect())
    near = {5: 4, 6: 4, 7: 4, 8: 4, 11: 1, 12: 1}
    smallest = {6: 5, 7: 5, 8: 5, 12: 11}
    assert found == sorted((i, near.get(i, 0), smallest.get(i, i), i not in smallest) for i, _ in rows)


def test_every_dimension_is_searched(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.0]), (5, [3.0, -1.0, 0.0])]
    rows += [(100 + i, v) for i, v in made(60, 4, 2)] + [(300 + i, v) for i, v in made(40, 9, 3)]
    expected = {}
    for dim in (2, 3, 4, 9):
        expected |= brute([r for r in rows if len(r[1]) == dim])
    found = {r.vec_id: (r.n_links, r.component_id) for r in op.near_duplicates(frame(spark, rows)).collect()}
    assert found[2] == (1, 1) and found[4] == (1, 3) and found.keys() == expected.keys()
    assert np.mean([found[i] == expected[i] for i in found]) > 0.98


def test_nothing_to_compare(spark):
    assert op.near_duplicates(frame(spark, [])).count() == 0
    assert [tuple(r) for r in op.near_duplicates(frame(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]
    assert op.near_duplicates(frame(spark, [(None, [1.0]), (2, [1.0])])).filter("component_id = 2 AND n_links = 1").count() == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(7, 7)]
    above = {n: n for e in edges for n in e}

    def root(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert found == {n: root(n) for n in linked}

import hashlib
import math

import numpy as np
import pytest

from gatewright.llm import hadamard_codes as op

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, code STRING, error INT, `of` INT"


def plain(rows, entries=op.ENTRIES, parts=op.PARTS, rounds=op.ROUNDS):
    """The rounds in Python's integers, without a transform. Rows are (id, vector, label)."""
    out = []
    kept = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for length in {len(v) for _, v, _ in kept}:
        mine = [(i, [math.floor(4096 * x) if abs(x) < 2**50 else int(x) * 4096 for x in v], label) for i, v, label in kept if len(v) == length]
        size = -(-length // parts)
        cut = [[tuple((v + [0] * parts)[p * size : (p + 1) * size]) if size else () for p in range(parts)] for _, v, _ in mine]
        books = [[c[p] for c in cut[:entries]] for p in range(parts)]

        def near(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(book))

        for _ in range(rounds):
            for p, book in enumerate(books):
                found = [near(c[p], book)[1] for c in cut]
                for e in set(found):
                    of = [c[p] for c, f in zip(cut, found) if f == e]
                    book[e] = tuple(sum(column) // len(of) for column in zip(*of))
        digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
        for (i, _, label), c in zip(mine, cut):
            found = [near(c[p], books[p]) for p in range(parts)]
            out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label, digest))
    totals = {}
    for _, _, error, label, _ in out:
        totals[label] = totals.get(label, 0) + error
    fits = lambda x: x if x < 2**63 else None
    return [(i, code, fits(error), fits(totals[label]), digest) for i, code, error, label, digest in out]


def same(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in op.compress(frame).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(found, key=key) == sorted(plain(rows), key=key)


def vectors(count, length, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    return (scale * rng.standard_normal((count, length))).tolist()


@pytest.mark.parametrize("width", [1, 2, 4, 8, 16, 64])
def test_coefficients_are_in_sequency_order(width):
    functions = op.walsh_hadamard(np.eye(width, dtype=np.int64)).T
    assert [(np.diff(f) != 0).sum() for f in functions] == list(range(width))
    assert (functions @ functions.T == width * np.eye(width)).all()


@pytest.mark.parametrize("top", [2, 10_000, 2**45])
@pytest.mark.parametrize("length", [1, 3, 8, 13])
def test_nearest_equals_all_distances(length, top):
    rng = np.random.default_rng(3)
    x, e = rng.integers(-top, top, (200, length)), rng.integers(-top, top, (16, length))
    e[9] = e[4]
    squares = ((x[:, None].astype(object) - e) ** 2).sum(axis=2)
    index, distance = op.nearest(x, e)
    assert (index == squares.argmin(axis=1)).all() and (distance == squares.min(axis=1)).all()


def test_codes_equal_the_plain_version(spark):
    rows = [(i, v, i % 3 or None) for i, v in enumerate(vectors(150, 64))]
    rows += [(500, None, 1), (501, [None] * 64, 1), (502, [float("nan")] * 64, 1), (503, [float("inf")] + [0.0] * 63, 2)]
    rows += [(7, rows[7][1], 1), (7, rows[7][1], 1), (None, rows[9][1], 2), (8, rows[30][1], 1), (600, [0.0] * 64, 2)]
    same(spark, rows)


def test_vectors_of_several_lengths(spark):
    rows = [(3 * i, v, 1) for i, v in enumerate(vectors(40, 10))] + [(3 * i + 1, v, 2) for i, v in enumerate(vectors(20, 24, 2))]
    same(spark, rows + [(1000, [], 3), (1001, [], 3), (1002, [0.5] * 3, 4)])


def test_fewer_vectors_than_entries(spark):
    same(spark, [(i, v, 1) for i, v in enumerate(vectors(5, 16))])


def test_components_beyond_64_bits(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(30, 16))] + [(100 + i, v, 5) for i, v in enumerate(vectors(12, 16, 4, 1e30))]
    same(spark, rows + [(300, [-(2.0**40)] * 16, 6)])


def test_limbs_add_up():
    for total in (0, 1, -1, 2**32, -(2**70) + 5, 3**80):
        assert sum(v << (op.LIMB * k) for k, v in op.limbs(total)) == total


def test_hot_labels_equal_joined_ones(spark):
    frame = spark.createDataFrame([(i, 1 if i % 3 else i % 7 or None, i) for i in range(500)], "vec_id INT, label INT, error BIGINT")
    rows = [sorted((r.vec_id, r.label_error) for r in op.with_label_error(frame, share).collect()) for share in (0.0, 0.2, 1.0)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 500


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)]):
        assert op.compress(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)).collect() == []

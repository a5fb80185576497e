import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gatewright.llm import balanced_shards as op

SCHEMA = "doc_id BIGINT, text STRING, size STRING, shard INT, slot STRING, bundle INT, weight INT, __row INT, of INT, task INT"


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2, 3, 4, 5, 6) for i, t in pairs], SCHEMA).repartition(3)


def plain_difference(weights, shards):
    """Differencing with lists that are searched and members that are copied."""
    rest = [(k, [(w, [k])] + [(0, [])] * (shards - 1)) for k, w in enumerate(weights)]
    number = len(rest)
    while len(rest) > 1:
        rest.sort(key=lambda p: (p[1][-1][0] - p[1][0][0], -p[1][0][0], p[0]))
        (_, one), (_, other) = rest[:2]
        joined = sorted(((a + b, x + y) for (a, x), (b, y) in zip(one, reversed(other))), key=lambda lane: -lane[0])
        rest = [*rest[2:], (number, joined)]
        number += 1
    out = [0] * len(weights)
    for shard, (_, members) in enumerate(rest[0][1] if rest else []):
        for k in members:
            out[k] = shard
    return out


@pytest.mark.parametrize("shards", [1, 2, 5, 24])
@pytest.mark.parametrize("count", [0, 1, 7, 120])
def test_differencing_equals_the_plain_version(count, shards):
    rng = np.random.default_rng(count)
    weights = rng.integers(1, 60, count).tolist()  # small, so that many tie
    assert op.difference(weights, shards) == plain_difference(weights, shards)


def test_many_items_end_within_a_byte_or_two():
    weights = np.random.default_rng(1).lognormal(7, 1, 5000).astype(int)
    sums = np.bincount(op.difference(weights.tolist()), weights=weights, minlength=24)
    assert sums.max() - sums.min() <= 2


def test_a_heavy_item_has_a_shard_of_its_own():
    weights = np.append(np.random.default_rng(2).integers(1, 500, 3000), 400_000)
    found = np.array(op.difference(weights.tolist()))
    assert (found == found[-1]).sum() == 1
    others = np.delete(np.bincount(found, weights=weights, minlength=24), found[-1])
    assert others.max() - others.min() <= 50


def checked(pairs, rows, shards=24):
    """Sizes, checksums, whole groups, gapless places; returns the bytes of each shard."""
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in pairs)
    texts = defaultdict(list)
    for i, t in pairs:
        texts[i].append((t or "").encode())
    group, slots, sizes = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        assert (r.size, r.text_crc32) in [(len(t) + 8, zlib.crc32(t)) for t in texts[r.doc_id]]
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id))
        sizes[r.shard] += r.size
        if len(set(texts[r.doc_id])) == 1:
            group[texts[r.doc_id][0]].add(r.shard)
    assert all(len(s) == 1 for s in group.values())
    for s in slots.values():
        assert [x[0] for x in sorted(s)] == list(range(len(s)))
        assert [x[1:] for x in sorted(s)] == sorted(x[1:] for x in s)  # by id, null first
    return [sizes[s] for s in range(shards)]


def some(count, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, "é" * int(n) + str(i)) for i, n in enumerate(rng.integers(0, 300, count))]


def test_groups_differenced_one_by_one_equal_the_plain_version(spark):
    pairs = some(300) + [(1000 + k, "copy" * 50) for k in range(40)]
    rows = op.shard_documents(docs(spark, pairs)).collect()
    sizes = checked(pairs, rows)
    weights = Counter()
    for _, t in pairs:
        weights[t] += len(t.encode()) + 8
    expected = np.bincount(plain_difference(sorted(weights.values()), 24), weights=sorted(weights.values()), minlength=24)
    assert sum(sizes) == sum(weights.values()) and max(sizes) - min(sizes) <= max(expected.max() - expected.min(), 40)


def test_bundles(spark):
    pairs = some(2000) + [(5000 + k, "a copy of which there are many") for k in range(700)]
    rows = op.shard_documents(docs(spark, pairs), shards=6, items=64).collect()
    sizes = checked(pairs, rows, 6)
    assert max(sizes) - min(sizes) < 0.02 * np.mean(sizes)


def test_a_group_with_a_third_of_all_bytes(spark):
    pairs = some(800) + [(5000 + k, "hot" * 100) for k in range(400)]
    sizes = sorted(checked(pairs, op.shard_documents(docs(spark, pairs), items=512).collect()))
    assert sizes[-1] == 400 * 308 and sizes[-2] - sizes[0] < 0.02 * sizes[0]


def test_nulls_ties_and_repeated_rows(spark):
    pairs = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y"), (None, None), (4, "long " * 40_000), (5, "x")]
    rows = op.shard_documents(docs(spark, pairs)).collect()
    checked(pairs, rows)
    assert len({r.shard for r in rows if r.doc_id in (1, 2)}) == 1


def test_empty_table(spark):
    frame = op.shard_documents(docs(spark, []))
    assert frame.count() == 0 and frame.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]

import random
import re

import numpy as np
import pytest

from gatewright.llm import ngram_join as op
from gatewright.llm import shingles
from gatewright.llm.components import Forest

SCHEMA = "doc_id BIGINT, text STRING, k STRING, n INT"


def plain_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def brute(pairs, size=4, percent=85):
    sets = [plain_set(t, size) for _, t in pairs]
    forest = Forest()
    for a in range(len(pairs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                forest.join(a, b)
    roots = [forest.root(k) for k in range(len(pairs))]
    least = {}
    for (i, _), r in zip(pairs, roots):
        least[r] = min(least.get(r, i), i)
    return sorted((i, len(s), least[r]) for (i, _), s, r in zip(pairs, sets, roots))


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(300)] + ["The", "of", "a"] * 30
    line = " ".join(rng.choice(vocabulary) for _ in range(15))
    texts = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        texts.append(" ".join(words) + (f"\n{line}" if rng.random() < 0.4 else ""))
    hub = [rng.choice(vocabulary) for _ in range(80)]
    for _ in range(n):
        copy = list(hub)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(80)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    for _ in range(40):
        words = texts[rng.randrange(len(texts))].split()
        if words:
            words[rng.randrange(len(words))] = "Q"
        texts.append("  ".join(words))
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in pairs], SCHEMA)


@pytest.mark.parametrize("seed, block", [(1, 640), (2, 16)])
def test_equals_brute_force(spark, seed, block, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", block)
    pairs = corpus(seed)
    found = sorted(map(tuple, op.similar_groups(frame(spark, pairs)).collect()))
    assert found == brute(pairs)


def test_other_parameters(spark):
    pairs = corpus(3, 60)
    assert sorted(map(tuple, op.similar_groups(frame(spark, pairs), 5, 80).collect())) == brute(pairs, 5, 80)


def test_odd_rows(spark):
    pairs = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "é É"), (8, "é é"), (9, "x " * 200_000), (10, "x " * 5)]
    assert sorted(map(tuple, op.similar_groups(frame(spark, pairs)).collect())) == brute(pairs)
    assert op.similar_groups(frame(spark, [])).count() == 0
    same = [(1, "a b c d e"), (1, "a b c d e"), (1, "other words in here now"), (None, "a b c d e")]
    assert sorted((r.doc_id or 0, r.component_id) for r in op.similar_groups(frame(spark, same)).collect()) == [(0, 1), (1, 1), (1, 1), (1, 1)]
    kept = op.drop_similar(frame(spark, pairs))
    assert kept.columns == frame(spark, []).columns and {r.doc_id for r in kept.collect()} == {i for i, *_ in pairs} - {5, 10}


def test_shingle_sets():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", " ", "\n", "é", "\x0b", "\xa0", "bc "]) for _ in range(rng.randint(0, 60)))
        assert len(shingles.shingle_set(text, 4)) == len(plain_set(text, 4)), repr(text)
    cut = " ".join("w%d" % rng.randrange(999) for _ in range(3000))
    whole = shingles.word_hashes(cut)
    old, shingles.SEGMENT = shingles.SEGMENT, 100
    try:
        assert (shingles.word_hashes(cut) == whole).all()
    finally:
        shingles.SEGMENT = old


def test_metric_links_find_all():
    rng = np.random.default_rng(6)
    base = rng.choice(10**6, 60, replace=False).astype(np.uint64)
    sets = []
    for _ in range(150):
        own = base.copy()
        own[rng.choice(60, rng.integers(0, 12), replace=False)] = rng.choice(10**6, 1)[0]
        sets.append(np.unique(own))
    local, every = op.LocalSets(sets), np.arange(150)
    found = {frozenset(p) for p in op.metric_links(local, every, every, 85)}
    expected = set()
    for a in range(150):
        for b in range(a):
            both = shingles.common(sets[a], sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                expected.add(frozenset((a, b)))
    assert found == expected


def test_profiles_bound_what_sets_share():
    rng = np.random.default_rng(9)
    for _ in range(200):
        base = rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64)
        a = np.unique(base)
        b = np.unique(np.concatenate([base[: rng.integers(0, len(base) + 1)], rng.integers(0, 1 << 63, rng.integers(1, 300), dtype=np.uint64)]))
        (n, p), (m, q) = (op.read_profile(op.profile(x)) for x in (a, b))
        width = min(len(p), len(q))
        most = np.minimum(p.reshape(width, -1).sum(axis=1), q.reshape(width, -1).sum(axis=1)).sum()
        assert (n, m, p.sum()) == (len(a), len(b), len(a)) and shingles.common(a, b) <= most
    same = np.arange(1 << 62, (1 << 62) + 5000, dtype=np.uint64)  # all in one range
    n, counts = op.read_profile(op.profile(same))
    assert n == 5000 and counts.max() >= 5000

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gatewright.llm import token_align as op
from gatewright.llm.common import tokenizer_file

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
PARTS = ["a", "B", " ", "  ", "\n", "\t", " \n", "\u00e9", ",", ".", "'s", "'", "1", "23", "\u3000", "\x1c", "\x00", "<|endoftext|>", "<s>", "\u65e5\u672c", "\x85", "\U0001f642", "\u200b", "&&", "of", "the", "\xa0", "\u2581", "aaaa", "ing", "word"]
EDGES = ["wordwithoutblank" * 50, "", "a\nb c", None, " " * 300, "\n" * 50, "\U0001f642" * 100, "same text", "same text", "x y " * 3000]


def texts(count, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(count)] + EDGES


@pytest.fixture(scope="module")
def both():
    return op.Aligner(*FILES)


def plain(text, both):
    """Ids, groups and links of one text, straight from the libraries."""
    nothing = (0, 0, 0, 0, "", Counter())
    if not text:
        return nothing
    a, b = both.a.tokenizer.encode(" " + text, add_special_tokens=False).ids, both.b.library.encode(text)
    bytes_a, bytes_b = [both.a.token_bytes_[i] for i in a], [both.b.token_bytes_[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return nothing
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = [], []
        while i < len(a) and ends_a[i] <= end:
            x.append(a[i])
            i += 1
        while j < len(b) and ends_b[j] <= end:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    links = Counter((p, q) for x, y in groups for p in x for q in y)
    written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(written.encode()).hexdigest(), links


@pytest.fixture(scope="module")
def expected(both):
    both.a.token_bytes_, both.b.token_bytes_ = both.a.token_bytes(), both.b.token_bytes()
    return lambda t: plain(t, both)


@pytest.mark.parametrize("piece, large", [(64, 1024), (5, 6), (3, 1)])
def test_groups_and_links_equal_a_plain_walk(both, expected, piece, large):
    both.piece, both.large_group = piece, large
    some = texts(1500)
    found, at = both.align(pa.array(some)), 0
    for k, text in enumerate(some):
        n = found["n_held"][k]
        links = dict(zip(found["held"][at : at + n].tolist(), found["links"][at : at + n].tolist()))
        at += n
        *figures, pairs = expected(text)
        assert [found[c][k] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")] == figures, repr(text)
        assert links == {p * both.width + q: v for (p, q), v in pairs.items()}, repr(text)
    both.piece, both.large_group = op.PIECE, op.LARGE_GROUP


def test_crossings_equal_a_merge():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (np.sort(rng.choice(60, rng.integers(0, 30), replace=False)) for _ in "ab")
        taken = np.cumsum([0] + [side == 0 for _, side in sorted([(x, 0) for x in a] + [(x, 1) for x in b])])
        diagonals = np.arange(len(a) + len(b) + 1)
        assert op.crossings(a, b, diagonals).tolist() == taken.tolist()


@pytest.mark.parametrize("piece", [1, 2, 7, 1000])
def test_pieces_are_stitched_into_groups(piece):
    rng = np.random.default_rng(4)
    for _ in range(60):
        top = int(rng.integers(2, 80))
        a, b = (np.append(np.sort(rng.choice(np.arange(1, top), rng.integers(0, top), replace=False)), top) for _ in "ab")
        common = np.intersect1d(a, b)
        group_a, group_b = op.groups_of(a, b, piece)
        assert group_a.tolist() == np.searchsorted(common, a).tolist() and group_b.tolist() == np.searchsorted(common, b).tolist()


@pytest.mark.parametrize("slice_bytes", [1, 2000, 1 << 30])
def test_documents_equal_the_plain_version(spark, expected, slice_bytes):
    some = texts(200, 7)
    frame = spark.createDataFrame([(k if k % 9 else None, t, k, "x") for k, t in enumerate(some)], "doc_id BIGINT, text STRING, slice INT, counts STRING").repartition(3)
    plain_rows = [(k if k % 9 else None, *expected(t)) for k, t in enumerate(some)]
    docs_with, best = Counter(), Counter()
    for *_, links in plain_rows:
        docs_with.update(links.keys())
    for (a, _), n in docs_with.items():
        best[a] = max(best[a], n)
    wanted = [
        (i, n_a, n_b, groups, n_links, sum(v for (a, b), v in links.items() if docs_with[a, b] == best[a]), sum(v * docs_with[p] for p, v in links.items()), digest)
        for i, n_a, n_b, groups, n_links, digest, links in plain_rows
    ]
    rows = [tuple(r) for r in op.align_documents(frame, slice_bytes=slice_bytes).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(rows, key=key) == sorted(wanted, key=key)


def test_empty_table(spark):
    assert op.align_documents(spark.createDataFrame([], "doc_id BIGINT, text STRING")).count() == 0
    rows = op.align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id BIGINT, text STRING")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

import functools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from gatewright.llm import byte_batch, packing as op
from gatewright.llm.common import tokenizer_file

SCHEMA = "doc_id BIGINT, text STRING, start STRING, `length` INT"


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in pairs], SCHEMA)


def plain(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_first_fit_decreasing_equals_a_plain_scan():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 300):
        sizes = sorted(rng.integers(1, 101, n).tolist(), reverse=True)
        free, expected = [], []
        for s in sizes:
            k = next((k for k, f in enumerate(free) if f >= s), len(free))
            if k == len(free):
                free.append(100)
            expected.append((k, 100 - free[k]))
            free[k] -= s
        assert op.first_fit_decreasing(sizes, 100) == expected


def test_whole_documents_are_packed(spark):
    rng = np.random.default_rng(1)
    pairs = [(i, " ".join("word%d," % w for w in rng.integers(0, 999, rng.integers(0, 900)))) for i in range(60)]
    pairs += [(100, None), (101, ""), (102, "x y " * 30_000), (103, "same"), (103, "same"), (None, "z")]
    rows = op.pack_documents(docs(spark, pairs), group_pieces=64).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    for i, t in pairs:
        if i == 103:
            continue
        ids, at = np.array(plain(t), dtype="<u4"), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert len(by_doc[103]) == 2


def test_little_padding(spark):
    frame = spark.range(20_000).selectExpr("id AS doc_id", "0L AS start", "1 + pmod(xxhash64(id), 2048) AS length")
    rows = op.pack(frame, group_pieces=5000).groupBy("sequence_id").sum("length").collect()
    used = sum(r[1] for r in rows)
    assert used / (2048 * len(rows)) > 0.98


def test_sequences_bring_the_ids_back(spark):
    frame = docs(spark, [(1, "a b c " * 2000), (2, "hello")])
    packed = op.pack_documents(frame)
    ids = defaultdict(dict)
    for r in op.sequences(frame, packed).collect():
        ids[r.doc_id][r.start] = r.ids
    assert sum((ids[1][k] for k in sorted(ids[1])), []) == plain("a b c " * 2000)
    assert ids[2][0] == plain("hello")


def test_empty_table(spark):
    assert op.pack_documents(docs(spark, [])).count() == 0


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y, z<|endoftext|>.", "end<|endoftext|>, and\n<|endoftext|>\n", "<|endoftext|> " * 3000]


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))


def untouched(text):
    return library().encode(text, add_special_tokens=False).ids


def test_special_strings_have_the_ids_of_the_library():
    import random

    encoder, rng = byte_batch.ByteBatch(tokenizer_file("byte_bpe_50k.json")), random.Random(9)
    assert untouched(SPECIAL[0]) == [64, 220, 50256, 275]
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "a", " ", "  ", "\n", "\t", ",", ".", "'s", "1", "\u00e9", " the"]
    texts = SPECIAL + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    ids, counts = encoder.encode(pa.array(texts))
    for text, found in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert found.tolist() == untouched(text), repr(text)


def test_packed_special_strings(spark):
    rows = defaultdict(list)
    for r in op.pack_documents(docs(spark, list(enumerate(SPECIAL)))).collect():
        rows[r.doc_id].append(r)
    for i, t in enumerate(SPECIAL):
        ids = np.array([*untouched(t), 1], dtype="<u4")
        for r in rows[i]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())

import zlib

import numpy as np
import pytest

from gatewright.llm import token_files as op
from gatewright.llm.common import tokenizer_file
from gatewright.llm.files import reading, shared_uri

SCHEMA = "doc_id BIGINT, text STRING, start STRING, ids INT"


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in pairs], SCHEMA)


def plain(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 70_000, 200_000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32)
    table = op.FrequencyTable.of_counts(np.bincount(ids, minlength=50_001))
    data = op.encode_block(ids, table)
    head, body = data[: op.HEADER.size], data[op.HEADER.size :]
    assert len(body) == op.body_size(head)
    assert (op.decode_block(head, body, table) == ids).all()
    for first, count in ((0, 1), (n // 2, 1000), (max(0, n - 3), 9), (n, 5)):
        assert (op.decode_block(head, body, table, first, count) == ids[first : first + count]).all()
    if n > 600:
        assert len(data) < 4 * n
        damaged = bytearray(body)
        damaged[-1] ^= 1
        with pytest.raises(ValueError):
            op.decode_block(head, bytes(damaged), table)


def test_one_symbol_and_many():
    table = op.FrequencyTable.of_counts(np.array([0, 7]))
    data = op.encode_block(np.ones(3000, np.uint32), table)
    assert (op.decode_block(data[: op.HEADER.size], data[op.HEADER.size :], table) == 1).all()
    counts = np.ones(60_000, np.int64)
    counts[0] = 10**15
    assert (op.FrequencyTable.of_counts(counts).frequency > 0).all()


def test_files_hold_all_documents_in_order(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(i), " ".join("w%d" % w for w in rng.integers(0, 500, rng.integers(0, 400)))) for i in rng.permutation(80)]
    pairs += [(200, None), (201, ""), (202, "long text " * 30_000), (7, "again"), (None, "no id")]
    folder = shared_uri(spark, "test-token-files")
    files, table = op.write_ids(docs(spark, pairs), folder)
    rows = op.read_documents(files, table).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, *sorted(i for i, _ in pairs if i is not None)]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        options = [t for i, t in pairs if i == r.doc_id]
        assert (r.n_tokens, r.ids_crc32) in {(len(plain(t)), zlib.crc32(plain(t).tobytes())) for t in options}
    one = files.orderBy("part").collect()[0]
    file = op.TokenFile(one.uri, table)
    whole = np.concatenate([ids for _, ids in file.documents()])
    assert (file.ids(5, 40) == whole[5:45]).all()
    with reading(one.uri) as raw:
        assert raw.read().endswith(op.MAGIC)


def test_empty_table(spark):
    assert op.round_trip(spark, docs(spark, [])).count() == 0


def test_special_strings_have_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    library, at = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")), 0
    texts = ["a <|endoftext|> b", "x<|endoftext|>, y", "plain"]
    rows = op.read_documents(*op.write_ids(docs(spark, list(enumerate(texts))), shared_uri(spark, "test-special"))).orderBy("start").collect()
    for r, t in zip(rows, texts, strict=True):
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)

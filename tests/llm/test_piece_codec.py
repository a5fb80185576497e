import hashlib
import random

import pytest

from gatewright.llm import piece_codec as op
from gatewright.llm.common import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
SCHEMA = "doc_id BIGINT, text STRING, ids STRING, decoded INT"


@pytest.fixture(scope="module", params=[5, 100_000])
def codec(request):
    return op.PieceCodec(MODEL, cache_units=request.param)


def test_ids_equal_the_library(codec):
    rng = random.Random(4)
    parts = ["a", "B", " ", "  ", "\n", "\t", " \n", "é", ",", ".", "'s", "1", "23", "　", "<s>", "<0x0A>", "日本", "🙂", "▁", "▁▁", "&&", "of", "the", "\x00", "ing", "tion"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        expected = codec.library.encode(text)
        assert codec.ids(text).tolist() == expected, repr(text)
        assert codec.decode(expected) == codec.library.decode(expected)


def test_long_texts_without_blanks(codec):
    text = "aaaaabababab" * 4000 + " " * 999
    assert codec.ids(text).tolist() == codec.library.encode(text)


def test_table_holds_the_last_token_of_every_prefix(codec):
    text = "▁internationalisation"
    last, length = codec.prefix_table(text)
    for end in range(1, len(text) + 1):
        assert codec.merged(text[:end])[-1] == codec.name[last[end]] and length[end] == len(codec.name[last[end]])


def test_rows(spark):
    pairs = [(1, None), (2, ""), (3, "Hello  world"), (3, "Hello  world"), (None, "x"), (4, "y" * 100_000)]
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in pairs], SCHEMA)
    lib = op.piece_codec(MODEL).library
    expected = []
    for i, t in pairs:
        ids = lib.encode(t or "")
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, op.piece_digests(frame).collect()), key=repr) == sorted(expected, key=repr)
    assert sorted((r.doc_id or 0, r.decoded) for r in op.encode_pieces(frame).collect()) == sorted((i or 0, t or "") for i, t in pairs)
    assert op.piece_digests(frame.limit(0)).count() == 0

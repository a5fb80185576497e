import random

import numpy as np
import pyarrow as pa
import pytest

from gatewright.llm import byte_batch as op
from gatewright.llm.common import tokenizer_file

PARTS = ["a", "B", " ", "  ", "\n", "\t", " \n", "\u00e9", ",", ".", "'s", "'", "1", "23", "\u3000", "\x1c", "\x00", "<|endoftext|>", "\u65e5\u672c", "\x85", "\U0001f642", "\u180e", "\u200b", "&&", "of", "the", "\xad", "\xa0"]


def some_texts(count, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(count)] + ["wordwithoutblank" * 500, "", "a\nb c", "x y " * 9000]


@pytest.mark.parametrize("special_as_text", [False, True])
def test_ids_equal_the_library(special_as_text):
    encoder, texts = op.ByteBatch(tokenizer_file("byte_bpe_50k.json"), special_as_text), some_texts(4000)
    assert encoder.plain is not None
    ids, counts = encoder.encode(pa.array(texts))
    at = 0
    for text, n, expected in zip(texts, counts, encoder.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[at : at + n].tolist() == expected.ids, repr(text)
        at += n
    assert at == len(ids)


def test_the_library_alone_gives_the_same_ids():
    encoder, texts = op.ByteBatch(tokenizer_file("byte_bpe_50k.json")), pa.array(some_texts(300))
    fast = encoder.encode(texts)
    encoder.plain = None
    assert all((x == y).all() for x, y in zip(fast, encoder.encode(texts)))


def test_every_plain_character_alone_and_between_others():
    encoder = op.ByteBatch(tokenizer_file("byte_bpe_50k.json"))
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1 {chr(c)}." for c in range(1, 0x260)]
    ids, counts = encoder.encode(pa.array(texts))
    expected = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert counts.tolist() == [len(e.ids) for e in expected] and ids.tolist() == [i for e in expected for i in e.ids]


def test_no_texts():
    ids, counts = op.ByteBatch(tokenizer_file("byte_bpe_50k.json")).encode(pa.array([], pa.string()))
    assert len(ids) == len(counts) == 0


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 100, 3, 3, 3)] + [None])], ["text"])
    parts = [p.num_rows for p in op.slices(batch, 0, 8)]
    assert sum(parts) == 7 and parts == [2, 1, 2, 2]
    assert list(op.slices(batch.slice(0, 0), 0)) == []


def test_runs():
    assert op.ragged(np.array([3, 9, 0]), np.array([2, 0, 1])).tolist() == [3, 4, 0]
    assert op.sums_by_run(np.array([1, 2, 3]), np.array([2, 0, 1])).tolist() == [3, 0, 3]

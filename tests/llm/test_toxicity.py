import itertools
import math
import random
import zlib

import numpy as np
import pytest

from gatewright.llm import toxicity as op
from gatewright.llm.common import table

SCHEMA = "doc_id BIGINT, text STRING, score STRING, toxic INT"
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(30)]
        if toxic:
            text.insert(rng.randint(0, 30), rng.choice(["zidiot", "grumpel" + rng.choice("abcdefgh")]))
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


@pytest.fixture(scope="module")
def model(corpus):
    return op.fit(*corpus)


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in pairs], SCHEMA)


def test_counts_cover_the_corpus(spark):
    rows = {r.gram: r.n for r in op.ngram_counts(docs(spark, [(1, "ab"), (2, "AB"), (3, None)])).collect()}
    expected = {}
    for text in ("ab", "ab", ""):
        symbols = [0, 0, 0, *[ord(c) - 96 for c in text], 0]
        for k in range(len(symbols) - 3):
            gram = sum(s * op.ALPHABET ** (3 - j) for j, s in enumerate(symbols[k : k + 4]))
            expected[gram] = expected.get(gram, 0) + 1
    assert rows == expected
    model = np.exp(op.character_model(docs(spark, [(1, "abc")]))).reshape(-1, op.ALPHABET)
    assert np.allclose(model.sum(axis=1), 1, atol=1e-4)


def test_decode_is_the_best_path(model):
    def cost(word_and_cost):
        word, cost = word_and_cost
        symbols = [0, 0, 0, *[ord(c) - 96 for c in word], 0]
        grams = [sum(s * op.ALPHABET ** (3 - j) for j, s in enumerate(symbols[k : k + 4])) for k in range(len(symbols) - 3)]
        return -cost + sum(float(model.characters[g]) for g in grams)

    for stretch in ("z1d10t", "aaab", "c.a.b", "1|!"):
        paths = [("".join(c for c, _ in p), sum(c for _, c in p)) for p in itertools.product(*op.lattice(stretch))]
        best = max(map(cost, paths))
        assert any(math.isclose(cost(p), best, abs_tol=1e-3) and p[0] == op.decode(stretch, model.characters) for p in paths)


def test_suspicious_stretches():
    assert set(op.suspicious("say 1d10t!! or i d i o t, noooo 12:30 abc a1b2")) == {"1d10t", "i d i o t", "noooo"}
    assert op.suspicious("plain words, 2024 and 3 more.") == []


def test_plain_and_disguised_words_score_alike(model):
    score = model.scorer()
    assert score("mono zidiot mi") > 0.5 > score("mono mi")
    for text in ("mono z1d10t mi", "a word: z i d i o t", "ZIDIOOOOT", "the grumpelx"):
        assert score(text) > 0.5, text


def test_held_out_rows(spark, corpus, model):
    frame, labels = corpus
    rows = {r.doc_id: r for r in op.score_documents(frame, model).collect()}
    assert len(rows) == 400
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
    assert all(r.predicted == int(i % 4 == 0) for i, r in rows.items() if r.held_out)
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert op.fit(frame, flipped).weights == model.weights
    assert op.drop_toxic(frame, model).count() == sum(r.predicted == 0 for r in rows.values())


def test_odd_rows(spark, model):
    frame = docs(spark, [(1, None), (2, ""), (None, "zidiot"), (3, "x" * 300_000), (3, "x" * 300_000)])
    rows = op.score_documents(frame, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert op.drop_toxic(frame, model).columns == frame.columns
    nothing = op.fit(frame, spark.createDataFrame([], "doc_id BIGINT, toxic INT"))
    assert {r.score for r in op.score_documents(frame, nothing).collect()} == {0.0}
    assert op.score_documents(frame.limit(0), model).count() == 0


def test_accuracy_on_labelled_documents(spark):
    frame, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    rows = op.score_documents(frame, op.fit(frame, labels)).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93


def test_suspicious_stretches_of_any_length():
    assert op.suspicious("1d10t" + "!" * 40) == ["1d10t"]
    assert op.suspicious("z" + "o" * 60) == ["z" + "o" * 60]
    spaced = " ".join("youareanidiotyouareanidiot")
    assert op.suspicious(spaced) == [spaced]
    assert set(op.suspicious("i  d  i  o  t, or i--d--i--o--t, or iddiot")) == {"i  d  i  o  t", "i--d--i--o--t", "iddiot"}


@pytest.mark.parametrize(
    "text",
    [
        "mono z1d10t" + "!" * 40,
        "mono zid" + "i" * 60 + "ot mi",
        "such a z i d i o t",
        "mono I z i d i o t",
        "4 z i d i o t",
        "z  i  d  i  o  t",
        "z--i--d--i--o--t",
        "z. i. d. i. o. t",
        "zziiddiioott",
        "zidiiot",
        " ".join("monomizidiotlarapidobu"),
        " ".join("monomi" * 8 + "zidiot" + "lara" * 8),
    ],
)
def test_every_disguise_is_decoded(model, text):
    assert model.scorer()(text) > 0.5


def test_a_leading_article_is_no_part_of_a_word(model):
    assert "zidiot" in op.restored_words("such a z i d i o t", model.characters, {})


def test_long_stretches_take_linear_time(model):
    score = model.scorer()
    for text in ("ab" * 100_000 + "c", "x " * 20_000, "1a" * 20_000, "aab" * 20_000, "a" + " " * 300_000 + "b"):
        assert 0 <= score(text) <= 1

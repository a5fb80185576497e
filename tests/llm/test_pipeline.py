from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from gatewright.llm import pii, toxicity
from gatewright.llm.common import table, tokenizer_file
from tests.llm.test_ngram_join import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, every stage run on its predecessor's written result."""
    docs, found = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER), f"test-{name}")
        found.append((docs.columns, docs.collect()))
    return found


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_each_stage_against_a_plain_version(spark, stages):
    raw = table(spark, FOLDER, "documents")
    columns = raw.columns
    assert all(c == columns for c, _ in stages[:-1])
    rows = [r for _, r in stages]
    docs = raw.collect()

    score = toxicity.fit(raw, table(spark, FOLDER, "labels")).scorer()
    assert sorted(rows[0]) == sorted(r for r in docs if score(r.text or "") < 0.5)

    last = {}
    for r in rows[0]:
        last[lowered(r.text)] = max(r.doc_id, last.get(lowered(r.text), r.doc_id))
    assert sorted(rows[1]) == sorted(r for r in rows[0] if last[lowered(r.text)] == r.doc_id)

    groups = {i: c for i, _, c in brute([(r.doc_id, r.text) for r in rows[1]], 5, 80)}
    assert sorted(rows[2]) == sorted(r for r in rows[1] if groups[r.doc_id] == r.doc_id)

    field = pii.fit_field(corpus_pipeline.staged(spark.createDataFrame(rows[2], raw.schema), "test-pii"))
    expected = {r.doc_id: pii.masked(r.text, pii.all_spans(r.text, field)[1]) for r in rows[2]}
    assert {r.doc_id: r.text for r in rows[3]} == expected

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    total, used = defaultdict(int), defaultdict(int)
    for r in rows[4]:
        total[r.doc_id] += r.length
        used[r.sequence_id] += r.length
    assert total == {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows[3]}
    assert max(used.values()) <= 2048


def test_odd_rows_pass_through(spark):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, keep_id STRING, score DOUBLE"
    docs = spark.createDataFrame([(1, None, "en", "s", 0, "x", 1.0), (2, "", "en", "s", 0, "x", 1.0), (None, "lone text", "en", "s", 1, "x", None), (3, "a b c d e f", None, None, None, None, None)], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER), "test-odd")
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == [(0, "lone text"), (2, ""), (3, "a b c d e f")]


def test_empty_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER), f"test-empty-{name}")
    assert docs.count() == 0 and "sequence_id" in docs.columns

"""Documents made ready for training: from the raw table to packed sequences.

Toxic documents go, then exact copies, then all but one document of each group of
similar ones; personal data is masked in what is left, and the texts are packed.
Every stage reads all its predecessor kept, from a written table, and its result
is written in turn, so a lost executor costs at most one stage. The last stage
returns pieces of sequences, the others documents.

Near-duplicates are linked at a Jaccard similarity of 0.8 of five-word shingles.
Stages keep null and empty texts (one row of equal texts stays), rows without id
where they are the only copy, and columns they do not know. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatewright.llm import exact_dedup, ngram_join, packing, pii, toxicity
from gatewright.llm.common import staged, table
from gatewright.session import apply_settings


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model of these documents and the labels outside the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z, the row with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity, directly or through others, the one with the smallest id."""
    return ngram_join.drop_similar(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind."""
    return pii.mask_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_similar),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: No SQL counterpart: models are fitted and texts are tokenised on the way. The tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

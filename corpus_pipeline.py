"""The corpus pipeline: documents pass five stages, each stored before the next one reads it.

Every stage takes null and empty texts, null keys and repeated rows as they come: a null text is never toxic, never a copy
and packs as an empty one. Rows equal in all columns are treated alike; of rows that share a key the Jaccard stage keeps one,
and rows without a key stay. An empty table passes as an empty table. Columns beside those of documents stay.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm import jaccard_join, line_dedup, packing, secret_scan, toxicity
from wardline.llm.text import dropped, made, staged

#: Tables that the stage before made for itself. Its result is stored when the next stage begins.
_LAST: list[str] = []


def _stage(work):
    """A stage that first removes the tables of the one before, unless its documents still read them."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        dropped(spark, _LAST, kept=docs)
        before = set(made())
        out = work(spark, docs, sf_dir)
        _LAST[:] = [t for t in made() if t not in before]
        return out

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score lies below 0.7; models are learned from the labelled ones among them."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of 50 words or more that an earlier document or part has."""
    return line_dedup.deduped(docs).select(*docs.columns)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word grams, similarity 0.8 or more, the least key stays."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


@_stage
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return secret_scan.masked_documents(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: No stage but the scan has an equivalent in SQL. The operators are checked by brute force in tests/llm; the pipeline's tests
#: check that each stage takes effect on all rows of the one before.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each result is written to the shared folder and read again.

    What a stage made for itself, and the documents it read, are removed once its result is stored.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = set(made())
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        dropped(spark, [t for t in made() if t not in before], kept=docs)
    return STAGES[-1][1](spark, docs, sf_dir)

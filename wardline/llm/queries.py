"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm import (
    bpe_codec,
    chat_format,
    collocations,
    fingerprints,
    jaccard_join,
    line_dedup,
    packing,
    periodic_runs,
    pivot_join,
    quality_rules,
    secret_scan,
    sql,
    token_counts,
    toxicity,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.round_trip(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(_table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more whose texts look like another template's marks."""
    more = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)"
    )
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.read_back(chat_format.windows(turns))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Texts without later repeated runs, and what was taken out."""
    done = line_dedup.deduped(_table(spark, folder, "documents"))
    return done.select("doc_id", "text", "n_chars", "removed_words", "removed_spans")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked(_table(spark, folder, "documents"), size=4, percent=85)


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, folder, "documents")).drop("masked")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(_table(spark, folder, "documents"))))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_join.nearest(_table(spark, folder, "embeddings"))


QUERIES = (
    op1_byte_bpe,
    op2_fingerprints,
    op3_toxicity,
    op4_packing,
    op5_quality_rules,
    op6_token_counts,
    op7_chat_format,
    op8_line_dedup,
    op9_jaccard_join,
    op10_secret_scan,
    op11_periodic_runs,
    op12_collocations,
    op13_nearest_vectors,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(sql.TEXTS)

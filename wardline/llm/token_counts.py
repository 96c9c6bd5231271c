"""Token counts: batch encoding inside Arrow functions that return lengths only."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import Memo, held, pieces, slices


def _lengths(spec: str) -> Memo:
    """Token counts of pieces under the tokenizer whose JSON is ``spec``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_padding()
    tokenizer.no_truncation()

    def count(batch: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    return Memo(count)


def counter(spec: str, limit: int):
    def run(batches):
        lengths = held(("lengths", spec), lambda: _lengths(spec))
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            cut = [pieces(t) for t in texts]
            lengths.learn(set().union(*cut))
            tokens = [sum(map(lengths.__getitem__, p)) for p in cut]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than ``limit`` tokens.

    ``tokenizer`` is the path of a byte-level tokenizer's JSON on the driver; its content travels with the tasks.
    Special strings inside texts count as the tokenizer's default has it. A task handles texts in slices of equal
    bytes. Texts are cut before white space, where the tokenizer's pattern always ends a token, so a long text
    needs no more memory than its pieces, and each distinct piece of a slice is encoded once.

    A null text counts as empty: 0 bytes, 0 tokens. A null key is kept. Repeated rows are counted each. Other
    columns are ignored. An empty table gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(counter(spec, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Periodic runs of words: seeds on diagonals are extended once each, and later periods of a run can be taken out.

A run of period q and at least 4 q words agrees with itself, q words on, over 3 q words. So lags are dealt into
classes from 2^j to 2^(j+1) - 1, and each class has grams of 3 * 2^j words, the least agreement that its runs
guarantee. Such a gram is no shorter than any lag of its class. Inside a run it therefore comes again after exactly
one period, never earlier (or the period would not be the smallest), so that neighbouring occurrences of a gram are
all the pairs that are needed: as many as there are words, where all pairs of a word said n times would be n^2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import slices

#: Periods that a run has at least, and its fewest words.
PERIODS, SHORTEST = 4, 6


def _numbers(words: list[bytes]) -> np.ndarray:
    """Equal words have equal numbers."""
    known = {w: i for i, w in enumerate(set(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers for pairs; the shorter side says how many there are."""
    n = min(len(left), len(right))
    both = left[:n] * (int(right.max(initial=0)) + 1) + right[:n]
    return np.unique(both, return_inverse=True)[1]


def _neighbours(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a gram and of its next occurrence."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    return order[:-1][same], order[1:][same]


def _agreement(x: np.ndarray, start: int, lag: int, step: int) -> int:
    """How many words from ``start`` on, in the direction ``step``, equal the word ``lag`` later."""
    most = len(x) - lag - start if step > 0 else start + 1
    n, width = 0, 64
    while n < most:
        take = min(width, most - n)
        low = start + n if step > 0 else start - n - take + 1
        differ = np.flatnonzero(x[low : low + take] != x[low + lag : low + lag + take])
        if len(differ):
            return n + int(differ[0] if step > 0 else take - 1 - differ[-1])
        n += take
        width *= 2
    return n


def runs_of(x: np.ndarray, periods: int = PERIODS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of numbers, by start, then period.

    Each stretch of a lag is extended once: the table of the furthest word covered at a lag rules out later seeds.
    The stretches of a class of lags overlap little, so the work is that of a sort for each of the log n classes.
    """
    if periods < 4 or shortest < 6:
        raise ValueError("the grams are long enough for four periods and six words or more")
    found = []
    if len(x) < shortest:
        return found
    pairs = _paired(x, x[1:])
    grams = _paired(pairs, pairs[2:])
    low = 1
    while periods * low <= len(x) and len(grams) > int(grams.max(initial=-1)) + 1:
        # Some gram occurs twice. They have four words for lag 1, else 2 * low; the class's own have five, else 3 * low.
        first, second = _neighbours(_paired(grams, grams[low:]))
        lag = second - first
        seeds = (lag >= low) & (lag < 2 * low)
        covered: dict[int, int] = {}
        for at, d in sorted(zip(first[seeds].tolist(), lag[seeds].tolist())):
            if at < covered.get(d, 0):
                continue
            begin = at - _agreement(x, at - 1, d, -1) if at else 0
            end = at + _agreement(x, at, d, 1)
            covered[d] = end
            length = end - begin + d
            if length >= max(shortest, periods * d):
                found.append((begin, length, d))
        low *= 2
        if low > 2:
            grams = _paired(grams, grams[low:])
    return sorted(found)


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stand in no run after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str | Column = "text", periods: int = PERIODS, shortest: int = SHORTEST) -> DataFrame:
    """Runs of every text and the text without their repeats: ``doc_id, n_words, runs, collapsed``.

    A run is a stretch of words with smallest period q and at least ``max(shortest, periods * q)`` words that no
    neighbouring word extends; words are what stands between plain white space. ``runs`` is ordered by start, then
    period. ``collapsed`` joins the words that no run holds after its first period by one space.

    A null or empty text has no words, no runs and an empty ``collapsed``. A null key is kept, repeated rows are
    searched each, other columns are ignored, an empty table gives no rows. A text is one unit of work; memory is a few
    numbers for each of its words.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), (F.col(text) if isinstance(text, str) else text).cast("string").alias("text")
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in slices(batches):
            counts, runs, texts = [], [], []
            for t in batch.column("text").to_pylist():
                words = (t or "").encode().split()
                own = runs_of(_numbers(words), periods, shortest)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                texts.append(b" ".join(without_repeats(words, own)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return rows.mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``: a tenth of the texts, by the checksum of the key, with a run planted at their end.

    With h the checksum and g = floor(h / 10), texts with h % 10 = 0 repeat, from word a = g % n on, the p words that
    follow, p = 1 + floor((n - a) / (3 + g % 8)). Rows without a key or without words stay as they are.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    cut = rows.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g")).withColumn("n", F.size("words").cast("long"))
    cut = cut.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    cut = cut.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("concat_ws(' ', transform(words, (w, i) -> CASE WHEN i < a THEN w ELSE words[int(a + (i - a) % p)] END))")
    return cut.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(repeated).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """What the runs of each text come to: their number, the run of greatest exponent, and digests.

    Exponents are compared exactly, as products of whole numbers. Runs come by start, then period, and only a greater
    exponent takes the place of an earlier one, so ties go to the smallest start, then period. No run: four nulls.
    """
    best = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (b, r) -> CASE "
        "WHEN b IS NULL OR CAST(r.length AS DECIMAL(19, 0)) * b.period > CAST(b.length AS DECIMAL(19, 0)) * r.period THEN r ELSE b END)"
    )
    listed = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(listed).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

"""Quality rules: base measures, and distance of a text's histograms from those of its language."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import ODD_SPACE, slices, staged

# Fixed values of the base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = " \t\n\x0b\x0c\r"

#: Frequent function words of some languages: the bins of the word histogram, beside one for all other words.
COMMON = {
    "en": "the of and to in a is that it for was on are as with by at be this from or an he they his not",
    "fr": "le la les de des du et un une en que qui est pour par dans sur au avec ne pas plus ce il",
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an",
    "es": "el la los las de y que en un una por con para no se del al lo como más su es",
}
BINS = {w: i for i, w in enumerate(sorted({w for words in COMMON.values() for w in words.split()}))}

#: Classes of characters, the bins of the other histogram.
CLASSES = "lower upper letter mark digit blank line stop punctuation symbol other".split()


def _class_of(c: str) -> str:
    if c in SYMBOLS:
        return "symbol"
    if c == "\n":
        return "line"
    if c in ".,;:!?":
        return "stop"
    kind = unicodedata.category(c)
    if kind in ("Ll", "Lu"):
        return {"Ll": "lower", "Lu": "upper"}[kind]
    by_first = {"L": "letter", "M": "mark", "N": "digit", "Z": "blank", "P": "punctuation", "S": "punctuation"}
    return "blank" if c in _BLANK else by_first.get(kind[0], "other")


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    index = {name: i for i, name in enumerate(CLASSES)}
    return np.array([index[_class_of(chr(i))] for i in range(0x110000)], np.uint8)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text) if ODD_SPACE.search(text) else text.split()


def repeated_words(words: list[str]) -> int:
    """Words inside windows of three that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    starts = np.array([counts[w] > 1 for w in windows] + [False, False])
    return int((starts | np.roll(starts, 1) | np.roll(starts, 2)).sum())


def measure(text: str) -> tuple:
    """Base measures of one text and its two histograms."""
    words = words_of(text)
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    classes = np.bincount(_class_table()[codes], minlength=len(CLASSES))
    hits = Counter(filter(BINS.__contains__, map(str.lower, words)))
    bins = np.zeros(len(BINS) + 1, np.int64)
    for w, n in hits.items():
        bins[BINS[w]] = n
    bins[-1] = len(words) - bins.sum()
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        classes,
        bins,
    )


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Base measures and histograms of every text. A null text has no words; other columns are ignored."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )

    def run(batches):
        for batch in slices(batches):
            found = list(zip(*(measure(t or "") for t in batch.column("text").to_pylist())))
            counts = [pa.array(c, pa.int64()) for c in found[:5]]
            histograms = [pa.array(list(h), pa.list_(pa.int64())) for h in found[5:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), *counts, *histograms],
                ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "bins"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, classes array<long>, bins array<long>",
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def _shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / total)


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance with logarithms to base two, 0 to 1, to nine decimals."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.round(F.sqrt(F.greatest(total, F.lit(0.0))), 9)


def references(measured: DataFrame, least_documents: int) -> tuple[DataFrame, DataFrame]:
    """Mean histograms by language and over all languages, of the texts that pass the base rules.

    The first holds languages with ``least_documents`` such texts or more. The second is one row.
    """
    sizes = {"classes": len(CLASSES), "bins": len(BINS) + 1}
    shares = measured.where(~base_failed()).select("lang", *(_shares(c).alias(c) for c in sizes))
    sums = shares.groupBy("lang").agg(
        F.count("*").alias("n"),
        *(F.array(*(F.sum(F.col(c)[i]) for i in range(k))).alias(c) for c, k in sizes.items()),
    )
    own = sums.where(F.col("n") >= least_documents).select(
        "lang", *(F.transform(c, lambda x: x / F.col("n")).alias(f"own_{c}") for c in sizes)
    )
    pooled = sums.agg(
        *(F.array(*(F.sum(F.col(c)[i]) / F.sum("n") for i in range(k))).alias(f"all_{c}") for c, k in sizes.items())
    ).withColumn("one", F.lit(1))
    return own, pooled


def quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    class_limit: float = 0.25,
    word_limit: float = 0.45,
    sum_limit: float = 0.4,
    word_guard: int = 100,
    least_documents: int = 20,
) -> DataFrame:
    """Base measures of every text, its distances from its language, and the verdict ``kept``.

    A text that passes the base rules is kept unless its histogram of character classes lies further than
    ``class_limit`` from the mean of its language, or, from ``word_guard`` words on, its histogram of common words
    further than ``word_limit`` or both together further than ``sum_limit``. Short texts are guarded because few
    words make uneven histograms. The reference is the mean over all texts of the language that pass the base rules; a language with fewer than
    ``least_documents`` of them, or none given, is held against the mean over all languages.

    A null text has no words and fails. Null keys and repeated rows are kept, each with its own verdict. Other
    columns are ignored. An empty table gives no rows.
    """
    measured = staged(measures(docs, key, text, lang))
    own, pooled = references(measured, least_documents)
    joined = measured.withColumn("one", F.lit(1)).join(own, "lang", "left").join(F.broadcast(pooled), "one", "left")
    judged = joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        *(
            F.when(
                F.col("n_words") > 0,
                _distance(_shares(c), F.coalesce(F.col(f"own_{c}"), F.col(f"all_{c}"))),
            ).alias(name)
            for c, name in (("classes", "class_distance"), ("bins", "word_distance"))
        ),
    )
    far = (F.col("class_distance") > class_limit) | (
        (F.col("n_words") >= word_guard)
        & (
            (F.col("word_distance") > word_limit)
            | (F.col("class_distance") + F.col("word_distance") > sum_limit)
        )
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))

"""Toxicity: class-conditional Kneser-Ney models over the characters of words, compared per word."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.hashing import run_hashes
from wardline.llm.text import FILTER_BITS, Memo, dropped, flagged, held, made, slices, staged

#: Characters a gram has at most, the predicted one included.
ORDER = 6
#: What each seen gram gives up for unseen ones.
DISCOUNT = 0.75
#: Labelled rows at most that the final curve is fitted on.
CURVE_ROWS = 20_000
#: Log ratio over the mean word of ordinary texts from which a word counts as evidence: e to this power times likelier.
MARGIN = 3.0
#: Slots of the tables that hold or bound what a gram counts.
SLOTS = 1 << 20
#: Marks of a word's two ends.
BEGIN, END = "\x02", "\x03"
_WORDS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def held_out(key: str | Column) -> Column:
    """Rows that no label is learned from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(0)).cast("string")) % 3 == 1


def _for_curve(key: str) -> Column:
    """The rows, an eighth of those learned from, that are kept out of the counts to fit the curve on."""
    return F.crc32(F.concat(F.lit("curve "), F.col(key).cast("string"))) % 8 == 0


def marked(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Labels that may be learned from: ``doc_id, toxic``. A key labelled twice is toxic if any is."""
    marks = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    marks = marks.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    return marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Texts with a label whose words are counted: ``doc_id, text, toxic``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    marks = marked(labels, key, label).where(~_for_curve("doc_id"))
    # Texts that surely have no label don't enter the join's exchange.
    wanted = flagged(rows.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")), "doc_id", marks.select("doc_id"))
    return wanted.where("_maybe").select("doc_id", "text").join(marks, "doc_id")


def word_counts(rows: DataFrame) -> DataFrame:
    """Occurrences of every word in toxic and in ordinary texts: ``word, toxic, ordinary``."""

    def run(batches):
        for batch in slices(batches):
            counts = Counter(), Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic == 0].update(words_of(text))
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in counts)],
                ["word", "toxic", "ordinary"],
            )

    found = rows.select("text", "toxic").mapInArrow(run, "word string, toxic long, ordinary long")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def grams(words: DataFrame, order: int = ORDER) -> DataFrame:
    """For every character of every word the gram that ends there, counted by class: ``gram, toxic, ordinary``.

    Grams have ``order`` characters, fewer only at the start of a word, whose mark they then begin with.
    """
    whole = F.concat(F.lit(BEGIN), "word", F.lit(END))
    places = words.select("toxic", "ordinary", whole.alias("w")).withColumn("i", F.explode(F.sequence(F.lit(2), F.length("w"))))
    start = F.greatest(F.col("i") - (order - 1), F.lit(1))
    return (
        places.select(F.substring(F.col("w"), start, F.col("i") - start + 1).alias("gram"), "toxic", "ordinary")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


def _shorter(c: str) -> Column:
    return F.expr(f"substring({c}, 2)")


def _context(c: str) -> Column:
    return F.expr(f"substring({c}, 1, length({c}) - 1)")


def shared_backoff(top: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> DataFrame:
    """Probabilities of shorter grams that both classes share: ``gram, shared``.

    A shorter gram counts the distinct characters seen before it in either class. Each length is discounted and
    falls back on the next shorter one, single characters on all characters alike.
    """
    tails = top.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("gram") - 1), lambda i: F.expr("gram").substr(i, F.length("gram")))).alias("long")).distinct()
    counts = tails.where(F.length("long") > 1).select(_shorter("long").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    counts = counts.withColumn("context", _context("gram"))
    sums = counts.groupBy("context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
    shares = counts.join(sums, "context").select(
        "gram",
        (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("all")).alias("own"),
        (discount * F.col("kinds") / F.col("all")).alias("passed"),
    )
    shares = staged(shares)
    single = shares.where(F.length("gram") == 1)
    uniform = single.agg((1.0 / F.greatest(F.count("*"), F.lit(1))).alias("u"))
    level = single.join(F.broadcast(uniform), F.lit(True)).select("gram", (F.col("own") + F.col("passed") * F.col("u")).alias("shared"))
    found = level
    for n in range(2, order):
        here = shares.where(F.length("gram") == n).withColumn("short", _shorter("gram"))
        below = level.select(F.col("gram").alias("short"), F.col("shared").alias("below"))
        level = here.join(below, "short").select("gram", (F.col("own") + F.col("passed") * F.col("below")).alias("shared"))
        found = found.unionByName(level)
    return found


def log_ratios(top: DataFrame, shared: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """Log of toxic over ordinary probability for every seen gram, and for a context's unseen grams.

    Returns ``text, ratio, ordinary`` twice, the last the count in ordinary texts. A class that never saw a context
    takes the shared probability.
    """
    top = top.withColumn("context", _context("gram"))
    classes = ("toxic", "ordinary")
    sums = top.groupBy("context").agg(
        *(F.sum(c).alias(f"{c}_all") for c in classes),
        *(F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in classes),
    )

    def passed(c: str) -> Column:
        return F.when(F.col(f"{c}_all") > 0, discount * F.col(f"{c}_kinds") / F.col(f"{c}_all")).otherwise(1.0)

    def probability(c: str) -> Column:
        own = F.when(F.col(f"{c}_all") > 0, F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"{c}_all")).otherwise(0.0)
        return own + passed(c) * F.col("shared")

    seen = top.join(sums, "context").withColumn("short", _shorter("gram"))
    seen = seen.join(shared.select(F.col("gram").alias("short"), "shared"), "short", "left")
    seen = seen.withColumn("shared", F.coalesce("shared", F.lit(1e-6)))
    of_grams = seen.select(F.col("gram").alias("text"), F.log(probability("toxic") / probability("ordinary")).alias("ratio"), "ordinary")
    of_contexts = sums.select(
        F.col("context").alias("text"),
        F.log(passed("toxic") / passed("ordinary")).alias("ratio"),
        F.col("ordinary_all").alias("ordinary"),
    )
    return of_grams, of_contexts


def text_keys(joined: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits that stand for each part [start, end) of a text, counted in characters, wherever it stands."""
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    return run_hashes(points, starts, ends).view(np.int64)


def keyed(of_grams: DataFrame, of_contexts: DataFrame) -> DataFrame:
    """Both tables of log ratios as one: ``key, context, ratio, ordinary``, with 64 bits for each text."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            starts = np.r_[0, ends[:-1]].astype(np.int64)[: len(texts)]
            keys = pa.array(text_keys("".join(texts), starts, ends))
            yield pa.RecordBatch.from_arrays([keys, *(batch.column(c) for c in names)], ["key", *names])

    names = ["context", "ratio", "ordinary"]
    both = [df.select("text", F.lit(c).alias("context"), "ratio", "ordinary") for df, c in ((of_grams, False), (of_contexts, True))]
    return both[0].unionByName(both[1]).mapInArrow(run, "key long, context boolean, ratio double, ordinary long")


def word_grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the grams that end at each character of each word, of their contexts, and each word's first gram."""
    whole = [BEGIN + w + END for w in words]
    sizes = np.array([len(w) for w in whole], np.int64)
    first = np.cumsum(sizes) - sizes
    begins = np.repeat(first, sizes - 1)
    heads = np.cumsum(sizes - 1) - (sizes - 1)
    # Ends run from the second character of a word to its last.
    ends = np.arange(len(begins)) - np.repeat(heads, sizes - 1) + begins + 2
    starts = np.maximum(begins, ends - order)
    joined = "".join(whole)
    return text_keys(joined, starts, ends), text_keys(joined, starts, ends - 1), heads


#: Words that a task remembers to have looked at.
LATELY = 1 << 17


class Bounds:
    """By kind (grams, contexts) and slot: a key in it, the largest ratio, and how many keys it has, up to two."""

    def __init__(self, raw: bytes | bytearray):
        at = [np.frombuffer(raw, kind, 2 * SLOTS, start * 2 * SLOTS) for kind, start in (("<i8", 0), ("<f4", 8), ("i1", 12))]
        self.key, self.most, self.n = (x.reshape(2, SLOTS) for x in at)


def bounds_of(ratios: DataFrame) -> bytes:
    """For each of SLOTS slots, of grams and of contexts, its key with the largest ratio and whether it has others.

    Its size is fixed. More grams only let more words pass.
    """
    slot = F.expr(f"int(pmod(key, {SLOTS}L))")
    rows = ratios.groupBy("context", slot.alias("slot")).agg(
        F.max_by("key", "ratio").alias("key"), F.max("ratio").cast("float").alias("most"), F.least(F.count("*"), F.lit(2)).cast("byte").alias("n")
    )
    rows = rows.toArrow()
    raw = bytearray(2 * SLOTS * 13)
    table = Bounds(raw)
    at = rows.column("context").to_numpy().astype(int), rows.column("slot").to_numpy()
    table.key[at], table.n[at] = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    # Rounded up, so that the bound stays one.
    table.most[at] = np.nextafter(rows.column("most").to_numpy().astype(np.float32), np.float32(np.inf))
    return bytes(raw)


def most_of(words: list[str], table: Bounds, order: int) -> np.ndarray:
    """What the ratio of each word is at most, by the slots of its grams and their contexts.

    The key that a slot holds is known exactly, as is that any other was not seen if the slot has no second one.
    Else the slot's largest ratio bounds it. A context that was not seen has no seen grams.
    """
    if not words:
        return np.zeros(0)
    grams_, contexts, heads = word_grams(words, order)
    found = np.zeros(len(grams_))
    at = contexts % SLOTS
    known, several = (table.key[1][at] == contexts) & (table.n[1][at] > 0), table.n[1][at] > 1
    some = np.flatnonzero(known | several)
    backoff = table.most[1][at[some]].astype(np.float64)
    backoff[~known[some]] = np.maximum(backoff[~known[some]], 0.0)
    at = grams_[some] % SLOTS
    own, n = table.most[0][at].astype(np.float64), table.n[0][at]
    seen = (table.key[0][at] == grams_[some]) & (n > 0)
    found[some] = np.where(seen, own, np.where(n > 1, np.maximum(own, backoff), backoff))
    return np.add.reduceat(found, heads)


def candidates(texts: DataFrame, bounds: bytes, least: float, order: int = ORDER) -> DataFrame:
    """The distinct words of all texts whose ratio may exceed ``least``: ``word``.

    ``most_of`` bounds a word's ratio from above, so no word that does exceed it is left out, and most others never
    leave their task.
    """

    def run(batches):
        table, lately = Bounds(bounds), set()
        for batch in slices(batches, most=SLOTS):
            words = list(set().union(*(words_of(t or "") for t in batch.column("text").to_pylist())) - lately)
            if len(lately) + len(words) > LATELY:
                lately = set()
            lately.update(words[:LATELY])
            kept = [words[i] for i in np.flatnonzero(most_of(words, table, order) > least).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], ["word"])

    return texts.select("text").mapInArrow(run, "word string").distinct()


def key_of(word: str) -> int:
    """64 bits that stand for a word in joins."""
    return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)


def word_ratios(words: DataFrame, ratios: DataFrame, order: int = ORDER) -> DataFrame:
    """Log of toxic over ordinary probability of distinct words, the sum over their grams: ``word_key, ratio``.

    A gram that was not seen takes the ratio of its context, 0 if that was not seen either.
    """

    def run(batches):
        for batch in slices(batches, "word", most=SLOTS):
            own = batch.column("word").to_pylist()
            grams_, contexts, heads = word_grams(own, order)
            keys = np.repeat(np.array([key_of(w) for w in own], np.int64), np.diff(np.r_[heads, len(grams_)]))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(grams_), pa.array(contexts)], ["word_key", "gram", "short"])

    places = words.mapInArrow(run, "word_key long, gram long, short long")
    seen = ratios.where("NOT context").select(F.col("key").alias("gram"), "ratio")
    backoff = ratios.where("context").select(F.col("key").alias("short"), F.col("ratio").alias("backoff"))
    found = places.join(seen, "gram", "left").join(backoff, "short", "left")
    return found.groupBy("word_key").agg(F.sum(F.coalesce("ratio", "backoff", F.lit(0.0))).alias("ratio"))


def ordinary_level(ratios: DataFrame, counts: DataFrame) -> float:
    """The mean log ratio over all words of the ordinary training texts; 0 if there are none.

    All their grams were seen, so the sum over words is one over grams.
    """
    total = ratios.where("NOT context AND ordinary > 0").agg(F.sum(F.col("ratio") * F.col("ordinary")).alias("x")).first().x
    n = counts.agg(F.sum("ordinary").alias("n")).first().n
    return total / n if n and total is not None else 0.0


def _filter_of(keys: DataFrame) -> bytes:
    """A filter of FILTER_BITS bits, one byte for each eight, that knows all keys; more keys only let more words pass."""
    (name,) = keys.columns
    slot = f"pmod({name}, {FILTER_BITS}L)"
    rows = keys.selectExpr(f"{slot} div 64 AS at", f"shiftleft(1L, int({slot} % 64)) AS bit").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return table.astype("<i8").tobytes()


def _maybe_keys(bits: bytes) -> Memo:
    """Keys of words that may be in the filter, None for all others."""

    def one(word: str) -> int | None:
        key = key_of(word)
        at = key % FILTER_BITS
        return key if bits[at >> 3] >> (at & 7) & 1 else None

    return Memo(lambda words: [one(w) for w in words])


def evidence(texts: DataFrame, excess: DataFrame) -> DataFrame:
    """How far each text's words are likelier as toxic than as ordinary, by length: ``u, x``; texts at 0 are left out.

    ``excess`` has what words have beyond the level of ordinary texts and the margin. It is summed over a text's words
    and divided by the square root of their number, with which the sum of chance deviations grows. Only words that
    may be in ``excess`` leave a text, counted, and meet it in a join.
    """
    bits = _filter_of(excess.select("word_key"))

    def run(batches):
        for batch in slices(batches):
            maybe = held(("maybe", bits), lambda: _maybe_keys(bits))
            cut = [words_of(t or "") for t in batch.column("text").to_pylist()]
            maybe.learn(set().union(*cut))
            out = []
            for u, words in zip(batch.column("u").to_pylist(), cut):
                counts = Counter(k for k in map(maybe.__getitem__, words) if k is not None)
                out += [(u, k, n, len(words)) for k, n in counts.items()]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "word_key", "n", "length"])

    pairs = texts.select("u", "text").mapInArrow(run, "u long, word_key long, n long, length long")
    found = pairs.join(excess, "word_key").dropDuplicates(["u", "word_key"])
    return found.groupBy("u").agg((F.sum(F.col("n") * F.col("excess")) / F.sqrt(F.max("length"))).alias("x"))


def _version(key: str, text: str) -> Column:
    """Tells rows apart by key and text; rows equal in both have the same score."""
    return F.xxhash64(F.col(key).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")))


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 100) -> tuple[float, float]:
    """Slope and level of a logistic curve by damped Newton steps. Without both labels the curve is flat."""
    n = len(y)
    if not n or y.min() == y.max():
        rate = (y.sum() + 0.5) / (n + 1.0) if n else 0.0
        return 0.0, float(np.log(rate / (1 - rate))) if n else -50.0
    scale = max(float(np.std(x)), 1e-9)
    a = np.stack([x / scale, np.ones(n)], axis=1)
    w = np.array([0.0, np.log(y.mean() / (1 - y.mean()))])
    pull = np.diag([penalty, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (y - p) - pull @ w
        bend = (a * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ a + pull
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, float(np.abs(step).max()))
        if float(np.abs(step).max()) < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


@dataclass(frozen=True)
class Scores:
    """Evidence by text, ``u, x``, and the curve from it to the score."""

    evidence: DataFrame
    slope: float
    level: float

    def of(self, x: Column) -> Column:
        return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), self.slope * x + self.level))))


def learned(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    order: int = ORDER,
    margin: float = MARGIN,
    curve_rows: int = CURVE_ROWS,
) -> Scores:
    """Learns both class models from all labelled texts that are not held out, and weighs all texts by them.

    Seven eighths of them are counted, word by word and gram by gram, in distributed aggregates over all such
    texts. The log ratios stay a distributed table; every word of the texts that may count as evidence gets the sum of
    its own grams' ratios in a join. A word's ratio is taken against the mean of the ordinary training texts' words. On the other
    eighth, evidence and label of at most ``curve_rows`` texts chosen by hash, a logistic curve is fitted. Without
    labels of both classes every text gets the same score. Null labels and null keys are not learned from.
    """
    before = made()
    counts = staged(word_counts(labelled(docs, labels, key, text, label)))
    top = staged(grams(counts, order))
    ratios = staged(keyed(*log_ratios(top, shared_backoff(top, order))))
    least = ordinary_level(ratios, counts) + margin
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), _version(key, text).alias("u"))
    of_words = word_ratios(candidates(texts, bounds_of(ratios), least, order), ratios, order)
    excess = staged(of_words.where(F.col("ratio") > least).select("word_key", (F.col("ratio") - least).alias("excess")))
    found = staged(evidence(texts, excess))
    # What was learned stands in the evidence now.
    dropped(docs.sparkSession, [t for t in made() if t not in before], kept=found)
    marks = marked(labels, key, label).where(_for_curve("doc_id"))
    curve = texts.select("doc_id", "u").join(marks, "doc_id").join(found, "u", "left")
    curve = curve.orderBy(F.xxhash64("doc_id"), "doc_id", "u").select(F.coalesce("x", F.lit(0.0)).alias("x"), "toxic").limit(curve_rows).toArrow()
    x, y = curve.column("x").to_numpy(), (curve.column("toxic").to_numpy() > 0).astype(float)
    slope, level = fit_curve(x, y)
    return Scores(found, max(slope, 0.0), level)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Toxicity of every text: ``doc_id, held_out, score, predicted``.

    The score compares the text's toxic and ordinary log-likelihoods word by word, normalised by length. Words that neither class saw cost
    both the same shared probability. A null or empty text has the score of no evidence. Null keys count as 0 for
    ``held_out``; repeated rows are scored each; other columns are ignored; an empty table gives no rows.
    """
    scores = learned(docs, labels, key, text)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _version(key, text).alias("u"))
    found = rows.join(scores.evidence, "u", "left").select("doc_id", scores.of(F.coalesce("x", F.lit(0.0))).alias("score"))
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents, all their columns, whose score lies below the threshold.

    A null or empty text has no evidence and stays where no evidence does. Rows without a key are scored as others;
    repeated rows share their score and stay or go together. An empty table gives no rows.
    """
    scores = learned(docs, labels, key, text)
    toxic = staged(scores.evidence.where(scores.of(F.col("x")) >= threshold).select("u"))
    # The score never falls with the evidence: what holds for a text without any holds for all if it is toxic.
    rows = docs.select(F.struct("*").alias("row"), _version(key, text).alias("u")).where(scores.of(F.lit(0.0)) < threshold)
    rows = flagged(rows, "u", toxic)
    # Texts that surely are not toxic don't enter the join's exchange.
    kept = rows.where("_maybe").join(toxic, "u", "left_anti").select("row").unionByName(rows.where(~F.col("_maybe")).select("row"))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))

"""Line dedup: winnowed fingerprints of words find shared parts, windows around them their first place, later runs go."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.hashing import mixed, run_hashes
from wardline.llm.text import flagged, slices, staged


def words_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, runs of bytes above the space."""
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[0], (b > 32).astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashes_of(text: str | None) -> np.ndarray:
    """Hashes of the words, 32 bits each."""
    raw = (text or "").encode()
    return run_hashes(np.frombuffer(raw, np.uint8), *words_of(raw)).astype(np.uint32)


def gram_of(least: int) -> int:
    """Words of a fingerprint: two fifths of the shortest run, so that a run holds some that can be left out."""
    return max(1, least * 2 // 5)


def _over(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over each ``width`` neighbours, in steps that double."""
    step = 1
    while step < width:
        more = min(step, width - step)
        x = f(x[: len(x) - more], x[more:])
        step += more
    return x


def winnowed(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept fingerprints and the word at which each starts, in order.

    A fingerprint is kept if it is the least, or as little as the least, of all that lie in some run of ``least``
    words. So equal runs of that length keep the same ones, whatever stands around them, one at least.
    """
    size = gram_of(least)
    width = least - size + 1
    if len(hashes) < least:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(len(hashes) - size + 1)
    grams = run_hashes(hashes, at, at + size)
    none = np.zeros(width - 1, np.uint64)
    kept = np.flatnonzero(_over(np.concatenate([none, _over(grams, width, np.minimum), none]), width, np.maximum) == grams)
    return grams[kept], kept


def contexts(hashes: np.ndarray, places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of all words that lie in a run of ``least`` words with the fingerprint at each place.

    Equal hashes mean the same runs around the fingerprint.
    """
    starts = np.maximum(places + gram_of(least) - least, 0)
    ends = np.minimum(places + least, len(hashes))
    return starts, ends, mixed(run_hashes(hashes, starts, ends) + (places - starts).astype(np.uint64))


def windows(size: int, places: np.ndarray, least: int) -> np.ndarray:
    """Starts of all runs of ``least`` words that hold the fingerprint at one of the places, in order."""
    edge = np.zeros(max(size - least, 0) + 2, np.int64)
    np.add.at(edge, np.maximum(places + gram_of(least) - least, 0), 1)
    np.add.at(edge, np.minimum(places, size - least) + 1, -1)
    return np.flatnonzero(np.cumsum(edge) > 0)


def joined_runs(starts: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Windows that begin at ``starts`` (in order) as runs that neither touch nor overlap."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > least)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + least).tolist()))


def own_repeats(hashes: np.ndarray, prints: np.ndarray, places: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Runs of at least ``least`` words of a text that repeat an earlier part of it."""
    _, which, n = np.unique(prints, return_inverse=True, return_counts=True)
    twice = places[n[which] > 1]
    if not len(twice):
        return []
    at = windows(len(hashes), twice, least)
    _, first, which = np.unique(run_hashes(hashes, at, at + least), return_index=True, return_inverse=True)
    return joined_runs(at[first[which] != np.arange(len(at))], least)


def _version(key: str, text: str) -> Column:
    """Tells rows apart by key and text; rows equal in both are treated alike."""
    return F.xxhash64(F.col(key).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit("")))


def _prints(docs: DataFrame, least: int) -> DataFrame:
    """Per text its kept fingerprints, each context of one once, and its repeats of itself."""

    def run(batches):
        for batch in slices(batches):
            out = [[] for _ in range(5)]
            for text in batch.column("text").to_pylist():
                hashes = hashes_of(text)
                fp, place = winnowed(hashes, least)
                around = contexts(hashes, place, least)[2]
                _, first = np.unique(around, return_index=True)
                first.sort()
                own = [x for r in own_repeats(hashes, fp, place, least) for x in r]
                for column, x in zip(out, (len(hashes), fp[first].view(np.int64), around[first].view(np.int64), place[first].astype(np.int32), own)):
                    column.append(x)
            kinds = pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(out, kinds))],
                ["u", "doc_id", "n", "prints", "contexts", "places", "own"],
            )

    return docs.mapInArrow(run, "u long, doc_id long, n int, prints array<long>, contexts array<long>, places array<int>, own array<int>")


def _word_hashes(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in slices(batches):
            words = [hashes_of(t).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("u"), pa.array(words, pa.binary())], ["u", "words"])

    return docs.mapInArrow(run, "u long, words binary")


def _first_places(rows: DataFrame, by: str) -> DataFrame:
    """For each value of ``by`` that several texts have the earliest of these: ``by, a``."""
    text = F.struct("doc_id", "u")
    found = rows.groupBy(by).agg(F.min(text).alias("first"), F.max(text).alias("last"))
    return found.where(F.col("first.u") != F.col("last.u")).select(by, F.col("first.u").alias("a"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 50) -> DataFrame:
    """Runs of words that repeat an earlier text: ``u, doc_id, runs``, each run as start and end word.

    A text comes earlier with a lower key; null keys come first. A run of ``least`` words goes if an earlier text has
    it, or an earlier part of the text. Any two equal ones keep the same fingerprint, so only the runs around
    fingerprints of several texts are looked at. Their contexts, all words in a run with the fingerprint, are keyed
    first: a text whose context an earlier one has repeats all of it. Where a fingerprint has several contexts, the
    runs in the first text of each are keyed by their hashes. Either way a key points to its first text, found by an
    aggregate, so a passage of many texts makes one row a text and never a pair of every two.
    """
    rows = docs.select(
        _version(key, text).alias("u"),
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    found = staged(_prints(rows, least))
    prints = found.select("u", "doc_id", "n", F.explode(F.arrays_zip("prints", "contexts", "places")).alias("x")).select(
        "u", "doc_id", "n", F.col("x.prints").alias("print"), F.col("x.contexts").alias("context"), F.col("x.places").alias("p")
    )
    shared = prints.groupBy("print").agg(
        F.min("u").alias("u0"), F.max("u").alias("u1"), F.min("context").alias("c0"), F.max("context").alias("c1")
    )
    shared = staged(shared.where("u0 != u1").select("print", F.expr("c0 != c1").alias("several")))
    # Most fingerprints stand in one text; they don't enter the join's exchange.
    maybe = flagged(prints, "print", shared.select("print")).where("_maybe").drop("_maybe")
    prints = staged(maybe.join(shared, "print").drop("print"))
    firsts = _first_places(prints, "context")
    linked = staged(prints.join(firsts, "context", "left").drop("context"))
    wholly = linked.where("a != u")
    start = F.greatest(F.col("p") + gram_of(least) - least, F.lit(0))
    wholly = wholly.select("u", "doc_id", start.alias("start"), F.least(F.col("p") + least, F.col("n")).alias("end"))

    # The first text of a context speaks for all that have it.
    places = linked.where("several AND (a IS NULL OR a = u)")
    places = staged(places.groupBy("u").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set("p")).alias("places")))
    words = _word_hashes(flagged(rows, "u", places.select("u")).where("_maybe").select("u", "text")).dropDuplicates(["u"])

    def run(batches):
        for batch in slices(batches, "words"):
            columns = [[], [], [], []]
            for r in batch.to_pylist():
                hashes = np.frombuffer(r["words"], "<u4")
                at = windows(len(hashes), np.array(r["places"], np.int64), least)
                for column, x in zip(columns, (np.full(len(at), r["u"], np.int64), [r["doc_id"]] * len(at), run_hashes(hashes, at, at + least).view(np.int64), at)):
                    column.extend(x)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.int32()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["u", "doc_id", "window", "p"])

    runs = staged(places.join(words, "u").mapInArrow(run, "u long, doc_id long, window long, p int"))
    firsts = staged(_first_places(runs, "window"))
    runs = flagged(runs, "window", firsts.select("window")).where("_maybe").drop("_maybe")
    partly = runs.join(firsts, "window").where("a != u").select("u", "doc_id", F.col("p").alias("start"), (F.col("p") + least).alias("end"))
    own = found.where(F.size("own") > 0).select(
        "u", "doc_id", F.explode(F.expr("transform(sequence(0, size(own) - 2, 2), i -> struct(own[i] as start, own[i + 1] as end))")).alias("r")
    )
    own = own.select("u", "doc_id", F.col("r.start").alias("start"), F.col("r.end").alias("end"))
    return wholly.unionByName(partly).unionByName(own).groupBy("u").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_set(F.struct("start", "end"))).alias("runs")
    )


def without_words(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the runs, the code points they took (start, end), and the number of words removed."""
    raw = text.encode()
    starts, _ = words_of(raw)
    starts = np.append(starts, len(raw)).tolist()
    kept, spans, at, removed, chars = [], [], 0, 0, 0
    merged: list[list[int]] = []
    for s, e in sorted(runs):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    for s, e in merged:
        before, gone = raw[at : starts[s]].decode(), raw[starts[s] : starts[e]].decode()
        kept.append(before)
        spans.append((chars + len(before), chars + len(before) + len(gone)))
        chars += len(before) + len(gone)
        removed += e - s
        at = starts[e]
    return "".join(kept) + raw[at:].decode(), spans, removed


def deduped(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", least: int = 50) -> DataFrame:
    """The documents, all their columns, without runs of ``least`` words or more that repeat an earlier text.

    The text loses its repeated runs with the white space behind them, and ``chars``, where there is such a column,
    is counted anew. Adds ``removed_words`` and ``removed_spans`` (code points of the former text, ends exclusive);
    columns of these names are replaced. Every document stays; one that repeats others wholly has an empty text.

    A null text stays null. Null keys come before all others. Repeated rows, equal in key and text, are treated
    alike and never against each other; rows with one key and different texts are told apart. Texts of fewer than
    ``least`` words and an empty table pass unchanged.
    """
    runs = staged(repeated_runs(docs, key, text, least))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"), _version(key, text).alias("u"))
    marked = flagged(rows, "u", runs.select("u"))
    none = F.lit(None).cast("array<struct<start:int,end:int>>")
    hit = marked.where("_maybe").join(runs.select("u", "runs"), "u", "left").select("row", "text", "runs")
    rest = marked.where(~F.col("_maybe")).select("row", "text", none.alias("runs"))

    def run(batches):
        for batch in slices(batches):
            out = []
            for t, r in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                new, spans, n = without_words(t, [(x["start"], x["end"]) for x in r]) if t and r else (t, [], 0)
                out.append((new, [{"start": s, "end": e} for s, e in spans], n))
            new, spans, n = zip(*out)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(new, pa.string()), pa.array(spans, kind), pa.array(n, pa.int64())],
                ["row", "text", "spans", "n"],
            )

    span = T.StructType().add("start", T.LongType()).add("end", T.LongType())
    shape = T.StructType().add("row", rows.schema["row"].dataType).add("text", T.StringType())
    changed = hit.mapInArrow(run, shape.add("spans", T.ArrayType(span)).add("n", T.LongType()))
    empty = F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    same = rest.select("row", "text", F.coalesce(empty, F.array()).alias("spans"), F.lit(0).cast("long").alias("n"))
    both = changed.unionByName(same)
    fresh = {text: F.col("text"), chars: F.length("text").cast("long")}
    return both.select(
        *(
            fresh.get(c, F.col("row").getField(c)).alias(c)
            for c in docs.columns
            if c not in ("removed_words", "removed_spans")
        ),
        F.col("n").alias("removed_words"),
        F.col("spans").alias("removed_spans"),
    )

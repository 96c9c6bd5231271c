"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, compared by subtracting and peeling."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import slices, tasks_of

#: Cells of a fingerprint and of the first attempt to compare two texts. Divisible by the three places of a digest.
CELLS = 24
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray, which: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers, one of four."""
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLIERS[which]
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLIERS[3]
    return x ^ (x >> np.uint64(32))


def paragraph_cutter(most: int) -> re.Pattern:
    """Sentences and lines; where one is longer than ``most`` characters, parts of that length from its start."""
    return re.compile(r"[^\n.!?]{1,%d}[.!?]*|[\n.!?]+" % most)


def digests(texts: list[str], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Paragraph digests of all texts in a row, and how many each text has.

    The low eight bits of a digest hold the paragraph's length, so what peeling recovers can be weighed. A paragraph
    that a text repeats gets a digest for each occurrence.
    """
    cut = paragraph_cutter(most)
    hashes, lengths, counts = [], [], []
    for t in texts:
        parts = cut.findall(t)
        hashes += map(xxhash.xxh3_64_intdigest, parts)
        lengths += map(len, parts)
        counts.append(len(parts))
    h, count = np.array(hashes, np.uint64), np.array(counts, np.int64)
    owner = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((h, owner))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    place = np.arange(len(h))
    first = np.maximum.accumulate(np.where(same, 0, place)) if len(h) else place
    nth = np.empty(len(h), np.uint64)
    nth[order] = (place - first).astype(np.uint64)
    h = _mixed(h + nth * _MULTIPLIERS[0], 0)
    return h & ~np.uint64(255) | np.minimum(np.array(lengths, np.int64), 255).astype(np.uint64), count


class Sketch:
    """Tables of ``cells`` cells for several texts: per cell a count, the sum of digests and the sum of checks."""

    def __init__(self, rows: int, cells: int):
        self.rows, self.cells = rows, cells
        self.count = np.zeros(rows * cells, np.int64)
        self.keys = np.zeros(rows * cells, np.uint64)
        self.checks = np.zeros(rows * cells, np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        """Adds digests to their owners' tables; a negative sign takes them away. Sums wrap around at 64 bits."""
        third = np.uint64(self.cells // 3)
        signs = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        signed = keys * signs.astype(np.uint64)
        check = _mixed(keys, 2) * signs.astype(np.uint64)
        for i in range(3):
            at = owner * self.cells + i * int(third) + (_mixed(keys ^ _MULTIPLIERS[i], 1) % third).astype(np.int64)
            np.add.at(self.count, at, signs)
            np.add.at(self.keys, at, signed)
            np.add.at(self.checks, at, check)

    def hex(self, row: int) -> str:
        """The table as text: counts, digests and checks, cut to sixteen, sixty-four and thirty-two bits."""
        at = slice(row * self.cells, (row + 1) * self.cells)
        cut = (self.count[at].astype("<u2"), self.keys[at].astype("<u8"), self.checks[at].astype("<u4"))
        return b"".join(x.tobytes() for x in cut).hex()

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """Takes out all digests that stand alone in a cell, again and again.

        Returns by row the recovered length and whether nothing was left over.
        """
        found = np.zeros(self.rows, np.int64)
        while True:
            alone = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[alone]
            keys = self.keys[alone] * sign.astype(np.uint64)
            good = _mixed(keys, 2) * sign.astype(np.uint64) == self.checks[alone]
            alone, sign, keys = alone[good], sign[good], keys[good]
            if not len(alone):
                break
            owner = alone // self.cells
            first = np.unique(np.stack([owner.astype(np.uint64), keys]), axis=1, return_index=True)[1]
            owner, sign, keys = owner[first], sign[first], keys[first]
            np.add.at(found, owner, (keys & np.uint64(255)).astype(np.int64))
            self.add(owner, keys, -sign)
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        return found, ~left.reshape(self.rows, self.cells).any(axis=1)


def _picked(count: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the digests of ``rows`` among all, and their new owners 0, 1, 2 and so on."""
    ends = np.cumsum(count)
    n = count[rows]
    base = np.repeat(ends[rows] - n - (np.cumsum(n) - n), n)
    return base + np.arange(n.sum()), np.repeat(np.arange(len(rows)), n)


def likeness(keys: np.ndarray, count: np.ndarray, a: np.ndarray, b: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Shared length over mean length (Dice) of the texts ``a[i]`` and ``b[i]``, 0 to 1.

    Tables are subtracted and peeled; pairs that leave something over are tried again with twice the cells. From
    three times the digests of a pair on, peeling fails so seldom that the loop ends; it has no other bound.
    """
    weight = np.zeros(len(count), np.int64)
    np.add.at(weight, np.repeat(np.arange(len(count)), count), (keys & np.uint64(255)).astype(np.int64))
    total = weight[a] + weight[b]
    out = np.ones(len(a))
    todo = np.flatnonzero(total)
    while len(todo):
        failed = []
        # As many pairs at once as keep the tables small.
        for part in np.array_split(todo, max(1, len(todo) * cells // 500_000)):
            table = Sketch(len(part), cells)
            for side, sign in ((a, 1), (b, -1)):
                at, owner = _picked(count, side[part])
                table.add(owner, keys[at], sign)
            found, done = table.peel()
            out[part] = np.where(done, 1 - found / total[part], out[part])
            failed.append(part[~done])
        todo = np.concatenate(failed)
        cells *= 2
    return out


def _bucket(key: str, bounds: list[int]) -> Column:
    """The number of bounds at or above a key: buckets by descending key, null keys last."""
    above = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<long>"), lambda x: x >= F.col(key)))
    return F.when(F.col(key).isNull(), F.lit(len(bounds) + 1)).otherwise(above).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows of ``doc_id, text`` dealt by ranges of descending key, each range followed by the first row after it.

    Adds ``bucket`` and ``follows``: true for the copy of a row that only serves as the next of the row before.
    Range limits are quantiles of the keys, one for each part of an exchange; that many numbers and texts meet in
    small tables. Sorting each bucket by descending key, text and ``follows`` puts each row's next behind it.
    """
    parts = tasks_of(docs)
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("q")).first()["q"] if shares else None
    rows = docs.withColumn("bucket", _bucket("doc_id", sorted(set(found or []))))
    # The first row of a bucket: its largest key, among equal keys the smallest text.
    tops = rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()
    tops = sorted((r["bucket"], r["top"]) for r in tops)
    before = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}
    if not before:
        return rows.withColumn("follows", F.lit(False))
    firsts = rows.join(
        F.broadcast(
            docs.sparkSession.createDataFrame([(t, b) for t, b in before.items()], "top long, home int")
        ),
        F.col("doc_id").eqNullSafe(F.col("top")),
    )
    firsts = firsts.groupBy("doc_id", "home").agg(F.min_by("text", F.coalesce("text", F.lit(""))).alias("text"))
    copies = firsts.select("doc_id", "text", F.col("home").alias("bucket"), F.lit(True).alias("follows"))
    # The last bucket is followed by the very first row; it sorts behind all others by ``follows``.
    return rows.withColumn("follows", F.lit(False)).unionByName(copies)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", paragraph: int = 48, cells: int = CELLS) -> DataFrame:
    """Fingerprint of every text, of its edited text, and how alike it is to the edited and to the next text.

    The next text is that of the next lower key; after the lowest key comes the highest. The edited text has its
    last third replaced by as many first characters of the next text, or all of it. Likeness is the shared length
    of paragraphs over the mean length of both texts, from the differing digests that peeling the subtracted
    tables recovers, with larger tables where the first ones fail. Equal texts have equal fingerprints; two empty
    texts are wholly alike.

    A null text counts as empty. Rows without a key come last; rows with one key are ordered by text, nulls first.
    Other columns are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    dealt = with_next(rows)
    dealt = dealt.repartitionById(tasks_of(docs) + 1, F.col("bucket")).sortWithinPartitions(
        "bucket", "follows", F.desc_nulls_last("doc_id"), "text"
    )

    def run(batches):
        held = None  # the last row of the slice before, whose next row is still to come
        for batch in slices(batches):
            ids, texts, buckets, follows = (batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "follows"))
            if held:
                ids, texts, buckets, follows = ([h, *x] for h, x in zip(held, (ids, texts, buckets, follows)))
            texts = [t or "" for t in texts]
            held = ids[-1], texts[-1], buckets[-1], follows[-1]
            own = [i for i in range(len(ids) - 1) if not follows[i]]
            if not own:
                continue
            edited = []
            for i in own:
                if buckets[i] != buckets[i + 1]:
                    raise ValueError("a bucket lacks the row that follows it")
                cut = len(texts[i]) // 3
                edited.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
            keys, count = digests(texts + edited, paragraph)
            at = np.array(own)
            new = len(texts) + np.arange(len(own))
            sketch = Sketch(len(count), cells)
            sketch.add(np.repeat(np.arange(len(count)), count), keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i] for i in own], pa.int64()),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([sketch.hex(i) for i in own]),
                    pa.array([sketch.hex(i) for i in new]),
                    pa.array(likeness(keys, count, at, new, cells)),
                    pa.array(likeness(keys, count, at, at + 1, cells)),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return dealt.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )

"""Packing: cutting-stock patterns by column generation, assigned to ranked pieces of documents."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.text import Memo, held, slices, staged, tasks_of, words

#: Tokens of a sequence.
SIZE = 2048
#: Lengths are rounded up to multiples of this for the patterns, so the linear program has SIZE / GRAIN rows.
GRAIN = 8

#: Fixed value: the pattern of the word tokenizer, whose normaliser composes and lowers letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NOT_PLAIN = re.compile("[^ -~\n\t\r\xa1-\xac\xae-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20ac]")
# The same pattern, its classes spelled out for plain characters.
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
#: Bytes as byte-level models spell them: printable ones as they are, the others from U+0100 on, in order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def splits_plainly(spec: str) -> bool:
    """True if ``plain_tokens`` cuts texts as the tokenizer does whose JSON this is."""
    made = json.loads(spec)
    kinds = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return kinds == ["NFC", "Replace", "Lowercase"] and (cuts[0].get("pattern") or {}).get("Regex") == PATTERN and cuts[-1].get("type") == "ByteLevel"


def _ids(spec: str) -> Memo:
    """Little-endian 32-bit ids of pieces."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_padding()
    tokenizer.no_truncation()

    def encode(batch: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    return Memo(encode)


def _plain_ids(spec: str) -> Memo:
    """The same for plain tokens. Each is what the model sees, so its merges are all there is to do."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_str(spec).model

    def encode(batch: list[str]) -> list[bytes]:
        spelled = (p if p.isascii() else p.encode().decode("latin-1").translate(_SPELLED) for p in batch)
        return [array("I", [t.id for t in model.tokenize(p)]).tobytes() for p in spelled]

    return Memo(encode, 192 << 20)


def is_plain(text: str) -> bool:
    """Whether ``plain_tokens`` can cut a text: Latin letters that the tokenizer leaves composed, common marks.

    Letters up to U+017F are as the tokenizer normalises them, but for U+0130.
    """
    return not (_NOT_PLAIN.search(text) or "<|" in text)


def plain_tokens(text: str) -> list[str]:
    """What the word tokenizer's pattern finds in a plain text once letters are lowered: few distinct parts."""
    return _PLAIN.findall(text.lower())


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end: int = 1,
    size: int = SIZE,
    with_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The ids of every text and the end id, cut into pieces of ``size``; the last piece of a text is what is left.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens`` and, if wanted, ``ids`` as little-endian 32-bit
    numbers. ``tokenizer`` is the path of a tokenizer's JSON on the driver that drops white space. A null text is
    empty and has the end id alone. Null keys and repeated rows are kept; other columns are ignored; an empty table
    gives no rows.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    last = np.array([end], "<u4").tobytes()
    plainly = splits_plainly(spec)

    def run(batches):
        whole, parts = held(("ids", spec), lambda: (_ids(spec), _plain_ids(spec)))
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            plain = [plainly and is_plain(t) for t in texts]
            cut = [plain_tokens(t) if p else words(t) for t, p in zip(texts, plain)]
            for memo, kind in ((parts, True), (whole, False)):
                memo.learn(set().union(*(c for c, p in zip(cut, plain) if p == kind)))
            out = []
            for doc, own, p in zip(batch.column("doc_id").to_pylist(), cut, plain):
                ids = b"".join(map((parts if p else whole).__getitem__, own)) + last
                for at in range(0, len(ids), 4 * size):
                    own = ids[at : at + 4 * size]
                    out.append((doc, at // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4) + (own,) * with_ids)
            columns = list(zip(*out))
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids,
            )

    return rows.mapInArrow(run, schema)


def best_pattern(values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of lengths 1 to ``room`` that fits, by dynamic programming; values[i] is of i + 1."""
    best, last = np.zeros(room + 1), np.zeros(room + 1, int)
    for c in range(1, room + 1):
        sums = values[:c] + best[c - 1 :: -1][:c]
        i = int(np.argmax(sums))
        best[c], last[c] = (sums[i], i + 1) if sums[i] > best[c - 1] else (best[c - 1], 0)
    pattern, c = np.zeros(room, int), room
    while c > 0:
        if last[c]:
            pattern[last[c] - 1] += 1
        c -= last[c] or 1
    return best[room], pattern


def column_generation(demand: np.ndarray, gap: float = 0.0005, rounds: int = 20_000) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to cut each, from the linear program of the cutting-stock problem.

    ``demand[i]`` counts items of length i + 1 for bins of ``len(demand)``. Each round prices a new pattern with the
    duals of the present basis and pivots it in. Ends when the bound by the best price is within ``gap``; every
    basis on the way is feasible, so ending after ``rounds`` costs padding only.
    """
    room = len(demand)
    own = np.flatnonzero(demand)
    if not len(own):
        return []
    rows = len(own)
    patterns = np.zeros((rows, rows), int)
    np.fill_diagonal(patterns, room // (own + 1))
    inverse = np.diag(1.0 / np.diag(patterns))
    level = inverse @ demand[own]
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        values = np.zeros(room)
        values[own] = np.maximum(duals, 0)
        worth, pattern = best_pattern(values, room)
        if worth <= 1 + gap:
            break
        entering = inverse @ pattern[own]
        grows = np.flatnonzero(entering > 1e-9)
        ratios = level[grows] / entering[grows]
        out = grows[np.argmin(ratios)]
        step = level[out] / entering[out]
        level = np.maximum(level - step * entering, 0)
        level[out] = step
        patterns[:, out] = pattern[own]
        inverse[out] /= entering[out]
        others = np.arange(rows) != out
        inverse[others] -= np.outer(entering[others], inverse[out])
    found = []
    for j in range(rows):
        whole = np.zeros(room, int)
        whole[own] = patterns[:, j]
        found.append((whole, float(level[j])))
    return found


def rounded(demand: np.ndarray, found: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of patterns: levels rounded down, and what they leave over packed first fit, longest first."""
    room = len(demand)
    left = demand.astype(int).copy()
    out = []
    for pattern, level in found:
        times = int(level + 1e-9)
        used = np.flatnonzero(pattern)
        if len(used):
            times = min(times, int((left[used] // pattern[used]).min()))
        if times > 0:
            left -= pattern * times
            out.append((pattern, times))
    bins: list[tuple[np.ndarray, int]] = []
    while left.any():
        pattern, free = np.zeros(room, int), room
        for i in np.flatnonzero(left)[::-1]:
            n = min(left[i], free // (i + 1))
            pattern[i] += n
            free -= n * (i + 1)
        used = np.flatnonzero(pattern)
        times = int((left[used] // pattern[used]).min())
        left -= pattern * times
        bins.append((pattern, times))
    return out + bins


def _intervals(patterns: list[tuple[np.ndarray, int]]) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """By class the runs of ranks that each pattern takes: class, from, to, first sequence, items a sequence, first slot."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in patterns:
        slot = 0
        for i in np.flatnonzero(pattern)[::-1]:
            n, start = int(pattern[i]), taken.get(int(i) + 1, 0)
            out.append((int(i) + 1, start, start + n * times, sequence, n, slot))
            taken[int(i) + 1] = start + n * times
            slot += n
        sequence += times
    return out, sequence


def pack(cut: DataFrame, size: int = SIZE, grain: int = GRAIN) -> DataFrame:
    """Places pieces of at most ``size`` tokens in sequences: adds ``sequence_id`` and ``offset``.

    Pieces are counted by length in steps of ``grain`` (at most size / grain counts reach the driver). A linear
    program over patterns of such lengths is solved there by column generation, and its rounded patterns become
    runs of ranks by length: a table of at most (size / grain) squared rows, plus as many for what rounding leaves.
    Ranks count within hash parts of a length and add up over the parts, so a length that a third of all pieces
    have is spread over tasks. Pieces are ranked by part, document and start; equal rows are interchangeable.

    The input is read several times and should be a stored table; see ``packed``. All its columns are kept. Null keys
    and repeated rows are pieces like others; no pieces give no rows.
    """
    spark, room = cut.sparkSession, size // grain
    own = cut.withColumn("_class", F.ceil(F.col("length") / grain).cast("int")).withColumn(
        "_part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(tasks_of(cut))).cast("int")
    )
    counts = staged(own.groupBy("_class", "_part").count())
    demand = np.zeros(room, np.int64)
    for r in counts.groupBy("_class").agg(F.sum("count").alias("n")).collect():
        demand[r["_class"] - 1] = r["n"]
    runs, _ = _intervals(rounded(demand, column_generation(demand)))
    table = spark.createDataFrame(
        runs or [(0, 0, 0, 0, 1, 0)], "_class int, _from long, _to long, _first long, _each long, _slot long"
    )
    before = Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_class", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("_class", "_part").orderBy("doc_id", "start", "ids_crc32")
    ranked = own.withColumn("_rank", F.row_number().over(order) - 1).join(offsets, ["_class", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    placed = ranked.join(F.broadcast(table), "_class").where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    nth = F.col("_rank") - F.col("_from")
    placed = placed.withColumn("sequence_id", F.col("_first") + F.floor(nth / F.col("_each")).cast("long")).withColumn(
        "_slot", F.col("_slot") + nth % F.col("_each")
    )
    along = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("offset", F.sum("length").over(along) - F.col("length"))
    return placed.select(*cut.columns, "sequence_id", "offset")


def packed(docs: DataFrame, tokenizer: str, end: int = 1, size: int = SIZE, grain: int = GRAIN, with_ids: bool = False) -> DataFrame:
    """Tokenises the documents once, stores the pieces in the shared folder and packs them.

    Nulls, repeated rows and empty tables as in ``token_pieces``: a null text is one piece that holds the end id.
    """
    return pack(staged(token_pieces(docs, tokenizer, end, size, with_ids)), size, grain)


def sequences(placed: DataFrame, size: int = SIZE, pad: int = 0) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` of pieces with ids, padded to ``size``.

    A sequence whose length is a power of two stays as it is.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = placed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n"))
    exact = F.col("n").isin([1 << i for i in range(size.bit_length())])
    padding = F.expr(f"unhex(repeat('{pad.to_bytes(4, 'little').hex()}', int({size} - n)))")
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return whole.select("sequence_id", F.when(exact, ids).otherwise(F.concat(ids, padding)).alias("ids"))

"""Phrase collocations: counts of word runs in weighted automata, united by prefix range, and scores from their parts.

A shard of texts gives one run of up to four words for each of its words. Sorted, these become an acyclic weighted
automaton: a row that differs from the row before in its d-th word opens new states from depth d on, and a state's
weight is the sum of the rows below it, which is the number of times its words stand in the shard. The automaton is cut
into prefix ranges, each range's parts of all shards meet in one task, are united, and lose what is too rare. Parts of
phrases are looked up by composing their own acceptor with the united automaton of their range.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.hashing import mixed
from wardline.llm.text import SLICE_BYTES, slices, staged, tasks_of

#: Marks that end a piece, and the byte that stands for the end of a piece among words (no word can hold it).
_ENDS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", b"\n" * 10)
_END = b"."
#: Words of a shard; its arrays take about a hundred bytes a word.
SHARD_WORDS = 1_000_000
#: Depth of an automaton, and the words that choose its range: words and pairs by their first word, longer runs by three.
#: A frequent first word has no more rows in a range than a shard has words, and a frequent run of three as well.
KINDS = ((2, 1), (4, 3))


def words_of(texts: list[str], block: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Lower-case words of the texts, an end mark behind each piece; long texts come in blocks that end with a piece."""
    raw = "\n".join([*texts, ""]).encode().lower().translate(_ENDS)
    start = 0
    while start < len(raw):
        end = raw.find(b"\n", start + block) + 1 or len(raw)
        yield raw[start:end].replace(b"\n", b" . ").split()
        start = end


@dataclass
class Automaton:
    """A weighted acyclic automaton of word runs, level by level, each level in the order of its runs.

    ``words`` is the alphabet, in whose order runs are sorted; its first entry, the empty word, ends a run. ``labels[d]`` are the words on
    the arcs into depth d + 1, ``fans[d]`` the numbers of arcs that leave each state of depth d + 1, ``weights`` those
    of the last level. The weight of any other state is the sum below it.
    """

    words: list[bytes]
    labels: list[np.ndarray]
    fans: list[np.ndarray]
    weights: np.ndarray

    @classmethod
    def built(cls, words: list[bytes], runs: np.ndarray, counts: np.ndarray) -> Automaton:
        """From sorted distinct runs, a row each (0 fills a run that has ended), and their counts."""
        depth = runs.shape[1]
        fresh = np.ones(runs.shape, bool)
        fresh[1:] = np.logical_or.accumulate(runs[1:] != runs[:-1], axis=1)
        labels = [runs[fresh[:, d], d] for d in range(depth)]
        fans = []
        for d in range(depth - 1):
            opened = np.cumsum(fresh[:, d + 1])
            first = np.flatnonzero(fresh[:, d])
            fans.append(np.diff(np.r_[opened[first] - 1, len(labels[d + 1])]))
        return cls(words, labels, fans, counts)

    def levels(self) -> list[np.ndarray]:
        """The weights of all states, level by level."""
        out = [self.weights]
        for fan in reversed(self.fans):
            starts = np.cumsum(fan) - fan
            out.insert(0, np.add.reduceat(out[0], starts) if len(starts) else out[0][:0])
        return out

    def runs(self, depth: int) -> np.ndarray:
        """A row of words for each state of the depth."""
        out = self.labels[0][:, None]
        for d in range(1, depth):
            out = np.column_stack([np.repeat(out, self.fans[d - 1], axis=0), self.labels[d]])
        return out

    def packed(self) -> bytes:
        """Compressed bytes; those of equal place in the numbers stand together."""
        arrays = [*self.labels, *self.fans, self.weights]
        head = struct.pack(f"<{len(arrays) + 1}Q", len(self.labels), *map(len, arrays))
        planes = [a.astype(k).view("u1").reshape(len(a), int(k[-1])).T.tobytes() for a, k in zip(arrays, self._kinds(len(arrays)))]
        return zstandard.compress(head + b"".join(planes) + b"\n".join(self.words), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Automaton:
        raw = zstandard.decompress(data)
        (depth,) = struct.unpack_from("<Q", raw)
        sizes = struct.unpack_from(f"<{2 * depth}Q", raw, 8)
        at, arrays = 8 + 16 * depth, []
        for n, kind in zip(sizes, cls._kinds(2 * depth)):
            width = int(kind[-1])
            planes = np.frombuffer(raw, "u1", n * width, at).reshape(width, n)
            arrays.append(np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64))
            at += n * width
        return cls(raw[at:].split(b"\n"), arrays[:depth], arrays[depth:-1], arrays[-1])

    @staticmethod
    def _kinds(n: int) -> list[str]:
        return ["<u4"] * (n - 1) + ["<u8"]

    @classmethod
    def spelled(cls, words: list[bytes], runs: np.ndarray, counts: np.ndarray) -> Automaton:
        """As ``built``, with only those words in the alphabet that the runs use."""
        used = np.zeros(len(words), bool)
        used[0] = True
        used[runs] = True
        number = np.cumsum(used) - 1
        return cls.built([words[i] for i in np.flatnonzero(used).tolist()], number[runs], counts)

    def relabelled(self, place: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Its runs in the numbers of a larger alphabet, and their weights."""
        number = np.fromiter(map(place.__getitem__, self.words), np.int64, len(self.words))
        return number[self.runs(len(self.labels))], self.weights


def _summed(runs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs in order, with the sums of their counts."""
    key = runs[:, -1]
    for d in range(runs.shape[1] - 2, -1, -1):  # ranks of ever longer ends keep the order and stay small
        key = runs[:, d] * (int(key.max(initial=0)) + 1) + key
        order = np.argsort(key)
        fresh = np.r_[True, key[order[1:]] != key[order[:-1]]] if len(order) else np.zeros(0, bool)
        key = np.empty(len(order), np.int64)
        key[order] = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    return runs[order[first]], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def united(parts: list[Automaton]) -> Automaton:
    """The automaton whose weights are the sums of the parts'."""
    words = list(dict.fromkeys(chain.from_iterable(p.words for p in parts)))
    place = {w: i for i, w in enumerate(words)}
    runs, counts = zip(*(p.relabelled(place) for p in parts))
    return Automaton.built(words, *_summed(np.concatenate(runs), np.concatenate(counts)))


def pruned(a: Automaton, least: int) -> Automaton:
    """Without runs rarer than ``least``; what a rare last word weighed goes to the end of its shorter run.

    So every run that is left, of the full depth or one word less, keeps its weight.
    """
    runs, counts = a.runs(len(a.labels)), a.weights
    runs[counts < least, -1] = 0
    a = Automaton.built(a.words, *_summed(runs, counts))
    weight = a.levels()[-2]
    kept = np.repeat(weight >= least, a.fans[-1])
    runs, counts = a.runs(len(a.labels))[kept], a.weights[kept]
    return Automaton.spelled(a.words, runs, counts)


def listed(a: Automaton) -> list[tuple[str, int, int]]:
    """(phrase, its words, weight) for the runs of a pruned automaton: those of full depth and of one word less."""
    out = []
    levels = a.levels()
    for depth in (len(levels) - 1, len(levels)):
        runs, weights = a.runs(depth), levels[depth - 1].tolist()
        said = [b" ".join(a.words[i] for i in run).decode() if run[-1] else "" for run in runs.tolist()]
        out += [(p, depth, w) for p, w in zip(said, weights) if p]
    return out


def composed(a: Automaton, parts: list[bytes]) -> list[int]:
    """The weight of each part: their acceptor walks the automaton, all parts at once, a level a step."""
    place = {w: i for i, w in enumerate(a.words)}
    split = [p.split(b" ") for p in parts]
    state = np.zeros(len(parts), np.int64)
    out = np.zeros(len(parts), np.int64)
    sizes = np.array([len(s) for s in split], np.int64)
    for d, weights in enumerate(a.levels()):
        fan = a.fans[d - 1] if d else np.array([len(a.labels[0])])
        arcs = np.repeat(np.arange(len(fan)), fan) * (len(a.words) + 1) + a.labels[d]
        label = np.array([place.get(s[d], len(a.words)) if d < len(s) else 0 for s in split], np.int64)
        wanted = state * (len(a.words) + 1) + label
        at = np.minimum(np.searchsorted(arcs, wanted), max(len(arcs) - 1, 0))
        found = (state >= 0) & (d < sizes) & (arcs[at] == wanted if len(arcs) else False)
        state = np.where(found, at, -1)
        ended = found & (sizes == d + 1)
        out[ended] = weights[at[ended]]
    return out.tolist()


def _ranges(hashes: np.ndarray, runs: np.ndarray, size: int, parts: int) -> np.ndarray:
    """The prefix range of each run: that of the hash of its first words."""
    h = np.zeros(len(runs), np.uint64)
    for d in range(size):
        h = mixed(h * np.uint64(31) + hashes[runs[:, d]])
    return (h % np.uint64(parts)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


class Shard:
    """Word runs of one language in one task, until there are enough for automata."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b"": 0, _END: 1}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        for w in set(words).difference(self.numbers):
            self.numbers[w] = len(self.numbers)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def cut(self, ranges: int) -> Iterator[tuple[int, int, bytes, int]]:
        """(depth, range, automaton, words said), once for each depth and range that has runs."""
        words, end = list(self.numbers), self.numbers[_END]
        x = np.concatenate(self.parts)
        hashes = _hashes(words)
        for depth, lead in KINDS:
            runs = np.zeros((len(x), depth), np.int64)
            open_ = np.ones(len(x), bool)
            for d in range(depth):
                open_[: len(x) - d] &= x[d:] != end
                open_[len(x) - d :] = False
                runs[: len(x) - d, d] = np.where(open_[: len(x) - d], x[d:], 0)
            runs, counts = _summed(*(lambda r: (r, np.ones(len(r), np.int64)))(runs[runs[:, lead - 1] > 0]))
            at = _ranges(hashes, runs, lead, ranges)
            order = np.argsort(at, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                if not len(own):
                    continue
                a = Automaton.spelled(words, runs[own], counts[own])
                yield depth, int(at[own[0]]), a.packed(), int(counts[own].sum())


def shards(docs: DataFrame, text: str, lang: str, ranges: int, most: int = SHARD_WORDS) -> DataFrame:
    """``lang, depth, part, automaton, said``: the automata of all shards by prefix range, and the runs they hold."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    schema = "lang string, depth int, part int, automaton binary, said long"

    def run(batches):
        held: dict[str, Shard] = {}

        def closed(own: str):
            for row in held.pop(own).cut(ranges):
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (own, *row)], schema=kinds)

        for batch in slices(batches):
            by_lang: dict[str, list[str]] = {}
            for own, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(own, []).append(t)
            for own, texts in by_lang.items():
                for words in words_of(texts):
                    held.setdefault(own, Shard()).add(words)
                    if held[own].size >= most:
                        yield from closed(own)
            while sum(s.size for s in held.values()) > 2 * most:
                yield from closed(max(held, key=lambda k: held[k].size))
        for own in list(held):
            yield from closed(own)

    kinds = pa.schema([("lang", pa.string()), ("depth", pa.int32()), ("part", pa.int32()), ("automaton", pa.binary()), ("said", pa.int64())])
    return rows.mapInArrow(run, schema)


def unions(parts: DataFrame, least: int) -> DataFrame:
    """``lang, depth, part, said, automaton``: each prefix range of all shards, without runs rarer than ``least``.

    Automata are united a few at a time, so a task holds its range's distinct runs beside the packed parts.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        waiting, size = [], 0
        for data in rows.automaton:
            waiting.append(Automaton.unpacked(data))
            size += len(waiting[-1].weights)
            if size > 2 * SHARD_WORDS + len(waiting[0].weights):
                waiting, size = [united(waiting)], 0
        packed = pruned(united(waiting), least).packed()
        return pd.DataFrame([(*key, int(rows.said.sum()), packed)], columns=["lang", "depth", "part", "said", "automaton"])

    return parts.groupBy("lang", "depth", "part").applyInPandas(run, "lang string, depth int, part int, said long, automaton binary")


def phrases(united_: DataFrame) -> DataFrame:
    """``lang, phrase, size, f``: all runs of one to four words that are left in the united automata."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])

    def run(batches):
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("automaton").to_pylist()):
                rows = listed(Automaton.unpacked(data))
                columns = zip(*rows) if rows else ([], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(([lang] * len(rows), *columns), schema.types)], schema=schema
                )

    return united_.select("lang", "automaton").mapInArrow(run, "lang string, phrase string, size int, f long")


def looked_up(parts: DataFrame, united_: DataFrame, ranges: int) -> DataFrame:
    """``lang, phrase, f`` for distinct ``lang, phrase``: each goes to the automaton of its prefix range.

    A part of a frequent phrase is frequent itself, so it is found; one that is not has weight 0.
    """

    def placed(batches):
        for batch in batches:
            split = [p.encode().split(b" ") for p in batch.column("phrase").to_pylist()]
            kinds = [KINDS[0] if len(s) <= KINDS[0][0] else KINDS[1] for s in split]
            words = sorted({b""}.union(*split))
            place = {w: i for i, w in enumerate(words)}
            runs = np.array([[place[w] for w in (s + [b""] * 4)[:4]] for s in split], np.int64).reshape(-1, 4)
            hashes, part = _hashes(words), np.zeros(len(split), np.int64)
            for kind in KINDS:
                own = np.array([k == kind for k in kinds], bool)
                part[own] = _ranges(hashes, runs[own], kind[1], ranges)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("phrase"), pa.array([k[0] for k in kinds], pa.int32()), pa.array(part, pa.int32())],
                ["lang", "phrase", "depth", "part"],
            )

    def run(asked: pd.DataFrame, automata: pd.DataFrame) -> pd.DataFrame:
        wanted = [p.encode() for p in asked.phrase]
        f = composed(Automaton.unpacked(automata.automaton.iloc[0]), wanted) if len(automata) and wanted else [0] * len(wanted)
        return pd.DataFrame({"lang": asked.lang, "phrase": asked.phrase, "f": pd.Series(f, index=asked.index, dtype="int64")})

    keys = ("lang", "depth", "part")
    asked = parts.select("lang", "phrase").mapInArrow(placed, "lang string, phrase string, depth int, part int")
    return asked.groupBy(*keys).cogroup(united_.groupBy(*keys)).applyInPandas(run, "lang string, phrase string, f long")


def _best(rows: DataFrame, most: int, parts: int) -> DataFrame:
    """Ranks of each language's best: first within the parts that the phrases are dealt to, then among what is left."""
    order = "ORDER BY score DESC, a DESC, phrase"
    dealt = rows.withColumn("_part", F.expr(f"pmod(xxhash64(phrase), {parts})"))
    left = dealt.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY lang, _part {order})")).where(F.col("rank") <= most)
    ranked = left.withColumn("rank", F.expr(f"CAST(row_number() OVER (PARTITION BY lang {order}) AS LONG)"))
    return ranked.where(F.col("rank") <= most).drop("_part")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, most: int = 2000) -> DataFrame:
    """The best phrases of two to four words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A to Z), split into pieces at ``.,;:!?`` and line ends, and these into words at spaces and
    tabs. ``a`` counts a phrase's places within pieces, ``n`` a language's words. Candidates have ``a >= least``. A cut
    after the first k words gives the counts ``l`` and ``r`` of both parts and the score floor(2000000 a / (l + r)); the
    lowest cut counts, the first of equal ones. A candidate whose words stand in a longer candidate with at least
    four fifths of its count is dropped. Each language's first ``most`` by score and ``a``, both descending, then phrase.

    A null text is empty, a null language is ``und``, repeated rows count each time, other columns are ignored; an empty
    table, or one without frequent phrases, gives no rows.
    """
    ranges = tasks_of(docs)
    whole = staged(unions(shards(docs, text, lang, ranges), least))
    said = whole.where(F.col("depth") == KINDS[0][0]).groupBy("lang").agg(F.sum("said").alias("n"))
    found = staged(phrases(whole).where("size > 1").withColumnRenamed("f", "a"))

    cuts = found.select("lang", "phrase", "a", F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("rest"),
    )
    parts = cuts.select("lang", F.explode(F.array("head", "rest")).alias("phrase")).distinct()
    weights = staged(looked_up(parts, whole, ranges))
    for name, count in (("head", "l"), ("rest", "r")):
        cuts = cuts.join(weights.select("lang", F.col("phrase").alias(name), F.col("f").alias(count)), ["lang", name])
    # Decimals hold the products of any counts.
    cuts = cuts.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) + r)"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.expr("min(struct(score, k, l, r))").alias("cut"))

    longer = found.where("size > 2").select("lang", "a", F.split("phrase", " ").alias("w"))
    inside = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    held = longer.select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = lowest.join(held, ["lang", "phrase"], "left").where(
        "around IS NULL OR CAST(around AS DECIMAL(19, 0)) * 100 < CAST(a AS DECIMAL(19, 0)) * 80"
    )
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return (
        _best(rows, most, ranges)
        .join(said, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    )

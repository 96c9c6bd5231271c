"""Size-aware Jaccard join of word n-grams: subset keys for small sets, inverted lists for large ones."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.components import components
from wardline.llm.hashing import mixed, run_hashes
from wardline.llm.text import flagged, slices, staged, tasks_of

#: Counters of how many sets a gram is in, by hash. Their number is fixed; they only order grams.
COUNTERS = 1 << 20
#: Counters of one stored row, and set sizes that the cost of small sets is weighed for.
CHUNK, SIZES = 4096, 64
#: Cost of one entry of an inverted list against that of one subset key.
LIST_COST = 4

#: Bits by which two sets are held against each other before they are compared.
PARITY = 1024

#: Times at most that the sets on a key are compared with another one of them before all of different components are.
ROUNDS = 3

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def grams_of(text: str, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct grams of ``size`` words, A to Z in lower case.

    With fewer words the whole sequence is one gram; without words there is none.
    """
    raw = text.encode().lower()
    blank = _BLANK[np.frombuffer(raw, np.uint8)]
    edge = np.diff(np.concatenate([[1], blank.astype(np.int8), [1]]))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = run_hashes(np.frombuffer(raw, np.uint8), starts, ends)
    first = np.arange(max(1, len(words) - size + 1))
    return np.unique(run_hashes(words, first, np.minimum(first + size, len(words))))


def least_common(n: int, percent: int) -> int:
    """Grams that a set of n shares at least with any set it links with."""
    return -(-n * percent // 100)


def subset_count(n: int, percent: int) -> int:
    return sum(comb(n, d) for d in range(n - least_common(n, percent) + 1))


def boundary(sizes: np.ndarray, percent: int) -> int:
    """The largest size of small sets: where subset keys of those and list entries of the others cost least.

    ``sizes[n]`` counts sets of n grams. Sets within linking distance of the boundary are on both sides.
    """
    keys = [subset_count(n, percent) if n else 0 for n in range(SIZES)]
    entries = [LIST_COST * (n - least_common(n, percent) + 1) for n in range(SIZES)]

    def cost(x: int) -> int:
        low = least_common(x + 1, percent)
        return sum(int(sizes[n]) * keys[n] for n in range(x + 1)) + sum(int(sizes[n]) * entries[n] for n in range(low, SIZES))

    return min(range(SIZES - 1), key=cost)


def subset_keys(grams: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all subsets that a linked set may share wholly, and their sizes."""
    n = len(grams)
    weights = mixed(grams)
    total = weights.sum(dtype=np.uint64)
    keys, left = [], []
    for d in range(n - least_common(n, percent) + 1):
        out = np.array(list(combinations(range(n), d)), int).reshape(comb(n, d), d)
        keys.append(mixed(total - weights[out].sum(axis=1, dtype=np.uint64) + np.uint64(n - d)))
        left.append(np.full(len(out), n - d))
    return np.concatenate(keys), np.concatenate(left)


def list_entries(grams: np.ndarray, percent: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set's rarest grams, enough to share one with every linked set, and how many grams from each on are left."""
    n = len(grams)
    rank = np.minimum(counts[(grams >> np.uint64(44)).astype(np.int64)], (1 << 20) - 1).astype(np.uint64)
    order = np.argsort(rank << np.uint64(44) | grams & np.uint64((1 << 44) - 1))
    kept = n - least_common(n, percent) + 1
    return grams[order[:kept]], n - np.arange(kept)


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """For each of PARITY hash slots whether an odd number of grams falls there, as 64-bit numbers.

    Two sets differ in at least as many grams as their bits differ in places.
    """
    odd = np.bincount((mixed(grams) >> np.uint64(54)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _counted(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many sets have a gram of each counter, and how many sets have each small size, over all texts.

    Each task adds up its own counters; sums meet by chunk. What reaches the driver has a fixed size.
    """

    def count(batches):
        counts, sizes = np.zeros(COUNTERS, np.int64), np.zeros(CHUNK, np.int64)
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                grams = grams_of(text or "", size)
                np.add.at(counts, (grams >> np.uint64(44)).astype(np.int64), 1)
                if len(grams) < SIZES:
                    sizes[len(grams)] += 1
        parts = [*counts.reshape(-1, CHUNK), sizes]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([p.astype("<i4").tobytes() for p in parts], pa.binary())],
            ["chunk", "counts"],
        )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(raw, "<i4")
                sums[chunk] = sums[chunk] + own if chunk in sums else own.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in sums.values()], pa.binary())],
            ["chunk", "counts"],
        )

    schema = "chunk int, counts binary"
    found = rows.select("text").mapInArrow(count, schema).repartition(tasks_of(rows), "chunk").mapInArrow(add, schema)
    counts, sizes = np.zeros(COUNTERS, np.int64), np.zeros(CHUNK, np.int64)
    for r in found.collect():
        own = np.frombuffer(r["counts"], "<i8")
        if r["chunk"] * CHUNK < COUNTERS:
            counts[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = own
        else:
            sizes[:] = own
    return counts, sizes[:SIZES]


def _sets(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row its set's size, two hashes and parity bits, and its keys with the most that a set behind each shares."""
    counts, sizes = _counted(rows, size)
    small = boundary(sizes, percent)
    low = least_common(small + 1, percent)
    shipped = rows.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 31) - 1).astype(np.int32))

    def run(batches):
        counts = shipped.value
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                grams = grams_of(text or "", size)
                n, parts = len(grams), []
                if 0 < n <= small:
                    parts.append(subset_keys(grams, percent))
                if n and n >= low:
                    parts.append(list_entries(grams, percent, counts))
                keys = np.concatenate([p[0] for p in parts]) if parts else grams
                rest = np.concatenate([p[1] for p in parts]) if parts else grams
                one = mixed(grams).sum(dtype=np.uint64)
                two = mixed(mixed(grams) ^ np.uint64(n)).sum(dtype=np.uint64)
                numbers = n, int(one.astype(np.int64)), int(two.astype(np.int64))
                out.append((*numbers, keys.view(np.int64), rest.astype(np.int32), parity_bits(grams)))
            n, one, two, keys, rest, bits = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(x, pa.int64()) for x in (n, one, two)),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(rest, pa.list_(pa.int32())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "one", "two", "keys", "rest", "bits"],
            )

    return rows.mapInArrow(run, "doc_id long, n long, one long, two long, keys array<long>, rest array<int>, bits array<long>")


def _may_link(percent: int, n: Column, rest: Column, other_n: Column, other_rest: Column) -> Column:
    """Whether what is left behind a common key can make the two sets alike enough."""
    return F.least(rest, other_rest) * (100 + percent) >= percent * (n + other_n)


def _bits_allow(percent: int) -> Column:
    """Whether the parity bits of ``l`` and ``r`` differ in no more places than grams of two linked sets may."""
    apart = " + ".join(f"bit_count(l.bits[{i}] ^ r.bits[{i}])" for i in range(PARITY // 64))
    return F.expr(f"({apart}) * {100 + percent} <= (l.n + r.n) * {100 - percent}")


def _verified(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are alike enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = flagged(rows, "doc_id", ids).where("_maybe").select("doc_id", "text")

    def build(batches):
        for batch in slices(batches):
            sets = [grams_of(t or "", size).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "grams"])

    sets = texts.mapInArrow(build, "doc_id long, grams binary")
    first = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("left"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("right"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "left", "right")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                joined = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((joined[1:] == joined[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def _placed(more: DataFrame, found: DataFrame) -> DataFrame:
    """Adds the component ``c`` that each set is in so far."""
    return more.join(found.withColumnRenamed("node", "doc"), "doc", "left").select("*", F.coalesce("component", "doc").alias("c")).drop("component")


def _late_links(more: DataFrame, found: DataFrame, links: DataFrame, tried: DataFrame, rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Components, links and tried pairs after each key's sets were held against one of them, chosen anew each time.

    What the smallest set of a group missed, any other of the group is likely to link, so groups of near copies
    grow together by one comparison a member. The choice is by document: sets that share many keys meet one leader.
    """
    for turn in range(ROUNDS):
        leader = F.min_by(F.struct("doc", "n", "rest", "bits", "c"), F.xxhash64("doc", F.lit(turn)))
        here = _placed(more, found)
        leaders = here.groupBy("k").agg(F.min("c").alias("x"), F.max("c").alias("y"), leader.alias("r")).where("x <> y").select("k", "r")
        near = here.alias("l").join(leaders, "k").where(
            (F.col("l.c") != F.col("r.c"))
            & _may_link(percent, F.col("l.n"), F.col("l.rest"), F.col("r.n"), F.col("r.rest"))
            & _bits_allow(percent)
        )
        near = near.select(F.least("l.doc", "r.doc").alias("a"), F.greatest("l.doc", "r.doc").alias("b")).distinct()
        near = staged(near.join(tried, ["a", "b"], "left_anti"))
        if near.isEmpty():
            continue
        late = staged(_verified(near, rows, size, percent))
        tried = tried.unionByName(near)
        if not late.isEmpty():
            links = links.unionByName(late)
            found = components(links)
    return found, links, tried


def linked(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Components of texts whose sets of word grams are alike: ``doc_id, n_shingles, component_id``.

    Two texts link when 100 times their common grams are at least ``percent`` times all their grams. Equal sets are
    first gathered into one. Small sets are keyed by every subset large enough to be all that two linked sets share;
    their largest size is where that costs least against lists. Large sets stand in inverted lists of their rarest
    grams, enough of them that linked sets meet; counters of fixed size put frequent grams last, which decides cost
    and not results.

    On each key, every set is compared with the smallest set there. Under a subset key that finds all components. In
    a list, sets that stay in different components are compared with another set of the list, ROUNDS times at most,
    and what is left then with each other, where the grams left behind the key and the sets' parity bits allow a
    link; so a group of near copies costs a few comparisons a member, and no link between components is lost.
    Candidates are verified on their whole sets.

    A null text has no words. A text without words links with nothing. Rows that share a key are one document,
    linked through any of its texts; rows without a key link with nothing and have no component. Other columns are
    ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    base = staged(_sets(rows, size, percent))
    known = base.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    groups = known.groupBy("one", "two", "n").agg(
        F.min("doc_id").alias("doc"), F.first("keys").alias("keys"), F.first("rest").alias("rest")
    )
    posts = groups.select("doc", "n", F.explode(F.arrays_zip("keys", "rest")).alias("x")).select(
        F.col("x.keys").alias("k"), "doc", "n", F.col("x.rest").alias("rest")
    )
    leads = posts.groupBy("k").agg(F.min(F.struct("n", "doc", "rest")).alias("lead"), F.count("*").alias("members"))
    leads = leads.where(F.col("members") > 1)
    shared = staged(posts.join(leads, "k"))
    lead = F.col("lead")
    star = shared.where(F.col("doc") != lead["doc"]).where(
        _may_link(percent, F.col("n"), F.col("rest"), lead["n"], lead["rest"])
    )
    star = staged(star.select(F.col("doc").alias("a"), lead["doc"].alias("b")).distinct())
    links = staged(_verified(star, rows, size, percent))
    found = components(links)

    more = _placed(shared.where(F.col("members") > 2).select("k", "doc", "n", "rest"), found)
    mixed_keys = more.groupBy("k").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("k")
    bits = known.groupBy("one", "two", "n").agg(F.min("doc_id").alias("doc"), F.first("bits").alias("bits"))
    more = more.join(mixed_keys, "k").select("k", "doc", "n", "rest")
    more = staged(more.join(bits.select("doc", "n", "bits"), ["doc", "n"]))
    tried = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found, links, tried = _late_links(more, found, links, tried, rows, size, percent)
    more = staged(_placed(more, found))
    left, right = more.alias("l"), more.alias("r")
    across = left.join(
        right,
        (F.col("l.k") == F.col("r.k"))
        & (F.col("l.c") < F.col("r.c"))
        & _may_link(percent, F.col("l.n"), F.col("l.rest"), F.col("r.n"), F.col("r.rest"))
        & _bits_allow(percent),
    ).select(F.col("l.doc").alias("a"), F.col("r.doc").alias("b"))
    across = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    across = staged(across.join(tried, ["a", "b"], "left_anti"))
    if not across.isEmpty():
        late = staged(_verified(across, rows, size, percent))
        if not late.isEmpty():
            found = components(links.unionByName(late))
    leaders = groups.select("one", "two", "n", "doc")
    # Equal sets share their least document; further rows of a document bring their own sets together.
    same = known.select("doc_id", "one", "two", "n").join(leaders, ["one", "two", "n"])
    repeated = same.groupBy("doc_id").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x <> y")
    if not repeated.isEmpty():
        joined = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(
            repeated.select(F.col("x").alias("a"), F.col("y").alias("b"))
        )
        found = components(joined.unionByName(same.join(repeated, "doc_id").select(F.col("doc").alias("a"), F.col("x").alias("b"))))
    placed = base.select("doc_id", "n", "one", "two").join(leaders, ["one", "two", "n"], "left")
    placed = placed.join(found, F.col("doc") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all their columns, with one of each component: that with the least key.

    Rows without a key stay. Of rows that share a key, the one with the least text stays.
    """
    found = staged(linked(docs, size, percent, key, text)).where(F.col("doc_id").isNotNull())
    # A document drops out if any of its rows lies in another's component; rows of one key count as copies.
    fate = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    fate = staged(fate.where((F.col("component_id") != F.col("doc_id")) | (F.col("rows") > 1)))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("own"), F.col(text).alias("order"))
    marked = flagged(rows, "own", fate.select("doc_id"))
    first = F.row_number().over(Window.partitionBy("own").orderBy("order"))
    fate = fate.select(F.col("doc_id").alias("known"), (F.col("component_id") != F.col("doc_id")).alias("gone"))
    touched = marked.where("_maybe").join(fate, F.col("own") == F.col("known"), "left")
    touched = touched.where(~F.coalesce("gone", F.lit(False)))
    single = touched.where(F.col("known").isNull()).select("row")
    repeated = touched.where(F.col("known").isNotNull()).withColumn("nth", first).where("nth = 1").select("row")
    kept = marked.where(~F.col("_maybe")).select("row").unionByName(single).unionByName(repeated)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))

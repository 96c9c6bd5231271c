"""Exact nearest vectors by inner product: a k-nearest-neighbour join over Voronoi cells of pivots.

With M the greatest norm of all data, a data vector s stands at (s, sqrt(M^2 - |s|^2)) and a query q at (q, 0). Their
distance squared is |q|^2 + M^2 - 2 q s, so the nearest data of a query are those of greatest inner product, and the
triangle inequality holds. Pivots deal both sides into cells. From a summary of the cells alone follows how far from
its pivot a data vector may stand that a query cell needs; only such vectors travel to the cell's groups. Bounds are
distances in floating point with some slack; scores are whole numbers and exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import staged

#: Numbers of the sample of vectors from which pivots and first bounds come; it travels to the tasks.
SAMPLE_NUMBERS = 1 << 18
PIVOTS = 64
#: Queries, and vectors, that one local join holds at most, give or take the evenness of a hash.
BLOCK, CHUNK = 2048, 1 << 16
#: Share of the greatest distance by which bounds are widened.
SLACK = 1e-6
#: Whole numbers below this are exact as doubles.
EXACT = float(1 << 53)

_PLACED = "row long, vec_id long, x array<double>, cell int, dist double, is_query boolean, q_cell int, q_dist double, reach double"


def whole(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """``row, vec_id, x``: components scaled and floored to whole numbers; vectors without a finite value each are left out."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where("x IS NOT NULL AND forall(x, v -> v IS NOT NULL)")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "x")

    def run(batches):
        for batch in batches:
            x = batch.column("x")
            flat = np.floor(x.flatten().to_numpy(zero_copy_only=False) * scale)
            offsets = np.r_[0, np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int32)
            bad = np.cumsum(np.r_[0, ~np.isfinite(flat)])
            done = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            out = pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), done], ["row", "vec_id", "x"])
            yield out.filter(pa.array(bad[offsets[1:]] == bad[offsets[:-1]]))

    return rows.mapInArrow(run, "row long, vec_id long, x array<double>")


def matrix(rows, dim: int) -> np.ndarray:
    """Lists of numbers as rows of a matrix; shorter ones are filled with zeros, which add nothing to a product."""
    if len(rows) and all(len(r) == dim for r in rows):
        return np.array(rows, np.float64).reshape(len(rows), dim)
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Data vectors with the further component that gives all of them the norm ``most``."""
    rest = np.maximum(most * most - np.einsum("ij,ij->i", x, x), 0)
    return np.column_stack([x, np.sqrt(rest)])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    near = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(near, 0))


def pivots_of(sample: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first: each next pivot is the sample's point with the greatest distance from those before."""
    chosen = sample[:1]
    near = distances(sample, chosen)[:, 0]
    while len(chosen) < most and near.max(initial=0) > 0:
        chosen = np.vstack([chosen, sample[near.argmax()]])
        near = np.minimum(near, distances(sample, chosen[-1:])[:, 0])
    return chosen


def placed(rows: DataFrame, every: int, k: int, sample: np.ndarray, pivots: np.ndarray, most: float) -> DataFrame:
    """Rows with their cell and distance from its pivot, as data and, where the key is divisible by ``every``, as query.

    ``reach`` is the query's distance from its k-th nearest of the sample and one more, which may be the query itself.
    """
    dim = pivots.shape[1] - 1

    def run(batches):
        points = lifted(sample, most)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                own = batch.slice(start, 4096)
                x = matrix(own.column("x").to_pylist(), dim)
                d = distances(lifted(x, most), pivots)
                cell = d.argmin(1)
                ids = own.column("vec_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                asks = np.flatnonzero(known & (ids.fill_null(0).to_numpy(zero_copy_only=False) % every == 0))
                at = np.column_stack([x[asks], np.zeros(len(asks))])
                q = distances(at, pivots)
                reach = np.full(len(asks), np.inf)
                if len(points) > k:
                    reach = np.partition(distances(at, points), k, axis=1)[:, k]
                columns = [own.column("row"), own.column("vec_id"), own.column("x"), pa.array(cell, pa.int32()), pa.array(d.min(1))]
                is_query = np.zeros(len(x), bool)
                is_query[asks] = True
                columns.append(pa.array(is_query))
                for values, kind in ((q.argmin(1), pa.int32()), (q.min(1), pa.float64()), (reach, pa.float64())):
                    full = np.zeros(len(x))
                    full[asks] = values
                    columns.append(pa.array(full, mask=~is_query).cast(kind))
                yield pa.RecordBatch.from_arrays(
                    columns, ["row", "vec_id", "x", "cell", "dist", "is_query", "q_cell", "q_dist", "reach"]
                )

    return rows.mapInArrow(run, _PLACED)


def plan_of(pivots: np.ndarray, asked: list, data: list, k: int, block: int, chunk: int, most: float) -> tuple[list, list]:
    """What each query cell needs, from summaries alone.

    ``asked`` has (cell, queries, greatest distance, greatest reach), ``data`` (cell, vectors, greatest distance,
    distances of the k + 1 nearest to the pivot). Returns (data cell, [(low, high, group)]) and (query cell, group,
    splits, chunks) rows: a data vector goes to the groups in whose range its distance lies. Small query cells share a
    group, neighbours first; a group of many queries is split, and its data are dealt into chunks.
    """
    between = distances(pivots, pivots)
    widen = SLACK * max(most, float(between.max(initial=0)), *(a[2] for a in asked), 1.0)
    ranges: dict[int, dict[int, tuple[float, float]]] = {}
    for i, _, far, reach in asked:
        # k other vectors at least lie within this distance of every query of the cell.
        seen = sorted(far + between[i, j] + d for j, _, _, nearest in data for d in nearest)
        span = far + min(reach, seen[k] if len(seen) > k else math.inf) + widen
        span = span if math.isfinite(span) else math.inf
        ranges[i] = {j: (float(between[i, j] - span), float(between[i, j] + span)) for j, *_ in data}
    groups, size, last = [], math.inf, None
    left = {a[0]: a[1] for a in asked}
    while left:
        i = min(left) if last is None else min(left, key=lambda c: (between[last, c], c))
        n, last = left.pop(i), i
        if size + n > block:
            groups.append([])
            size = 0
        groups[-1].append((i, n))
        size += n
    wanted: dict[int, list] = {j: [] for j, *_ in data}
    cells = []
    for g, own in enumerate(groups):
        needed = 0
        for j, n, far, nearest in data:
            wanted[j] += [(*ranges[i][j], g) for i, _ in own]
            needed += n * any(not (far < low or min(nearest) > high) for low, high, _ in wanted[j][-len(own) :])
        splits, chunks = math.ceil(sum(n for _, n in own) / block), max(1, math.ceil(needed / chunk))
        cells += [(i, g, splits, chunks) for i, _ in own]
    return list(wanted.items()), cells


def best(q: np.ndarray, s: np.ndarray, k: int, barred: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each query its k best (place in s, score): greater scores first, then earlier places. Exact for any numbers.

    ``barred`` has the place in s that each query may not take, or -1.
    """
    longest = math.sqrt(float(np.einsum("ij,ij->i", q, q).max(initial=0))) * math.sqrt(float(np.einsum("ij,ij->i", s, s).max(initial=0)))
    if longest >= EXACT / 2:  # products of whole numbers of any size
        ints = [[int(v) for v in row] for row in s]
        out = []
        for row, own in zip(q, barred):
            mine = [int(v) for v in row]
            scores = [(-sum(a * b for a, b in zip(mine, o)), i) for i, o in enumerate(ints) if i != own]
            out.append([(i, -v) for v, i in sorted(scores)[:k]])
        return out
    out = []
    for start in range(0, len(q), 64):
        scores = q[start : start + 64] @ s.T  # sums of whole numbers below 2^53: exact in any order
        own = barred[start : start + 64]
        scores[np.flatnonzero(own >= 0), own[own >= 0]] = -np.inf
        least = np.partition(scores, -k, axis=1)[:, -k] if len(s) > k else np.full(len(scores), -np.inf)
        for row, low in zip(scores, least):
            over, ties = np.flatnonzero(row > low), np.flatnonzero(row == low)
            took = np.r_[over, ties[: k - len(over)]]
            took = took[np.isfinite(row[took])]
            took = took[np.lexsort((took, -row[took]))]
            out.append([(int(i), int(row[i])) for i in took])
    return out


def nearest(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, scale: float = 1024.0,
    pivots: int = PIVOTS, block: int = BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """The k best vectors by inner product for each row whose key is divisible by ``every``: ``query_id, rank, vec_id, score``.

    Components become floor(scale * x). Candidates are all rows but the query's own row; ties go to the smaller key,
    and fewer candidates give fewer rows. Vectors that are null or have a component that is null or not finite, before
    or after scaling, take no part. Shorter vectors count as filled with zeros, an empty one as zeros. Rows without a key
    are no queries, but candidates, after others of equal score. Repeated rows are queries and candidates each. Scores
    beyond 64 bits are given as the nearest 64-bit number and ranked as doubles. Other columns are ignored; an empty
    table, or one without queries, gives no rows.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score long"
    rows = whole(vectors, key, vector, scale)
    norm = F.expr("aggregate(x, 0D, (s, v) -> s + v * v)")
    facts = rows.agg(F.sqrt(F.max(norm)).alias("most"), F.max(F.size("x")).alias("dim")).first()
    if facts.dim is None:
        return spark.createDataFrame([], out)
    most, dim = facts.most * (1 + 1e-12), max(facts.dim, 1)
    drawn = rows.select("x").orderBy(F.xxhash64("x"), "x").limit(max(1, SAMPLE_NUMBERS // dim)).collect()
    sample = matrix([r.x for r in drawn], dim)
    chosen = pivots_of(lifted(sample, most), pivots)
    if not np.isfinite(chosen).all():  # beyond the range of doubles: one cell that everything is needed of
        chosen, sample, most = np.zeros((1, dim + 1)), sample[:0], 0.0
    found = staged(placed(rows, every, k, sample, chosen, most))

    asked = found.where("is_query").groupBy("q_cell").agg(F.count("*"), F.max("q_dist"), F.max("reach")).collect()
    near = found.selectExpr("cell", "dist", "row_number() OVER (PARTITION BY cell ORDER BY dist) AS place").where(f"place <= {k + 1}")
    near = near.groupBy("cell").agg(F.collect_list("dist").alias("nearest"))
    data = found.groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("far")).join(near, "cell")
    data = data.select("cell", "n", "far", "nearest").collect()
    wanted, cells = plan_of(chosen, [tuple(a) for a in asked], [tuple(d) for d in data], k, block, chunk, most)
    # As many rows as there are pivots, at most.
    needs = spark.createDataFrame(wanted, "cell int, needs array<struct<low: double, high: double, g: int>>")
    dealt = spark.createDataFrame(cells, "q_cell int, g int, splits int, chunks int")

    part = "pmod(xxhash64(row), {})"
    queries = found.where("is_query").join(F.broadcast(dealt), "q_cell")
    own = ("row AS query", "vec_id AS query_id", "x AS q")
    queries = queries.selectExpr("g", f"int({part.format('splits')}) AS split", "explode(sequence(0, chunks - 1)) AS chunk", *own)
    # A distance that is no number any more rules nothing out.
    goes = "array_distinct(transform(filter(needs, e -> isnan(dist) OR dist BETWEEN e.low AND e.high), e -> e.g))"
    sent = found.join(F.broadcast(needs), "cell").selectExpr("row", "vec_id", "x", f"explode({goes}) AS g")
    sent = sent.join(F.broadcast(dealt.select("g", "splits", "chunks").distinct()), "g")
    ids = ("row AS row", "coalesce(vec_id, 0L) AS vec_id", "vec_id IS NULL AS none", "x AS x")
    sent = sent.selectExpr("g", "explode(sequence(0, splits - 1)) AS split", f"int({part.format('chunks')}) AS chunk", *ids)
    columns = ["query", "query_id", "vec_id", "score", "size"]

    def local(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        s = s.sort_values(["none", "vec_id"], kind="stable")  # the order of ties
        at = {r: i for i, r in enumerate(s.row.tolist())}
        barred = np.array([at.get(r, -1) for r in q["query"].tolist()], np.int64)
        tops = best(matrix(q.q.tolist(), dim), matrix(s.x.tolist(), dim), k, barred) if len(s) else []
        ids = [None if none else v for none, v in zip(s.none.tolist(), s.vec_id.tolist())]
        rows = [
            (row, own, ids[i], min(max(v, -(1 << 63)), (1 << 63) - 1), float(v))
            for row, own, top in zip(q["query"].tolist(), q.query_id.tolist(), tops)
            for i, v in top
        ]
        return pd.DataFrame(rows, columns=columns).astype({"vec_id": "Int64"})

    keys = ("g", "split", "chunk")
    schema = "query long, query_id long, vec_id long, score long, size double"
    tops = queries.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(local, schema)
    order = "score DESC, size DESC, vec_id NULLS LAST"
    ranked = tops.withColumn("rank", F.expr(f"row_number() OVER (PARTITION BY query ORDER BY {order})"))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

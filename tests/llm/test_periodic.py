"""Periodic runs against their definition, tried out for every start and period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from wardline.llm import periodic_runs
from wardline.llm.queries import op11_periodic_runs


def brute(words):
    """Every maximal stretch of every period; of equal stretches only the smallest period is a run."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def expected(key, text):
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return key, len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_runs_are_those_of_the_definition():
    r = random.Random(3)
    for i in range(3000):
        few = r.choice([1, 2, 2, 3, 20])
        x = [r.randrange(few) for _ in range(r.randrange(0, 120))]
        for _ in range(r.randrange(4)):
            part = x[: r.randrange(1, 20)] or [0]
            at = r.randrange(len(x) + 1)
            x[at:at] = part * r.randrange(2, 9) + part[: r.randrange(len(part))]
        assert periodic_runs.runs_of(np.array(x, np.int64)) == brute(x), (i, x)


def test_words_with_nested_periods_take_linear_work():
    x = np.tile(np.r_[np.zeros(50, np.int64), 1], 20_000)
    runs = periodic_runs.runs_of(x)
    assert (0, len(x), 51) in runs and len(runs) == 20_001
    thue = np.array([bin(i).count("1") % 2 for i in range(1 << 17)])
    assert periodic_runs.runs_of(thue) == []
    a, b = [0], [0, 1]
    while len(b) < 1 << 17:
        a, b = b, b + a
    assert periodic_runs.runs_of(np.array(b)) == []  # no part of the Fibonacci word repeats four times


def test_query_equals_brute_force(spark, small, tmp_path, edges, edge_rows):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect() if len(r.text or "") < 20_000]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op11_periodic_runs(spark, str(tmp_path)).collect()))
    want = sorted(expected(*x) for x in rows)
    assert got == want and sum(x[1] for x in want) > 5
    edges.write.parquet(f"{tmp_path}/edge/documents.parquet")
    got = list(map(tuple, op11_periodic_runs(spark, f"{tmp_path}/edge").collect()))
    assert {g for g in got if g[0] != 7} == {expected(*x) for x in edge_rows if x[0] != 7}
    assert len(got) == len(edge_rows)


def test_long_repeated_and_empty_inputs(spark, no_rows):
    text = "wander over the quiet hills, " * 4000
    df = spark.createDataFrame([(1, text), (1, text), (None, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.periodic_runs(df).collect()}
    assert got == {(1, 20_000, ((0, 20_000, 5),), "wander over the quiet hills,"), (None, 0, (), "")}
    assert periodic_runs.periodic_runs(no_rows).count() == 0
    assert periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(no_rows))).count() == 0

"""Collocations against direct counting, and automata against plain dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from wardline.llm import collocations
from wardline.llm.collocations import Automaton, composed, united
from wardline.llm.queries import op12_collocations


def brute(rows, least=30, most=2000):
    said, f = Counter(), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            said[lang or "und"] += len(w)
            for i in range(len(w)):
                for m in range(1, min(4, len(w) - i) + 1):
                    f[lang or "und", tuple(w[i : i + m])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    around = defaultdict(int)
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                around[lang, w[i : i + m]] = max(around[lang, w[i : i + m]], a)
    by_lang = defaultdict(list)
    for (lang, w), a in cand.items():
        if 100 * around[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        by_lang[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {
        (lang, i, p.decode(), -a, l, r, said[lang], -s)
        for lang, own in by_lang.items()
        for i, (s, a, p, l, r) in enumerate(sorted(own)[:most], 1)
    }


def texts(seed, n, few):
    r = random.Random(seed)
    words = [w + r.choice(["", "é", "东", "Q"]) for w in "a b c d e f g".split()[:few]]
    ends = [" ", " ", " ", "\t ", ", ", ".", "\n", " \x0b"]
    return ["".join(r.choice(words) + r.choice(ends) for _ in range(r.randrange(1, 60))) for _ in range(n)]


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "text string, lang string")
    return set(map(tuple, collocations.collocations(df.repartition(5), **more).collect()))


def test_equals_direct_counting(spark):
    rows = [(t, random.Random(i).choice(["x", "y", None, "und"])) for i, t in enumerate(texts(5, 800, 5))]
    want = brute(rows)
    assert run(spark, rows) == want and len(want) > 50
    assert run(spark, rows, most=7) == brute(rows, most=7)
    assert run(spark, rows, least=90) == brute(rows, least=90)


def test_nested_and_tied_phrases(spark):
    rows = [("one two three four. one two", "x")] * 40 + [("five six, one two three", None)] * 30 + [("b a. c a", "x")] * 50
    assert run(spark, rows) == brute(rows)


def test_edges(spark, edges, edge_rows, no_rows):
    want = brute([(t, None) for _, t in edge_rows])
    assert set(map(tuple, collocations.collocations(edges).collect())) == want and want
    assert collocations.collocations(no_rows).count() == 0
    assert run(spark, [("too rare a phrase", "x")]) == set()


def test_hot_words_and_phrases(spark):
    r = random.Random(9)
    rows = [("the hot pair " + " ".join(r.choice(["the", "hot", "u", "v%d" % r.randrange(400)]) for _ in range(40)), "x") for _ in range(2000)]
    assert run(spark, rows) == brute(rows)


def test_union_composition_and_packing():
    r = random.Random(1)
    parts, total = [], Counter()
    for _ in range(9):
        own = Counter()
        for _ in range(300):
            w = [r.choice("abcdefgh") for _ in range(r.randrange(1, 5))]
            own[tuple(w)] += r.randrange(1, 2**40)
        total += own
        words = sorted({""}.union(*own))
        runs = sorted([[words.index(x) for x in w] + [0] * (4 - len(w)), c] for w, c in own.items())
        a = Automaton.built([w.encode() for w in words], np.array([x for x, _ in runs]), np.array([c for _, c in runs]))
        b = Automaton.unpacked(a.packed())
        assert b.words == a.words and all(map(np.array_equal, [*a.labels, *a.fans, a.weights], [*b.labels, *b.fans, b.weights]))
        parts.append(b)
    prefixes = Counter()
    for w, c in total.items():
        for m in range(1, len(w) + 1):
            prefixes[w[:m]] += c
    asked = [*prefixes, ("zz",), ("a", "zz"), tuple("abcda")]
    whole = united([united(parts[:4]), *parts[4:]])
    assert composed(whole, [" ".join(w).encode() for w in asked]) == [prefixes[w] for w in asked]


def test_small_shards_give_the_same(spark):
    rows = [(t, "x") for t in texts(8, 300, 4)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(40)
    parts = collocations.shards(df, "text", "lang", 4, most=200)
    assert parts.count() > 100
    whole = {(p.phrase, p.f) for p in collocations.phrases(collocations.unions(parts, 30)).collect()}
    once = {(p.phrase, p.f) for p in collocations.phrases(collocations.unions(collocations.shards(df, "text", "lang", 4), 30)).collect()}
    assert whole == once and whole


def test_query_counts_all_documents(spark, small):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert set(map(tuple, op12_collocations(spark, small).collect())) == brute(rows)

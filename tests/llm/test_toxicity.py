"""Toxicity models on planted vocabularies."""

import random
import zlib

import pytest

from wardline.llm import toxicity

BAD = "grimwort grimlok grimvane vexoid vexura vexling".split()


@pytest.fixture(scope="module")
def corpus(spark, words):
    rows, labels = [], []
    r = random.Random(5)
    for i in range(900):
        bad = i % 6 == 0
        text = words(i, 120).split(" ")
        if bad:
            for _ in range(6):
                text.insert(r.randrange(len(text)), r.choice(BAD))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_texts_are_told_apart(corpus):
    docs, labels = corpus
    rows = toxicity.toxicity(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert right / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_of_held_out_rows_do_not_matter(corpus):
    docs, labels = corpus
    other = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS string)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    one, two = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, other))
    assert all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_edge_rows_and_no_labels(spark, edges, edge_rows, corpus, no_rows):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(edges, none).collect()
    assert len(rows) == len(edge_rows) and len({r.score for r in rows}) == 1 and not any(r.predicted for r in rows)
    kept = toxicity.without_toxic(edges, corpus[1])
    assert kept.columns == edges.columns
    assert toxicity.toxicity(no_rows, corpus[1]).count() == 0


def test_probabilities_of_a_context_sum_to_one(spark):
    counts = [("banana", 3, 0), ("bandana", 1, 2), ("cabana", 0, 4), ("nab", 2, 2)]
    top = toxicity.grams(spark.createDataFrame(counts, "word string, toxic long, ordinary long"), order=3).cache()
    shared = {r.gram: r.shared for r in toxicity.shared_backoff(top, order=3).collect()}
    seen = {r.gram: r for r in top.collect()}
    letters = {g for g in shared if len(g) == 1}
    assert abs(sum(shared[x] for x in letters) - 1) < 1e-9
    assert seen["ana"].toxic == 3 * 2 + 1 and seen["ana"].ordinary == 2 + 4
    for context in {g[:-1] for g in shared if len(g) == 2}:
        own = sum(shared.get(context + x, 0) for x in letters)
        assert own <= 1 + 1e-9


def test_a_rare_gram_keeps_its_own_ratio(spark, words):
    """Every gram of a rare toxic word shares its hash modulo 2^20 with a gram of frequent ordinary words."""
    rare, r = "wjkqvy", random.Random(3)
    whole = "\x02" + rare + "\x03"
    slots = {zlib.crc32(whole[max(0, i - 6) : i].encode()) % (1 << 20) for i in range(2, len(whole) + 1)}
    twins = []
    while slots:
        twin = "".join(r.choices("abcdefghilmnoprstu", k=6))
        if (slot := zlib.crc32(twin.encode()) % (1 << 20)) in slots:
            slots.remove(slot)
            twins.append(twin)
    rows = [(i, " ".join([words(i, 60), *([rare] if i % 6 == 0 else twins * 4)])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(600)], "doc_id long, toxic int")
    found = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in found) / len(found) > 0.97


def test_a_word_has_the_sum_of_its_grams(spark):
    seen = {"\x02b": 0.5, "\x02ba": -1.0, "ban": 2.0, "ana": 0.25}
    contexts = {"na": 3.0, "an": -7.5}
    tables = (spark.createDataFrame([(k, v, 1) for k, v in x.items()], "text string, ratio double, ordinary long") for x in (seen, contexts))
    ratios = toxicity.keyed(*tables).cache()
    got = toxicity.word_ratios(spark.createDataFrame([("banana",), ("q",)], "word string"), ratios, order=3).collect()
    # Neither nan nor na with the end mark is seen: both fall back on na.
    assert {r.word_key: r.ratio for r in got} == {
        toxicity.key_of("banana"): 0.5 - 1.0 + 2.0 + 0.25 + 3.0 + 0.25 + 3.0,
        toxicity.key_of("q"): 0.0,
    }


def test_bounds_leave_no_word_out(spark, words):
    """Words that pass the bound hold every word whose ratio, summed directly, exceeds the level; grams are spelled out."""
    r = random.Random(4)
    counts = [(w, r.randrange(5), r.randrange(9)) for w in {w for w in words(7, 400).replace("\n", " ").split()}]
    counts += [("grimvex", 9, 0), ("vexgrim", 7, 0)]
    top = toxicity.grams(spark.createDataFrame(counts, "word string, toxic long, ordinary long")).cache()
    of_grams, of_contexts = toxicity.log_ratios(top, toxicity.shared_backoff(top))
    seen, backoff = ({x.text: x.ratio for x in df.collect()} for df in (of_grams, of_contexts))
    ratios = toxicity.keyed(of_grams, of_contexts).cache()

    def direct(word):
        whole = "\x02" + word + "\x03"
        grams = [whole[max(0, i - 6) : i] for i in range(2, len(whole) + 1)]
        return sum(seen.get(g, backoff.get(g[:-1], 0.0)) for g in grams)

    asked = sorted({w for w, _, _ in counts} | {w for w in words(8, 300).replace("\n", " ").replace(".", " ").split()} | {"grimvexed", "o", "éa"})
    got = {x.word_key: x.ratio for x in toxicity.word_ratios(spark.createDataFrame([(w,) for w in asked], "word string"), ratios).collect()}
    assert all(abs(got[toxicity.key_of(w)] - direct(w)) < 1e-9 for w in asked)
    texts = spark.createDataFrame([(" ".join(asked),), (None,), ("",)], "text string")
    bounds = toxicity.bounds_of(ratios)
    for least in (-1.0, 0.5, 2.0, 5.0):
        kept = {x.word for x in toxicity.candidates(texts, bounds, least).collect()}
        plain = {x for w in asked for x in toxicity.words_of(w)}
        assert {w for w in plain if direct(w) > least} <= kept <= plain
    said = sum(o for _, _, o in counts)
    level = sum(o * direct(w) for w, _, o in counts) / said
    frame = spark.createDataFrame(counts, "word string, toxic long, ordinary long")
    assert abs(toxicity.ordinary_level(ratios, frame) - level) < 1e-9


def test_ordinary_words_stay_with_their_tasks(spark, words):
    """Words of ordinary texts pass no bound, though what is unseen behind their contexts has a positive ratio."""
    plain = sorted({w for w in words(7, 3000).replace("\n", " ").replace(".", " ").split() if len(w) > 4})
    counts = [(w, 0, 9) for w in plain] + [("grimvex", 9, 0), ("vexgrim", 7, 0)]
    top = toxicity.grams(spark.createDataFrame(counts, "word string, toxic long, ordinary long")).cache()
    ratios = toxicity.keyed(*toxicity.log_ratios(top, toxicity.shared_backoff(top))).cache()
    texts = spark.createDataFrame([(" ".join([*plain, "grimvex"]),)], "text string")
    kept = {x.word for x in toxicity.candidates(texts, toxicity.bounds_of(ratios), 3.0).collect()}
    assert "grimvex" in kept and len(kept) < 0.05 * len(plain)


def test_wholly_toxic_texts_are_found(spark, corpus):
    docs, labels = corpus
    texts = ["grimwort", "vexling " * 30, "grimwort vexura", " ".join(BAD * 4)]
    more = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = toxicity.toxicity(docs.unionByName(more), labels).where("doc_id >= 5000").collect()
    assert len(found) == len(texts) and all(r.predicted for r in found)

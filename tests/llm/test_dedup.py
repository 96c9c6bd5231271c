"""Line dedup, Jaccard join and components against brute force."""

import random
import re

import pytest

from wardline.llm import jaccard_join, line_dedup
from wardline.llm.components import components


@pytest.fixture(scope="module")
def shared_passages(spark, words):
    """Texts in which three passages of 60 words recur inside lines, one of them in a third of all texts."""
    passages = [words(9000 + i, 60).replace("\n", " ") for i in range(3)]
    r, rows = random.Random(1), []
    for i in range(120):
        parts = words(i, 90).split(" ")
        which = 0 if i % 3 == 0 else i % 40 if i % 40 in (1, 2) else None
        if which is not None:
            parts.insert(r.randrange(len(parts)), passages[which])
        rows.append((i, " ".join(parts)))
    return rows, passages


def test_later_passages_go_and_all_else_stays(spark, shared_passages):
    rows, passages = shared_passages
    got = {r.doc_id: r for r in line_dedup.deduped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i, t in rows:
        here = [p for p in passages if p in t]
        if not here:
            assert got[i].text == t and got[i].removed_words == 0
        for p in here:
            if p in first:
                assert p not in got[i].text and 55 <= got[i].removed_words <= 70
            else:
                first[p] = i
                assert got[i].text == t
    for i, t in rows:
        out, at = "", 0
        for s in got[i].removed_spans:
            out, at = out + t[at : s.start], s.end
        assert out + t[at:] == got[i].text


def test_line_dedup_of_edge_rows(edges, edge_rows, no_rows):
    done = line_dedup.deduped(edges)
    assert [c for c in done.columns if c != "removed_words"] == [c for c in edges.columns if c != "removed_words"] + ["removed_spans"]
    rows = done.collect()
    assert len(rows) == len(edge_rows)
    by = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert by[0] is None and by[1] == "" and by[5] == dict(edge_rows)[5] and 0 < len(by[7].split()) < 60
    assert line_dedup.deduped(no_rows).count() == 0


def test_copies_and_rows_that_repeat_a_key(spark, words):
    t, other = words(1, 200), words(2, 200)
    rows = [(5, t), (5, t), (6, t), (7, "before " + t + " after"), (8, other), (8, t)]
    got = sorted((r.doc_id, r.text) for r in line_dedup.deduped(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([(5, t), (5, t), (6, ""), (7, "before after"), (8, other), (8, "")])


def _brute(rows, size, percent):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(table))
        sets[k] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.fixture(scope="module")
def near_copies(words):
    """Small and large texts, chains of near copies, copies in upper case, a passage that many share."""
    r, rows, key = random.Random(2), [], 0
    passage = words(77, 50)
    for base in range(40):
        n = r.choice([2, 5, 9, 14, 20, 60, 250])
        current = words(500 + base, n).split(" ")
        for _ in range(r.choice([1, 2, 8])):
            rows.append((key, " ".join(current)))
            key += 1
            current = list(current)
            for _ in range(r.choice([0, 1, max(1, n // 60), n // 20])):
                current[r.randrange(len(current))] = words(r.randrange(10**6), 1)
        if base % 3 == 0:
            rows.append((key, passage + " " + words(900 + base, 60)))
            rows.append((key + 1, rows[-1][1].upper()))
            key += 2
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 70)])
def test_components_are_those_of_all_pairs(spark, near_copies, size, percent):
    docs = spark.createDataFrame(near_copies, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.linked(docs, size, percent).collect()}
    wanted = _brute(near_copies, size, percent)
    assert got == wanted
    kept = {r.doc_id for r in jaccard_join.one_of_each(docs, size, percent).collect()}
    assert kept == {c for _, c in wanted.values()}


def test_copies_that_miss_the_smallest_cost_few_comparisons(spark, words, monkeypatch):
    """Near copies link with each other, not with the smallest text of their lists."""
    base, r, tried = words(1, 250).split(), random.Random(1), []
    # The start is frequent, so the rarest grams of the copies are those that the smallest text has.
    rows = [(1000, " ".join(base[-208:]))] + [(2000 + i, " ".join(base[:45]) + " " + words(3000 + i, 260)) for i in range(80)]
    for i in range(60):
        text = list(base)
        text[r.randrange(len(text))] = f"other{i}"
        rows.append((i, " ".join(text)))
    plain = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *a: tried.append(pairs.count()) or plain(pairs, *a))
    got = {r.doc_id: r.component_id for r in jaccard_join.linked(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == {k: c for k, (_, c) in _brute(rows, 4, 85).items()} and set(map(got.get, range(60))) == {0} and got[1000] == 1000
    assert sum(tried) < 6 * len(rows)


def test_subset_keys_are_all_that_a_link_can_share():
    for n in range(1, 24):
        least = jaccard_join.least_common(n, 85)
        assert 100 * least >= 85 * n > 100 * (least - 1)
    import numpy as np

    keys, left = jaccard_join.subset_keys(np.arange(1, 15, dtype=np.uint64), 85)
    assert len(set(keys.tolist())) == len(keys) == jaccard_join.subset_count(14, 85) and left.min() == 12


def test_the_boundary_follows_cost():
    import numpy as np

    few_large, few_small = np.zeros(64, int), np.zeros(64, int)
    few_large[5], few_small[30] = 1000, 1000
    assert jaccard_join.boundary(few_large, 85) >= 5 and jaccard_join.boundary(few_small, 85) < 30


def test_jaccard_join_of_edge_rows(edges, edge_rows, no_rows):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.linked(edges, 4, 85).collect())
    assert len(got) == len(edge_rows)
    assert ("3", 1, "3") in got and ("12", 1, "3") in got and ("0", 0, "0") in got and ("None", 1, "None") in got
    kept = jaccard_join.one_of_each(edges, 4, 85)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, range(10)), "None", "None"])
    assert jaccard_join.linked(no_rows).count() == 0 and jaccard_join.one_of_each(no_rows).count() == 0


def test_long_chains_are_one_component(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (2000, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def _left(rows, least=50):
    """Words of each text that lie in no run that an earlier text, or an earlier part of it, has: all windows compared."""
    seen, out = {}, {}
    for k, t in rows:
        words = t.split()
        gone = set()
        for i in range(len(words) - least + 1):
            if seen.setdefault(tuple(words[i : i + least]), (k, i)) != (k, i):
                gone.update(range(i, i + least))
        out[k] = [w for i, w in enumerate(words) if i not in gone]
    return out


def _same_as_all_windows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text.split() for r in line_dedup.deduped(docs).collect()}
    wanted = _left(rows)
    assert [k for k in wanted if got[k] != wanted[k]] == []


def test_every_passage_of_fifty_words_goes(spark, words):
    """Passages of 49 to 52 words, with and without sentence ends, within and at the ends of texts."""
    r, rows = random.Random(8), []
    for i in range(300):
        passage = words(5000 + i, 49 + i % 4)
        passage = passage.replace(".", "").replace("\n", " ") if i % 2 else passage
        for k in (2 * i, 2 * i + 1):
            parts = words(20_000 + k, r.choice([0, 1, 30, 200])).split(" ")
            parts.insert(r.randint(0, len(parts)), passage)
            rows.append((k, " ".join(parts).strip()))
    rows += [(1000, "again " * 300), (1001, "again " * 120 + words(1, 60)), (1002, "a b c " * 90 + "again " * 50)]
    _same_as_all_windows(spark, rows)


def test_partial_quotes_hide_no_repeat(spark, words):
    """Two early texts have the two ends of a passage that later ones have whole, or changed in one word."""
    r, rows = random.Random(9), []
    for i in range(60):
        p = words(7000 + i, 70).split()
        changed = list(p)
        changed[r.randrange(70)] = "changed"
        for j, part in enumerate((p[:45], p[-45:], p, p, changed, p + p, changed)):
            k = 10 * i + j
            rows.append((k, " ".join([words(30_000 + k, 30), *part, words(40_000 + k, 30)])))
    _same_as_all_windows(spark, rows)


def test_odd_column_names_pass(spark, words):
    rows = [(1, words(1, 90), "x", 1), (2, words(1, 90), "y", 2)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "my col", "a.b"])
    got = {r["doc_id"]: r for r in line_dedup.deduped(docs).collect()}
    assert got[2]["text"] == "" and got[1]["text"] and (got[2]["my col"], got[2]["a.b"]) == ("y", 2)

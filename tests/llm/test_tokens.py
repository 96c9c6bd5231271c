"""Encoding, counting and packing against the tokenizers' own libraries."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from wardline.llm import bpe_codec, packing, text, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def rank_file():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def test_round_trip_gives_the_librarys_ids_and_the_texts_bytes(edges, edge_rows, rank_file):
    got = bpe_codec.round_trip(edges, RANKS, public_tokenizers.PATTERN).collect()
    wanted = []
    for key, t in edge_rows:
        ids = rank_file.encode_ordinary(t or "")
        wanted.append((key, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    order = lambda rows: sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert order(got) == order(wanted)


def test_encode_then_decode_returns_every_text(edges, edge_rows):
    encoded = bpe_codec.encode(edges.where("doc_id = 5"), RANKS, public_tokenizers.PATTERN)
    assert bytes(bpe_codec.decode(encoded, RANKS).first()["bytes"]).decode() == edge_rows[5][1]


def test_every_vocabulary_entry_alone_is_one_token(rank_file):
    with open(RANKS, "rb") as f:
        own = bpe_codec.Codec(f.read(), public_tokenizers.PATTERN)
    tokens = [t for t in own.table if len(own.pattern.findall(t.decode("utf-8", "replace"))) == 1 and t.decode("utf-8", "ignore").encode() == t]
    own.memo.learn({t.decode() for t in tokens})
    assert all(own.memo[t.decode()] == tuple(rank_file.encode_ordinary(t.decode())) for t in tokens)


def test_every_code_point_is_split_as_by_the_library(rank_file):
    with open(RANKS, "rb") as f:
        own = bpe_codec.Codec(f.read(), public_tokenizers.PATTERN)
    for start in range(0, 0x3100, 64):
        t = " ".join(f"a{chr(c)}b {chr(c)} " for c in range(start, start + 64))
        parts = text.pieces(t)
        own.memo.learn(set(parts))
        assert own.ids(parts) == rank_file.encode_ordinary(t), hex(start)


def test_pieces_join_to_the_text(edge_rows):
    for _, t in edge_rows:
        assert "".join(text.pieces(t or "")) == (t or "")


def test_counts_are_the_librarys(edges, edge_rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = sorted(map(tuple, token_counts.token_counts(edges, path).collect()), key=str)
    wanted = []
    for key, t in edge_rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False))
        wanted.append((key, len((t or "").encode()), n, n > 512))
    assert got == sorted(wanted, key=str)


def test_operators_on_no_rows_give_none(no_rows):
    assert bpe_codec.round_trip(no_rows, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.token_counts(no_rows, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert packing.packed(no_rows, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_packing_keeps_every_id_once_and_leaves_no_gaps(edges, edge_rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.packed(edges, path, with_ids=True)
    sequences = defaultdict(list)
    got = defaultdict(list)
    for r in rows.collect():
        sequences[r.sequence_id].append(r)
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    wanted = defaultdict(list)
    for key, t in edge_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            part = np.array(ids[at : at + 2048], "<u4")
            wanted[key].append((at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for r in packing.sequences(rows).collect():
        n = sum(p.length for p in sequences[r.sequence_id])
        assert len(r.ids) == 4 * (n if n & (n - 1) == 0 else 2048)


@pytest.mark.parametrize("scale", [1, 50, 5000])
def test_patterns_meet_the_demand_close_to_its_bound(scale):
    rng = np.random.default_rng(scale)
    demand = rng.poisson(rng.exponential(1, 64) * scale * np.exp(-np.arange(64) / 15))
    patterns = packing.rounded(demand, packing.column_generation(demand))
    assert (sum(p * n for p, n in patterns) == demand).all()
    assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in patterns)
    bound = (demand * np.arange(1, 65)).sum() / 64
    assert sum(n for _, n in patterns) <= bound * 1.01 + 8


def test_the_knapsack_finds_the_best_pattern():
    values = np.array([0.0, 3.0, 4.6, 0.0, 8.0])
    worth, pattern = packing.best_pattern(values, 5)
    assert worth == 8.0 and pattern.tolist() == [0, 0, 0, 0, 1]


def test_a_length_that_most_pieces_share_is_ranked_without_gaps(spark):
    cut = spark.range(5000).selectExpr("id doc_id", "0L start", "IF(id % 3 = 0, 512L, 100 + id % 700) length", "id ids_crc32", "1L doc_tokens")
    rows = packing.pack(cut).collect()
    assert len(rows) == 5000
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and sum(used.values()) / 2048 / len(used) > 0.98


def test_plain_tokens_have_the_librarys_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    whole, parts = packing._ids(spec), packing._plain_ids(spec)
    assert packing.splits_plainly(spec)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert not packing.splits_plainly(f.read())
    r = random.Random(1)
    odd = [chr(c) for c in (0x85, 0xA0, 0xAD, 0x2003, 0x200B, 0x300, 0x301, 0x1E9E, 0x130, 0x131, 0x17F, 0x212A, 0x3A3, 0x3C2, 0x6771, 0x661, 0xBD)]
    chars = [chr(c) for c in range(0x20, 0x250)] + list("'''sstrevemlld  \n\t\r..,!?<|>") + odd + [chr(c) for c in range(0x2010, 0x2060)]
    plain = [c for c in chars if not packing._NOT_PLAIN.search(c)]
    texts = ["".join(r.choice(kind) for _ in range(r.randrange(1, 60))) for kind in (chars, plain, "' srtevmlldSTREVMLLD.a1") for _ in range(3000)]
    texts += ["it's <|endoftext|> a|", "<|startoftext|>", "", " "]
    assert sum(map(packing.is_plain, texts)) > 5000
    for t in texts:
        memo, cut = (parts, packing.plain_tokens(t)) if packing.is_plain(t) else (whole, text.words(t))
        memo.learn(set(cut))
        got = np.frombuffer(b"".join(map(memo.__getitem__, cut)), "<u4").tolist()
        assert got == library.encode(t, add_special_tokens=False).ids, t


def test_workers_let_go_of_what_other_operators_held():
    import pyarrow as pa

    from wardline.llm import text

    def task(key=None):
        for _ in text.slices(iter([pa.RecordBatch.from_pydict({"text": ["a", None]})])):
            if key:
                text.held(key, object)

    for _ in range(3):
        task("one")
        first = text.held("one", object)
    task("one")
    list(text.slices(iter([])))
    assert text.held("one", object) is first
    for _ in range(2):
        task()
    assert not text._HELD


def test_memo_stays_within_its_bytes():
    """50,000 distinct texts that are one long piece each leave nothing behind; short ones come back."""
    asked = Counter()

    def compute(batch):
        asked.update(batch)
        return [p.upper() for p in batch]

    memo = text.Memo(compute, most=1 << 20)
    for i in range(50_000):
        p = f"{i} no-break\u00a0space " + "x" * 80
        memo.learn({p, "often", f"w{i % 700}"})
        assert memo[p] == p.upper() and memo["often"] == "OFTEN"
        assert len(memo) + len(memo.older) < 4000 and len(memo.once) <= 1
    assert asked["often"] == 1 and asked["w5"] <= 2
    for i in range(20_000):
        memo.learn({f"short{i}", "often"})
        assert memo.held < 1 << 20 and memo["often"] == "OFTEN"
    assert asked["often"] == 1

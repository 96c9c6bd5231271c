"""Byte-level BPE encoding and decoding through a sentencepiece model serialised from a rank file."""

from __future__ import annotations

import base64
import hashlib
import struct
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import Memo, held, pieces, slices

#: Byte b stands as the character U+0100 + b inside pieces: one character a byte, none of them white space.
_TO_CHARS = {b: 0x100 + b for b in range(256)}
_TO_BYTES = {0x100 + b: b for b in range(256)}


def mapped(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHARS)


def unmapped(piece: str) -> bytes:
    return piece.translate(_TO_BYTES).encode("latin-1")


def read_ranks(data: bytes) -> list[bytes]:
    """Tokens of a rank file in the order of their ranks, which have to be 0, 1, 2 and so on."""
    ranked = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, data.splitlines()))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks have to be gapless")
    return [t for _, t in ranked]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: a varint, a 32-bit float or a length-delimited value."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_proto(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: byte-mapped pieces with the negative rank as score and no normalisation.

    Field numbers are those of the published model format. The piece for unknown characters comes last, so a
    token's id is its rank.
    """
    piece = [_field(1, mapped(t).encode()) + _field(2, -float(rank)) + _field(3, 1) for rank, t in enumerate(tokens)]
    piece.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    no_id = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(piece)) + _field(40, len(tokens)) + b"".join(_field(n, no_id) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in piece) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes pre-tokens by rank and decodes ids by the inverse mapping."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        import sentencepiece

        tokens = read_ranks(ranks)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.pattern = regex.compile(pattern)
        self.table = [unmapped(self.model.id_to_piece(i)) for i in range(len(tokens))]
        self.digits = [str(i) for i in range(len(tokens))]
        # A whole pre-token that is in the vocabulary is one token, even where no order of merges builds it.
        spelled = self.model.encode([mapped(t) for t in tokens], num_threads=1)
        self.whole = {mapped(t): [i] for i, (t, ids) in enumerate(zip(tokens, spelled)) if ids != [i]}
        self.memo = Memo(self._encode)
        self.trips = Memo(self._trip)

    def _encode(self, parts: list[str]) -> list[tuple[int, ...]]:
        cut = [[mapped(m.encode()) for m in self.pattern.findall(p)] for p in parts]
        distinct = list(set(chain.from_iterable(cut)))
        ids = dict(zip(distinct, self.model.encode(distinct, num_threads=1)))
        ids.update((k, v) for k, v in self.whole.items() if k in ids)
        return [tuple(chain.from_iterable(ids[m] for m in c)) for c in cut]

    def _trip(self, parts: list[str]) -> list[tuple[int, str, bytes]]:
        """Per piece the number of its ids, the ids in decimal, and what they decode to."""
        return [(len(ids), ",".join(map(self.digits.__getitem__, ids)), self.decode(ids)) for ids in self._encode(parts)]

    def ids(self, parts: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, parts)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


def codec(ranks: bytes, pattern: str) -> Codec:
    """One codec per worker process."""
    return held(("codec", ranks, pattern), lambda: Codec(ranks, pattern))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The token ids of every text: ``doc_id, ids``.

    ``ranks`` is the path of a rank file on the driver, ``pattern`` splits texts into pre-tokens that merges never
    cross. A null text has no ids. A null key is kept; repeated rows are encoded each; other columns are ignored;
    an empty table gives no rows.
    """
    with open(ranks, "rb") as f:
        data = f.read()

    def run(batches):
        own = codec(data, pattern)
        for batch in slices(batches):
            cut = [pieces(t or "") for t in batch.column("text").to_pylist()]
            own.memo.learn(set().union(*cut))
            out = pa.array([own.ids(p) for p in cut], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out], ["doc_id", "ids"])

    return _rows(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The bytes of every id list: ``doc_id, bytes``. Null ids give no bytes; an id outside the file is an error."""
    with open(ranks, "rb") as f:
        data = f.read()

    def run(batches):
        table = read_ranks(data)
        for batch in batches:
            out = [b"".join(table[i] for i in ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", step: int = 50_000) -> DataFrame:
    """Encodes every text, decodes the ids again and returns digests of both.

    A piece that a slice has often is encoded and decoded once. Digests grow ``step`` pieces at a time, so a very
    long text never stands as one list of ids. Nulls, repeated
    rows and other columns as in ``encode``; a null text has the digests of nothing.
    """
    with open(ranks, "rb") as f:
        data = f.read()

    def run(batches):
        own = codec(data, pattern)
        for batch in slices(batches):
            cut = [pieces(t or "") for t in batch.column("text").to_pylist()]
            own.trips.learn(set().union(*cut))
            found = []
            for parts in cut:
                n, spelled, decoded = 0, hashlib.sha256(), hashlib.sha256()
                for start in range(0, len(parts), step):
                    tokens, digits, raw = zip(*map(own.trips.__getitem__, parts[start : start + step]))
                    spelled.update(("," if n else "").encode() + ",".join(digits).encode())
                    decoded.update(b"".join(raw))
                    n += sum(tokens)
                found.append((n, spelled.hexdigest(), decoded.hexdigest()))
            n, spelled, decoded = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(spelled), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _rows(docs, key, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

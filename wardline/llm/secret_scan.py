"""Secret scans: fixed patterns, and strings that a primed compressor finds new in a sensitive context."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.text import slices

# Fixed values of the base kinds, in the order in which ties are listed.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
#: A text whose lower-case form has none of these has no assignment and no sensitive word.
_ASSIGN_HINTS = ("passw", "secret", "token", "api_key", "apikey")
_CONTEXT_HINTS = ("key", "secret", "token", "passw", "pwd", "credential", "auth", "bearer", "private", "signature", "access")

#: Words that make what follows sensitive.
CONTEXT = re.compile(r"key|secret|token|passw|pwd|credential|auth|bearer|private|signature|access", re.ASCII | re.IGNORECASE)
#: A string that may be a secret.
SHORTEST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Names that occur in code and configuration, which prime the compressor beside the surrounding text.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key secret_key private_key public_key client_secret client_id "
    "authorization bearer credential signature session cookie username user_name account endpoint bucket region "
    "connection_string database hostname localhost environment configuration parameter returns function import "
    "document identifier reference description content application version language source http https www com org"
).encode()


def _novelty(value: str, around: bytes) -> float:
    """Bytes that the value adds to its surroundings under a primed compressor, per byte of the value."""
    import zstandard

    primer = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=9, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False)
    raw = value.encode()
    return (len(press.compress(around[-64:] + raw)) - len(press.compress(around[-64:]))) / len(raw)


def _merged(spans) -> list[tuple[int, int]]:
    """Disjoint spans, in order, that cover the same places."""
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _candidates(text: str, reach: int, taken: list[tuple[int, int]]):
    """Strings that start within ``reach`` behind a sensitive word and touch no span that is ``taken``, each once.

    Strings, sensitive words and taken spans are walked side by side, so the work grows with the text. A string
    that holds the sensitive word itself counts from behind it.
    """
    strings = [m.span() for m in CANDIDATE.finditer(text)]
    i = j = last = 0
    for hint in CONTEXT.finditer(text):
        while True:
            at = max(hint.end(), last)
            while i < len(strings) and strings[i][1] - max(strings[i][0], at) < SHORTEST:
                i += 1
            if i == len(strings):
                return
            start, end = max(strings[i][0], at), strings[i][1]
            if start > hint.end() + reach:
                break
            last = end
            while j < len(taken) and taken[j][1] <= start:
                j += 1
            if j == len(taken) or taken[j][0] >= end:
                yield start, end


def scan(text: str, least: float = 0.6, reach: int = 40, around: int = 400) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of one text, ordered; ends are exclusive."""
    found = []
    lower = text.lower()
    if any(map(lower.__contains__, _ASSIGN_HINTS)):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(map(lower.__contains__, _CONTEXT_HINTS)):
        for start, end in _candidates(text, reach, _merged((s, e) for s, _, e in found)):
            value = text[start:end]
            if not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
                continue
            near = text[max(0, start - around) : start] + text[end : end + around]
            if _novelty(value, near.encode()) >= least:
                found.append((start, 3, end))
    return sorted(found)


def masked(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span replaced by the mark; spans that overlap share one."""
    out, at, end = [], 0, -1
    for start, _, stop in sorted(spans):
        if start >= end:
            out += [text[at:start], mark]
        end = at = max(stop, end)
    return "".join(out) + text[at:]


def _spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.6) -> DataFrame:
    """Secrets of every text: counts and spans by kind, and the text with its spans masked.

    Base kinds follow fixed patterns. To them the method adds ``novel``: a string of 16 characters or more, with
    letters and digits, that starts within 40 characters of a sensitive word and overlaps no base span, if a
    compressor primed with common identifiers and the 400 characters on both sides still needs ``least`` bytes or
    more for each of its bytes. Positions are code points, ends exclusive.

    A null text counts as empty and stays null in ``masked``. A null key is kept; repeated rows are scanned each;
    other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            spans = [scan(t or "", least) for t in texts]
            base = [_spelled([x for x in s if x[1] < 3]) for s in spans]
            count = [pa.array([sum(x[1] == k for x in s) for s in spans], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *count,
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]),
                    pa.array([_spelled(s) for s in spans]),
                    pa.array([t if t is None else masked(t, s) for t, s in zip(texts, spans)], pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans", "masked"],
            )

    return rows.mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string, masked string",
    )


def masked_documents(docs: DataFrame, text: str = "text", chars: str = "n_chars", least: float = 0.6) -> DataFrame:
    """The documents, all their columns, with secrets masked in the text and the count of characters renewed.

    A null text stays null, as does its count. Keys are not looked at; repeated rows are masked each; an empty table
    gives no rows.
    """
    names = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches):
            out = [t if t is None else masked(t, scan(t, least)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

    done = rows.mapInArrow(run, rows.schema)
    new = {text: F.col("text"), chars: F.length("text").cast("long")}
    return done.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in names))

"""Helpers that several text operators share: shared-folder tables, byte-balanced slices, safe word pieces."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import shared_dir

#: Bits of the id filter that travels to the tasks.
FILTER_BITS = 1 << 23
#: Text bytes an operator works on at once inside a task.
SLICE_BYTES = 4 << 20

#: A run of plain white space and the word after it. Cuts fall only before white space.
_PIECES = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
#: White space of any other kind, by any library's notion of it.
ODD_SPACE = re.compile(
    "["
    + "".join(
        map(
            chr,
            [
                0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010),
                0x2028, 0x2029, 0x202F, *range(0x205F, 0x2065), 0x3000, 0xFEFF,
            ],
        )
    )
    + "]"
)
#: Between an ASCII letter or digit and a space, every word pattern used here ends a match.
_SURE_CUT = re.compile(r"(?<=[A-Za-z0-9]) ")


#: Written tables that are still there, in the order in which they were made.
_STAGED: list[str] = []


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back; removed by ``dropped`` or when the engine stops."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    store, folder = _folder(spark, path)
    store.deleteOnExit(folder)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def made() -> list[str]:
    """The staged tables that are still there."""
    return list(_STAGED)


def dropped(spark: SparkSession, tables: list[str], kept: DataFrame) -> None:
    """Removes staged tables whose readers are done, but for those that ``kept`` reads."""
    read = {part for f in kept.inputFiles() for part in f.split("/") if part.startswith("llm-")}
    for path in tables:
        if path in _STAGED and path.rsplit("/", 1)[1] not in read:
            store, folder = _folder(spark, path)
            store.delete(folder, True)
            _STAGED.remove(path)


def tasks_of(df: DataFrame) -> int:
    """The number of parts a keyed exchange uses."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def flagged(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Adds ``_maybe``: false where the long ``column`` is surely not among ``ids`` (one column).

    The filter is at most FILTER_BITS / 64 rows of 64 bits, whatever the number of ids, so it may be broadcast. More
    ids only let more rows pass.
    """
    (name,) = ids.columns

    def slot(c: str) -> str:
        return f"pmod(xxhash64({c}), {FILTER_BITS}L)"

    bits = ids.selectExpr(f"{slot(name)} div 64 AS _word", f"shiftleft(1L, int({slot(name)} % 64)) AS _bit")
    bits = staged(bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    joined = rows.withColumn("_word", F.expr(f"{slot(column)} div 64")).join(F.broadcast(bits), "_word", "left")
    hit = F.expr(f"(shiftrightunsigned(_bits, int({slot(column)} % 64)) & 1L) = 1L")
    return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_word", "_bits")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``most`` text bytes, one row at least.

    A task that slices its rows without asking for what is ``held`` lets it go when the next such task begins.
    """
    begun = False
    for batch in batches:
        if batch.num_rows and not begun:
            begun = True
            _let_go()
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def pieces(text: str, long: int = 20_000) -> list[str]:
    """Cuts where no token of the supported patterns can cross: before a run of white space.

    A text with white space beyond space, tab and line ends is cut only between an ASCII letter or digit and a
    space, into parts of ``long`` characters or more. Joined together, the pieces are the text.
    """
    if not ODD_SPACE.search(text):
        return _PIECES.findall(text)
    out, start = [], 0
    while start < len(text):
        cut = _SURE_CUT.search(text, start + long) if len(text) - start > long else None
        end = cut.start() if cut else len(text)
        out.append(text[start:end])
        start = end
    return out


def words(text: str) -> list[str]:
    """The text without white space, cut at it; a text with unusual white space is cut into ``pieces``."""
    return pieces(text) if ODD_SPACE.search(text) else text.split()


_HELD: dict = {}
#: Whether a task asked for it since the last one began.
_ASKED = [False]


def _let_go() -> None:
    if not _ASKED[0]:
        _HELD.clear()
    _ASKED[0] = False


def held(key, build):
    """What ``build`` makes for ``key``, once per worker process, which holds one such thing at a time.

    Workers serve one operator after the other; what the last one needed goes when the next one asks for its own, or
    has worked on a task without.
    """
    _ASKED[0] = True
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


class Memo(dict):
    """Results by piece, in bounded memory: an estimate of the bytes held stays below ``most`` and one slice's pieces.

    Half of them are for pieces asked for lately. When these fill their half, they become the older half, from which
    what is asked for again comes back, and the rest goes. Pieces over LONG characters hardly ever repeat: they are
    held until the next ``learn`` only.
    """

    LONG = 64

    def __init__(self, compute, most: int = 128 << 20):
        super().__init__()
        self.compute, self.most = compute, most
        self.older, self.once, self.held = {}, {}, 0

    def __missing__(self, piece: str):
        return self.once[piece]

    def learn(self, wanted: set[str]) -> None:
        """Makes the results of all ``wanted`` pieces available, until the next call at least."""
        if self.held > self.most // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.once = {}
        new = wanted.difference(self)
        known = {p: self.older[p] for p in new.intersection(self.older)} if self.older else {}
        missing = list(new.difference(known))
        known.update(zip(missing, self.compute(missing) if missing else ()))
        long = [p for p in known if len(p) > self.LONG]
        self.once = {p: known.pop(p) for p in long}
        self.update(known)
        # A text object, its place in the table, and results of a few bytes for each character, on the high side.
        self.held += 250 * len(known) + 16 * sum(map(len, known))

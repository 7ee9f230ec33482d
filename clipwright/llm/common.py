"""Helpers shared by the operators of this package: written intermediates, text columns, byte kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwright.session import scratch_path

#: Bytes of text that one call of a numpy kernel looks at; a longer document is one call of its own.
CHUNK_BYTES = 1 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of the file system that Spark itself uses."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def whole_text(column: str | Column = "text") -> Column:
    """The text, the empty string for null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """Only A-Z become lower case; every other character stays as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(id_column: str, text_column: str) -> Column:
    """Id, hash and length of the text: rows that share a key are equal in both, so their results may be shared."""
    text = whole_text(text_column)
    return F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("length"))


def held_out(id_column: str, remainder: int, folds: int = 5) -> Column:
    """Whether crc32 of the id written as text leaves ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds == remainder


# ---------------------------------------------------------------- words of byte-level tokenizers

#: Marks that are no part of a word's letters; an apostrophe may begin a piece with letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this are composed already and become lower case one by one, but for the dotted I.
PLAIN, DOTTED = "\u0180", "\u0130"


def byte_characters() -> dict[int, str]:
    """For each character below ``PLAIN`` the characters by which a byte-level model knows its bytes."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*shown}))}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(ord(PLAIN))}


# ---------------------------------------------------------------- kernels on Arrow text

def text_slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset: column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, raw[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes within each text, and the runs before each offset."""
    n = len(inside)
    opens, closes = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    opens[:n] = inside
    opens[1:n] &= ~inside[:-1]
    closes[1:] = inside
    closes[1:n] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    joined = cut[inside[cut] & inside[cut - 1]]
    opens[joined] = True
    closes[joined] = True
    starts = np.flatnonzero(opens[:n])
    return starts, np.flatnonzero(closes), np.searchsorted(starts, offsets)


class WordHasher:
    """Polynomial fingerprints of byte runs, from prefix sums modulo 2**64 with an odd base."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self):
        self._ensure(1 << 16)

    def _ensure(self, n: int) -> None:
        for name, base in (("power", self.BASE), ("back", self.INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.power):
            self._ensure(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.back[starts])

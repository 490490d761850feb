"""Helpers shared by the operators: staged tables, Arrow batch size, word hashing.

Word hashing works on whole Arrow buffers with numpy. A *word* is a maximal
run of bytes outside ``\\x20 \\x09-\\x0D``; all of those are ASCII, so cutting
UTF-8 bytes gives the same words as cutting code points.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import riskloom
from riskloom.session import shared_path

ARROW_ROWS = 1000
ARROW_BYTES = "4m"
SLICE_BYTES = 1 << 19
KEPT_POWERS = 1 << 19  # powers that a worker keeps; a longer sequence's go after use

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package even where only the driver has it on its path."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(riskloom.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="riskloom-ship-")) / "riskloom-package.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in root.rglob("*.py"):
                archive.write(file, file.relative_to(root.parent))
        sc.addPyFile(str(target))  # Spark sends it to every executor
        _SHIPPED.add(sc.applicationId)


def python_stage(spark: SparkSession) -> None:
    """Before an Arrow function is planned: workers can import it, and batches stay at a few MB whatever the texts' length."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser; every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any range of a sequence, from one prefix sum."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = U64(base), U64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up, self.down
        size = max(n, min(2 * len(self.up), KEPT_POWERS), 4096)
        with np.errstate(over="ignore"):
            up, down = np.full(size, self.base), np.full(size, self.inverse)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up, out=up), np.multiply.accumulate(down, out=down)
        if size <= KEPT_POWERS:
            self.up, self.down = up, down
        return up, down

    def ranges(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``values[start:end]`` for each pair; equal content gives equal hashes."""
        n = len(values)
        up, down = self.powers(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, dtype=U64)
            np.cumsum(values * up[:n], out=total[1:])
            return mix64((total[end] - total[start]) * down[start] + (end - start).astype(U64))


_BYTES = mix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTES_LOWER = _BYTES[_LOWER]
_WORD = Rolling(0x5851F42D4C957F2D)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the words before each text (n + 1 entries)."""
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word and the words before each text; ``lower`` folds A-Z first."""
    start, end, before = word_bounds(data, offsets)
    return byte_hashes(data, start, end, lower), before


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each range of bytes; ranges are in order and do not overlap."""
    table = _BYTES_LOWER if lower else _BYTES
    out, at = np.empty(len(start), dtype=U64), 0
    while at < len(start):  # pieces end between ranges, so memory does not follow one text's length
        stop = max(at + 1, int(np.searchsorted(end, start[at] + SLICE_BYTES, "right")))
        lo = start[at]
        out[at:stop] = _WORD.ranges(table[data[lo : end[stop - 1]]], start[at:stop] - lo, end[at:stop] - lo)
        at = stop
    return out


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``most`` bytes; a longer text stands alone."""
    n, at = len(offsets) - 1, 0
    while at < n:
        stop = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1))
        yield at, stop
        at = stop

"""What the operators of this subpackage share: tables kept between jobs, and whole batches of text as numpy arrays."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than space and \t \n \v \f \r; in UTF-8 these bytes occur in no other character.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; one of our own only where that is unset and all run in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: cuts the lineage, and outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/kinfold-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes what `kept` wrote. Only for tables that nothing will read again: what was made of them must be written itself."""
    for df in tables:
        if path := getattr(df, "kept_at", None):
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame, name: str) -> str:
    """A name that no column of df has, in upper or lower case: `name`, with underscores before it where that is taken."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fold_ascii(column) -> object:
    """Lower-cases A-Z only."""
    return F.translate(column, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Returns memory that is free to the system: a worker process outlives its task, and the next stage's workers stand beside it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run: Callable) -> Callable:
    """A function of batches for mapInArrow that gives free memory back after each batch that it returns, and at its end."""

    @functools.wraps(run)
    def own(batches):
        for out in run(batches):
            yield out
            del out
            give_back()
        give_back()

    return own


def trimmed_group(run: Callable) -> Callable:
    """The same for applyInArrow, after each group."""

    def own(key, rows):
        try:
            return run(key, rows)
        finally:
            give_back()

    return own


def trimmed_cogroup(run: Callable) -> Callable:
    """The same for a cogroup's applyInArrow."""

    def own(key, left, right):
        try:
            return run(key, left, right)
        finally:
            give_back()

    return own


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(cls, name, np.cumprod(x, dtype=np.uint64))
        return cls.up, cls.down


class Texts:
    """Some rows of text as one byte buffer, with the words of all of them: where they start and end, and of which row each is."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool = True):
        self.data, self.offsets = (_FOLD[data] if fold else data), offsets
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        before[:1] = True
        np.logical_or(~solid[:-1], edge[1:-1], out=before[1:])
        after = np.empty(len(data), bool)
        after[-1:] = True
        np.logical_or(~solid[1:], edge[1:-1], out=after[:-1])
        self.starts = np.flatnonzero(solid & before)
        self.ends = np.flatnonzero(solid & after) + 1
        self.first = np.searchsorted(self.starts, offsets)  # of each row, the number of its first word; one more at the end

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, by differences of one running polynomial."""
    up, down = _Powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def raw_slices(column: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column of about `most` bytes each, a row at least: first row, row after the last, bytes, offsets of rows. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, raw, body = column.buffers()
    offsets = np.frombuffer(raw, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def parts(batch: pa.RecordBatch, at: int, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows, in order, with about `most` bytes each in its text column `at`, a row at least; they share the batch's memory."""
    ends = np.cumsum(pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    row = 0
    while row < len(ends):
        to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + most, "right")))
        yield batch.slice(row, to - row)
        row = to


def texts_of(column: pa.Array, most: int = 2_000_000, fold: bool = True) -> Iterator[tuple[int, int, Texts]]:
    """The slices as `Texts`."""
    for at, to, data, offsets in raw_slices(column, most):
        yield at, to, Texts(data, offsets, fold)


def row_hashes(starts: np.ndarray, hashes: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles; all its words as one where there are fewer; empty without words."""
    n = len(hashes)
    whole = np.zeros(n, np.uint64)
    if n >= k:
        roll = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            roll = mix64(roll * np.uint64(0x2545F4914F6CDD1D) + hashes[i : n - k + 1 + i] + np.uint64(i + 1))
        whole[: n - k + 1] = roll
    out = []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        elif b > a:
            x = np.zeros(1, np.uint64)
            for i in range(b - a):
                x = mix64(x * np.uint64(0x2545F4914F6CDD1D) + hashes[a + i : a + i + 1] + np.uint64(i + 1))
            out.append(mix64(x + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def packed(values: np.ndarray) -> bytes:
    """Sorted or small unsigned integers as bytes: differences are the caller's; planes of equal significance lie together, so that zeros compress away."""
    import zstandard

    x = np.ascontiguousarray(values)
    planes = x.view(np.uint8).reshape(-1, x.itemsize).T if len(x) else np.zeros((x.itemsize, 0), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)

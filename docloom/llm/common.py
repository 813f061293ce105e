"""What the operators of this subpackage share: the shared folder, Arrow plumbing and a vectorised word kernel.

The kernel reads the bytes of an Arrow string column where they lie, finds words by a table look-up and
hashes them eight bytes at a time, so no Python string is made for a word.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U = np.uint64
#: Bytes of text that the kernel handles at once; a longer text is handled alone.
CHUNK_BYTES = 512 << 10


# ------------------------------------------------------------------ shared folder

def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors see.

    Only on one machine (a local master, as in tests) may the session name none: then a folder of our own is taken and
    recorded. On a cluster that raises ValueError.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        top = "file:///tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/docloom-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """Bound the rows of the Arrow batches of plans made from now on: what a Python worker holds at once.

    Operators that look at each row alone take small batches; those that combine rows within a batch take larger ones.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def trim() -> None:
    """Give memory that a finished task has freed back to the system: idle Python workers live on for a while."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def lean(run: Callable) -> Callable:
    """A function over batches that trims the worker's memory when a task ends."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()
    return whole


def lean_groups(f: Callable, every: int = 16) -> Callable:
    """A function over groups that trims the worker's memory now and then."""
    calls = [0]

    def count() -> None:
        calls[0] += 1
        if calls[0] % every == 0:
            trim()

    # Spark looks at the number of parameters
    def one(table: pa.Table) -> pa.Table:
        count()
        return f(table)

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        count()
        return f(left, right)
    return one if f.__code__.co_argcount == 1 else two


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ Arrow

def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a copy; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about `size` bytes together, one row at least."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = to


# ------------------------------------------------------------------ hashing

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA0761D6478BD642F)
    x ^= x >> U(32)
    return x


def odd_keys(n: int, seed: int) -> np.ndarray:
    """n odd multipliers fixed by the seed."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 2 + 1)) | U(1)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U)


def unquoted(raw: np.ndarray) -> np.ndarray:
    """The bytes with punctuation beyond ASCII blanked: U+00A0 to U+00BF but letters and digits, U+2000 to U+206F, U+3000 to U+303F."""
    if not len(raw) or raw.max() < 0xC2:
        return raw
    out = raw.copy()
    one = np.append(raw[1:], np.uint8(0))
    two = np.append(raw[2:], np.zeros(2, np.uint8))[:len(raw)]
    at = np.flatnonzero((raw == 0xC2) & (one >= 0xA0) & (one <= 0xBF) & ~np.isin(one, (0xAA, 0xB2, 0xB3, 0xB5, 0xB9, 0xBA)))
    out[at], out[at + 1] = 0x20, 0x20
    at = np.flatnonzero(((raw == 0xE2) & ((one == 0x80) | ((one == 0x81) & (two <= 0xAF)))) | ((raw == 0xE3) & (one == 0x80)))
    out[at], out[at + 1], out[at + 2] = 0x20, 0x20, 0x20
    return out


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts: byte ranges, the row of each, and row boundaries."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, *, lower: bool = False, space: np.ndarray = _SPACE):
        self.raw = _LOWER[raw] if lower else raw
        self.offsets = offsets
        solid = ~space[self.raw]
        first, last = solid.copy(), solid.copy()
        if len(solid):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            edge = offsets[:-1][np.diff(offsets) > 0]
            first[edge] = solid[edge]
            edge = offsets[1:][np.diff(offsets) > 0] - 1
            last[edge] = solid[edge]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: words of row i are bounds[i]:bounds[i + 1]
        self.bounds = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self, seed: int = 7) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.end - self.start
        padded = np.zeros(len(self.raw) + 16, np.uint8)
        padded[:len(self.raw)] = self.raw
        lanes = np.ndarray((len(self.raw) + 8,), "<u8", padded, strides=(1,))
        h = mix(size.astype(U) + U(seed))
        at, todo = self.start, None
        left = size
        while True:
            part = lanes[at] & _MASKS[np.minimum(left, 8)]
            if todo is None:
                h = mix(h ^ part)
            else:
                h[todo] = mix(h[todo] ^ part)
            more = np.flatnonzero(left > 8)
            if not len(more):
                return h
            todo = more if todo is None else todo[more]
            at, left = at[more] + 8, left[more] - 8


def windows(h: np.ndarray, bounds: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows that start at each word, and which of them lie within one row."""
    out = np.zeros(len(h), U)
    for k, key in enumerate(odd_keys(n, seed)):
        if k < len(h):
            out[:len(h) - k] += h[k:] * key
    inside = np.zeros(len(h), bool)
    starts, ends = bounds[:-1], bounds[1:]
    whole = ends - starts >= n
    step = np.zeros(len(h) + 1, np.int32)
    np.add.at(step, starts[whole], 1)
    np.add.at(step, ends[whole] - n + 1, -1)
    inside[:] = np.cumsum(step[:-1]) > 0
    return mix(out), inside


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


# ------------------------------------------------------------------ blocks of names for a fragment

def place(token: np.ndarray, fragments: int) -> np.ndarray:
    """Fragment (upper half) and fingerprint within it (lower half) of each shingle."""
    f = ((token >> U(32)) * U(fragments)) >> U(32)
    return (f << U(32)) | (token & U(0xFFFFFFFF))


def pack(r: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted distinct fingerprints as differences, and how often each occurs (up to 255), in planes of bytes."""
    step = np.diff(r.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return step.view(np.uint8).reshape(-1, 4).T.tobytes() + np.minimum(times, 255).astype(np.uint8).tobytes()


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(block, np.uint8).reshape(5, -1)
    return np.cumsum(np.ascontiguousarray(planes[:4].T).view("<u4").ravel(), dtype=np.uint32), planes[4]

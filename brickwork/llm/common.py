"""What the text operators share: shared folders, Arrow batches and vectorised word hashing."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy step holds. The working arrays are about 50 times this.
SLICE_BYTES = 1 << 19
#: Bytes of one Arrow batch between Spark and Python, where the session allows more; a longer row is a batch alone.
BATCH_BYTES = 4 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.ones(1, U64)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only in local mode (tests) one of our own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir")
    if not found:
        existing = sc._jsc.sc().getCheckpointDir()
        if not existing.isDefined() and not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = existing.get() if existing.isDefined() else "file://" + tempfile.mkdtemp(prefix="shared")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared folder, so a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like checkpoint, as a compressed Parquet table."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, df: DataFrame) -> str:
    """A column name that df hasn't got."""
    taken = {c.lower() for c in df.columns}
    while f"__{name}" in taken:
        name += "_"
    return f"__{name}"


def bounded(df: DataFrame) -> DataFrame:
    """df, whose session from now on passes rows to Python in batches of at most BATCH_BYTES."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of at most so many bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    release()


def release() -> None:
    """Gives freed memory back to the system: workers stay for later tasks, several to an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of the rows, one more than rows; they count from the start of the buffer."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column. Null rows are empty."""
    if column.null_count:
        column = column.fill_null("")
    ends = offsets(column)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


_SPACES = re.compile(rb"[\x20\x09-\x0D]")
_WORD = re.compile(rb"[^\x20\x09-\x0D]")


def runs(column: pa.Array, after: int = 0, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The column itself; one row of more than limit bytes as runs of whole words, one array each.

    Each run but the last ends with the `after` words that the next one begins with, so sequences of
    up to after + 1 words are whole in one run, and each lies in one alone. A word alone may be over the limit.
    """
    data, ends = column_bytes(column)
    if len(column) != 1 or len(data) <= limit:
        yield column
        return
    raw, at, n = memoryview(data), 0, len(data)
    more = re.compile(rb"(?:[\x20\x09-\x0D]+[^\x20\x09-\x0D]+){0,%d}" % after)
    while True:
        edge = _SPACES.search(raw, min(at + limit, n))
        end = edge.start() if edge else n
        to = more.match(raw, end).end()
        last = not _WORD.search(raw, to)
        yield pa.array([bytes(raw[at : n if last else to])], pa.binary())
        if last:
            return
        at = end


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < min(n, SLICE_BYTES + 1):
        _POWERS = _accumulated(SLICE_BYTES + 1, _BASE)
    return _POWERS[:n] if n <= len(_POWERS) else _accumulated(n, _BASE)  # what is kept stays small


def _accumulated(n: int, base: int) -> np.ndarray:
    more = np.full(n, base, U64)
    more[0] = 1
    return np.multiply.accumulate(more)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_INVERSE = pow(_BASE, -1, 1 << 64)
_INVERSES = np.ones(1, U64)


def inverses(n: int) -> np.ndarray:
    global _INVERSES
    if len(_INVERSES) < min(n, SLICE_BYTES + 1):
        _INVERSES = _accumulated(SLICE_BYTES + 1, _INVERSE)
    return _INVERSES[:n] if n <= len(_INVERSES) else _accumulated(n, _INVERSE)


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a slice of documents.

    data: the bytes (A-Z lower-cased if asked); start, end: the words' places in data; first: the
    number of words before each document, one entry more than documents; hash: 64 bits of each word.
    """

    def __init__(self, column: pa.Array, lower: bool = False, hashed: bool = True):
        data, ends = column_bytes(column)
        self.data = _LOWER[data] if lower else data
        n = len(data)
        black = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[ends] = True
        before = np.empty(n, bool)
        if n:
            before[0] = True
            np.logical_not(black[:-1], out=before[1:])
        self.start = np.flatnonzero(black & (before | edge[:n]))
        after = np.empty(n, bool)
        if n:
            after[-1] = True
            np.logical_not(black[1:], out=after[:-1])
        self.end = np.flatnonzero(black & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, ends)
        self.count = np.diff(self.first)
        self.ends = ends
        if hashed:
            total = np.zeros(n + 1, U64)
            np.cumsum(_BYTE[self.data] * powers(n), out=total[1:])
            self.hash = mix((total[self.end] - total[self.start]) * inverses(n + 1)[self.start] + (self.end - self.start).astype(U64))

    def doc(self) -> np.ndarray:
        """Of each word, its document's place in the slice."""
        return np.repeat(np.arange(len(self.count)), self.count)


def rows_list(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from each row's number of values and all values in order."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))

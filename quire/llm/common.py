"""Shared pieces: reading tables, scratch tables, word hashing, small numpy kernels."""

from __future__ import annotations

import ctypes
import hashlib
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words, as a set for btrim and as a pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def by_value(name: str) -> None:
    """Send a module's functions to the executors whole, so that they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Fewer rows in an Arrow batch than Spark's default, for texts are long; a value set by the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a temporary one only where none is set."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='quire-')}"
        sc.setCheckpointDir(shared)
    return shared.rstrip("/")


#: Folders of all scratch tables of this process, oldest first.
_FOLDERS: list[str] = []


class Scratch:
    """Tables in the shared folder that cut lineage: what is read back no longer depends on executors' shuffle files.

    Results are read from these tables when they are used, so they stay until `clear`.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{scratch_dir(spark)}/quire-{uuid.uuid4().hex}"
        self.n = 0
        _FOLDERS.append(self.root)

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._quire_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove a table that nothing reads any more."""
        path = getattr(df, "_quire_path", None)
        if path:
            _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def mark() -> int:
    """How many folders of scratch tables there are; a point that `clear` can go back to."""
    return len(_FOLDERS)


def clear(spark: SparkSession, since: int = 0) -> None:
    """Remove the scratch tables made since `mark` gave that number. Results that weren't written or collected can't be read afterwards."""
    while len(_FOLDERS) > since:
        _delete(spark, _FOLDERS.pop())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def digest(text: Column, i: int) -> Column:
    """The i-th of a family of 64-bit hashes. The number is hashed first, so each starts from a state of its own and none is a function of another."""
    return F.xxhash64(F.lit(i), text)


def trimmed(text: Column) -> Column:
    """Text without white space at its ends; null counts as empty."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    t = trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % n


def lean(run):
    """A kernel over batches that gives freed memory back to the system when a task ends, for Python workers outlive tasks."""

    def kernel(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return kernel


# numpy kernels


#: Bytes of text that are hashed at a time; a longer text makes a part of its own.
PART_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1


def text_parts(batch, columns: tuple[str, ...] = ("text",), part: int = PART_BYTES):
    """Parts of an Arrow batch with about so many bytes of text each."""
    ends = np.zeros(batch.num_rows + 1, np.int64)
    for c in columns:
        size = batch.column(c).cast("large_binary")
        off = np.frombuffer(size.buffers()[1], np.int64)[size.offset : size.offset + len(size) + 1]
        ends += off - off[0]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + part, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


#: Words longer than this are hashed one by one.
LONG_WORD = 64
#: Bytes that belong to words.
INK = np.ones(256, bool)
INK[[9, 10, 11, 12, 13, 32]] = False


def cut(column, ink: np.ndarray = INK, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow string column, begin and end of each maximal run of `ink` bytes within one text, and each text's first run; null is empty.

    lower: A-Z become a-z.
    """
    column = column.cast("large_binary")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    n = int(off[-1] - off[0])
    none = np.empty(0, np.int64)
    if not n:
        return np.empty(0, np.uint8), none, none, np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    if column.null_count:
        # the bytes of a null row, if any, count as white space
        raw = raw.copy()
        for i in np.flatnonzero(np.asarray(column.is_null())):
            raw[off[i] : off[i + 1]] = 32
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        raw = table[raw]
    inked = ink[raw]
    start = inked.copy()
    start[1:] &= ~inked[:-1]
    edge = off[(off > 0) & (off < n)]
    start[edge] = inked[edge]
    stop = np.zeros(n + 1, bool)  # after a run's last byte
    stop[1:n] = inked[:-1] & (~inked[1:] | start[1:])
    stop[n] = inked[-1]
    begin, end = np.flatnonzero(start), np.flatnonzero(stop)
    return raw, begin, end, np.searchsorted(begin, off, "left")


def tokens(column, ink: np.ndarray = INK, lower: bool = False) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The runs that `cut` finds as an Arrow array of their own, and each text's first run."""
    raw, begin, end, first = cut(column, ink, lower)
    stops = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=stops[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(stops), pa.py_buffer(raw[ink[raw]])]), first


def hash_words(column, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts of an Arrow string column, in order, and each text's first word; null is empty.

    Works on the bytes of the whole column at once: eight bytes at a time are mixed into the hash of every word that has so many,
    each step with the finaliser of splitmix64. Words of more than LONG_WORD bytes are hashed one by one by BLAKE2b.
    lower: A-Z count as a-z.
    """
    raw, begin, end, first = cut(column, INK, lower)
    length = end - begin
    h = mix(length.astype(np.uint64) + np.uint64(_ODD))
    if not len(h):
        return h, first
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw), "<u8", padded, 0, (1,))
    long = np.flatnonzero(length > LONG_WORD)
    alive, j = np.flatnonzero(length <= LONG_WORD), 0
    while len(alive):
        left = length[alive] - j
        lane = eight[begin[alive] + j]
        lane &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64))
        h[alive] = mix((h[alive] ^ lane) * np.uint64(_ODD) + np.uint64(j + 1))
        j += 8
        alive = alive[left > 8]
    for i in long:
        h[i] = int.from_bytes(hashlib.blake2b(raw[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h, first


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values evenly."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def grams(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of k consecutive values; entry i covers i to i + k - 1."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = h.view(np.uint64) if h.dtype == np.int64 else h
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15 + salt & 0xFFFFFFFFFFFFFFFF))
    for i in range(k):
        out *= np.uint64(0x100000001B3)
        out += h[i : i + n]
        out ^= out >> np.uint64(29)
    return mix(out)


def starts_of(off: np.ndarray, k: int) -> np.ndarray:
    """Whether position i starts k values of one list, for all i of the flat values that grams() covers."""
    total = int(off[-1])
    n = total - k + 1
    if n <= 0:
        return np.empty(0, bool)
    ends = np.repeat(off[1:], np.diff(off))
    return np.arange(n) + k <= ends[:n]


def owners(off: np.ndarray) -> np.ndarray:
    """The list that each flat value belongs to."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))

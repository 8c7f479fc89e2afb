"""What several operators need: reading tables, written intermediates, words and hashes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a Bloom filter: 16 for each value, up to a bound of 32 MB.
BITS_PER_VALUE, MOST_BITS = 16, 1 << 28
PAGE_BITS = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only a plain local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    session = spark.sparkContext.applicationId
    if session not in _LOCAL_FOLDERS:
        import tempfile

        _LOCAL_FOLDERS[session] = tempfile.mkdtemp(prefix="llm-")
    return _LOCAL_FOLDERS[session]


class Scratch:
    """Intermediate tables as Parquet in the shared folder; what is left goes when the JVM ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(path)
        self._fs.deleteOnExit(path)
        self._n = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Writes `df` once and returns the reading of it, with its lineage cut."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        read._scratch_path = path
        return read

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables no plan reads any more."""
        for df in tables:
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path), True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Tables written within leave no shuffle files behind: nothing reads those again once a table stands."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(text: str) -> bytes:
    """UTF-8 bytes with only A-Z lowered."""
    return text.encode("utf-8", "replace").lower()


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than [\\x20\\x09-\\x0D], lower-cased in A-Z; bytes.split cuts at exactly these."""
    return ascii_lower(text).split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, kept per worker up to a bound."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs_hashed(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` consecutive values; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = mixed(out * GOLDEN + hashes[i : i + n])
    return out


_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


class SplitTexts:
    """The words of some UTF-8 texts without an object for each: begin and end in `raw`, the text's row, a 64-bit hash.
    A hash takes a word's length and its bytes in steps of eight, all words at once."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join([*texts, b""]) + bytes(8)
        n = len(self.raw) - 8
        blank = _BLANK[np.frombuffer(self.raw, np.uint8, n)]
        edges = np.flatnonzero(np.concatenate([~blank[:1], blank[1:] != blank[:-1]]))
        self.begin, self.end = edges[0::2], edges[1::2]
        bounds = np.cumsum([len(t) + 1 for t in texts]) if texts else np.empty(0, np.int64)
        self.row = np.searchsorted(bounds, self.begin, "right")
        length = self.end - self.begin
        eights = np.ndarray((n + 1,), "<u8", self.raw, strides=(1,))
        self.hash = mixed(length.astype(np.uint64))
        left, step = np.arange(len(length)), 0
        while len(left):
            value = eights[self.begin[left] + step]
            short = np.minimum(length[left] - step, 8).astype(np.uint64)
            value &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * short)
            self.hash[left] = mixed(self.hash[left] * GOLDEN + value)
            step += 8
            left = left[length[left] > step]

    def between(self, first: int, last: int) -> bytes:
        """Words first to last, joined by one space."""
        return b" ".join(self.raw[self.begin[first] : self.end[last]].split())


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def text_batches(batches: Iterable[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that the texts of each hold about `most` bytes; a longer text is alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, carried: Iterable[str], **columns) -> pa.RecordBatch:
    """The carried columns as they are, then new ones; lists and numpy arrays become Arrow arrays of a given type."""
    arrays = [batch.column(c) for c in carried]
    arrays += [pa.array(values, kind) for values, kind in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=[*carried, *columns])


def crc_mod(column: str, by: int) -> Column:
    """crc32 of a number as text, modulo `by`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def only(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra columns can't clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def kind_of(docs: DataFrame, *columns: str) -> str:
    """The named columns of a frame as a DDL schema."""
    return ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)


def _places(values: np.ndarray, bits: int) -> list[np.ndarray]:
    one, step = values.view(np.uint64), mixed(values.view(np.uint64) ^ GOLDEN) | np.uint64(1)
    return [((one + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64) for k in range(5)]


def bloom_filter(values: DataFrame, count: int) -> tuple[int, np.ndarray]:
    """A Bloom filter of about `count` hashes, the only column: tasks set bits in pages, pages are joined, and the
    whole has at most MOST_BITS."""
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(PAGE_BITS.bit_length() - 1, math.ceil(math.log2(max(1, BITS_PER_VALUE * count)))))

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits, bool)
        for batch in batches:
            for at in _places(batch.column(0).to_numpy(), bits):
                held[at] = True
        rows = np.packbits(held).reshape(-1, PAGE_BITS // 8)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([rows[i].tobytes() for i in used], pa.binary())], names=["page", "bits"])

    def joined(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PAGE_BITS // 8, np.uint8)
        for batch in batches:
            for raw in batch.column("bits").to_pylist():
                total |= np.frombuffer(raw, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([total.tobytes()], pa.binary())], names=["page", "bits"])

    schema = "page long, bits binary"
    out = np.zeros((bits // PAGE_BITS, PAGE_BITS // 8), np.uint8)
    for r in values.mapInArrow(pages, schema).groupBy("page").applyInArrow(joined, schema).collect():
        out[r["page"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits, out.ravel()


def passing(values: np.ndarray, filter_: tuple[int, np.ndarray]) -> np.ndarray:
    bits, held = filter_
    out = np.ones(len(values), bool)
    for at in _places(values, bits):
        out &= (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def probably_among(keys: DataFrame, name: str) -> Callable[[str], Column]:
    """A condition on a column, true for every value in column `name` of `keys` and by chance for few others. It spares
    rows a shuffle before an exact join; beyond what the bounded filter can tell apart, it lets all pass."""
    values = keys.select(F.xxhash64(name).alias("value"))
    sent = keys.sparkSession.sparkContext.broadcast(bloom_filter(values, keys.count()))

    @F.pandas_udf("boolean")
    def among(value: pd.Series) -> pd.Series:
        return pd.Series(passing(value.to_numpy(np.int64), sent.value))

    return lambda column: among(F.xxhash64(column))

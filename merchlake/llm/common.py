"""Helpers shared by the operators: scratch tables, words, hashes, groups of sorted rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.operators.tables import delete_folder
from merchlake.session import work_folder


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted at its end: once a table is written nobody reads
    them again, and until the driver collects garbage they would fill the executors' disks."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before or "false")


class Scratch:
    """Intermediate tables of one operator call, in the folder that driver and executors share.

    A table is written once and read back, so whatever follows does not recompute it when an
    executor is lost. Tables are deleted as soon as all that was made of them is written too.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{work_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self._number = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self._number += 1
        path = f"{self.folder}/{self._number:03d}-{name}"
        with _shuffles_deleted(self.spark):
            df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(kept)] = kept, path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables given out by ``keep``; no later plan may read them."""
        for table in tables:
            _, path = self._paths.pop(id(table))
            delete_folder(self.spark, path)

    def only(self, *tables: DataFrame) -> None:
        """Deletes all tables but these."""
        kept = {id(t) for t in tables}
        self.drop(*[t for key, (t, _) in list(self._paths.items()) if key not in kept])

    @contextmanager
    def inner(self) -> Iterator[Scratch]:
        """Tables of one step, deleted at its end; its result is kept outside."""
        self._number += 1
        step = Scratch(self.spark, "step", f"{self.folder}/{self._number:03d}-step")
        yield step
        step.only()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _marked(rows: DataFrame, key: str, wanted: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``__hit``: false where the key is surely not in ``wanted``.

    A bitmap of fixed size (2**bits bits, in 64-bit words) of the wanted keys is broadcast. However many
    keys are wanted, it has at most 2**(bits - 6) words; once full it marks all rows.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << bits))
    bit = f"int({_slot_sql(key, bits)} & 63)"
    bitmap = (
        wanted.select(F.shiftright(slot, 6).alias("__word"), F.expr(f"shiftleft(1L, {bit})").alias("b"))
        .groupBy("__word")
        .agg(F.bit_or("b").alias("__bits"))
    )
    hit = F.expr(f"coalesce(`{key}` IS NOT NULL AND (shiftright(__bits, {bit}) & 1) = 1, false)")
    marked = rows.join(F.broadcast(bitmap), F.shiftright(slot, 6) == F.col("__word"), "left")
    return marked.withColumn("__hit", hit).drop("__word", "__bits")


def within(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 24) -> DataFrame:
    """``rows`` joined with ``wanted`` by the key, most of the other rows being left out before the shuffle.

    No semi join by the key may follow: Spark would move it below the bitmap, and shuffle all rows for it.
    """
    return _marked(rows, key, wanted, bits).filter("__hit").drop("__hit").join(wanted, key)


def beside(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those that may have a key in ``wanted``, left-joined with it, and the others,
    which do not move."""
    marked = _marked(rows, key, wanted, bits)
    return marked.filter("__hit").drop("__hit").join(wanted, key, "left"), marked.filter("NOT __hit").drop("__hit")


def _slot_sql(name: str, bits: int) -> str:
    return f"pmod(xxhash64(`{name}`), {1 << bits}L)"


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as bytes objects."""
    return column.cast(pa.binary()).to_pylist()


class Hashes(dict):
    """64-bit hash of each word, remembered for the words met lately."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_2 = np.uint64(0xD6E8FEB86659FD93)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 bits of the result."""
    x = values ^ (values >> np.uint64(32))
    x = x * ODD_2
    x ^= x >> np.uint64(29)
    x = x * ODD
    x ^= x >> np.uint64(32)
    return x


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values, in order; empty when there are fewer."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = (h ^ values[k : k + n]) * ODD
        h ^= h >> np.uint64(31)
    return h


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to about ``limit``; one item at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys out of rows that come sorted by these keys."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        change[0] = last is not None and first != last
        cuts = [*np.flatnonzero(change), batch.num_rows]
        start = 0
        for cut in cuts[:-1]:
            if cut > start:
                pending.append(batch.slice(start, cut - start))
            if pending:
                yield pa.Table.from_batches(pending)
            pending, start = [], cut
        pending.append(batch.slice(start))
        last = tuple(c[-1] for c in columns)
    if pending:
        yield pa.Table.from_batches(pending)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list of ``counts[i]`` consecutive values per row."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def has_remainder(column: str, divisor: int, remainder: int) -> Column:
    """Whether the crc32 of a number's text leaves ``remainder``; false where the number is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % divisor == remainder, F.lit(False))

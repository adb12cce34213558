"""CSV exports whose quoted texts may hold line breaks, read split by split.

Whether a line break ends a record depends on all quotes before it. A first pass gives, per file
split, the parity of its quotes and how many records begin in it, both for a split that begins
outside quotes and for one that begins inside. Sums over the splits of a file then tell how each
split really begins and how many records come before it. The second pass puts records together and
numbers them; only a record that crosses a split's end is brought together from two or more tasks.

Running sums over a file's lines need their order, which a shuffle would lose: the two passes are
Python functions over Arrow batches. Everything else is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_WHOLE_RECORD = -1
_PARTS = "file long, row long, part long, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and the split they begin in, in the file's order within a task."""
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select(*place, "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The parts of a batch that belong to one split each."""
    file, block = (batch.column(k).to_numpy() for k in (0, 1))
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if stop > start:
            yield int(file[start]), int(block[start]), batch.slice(start, stop - start)


def _parity(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the quotes up to each line's end, and whether the line has content."""
    quotes = pc.count_substring(lines, '"').to_numpy()
    filled = pc.not_equal(pc.utf8_rtrim(lines, "\r"), "").to_numpy(zero_copy_only=False)
    return np.cumsum(quotes) & 1, filled


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: the parity of its quotes, and records beginning in it if it begins outside or inside quotes."""
    found: dict[tuple[int, int], list[int]] = {}
    for batch in batches:
        for file, block, rows in _runs(batch):
            state = found.setdefault((file, block), [0, 0, 0])
            after, filled = _parity(rows.column(2))
            before = np.append(0, after[:-1]) ^ state[0]
            state[0] ^= int(after[-1])
            state[1] += int((filled & (before == 0)).sum())
            state[2] += int((filled & (before == 1)).sum())
    rows = [(*key, *state) for key, state in found.items()]
    names = ["file", "block", "parity", "if_outside", "if_inside"]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(5)], names)


def splits(lines: DataFrame) -> DataFrame:
    """Per file split: whether it begins ``inside`` quotes, and the records ``before`` it in its file."""
    measured = lines.mapInArrow(_measured, "file long, block long, parity long, if_outside long, if_inside long")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    all_quotes = F.sum("parity").over(Window.partitionBy("file"))
    closed = F.when(all_quotes % 2 == 0, F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).otherwise(
        F.raise_error(F.lit("Malformed CSV: a file ends inside quotes")).cast("bigint")
    )
    begun = F.when(F.col("inside") == 1, F.col("if_inside")).otherwise(F.col("if_outside"))
    return (
        measured.withColumn("inside", closed)
        .withColumn("begun", begun)
        .select("file", "block", "inside", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("before"))
    )


class _Assembler:
    """Records of one split after the other; ``wanted`` selects whole records or pieces of crossing ones."""

    def __init__(self, whole: bool):
        self.whole = whole
        self.at: tuple[int, int] | None = None
        self.out: list[tuple[int, int, str]] = []

    def begin(self, at: tuple[int, int], inside: int, before: int) -> None:
        self.at, self.inside, self.row = at, inside, before
        self.open: list[str] = []
        self.crosses = bool(inside)

    def close(self) -> None:
        """The split's end: what is open goes on in the next one."""
        if self.at and self.inside and self.open and not self.whole:
            self.out.append((self.row, self.at[1], "\n".join(self.open)))

    def add(self, lines: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Rows and texts of the records that are one line; the others are gathered in ``out``."""
        after, filled = _parity(lines)
        after = after ^ self.inside
        before = np.append(self.inside, after[:-1])
        rows = self.row + np.cumsum((before == 0) & filled)
        for k in np.flatnonzero(before | after).tolist():
            if not before[k]:
                self.open, self.crosses = [], False
            self.open.append(lines[k].as_py())
            if not after[k]:
                if self.whole != self.crosses:
                    part = self.at[1] if self.crosses else _WHOLE_RECORD
                    self.out.append((int(rows[k]), part, "\n".join(self.open)))
                self.open = []
        self.inside, self.row = int(after[-1]), int(rows[-1])
        single = (before == 0) & (after == 0) & filled if self.whole else np.zeros(len(after), bool)
        return rows[single], lines.filter(pa.array(single))


def _assembled(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Assembler(whole)

        def gathered() -> pa.RecordBatch:
            rows, state.out = state.out, []
            file = state.at[0] if state.at else 0
            columns = [pa.array([file] * len(rows), pa.int64())]
            columns += [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, ["file", "row", "part", "text"])

        for batch in batches:
            for file, block, part in _runs(batch):
                if state.at != (file, block):
                    state.close()
                    yield gathered()
                    state.begin((file, block), part.column(3)[0].as_py(), part.column(4)[0].as_py())
                rows, texts = state.add(part.column(2))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file)), pa.array(rows, pa.int64()), pa.array(np.full(n, _WHOLE_RECORD)), texts],
                    ["file", "row", "part", "text"],
                )
                yield gathered()
        state.close()
        yield gathered()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record's text with its file and its row in it (the header is row 1).

    The table of splits has one short row per file split, so it is broadcast; a join by shuffling
    would lose the lines' order.
    """
    lines = _lines(spark, path)
    placed = lines.join(F.broadcast(splits(lines)), ["file", "block"]).select("file", "block", "value", "inside", "before")
    whole = placed.mapInArrow(_assembled(True), _PARTS).select("file", "row", "text")
    pieces = F.array_sort(F.collect_list(F.struct("part", "text")))
    crossing = placed.mapInArrow(_assembled(False), _PARTS).groupBy("file", "row").agg(
        F.array_join(F.transform(pieces, lambda x: x["text"]), "\n").alias("text")
    )
    return whole.unionByName(crossing)


def read(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """All columns as text, with ``file`` and ``row`` (1 for the first row behind the header).

    The columns' names come from the header; a file with another header raises, and so do a record
    with another number of fields and a file that ends inside quotes.
    """
    names = spark.read.options(**options, recursiveFileLookup=True).csv(path).columns
    schema = StructType([StructField(f"c{k}", StringType()) for k in range(len(names))])
    text = F.regexp_replace("text", "\r$", "")
    ddl = ", ".join(f"{f.name} string" for f in schema.fields)
    parsed = records(spark, path).select(
        "file", "row", F.from_csv(text, ddl, {"mode": "FAILFAST", "escape": '"', "quote": '"'}).alias("v")
    )
    header = F.array(*[F.col(f"v.{f.name}") for f in schema.fields]) == F.array(*[F.lit(n) for n in names])
    wrong: Column = F.raise_error(F.lit("CSV header does not conform to the first file's")).cast("boolean")
    data = F.when(F.col("row") > 1, F.lit(True)).when(header, F.lit(False)).otherwise(wrong)
    return parsed.filter(data).select(
        "file", (F.col("row") - 1).alias("row"), *[F.col(f"v.{f.name}").alias(n) for f, n in zip(schema.fields, names, strict=True)]
    )

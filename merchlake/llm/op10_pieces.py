"""SentencePiece encoding and decoding by shortest paths in a weighted finite-state transducer."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake.llm.common import bytes_of, lists, slices, table
from merchlake.llm.transducer import SPACE, Transducer

TOKENIZERS = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"


class Codec:
    """Encodes and decodes texts; the paths of parts met lately are remembered.

    Where no piece has a space sign after another character, a text falls into parts that begin with
    spaces and have independent paths.
    """

    LIMIT = 400_000

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        known = transducer.symbols[[ord("\n"), ord("\t")]] >= 0
        stops = "".join(c for c, k in zip("\n\t", known, strict=True) if not k)
        pattern = f"[{stops}]| *[^ {stops}]+| +" if stops else " *[^ ]+| +"
        self.parts = re.compile(pattern.encode() if not transducer.spaces_inside else b"(?s).+")
        letters = [_piece_bytes(p, i, transducer) for i, p in enumerate(transducer.pieces)]
        self.letters = np.frombuffer(b"".join(letters), np.uint8)
        self.letter_starts = np.append(0, np.cumsum([len(x) for x in letters]))
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def normalised(self, text: bytes) -> bytes:
        """Space signs become spaces; if the vocabulary says so, runs of spaces become one and one
        space is put in front."""
        text = text.replace(SPACE.encode(), b" ")
        if self.transducer.collapse:
            text = re.sub(b" +", b" ", text).strip(b" ")
        return b" " + text if text and self.transducer.dummy_prefix else text

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each."""
        split = [self.parts.findall(self.normalised(x)) for x in texts]
        if len(self.rows) > self.LIMIT:
            self._clear()
        new = [x for x in set().union(*split) if x not in self.rows]
        for start, stop in slices([len(x) for x in new], 1 << 18):
            part = [x.decode("utf-8", "replace").replace(" ", SPACE) for x in new[start:stop]]
            ids, counts = self.transducer.shortest(part)
            self.rows.update(zip(new[start:stop], range(len(self.rows), len(self.rows) + stop - start), strict=True))
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        number = [len(x) for x in split]
        rows = np.fromiter((r for x in split for r in map(self.rows.__getitem__, x)), np.int64, sum(number))
        ids, size = _gather(self.ids, self.starts, rows)
        ends = np.append(0, np.cumsum(size))
        bounds = np.append(0, np.cumsum(number))
        return ids, np.diff(ends[bounds])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids; bytes that are no UTF-8 become the replacement sign."""
        letters, size = _gather(self.letters, self.letter_starts, ids.astype(np.int64))
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))]
        raw = letters.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return [x[1:] if self.transducer.dummy_prefix and x.startswith(" ") else x for x in texts]

    def checked(self, texts: list[bytes], ids: np.ndarray, counts: np.ndarray) -> list[bool]:
        wanted = [self.normalised(x) for x in texts]
        if self.transducer.dummy_prefix:
            wanted = [x[1:] for x in wanted]
        return [x == y.encode() for x, y in zip(wanted, self.decode(ids, counts), strict=True)]


def _gather(values: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = starts[rows + 1] - starts[rows]
    at = np.repeat(starts[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return values[at], size


def _piece_bytes(piece: str, i: int, transducer: Transducer) -> bytes:
    byte = np.flatnonzero(transducer.byte_ids == i)
    if len(byte):
        return bytes([int(byte[0])])
    if i == transducer.unknown:
        return " ⁇ ".encode()
    control = piece.startswith("<") and piece.endswith(">") and i < 3
    return b"" if control else piece.replace(SPACE, " ").encode()


def encode(
    docs: DataFrame,
    text_column: str = "text",
    model: str = os.path.join(TOKENIZERS, PIECES),
    ids_column: str = "piece_ids",
    checked_column: str | None = None,
) -> DataFrame:
    """``docs`` with the column ``ids_column`` array<int>, the piece ids of the text.

    With ``checked_column`` that boolean column follows: whether decoding the ids gives the text back,
    space signs read as spaces and, where the vocabulary collapses spaces, in its collapsed form.

    The compiled transducer, a few megabytes whatever the corpus, goes out with the job; texts are
    encoded where they are and nothing is shuffled.

    Edge cases: a null or empty text has no ids. Repeated rows and null ids are encoded one by one.
    A column named like ``ids_column`` is replaced; all others pass through, whatever their names.
    A part without a space of n characters takes n steps. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    compiled = spark.sparkContext.broadcast(Transducer.load(model))
    call = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(call, compiled)
        for batch in batches:
            texts = [x or b"" for x in bytes_of(batch.column(batch.schema.get_field_index(text_column)))]
            for start, stop in slices([len(x) for x in texts], 1 << 20):
                ids, counts = codec.encode(texts[start:stop])
                part = batch.slice(start, stop - start)
                columns, names = [*part.columns, lists(ids, counts, pa.int32())], [*batch.schema.names, ids_column]
                if checked_column:
                    columns.append(pa.array(codec.checked(texts[start:stop], ids, counts), pa.bool_()))
                    names.append(checked_column)
                yield pa.RecordBatch.from_arrays(columns, names)

    rest = docs.drop(ids_column, *([checked_column] if checked_column else []))
    fields = [T.StructField(ids_column, T.ArrayType(T.IntegerType()))]
    if checked_column:
        fields.append(T.StructField(checked_column, T.BooleanType()))
    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, *fields]))


_CODECS: dict[str, Codec] = {}


def _codec(call: str, compiled: Broadcast) -> Codec:
    """The worker's codec of one call's transducer, kept for its next tasks; only the latest is."""
    if call not in _CODECS:
        _CODECS.clear()
        _CODECS[call] = Codec(compiled.value)
    return _CODECS[call]


def decode(
    docs: DataFrame, ids_column: str = "piece_ids", model: str = os.path.join(TOKENIZERS, PIECES), text_column: str = "decoded"
) -> DataFrame:
    """``docs`` with the column ``text_column``, the text that the ids stand for.

    Edge cases: null or no ids give an empty text. Ids outside the vocabulary raise. A column named
    like ``text_column`` is replaced; all others pass through.
    """
    compiled = docs.sparkSession.sparkContext.broadcast(Transducer.load(model))
    call = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(call, compiled)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_column))
            counts = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            texts = codec.decode(column.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_column]
            )

    rest = docs.drop(text_column)
    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField(text_column, T.StringType())]))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, and whether decoding gives the text back, for every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(documents, checked_column="round_trip").select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip"
    )


QUERIES = {"op10_pieces": op10_pieces}
SQL: dict[str, str] = {}

"""Near-duplicate documents: fast similarity sketches of word shingles, banding, exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import sketch
from merchlake.llm.common import Hashes, Scratch, bytes_of, slices, table, windows, within
from merchlake.llm.linking import link

WORDS = 5
PERCENT = 75
#: Bins of a sketch; the first ROWS * BANDS of them are banded, all of them estimate similarity.
BINS = 256
ROWS = 6
BANDS = 40


class Shingler:
    """Sorted distinct shingle hashes of a text.

    Words are runs of bytes other than space, tab, newline, vertical tab, form feed and carriage
    return, A-Z lower-cased. A text of fewer words than a shingle is one shingle; one without words
    has none.
    """

    def __init__(self, words: int = WORDS):
        self.words = words
        self.hashes = Hashes()

    def of(self, text: bytes) -> np.ndarray:
        words = self.hashes.of(text.lower().split())
        return np.unique(windows(words, min(self.words, len(words)))) if len(words) else windows(words, self.words)


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest id reachable over links, kept says that it is the row's own.

    Equal sets form one class before anything is compared. Each class is sketched, its bands find
    candidates, and every link is checked on the whole sets of both texts (see ``linking``).

    Edge cases: a null or word-less text has 0 shingles and is linked with nothing. A row without id
    is never linked: component_id is null and kept true. Rows that repeat an id with the same text
    share one result; with different texts each row has the result of its own text. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    sketches = scratch.keep(_sketches(rows, words), "sketches")
    # The smallest id of a class owns it; the row number makes class ids unique even if ids repeat.
    classes = scratch.keep(
        sketches.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("owner"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )

    def bodies(wanted: DataFrame) -> DataFrame:
        owners = scratch.keep(classes.select("id", "owner", "set_key").join(wanted, "id", "left_semi"), "owners")
        texts = within(rows, "doc_id", owners.withColumnRenamed("owner", "doc_id"))
        # Rows that repeat an id give the same set again: one of them is enough.
        return texts.select("id", "set_key", "text").mapInArrow(_confirmed(words), "id long, body binary").dropDuplicates(["id"])

    roots = link(
        scratch, classes.select("id", "size", "sig"), bodies, _hashes, percent, sketch.cut(percent / 100, BINS), BANDS, ROWS
    )
    owned = classes.select("id", "set_key", "owner").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    smallest = owned.groupBy("root").agg(F.min("owner").alias("component"))
    of_class = scratch.keep(owned.join(smallest, "root").select("set_key", "component"), "components")
    slim = scratch.keep(sketches.select("doc_id", "n_shingles", "set_key"), "sets")
    scratch.only(slim, of_class)
    return (
        slim.join(of_class, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _sketches(rows: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            texts = [x or b"" for x in bytes_of(batch.column(1))]
            for start, stop in slices([len(x) for x in texts], 1 << 20):
                sets = [shingler.of(x) for x in texts[start:stop]]
                sizes = np.array([len(x) for x in sets])
                filled = sizes > 0
                sketches = sketch.sketch(np.concatenate(sets), sizes, BINS)
                sig = sketch.short(sketches)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(sizes, pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets], pa.binary()),
                        pa.array([s.tobytes() if f else None for s, f in zip(sig, filled, strict=True)], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_key", "sig"],
                )

    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def _hashes(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint64)


def _confirmed(words: int):
    """Sets of the texts that really have their class's set; an id may come with several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler.of(x or b"").tobytes() for x in bytes_of(batch.column(2))]
            keep = [xxhash.xxh3_128_digest(x) == k for x, k in zip(sets, batch.column(1).to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "body"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return run


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op3_near_duplicates": op3_near_duplicates}
SQL = {
    "op3_near_duplicates": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
            ) AS w FROM documents
        ),
        p AS (
            SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g FROM p
        ),
        n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ),
        i AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
            FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
        ),
        e AS (
            SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
        ),
        l AS (
            SELECT a, b FROM e UNION ALL SELECT b, a FROM e
        ),
        r AS (
            SELECT doc_id, doc_id AS root FROM d
            UNION
            SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b
        ),
        m AS (
            SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, root AS component_id, doc_id = root AS kept
        FROM m LEFT JOIN n USING (doc_id)
    """,
}

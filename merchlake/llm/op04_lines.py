"""Fuzzy line deduplication: character-shingle sketches, banding, exact checks, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake.llm import sketch
from merchlake.llm.common import ODD, Scratch, beside, bytes_of, mix, slices, table, within
from merchlake.llm.linking import link

CHARS = 8
PERCENT = 80
ROWS = 3
BANDS = 10
_NEWLINE = 10


def char_shingles(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive codes; runs of doubling length are put together."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    whole, done, part, length = None, 0, mix(codes.astype(np.uint64) + ODD), 1
    while True:
        if size & length:
            piece = part[done : done + n]
            whole = piece.copy() if whole is None else whole * ODD + (piece ^ (piece >> np.uint64(31)))
            done += length
        if done == size:
            return whole
        part = part[:-length] * ODD + (part[length:] ^ (part[length:] >> np.uint64(31)))
        length *= 2


def codes_of(text: str | bytes) -> np.ndarray:
    raw = text if isinstance(text, str) else text.decode("utf-8", "replace")
    return np.frombuffer(raw.encode("utf-32-le", "replace"), np.uint32)


def line_shingles(line: bytes, size: int) -> np.ndarray:
    """Sorted distinct character shingles; a line shorter than a shingle is one."""
    codes = codes_of(line)
    return np.unique(char_shingles(codes, min(size, len(codes)))) if len(codes) else np.zeros(0, np.uint64)


def deduplicate_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    chars: int = CHARS,
    percent: int = PERCENT,
    carry: list[str] | None = None,
) -> DataFrame:
    """doc_id, text, n_lines, n_removed and the columns ``carry`` for each row of ``docs``.

    Lines are the parts between newlines. Two lines are alike when 100 * |intersection| >=
    percent * |union| of their sets of ``chars``-character shingles. Of each group of lines that are
    alike, directly or through others, the first one stays: that of the smallest id, and the
    foremost in its text. The others leave the text together with their newline.

    Edge cases: lines without a visible character always stay and are like nothing. A null text
    stays null and has 0 lines. A row without id stays as it is and is compared with nothing. Rows
    that repeat an id count as one document: equal lines at the same place share one fate. Columns that
    are not carried are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    # Carried columns travel as one, under a name of its own.
    carried = F.struct(*(F.col(c) for c in carry)) if carry else F.lit(0)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        carried.alias("carried"),
    )
    known = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    lines = scratch.keep(_lines(known, chars), "lines")
    classes = scratch.keep(
        lines.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("sig").alias("sig"))
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )

    def bodies(wanted: DataFrame) -> DataFrame:
        places = classes.select("id", "first", "h1").join(wanted, "id", "left_semi")
        per_doc = scratch.keep(
            places.groupBy(F.col("first.doc_id").alias("doc_id")).agg(
                F.collect_list(F.struct(F.col("first.pos").alias("pos"), "id", "h1")).alias("wanted")
            ),
            "places",
        )
        texts = within(known, "doc_id", per_doc)
        return texts.select("text", "wanted").mapInArrow(_picked, "id long, body binary").dropDuplicates(["id"])

    roots = link(
        scratch, classes.select("id", "size", "sig"), bodies, lambda line: line_shingles(line, chars), percent,
        sketch.cut(percent / 100, ROWS * BANDS), BANDS, 2 * ROWS,
    )
    grouped = classes.join(roots, "id", "left").filter("n > 1 OR root IS NOT NULL")
    grouped = scratch.keep(
        grouped.select("h1", "h2", "first", F.coalesce("root", "id").alias("root")), "grouped"
    )
    foremost = grouped.groupBy("root").agg(F.min("first").alias("stays"))
    fates = scratch.keep(grouped.join(foremost, "root").select("h1", "h2", "stays"), "fates")
    removed = (
        lines.select("doc_id", "pos", "h1", "h2")
        .join(fates, ["h1", "h2"])
        .filter((F.col("doc_id") != F.col("stays.doc_id")) | (F.col("pos") != F.col("stays.pos")))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("pos", "h1")).alias("removed"))
    )
    removed = scratch.keep(removed, "removed")
    scratch.only(removed)
    rebuilt = _rebuilt(rows, removed)
    return rebuilt.select("doc_id", "text", "n_lines", "n_removed", *(F.col(f"carried.`{c}`").alias(c) for c in carry or []))


def _rebuilt(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Texts without the removed lines; the other texts do not move."""
    touched, whole = beside(rows, "doc_id", removed)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    columns = ["doc_id", "text", "n_lines", "n_removed", "carried"]
    shape = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            rows.schema["carried"],
        ]
    )
    whole = whole.withColumn("n_lines", n_lines.cast("long")).withColumn("n_removed", F.lit(0).cast("long"))
    return touched.select("doc_id", "text", "removed", "carried").mapInArrow(_without, shape).unionByName(whole.select(*columns))


def _key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def _lines(rows: DataFrame, chars: int) -> DataFrame:
    """doc_id, pos, the two halves of the line's key and its sketch, for lines with visible text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = bytes_of(batch.column(1))
            for start, stop in slices([len(x) for x in texts], 1 << 20):
                yield _sketched(ids[start:stop], texts[start:stop], chars)

    return rows.mapInArrow(run, "doc_id long, pos int, h1 long, h2 long, size int, sig binary")


def _sketched(ids: np.ndarray, texts: list[bytes], chars: int) -> pa.RecordBatch:
    split = [x.split(b"\n") for x in texts]
    counts = np.array([len(x) for x in split])
    lines = [line for x in split for line in x]
    doc = np.repeat(ids, counts)
    pos = np.arange(len(lines)) - np.repeat(np.cumsum(counts) - counts, counts)
    visible = np.array([bool(line.strip()) for line in lines])

    codes = codes_of(b"\n".join(texts))
    ends = np.append(np.flatnonzero(codes == _NEWLINE), len(codes))
    starts = np.append(0, ends[:-1] + 1)
    lengths = ends - starts
    runs = char_shingles(codes, chars)
    # Shingles that lie in one line, for visible lines; short lines get one shingle of their own.
    number = np.where(visible, np.maximum(lengths - chars + 1, 0), 0)
    at = np.repeat(starts - (np.cumsum(number) - number), number) + np.arange(number.sum())
    short = np.flatnonzero(visible & (lengths < chars))
    keys = np.frombuffer(b"".join(map(_key, lines)), np.int64).reshape(-1, 2)
    owner = np.concatenate([np.repeat(np.arange(len(lines)), number), short])
    elements = np.concatenate([runs[at] if len(at) else np.zeros(0, np.uint64), keys[short, 0].view(np.uint64)])
    order = np.argsort(owner, kind="stable") if len(short) else slice(None)
    shown = np.flatnonzero(visible)
    sizes = np.bincount(owner, minlength=len(lines))[shown]
    sketches = sketch.sketch(elements[order], sizes, ROWS * BANDS)
    sig = (mix(sketches) >> np.uint64(48)).astype(">u2")
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[shown], pa.int64()),
            pa.array(pos[shown], pa.int32()),
            pa.array(keys[shown, 0]),
            pa.array(keys[shown, 1]),
            pa.array(sizes, pa.int32()),
            pa.array([row.tobytes() for row in sig], pa.binary()),
        ],
        ["doc_id", "pos", "h1", "h2", "size", "sig"],
    )


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = [], []
        for text, wanted in zip(bytes_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            lines = text.split(b"\n")
            for place in wanted:
                # An id may come with several texts; only the class's own line counts.
                if place["pos"] < len(lines) and _half(lines[place["pos"]]) == place["h1"]:
                    ids.append(place["id"])
                    found.append(lines[place["pos"]])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["id", "body"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, n_lines, n_removed = [], [], []
        for text, removed in zip(bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            if text is None:
                texts.append(None)
                n_lines.append(0)
                n_removed.append(0)
                continue
            lines = text.split(b"\n")
            gone = {x["pos"] for x in removed or () if x["pos"] < len(lines) and _half(lines[x["pos"]]) == x["h1"]}
            texts.append(b"\n".join(line for i, line in enumerate(lines) if i not in gone))
            n_lines.append(len(lines))
            n_removed.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(n_lines, pa.int64()),
                pa.array(n_removed, pa.int64()),
                batch.column(3),
            ],
            ["doc_id", "text", "n_lines", "n_removed", "carried"],
        )


def _half(line: bytes) -> int:
    return int.from_bytes(_key(line)[:8], "little", signed=True)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the digest of the remaining text, for every document."""
    return deduplicate_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


QUERIES = {"op4_line_dedup": op4_line_dedup}
#: Lines are compared if they share one of their rarest shingles, as many as a similar pair can not do
#: without; this loses no link.
SQL = {
    "op4_line_dedup": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
        ),
        l AS (
            SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM t
        ),
        c AS (
            SELECT line, min((doc_id, pos)) AS first, row_number() OVER (ORDER BY line) AS id
            FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
        ),
        o AS (
            SELECT id, line, unnest(range(1, greatest(len(line) - 6, 2))) AS o FROM c
        ),
        g AS (
            SELECT DISTINCT id, substring(line, o, 8) AS g FROM o
        ),
        f AS (
            SELECT g, count(*) AS f FROM g GROUP BY g
        ),
        k AS (
            SELECT id, g, row_number() OVER (PARTITION BY id ORDER BY f, g) AS k, count(*) OVER (PARTITION BY id) AS n
            FROM g JOIN f USING (g)
        ),
        h AS (
            SELECT id, g, n FROM k WHERE k <= n - (8 * n + 9) // 10 + 1
        ),
        q AS (
            SELECT DISTINCT x.id AS a, y.id AS b, x.n AS m, y.n AS n FROM h x JOIN h y ON x.g = y.g AND x.id < y.id
            WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
        ),
        e AS (
            SELECT a, b FROM q JOIN g x ON x.id = a JOIN g y ON y.id = b AND y.g = x.g
            GROUP BY a, b, m, n HAVING 100 * count(*) >= 80 * (m + n - count(*))
        ),
        b AS (
            SELECT a, b FROM e UNION ALL SELECT b, a FROM e
        ),
        r AS (
            SELECT id, id AS root FROM c
            UNION
            SELECT b.b, r.root FROM r JOIN b ON b.a = r.id WHERE r.root < b.b
        ),
        m AS (
            SELECT id, min(root) AS root FROM r GROUP BY id
        ),
        z AS (
            SELECT c.line, min(c.first) OVER (PARTITION BY m.root) AS stays FROM m JOIN c USING (id)
        ),
        w AS (
            SELECT l.doc_id, l.pos, l.line, coalesce(z.stays <> (l.doc_id, l.pos), false) AS gone FROM l LEFT JOIN z USING (line)
        ),
        y AS (
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
                   coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
            FROM w GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               CASE WHEN text IS NOT NULL THEN sha256(kept) END AS kept_sha256
        FROM t LEFT JOIN y USING (doc_id)
    """,
}

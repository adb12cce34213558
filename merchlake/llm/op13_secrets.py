"""Secret scans: patterns, and literals that sensitive names hold after constants are propagated."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import lexing
from merchlake.llm.common import slices, table

# Kinds of findings in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32}[0-9a-f]*")

COLUMNS = "doc_id long, findings array<struct<kind:string,start:long,end:long,target:string,score:double>>"
_FINDING = pa.struct(
    [pa.field("kind", pa.string()), pa.field("start", pa.int64()), pa.field("end", pa.int64()), pa.field("target", pa.string()), pa.field("score", pa.float64())]
)


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the patterns find, in order."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def findings(text: str) -> list[dict]:
    """All findings of a text by start and kind. A literal that meets a pattern's finding is left out."""
    base = patterns(text)
    rows = [(start, kind, end, None, 1.0) for start, kind, end in base]
    ends = at = 0
    for literal in lexing.secrets(text):
        while at < len(base) and base[at][0] < literal.end:
            ends, at = max(ends, base[at][2]), at + 1
        if literal.start >= ends:
            rows.append((literal.start, 3, literal.end, literal.target, literal.score))
    return [{"kind": KINDS[k], "start": s, "end": e, "target": t, "score": p} for s, k, e, t, p in sorted(rows, key=lambda r: r[:3])]


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Findings in each row of ``docs``: kind, start, end (code points, end exclusive), target, score.

    ``assign``, ``access`` and ``hex`` are matches of patterns. ``literal`` is the content of a literal
    that a sensitive name holds (``target``), as written there or over constants and joined parts.

    Edge cases: a null or empty text has no findings. Rows with a null or repeated id are scanned one
    by one. A string that its line does not end hides the rest of that line from the lexer, not from
    the patterns. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.binary_length(texts).fill_null(0).to_pylist()
            for start, stop in slices(sizes, 1 << 22):
                found = [findings(x) if x else [] for x in texts.slice(start, stop - start).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(found, pa.list_(_FINDING))], ["doc_id", "findings"]
                )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, COLUMNS)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: numbers of pattern findings, their digest, and all spans."""

    def of(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def spans(column):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = spans(F.filter("findings", lambda x: x["kind"] != "literal"))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans(F.col("findings")).alias("spans"), of("literal")
    )


QUERIES = {"op13_secrets": op13_secrets}
SQL: dict[str, str] = {}

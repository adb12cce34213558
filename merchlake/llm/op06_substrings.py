"""Substring deduplication: suffix automata of reference shards, matching statistics of documents.

A window of 13 words goes if a document with a smaller id has the same words in a row. The
reference is the whole corpus, so it is not broadcast whole: it is cut into shards, one per
reference document, and each document meets only the shards it can match.

1. Anchors. Each window picks one of its 5-word runs, the one with the smallest hash, so equal
   windows pick equal runs. Anchors in two documents or more are counted; the smallest id that has
   one owns it. Windows whose anchor is in one document only are unique.
2. First round. The owner's text around its anchors is the reference shard; the other documents'
   text around the same anchors is streamed against its automaton. A shard that much text meets is
   copied whole to several tasks, one number of copies per owner, and what is streamed against it is
   dealt over them.
3. Second round. A window that its anchor's owner does not have may still be in another smaller
   document. Such windows are grouped by their own hash, whose smallest id is the exact owner, and
   streamed against automata of these owners' text.

Hashes only decide which texts meet; removal is decided by the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm.automaton import SuffixAutomaton, spans
from merchlake.llm.common import Hashes, Scratch, beside, bytes_of, mix, table, windows, within

WINDOW = 13
ANCHOR = 5
#: Fragments per copy of a shard, at most; a shard of much text takes in SHARE times its own anchors.
STREAMED = 2048
SHARE = 8


def anchors(hashes: np.ndarray, window: int, size: int) -> np.ndarray:
    """For each window of a text, its anchor: the smallest hash of its runs of ``size`` words."""
    smallest, length = mix(windows(hashes, size)), 1
    wanted = window - size + 1
    while length < wanted and len(smallest):
        step = min(length, wanted - length)
        smallest = np.minimum(smallest[:-step], smallest[step:])
        length += step
    return smallest.view(np.int64)


def _anchor_rows(rows: DataFrame, window: int) -> DataFrame:
    """anchor, doc_id: the distinct anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), bytes_of(batch.column(1))
            found = [np.unique(anchors(hashes.of(text.split()), window, ANCHOR)) for text in texts]
            if found:
                owners = np.repeat(ids, [len(x) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), pa.array(owners, pa.int64())], ["anchor", "doc_id"]
                )

    return rows.mapInArrow(run, "anchor long, doc_id long")


FRAGMENT = (
    "owner long, part int, streamed boolean, doc_id long, start int, words binary, windows array<int>, hashes array<long>"
)
_FRAGMENT_TYPES = pa.schema(
    [
        ("owner", pa.int64()),
        ("part", pa.int32()),
        ("streamed", pa.bool_()),
        ("doc_id", pa.int64()),
        ("start", pa.int32()),
        ("words", pa.binary()),
        ("windows", pa.list_(pa.int32())),
        ("hashes", pa.list_(pa.int64())),
    ]
)


class _Fragments:
    """Collects fragments: runs of windows of one text that all meet the same owner."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(
        self, doc: int, words: list[bytes], hashes: np.ndarray, at: np.ndarray, owners: np.ndarray, copies: np.ndarray, window: int
    ) -> None:
        """``at``: windows of the text in order; ``owners``: of each of these windows; ``copies``: of each owner's shard."""
        order = np.lexsort((at, owners))
        at, owners, copies = at[order], owners[order], copies[order]
        cut = np.flatnonzero((np.diff(owners) != 0) | (np.diff(at) > window)) + 1
        for piece in np.split(np.arange(len(at)), cut):
            first, last, owner = int(at[piece[0]]), int(at[piece[-1]]), int(owners[piece[0]])
            text = b" ".join(words[first : last + window])
            several = int(copies[piece[0]])
            if owner == doc:
                self.rows += [(owner, part, False, doc, first, text, [], []) for part in range(several)]
            else:
                place = windows(np.array([doc, first], np.int64).view(np.uint64), 2)
                part = int(mix(place)[0] % np.uint64(several))
                self.rows.append((owner, part, True, doc, first, text, at[piece] - first, hashes[at[piece]]))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _FRAGMENT_TYPES, strict=True)], schema=_FRAGMENT_TYPES
        )


def _first_fragments(texts: DataFrame, window: int) -> DataFrame:
    """Fragments of texts (doc_id, text, anchors) around the anchors that they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, out = Hashes(), _Fragments()
        for batch in batches:
            shared = batch.column(2)
            offsets, values = shared.offsets.to_numpy(), shared.values
            anchor, owner, copies = (values.field(k).to_numpy() for k in ("anchor", "owner", "copies"))
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)), strict=True)):
                part = slice(offsets[i], offsets[i + 1])
                words = text.split()
                h = hashes.of(words)
                own = anchors(h, window, ANCHOR)
                order = np.argsort(anchor[part])
                known = anchor[part][order]
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                at = np.flatnonzero(known[place] == own)
                if len(at):
                    chosen = order[place[at]]
                    all_windows = windows(h, window).view(np.int64)
                    out.add(doc, words, all_windows, at, owner[part][chosen], copies[part][chosen], window)
                if len(out.rows) > 2000:
                    yield out.batch()
        if out.rows:
            yield out.batch()

    return texts.select("doc_id", "text", "anchors").mapInArrow(run, FRAGMENT)


def _second_fragments(left: DataFrame, window: int) -> DataFrame:
    """Fragments of left-over fragments (doc_id, start, words, shared) whose windows have an owner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, out = Hashes(), _Fragments()
        for batch in batches:
            for doc, start, text, shared in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = text.split()
                at = np.array([x["place"] for x in shared], np.int64)
                owner = np.array([x["owner"] for x in shared], np.int64)
                copies = np.array([x["copies"] for x in shared], np.int64)
                before = len(out.rows)
                out.add(doc, words, windows(hashes.of(words), window).view(np.int64), at, owner, copies, window)
                out.rows[before:] = [(*r[:4], r[4] + start, *r[5:]) for r in out.rows[before:]]
                if len(out.rows) > 2000:
                    yield out.batch()
        if out.rows:
            yield out.batch()

    return left.select("doc_id", "start", "words", "shared").mapInArrow(run, FRAGMENT)


MATCHED = (
    "doc_id long, start int, found array<struct<start: int, end: int>>, words binary, places array<int>, hashes array<long>"
)


def _matched_batch(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    doc, start, found, text, places, hashes = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, pa.int64()),
            pa.array(start, pa.int32()),
            pa.array([[{"start": a, "end": b} for a, b in x] for x in found], span),
            pa.array(text, pa.binary()),
            pa.array(places, pa.list_(pa.int32())),
            pa.array(hashes, pa.list_(pa.int64())),
        ],
        ["doc_id", "start", "found", "words", "places", "hashes"],
    )


def _streamed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Matches fragments as they come; only the automaton of the shard at hand is held."""
    shard, automaton, rows = None, SuffixAutomaton(), []
    seen: dict[bytes, list[int]] = {}
    slim = (batch.slice(k, 500) for batch in batches for k in range(0, batch.num_rows, 500))
    for batch in slim:
        # Rows come by owner and part, the owner's own first.
        for owner, part, follows, doc, start, text, places, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (owner, part) != shard:
                shard, automaton, seen = (owner, part), SuffixAutomaton(), {}
            if not follows:
                automaton.add(text.split())
                continue
            longest = seen.get(text)
            if longest is None:
                longest = automaton.matches(text.split())
                if len(seen) < 1000:
                    seen[text] = longest
            found = [(start + a, start + b) for a, b in spans(longest, window)]
            left = [k for k, p in enumerate(places) if longest[p + window - 1] < window]
            rows.append(
                (doc, start, found, text if left else None, [places[k] for k in left], [hashes[k] for k in left])
            )
        if rows:
            yield _matched_batch(rows)
            rows = []


def _matched(fragments: DataFrame, window: int) -> DataFrame:
    """Streams each fragment against the automaton of its owner's fragments.

    found: the removed spans, in words of the document; places, hashes: windows that the owner does
    not have, in words of the fragment.
    """
    placed = fragments.repartition("owner", "part").sortWithinPartitions("owner", "part", "streamed")
    return placed.mapInArrow(lambda batches: _streamed(batches, window), MATCHED)


def _with_copies(scratch: Scratch, owned: DataFrame) -> DataFrame:
    """Adds the copies of the owner's shard to its anchors or windows (owner, n, ...).

    What occurs n times is in n - 1 streamed fragments at most.
    """
    streamed, own = F.sum("n") - F.count("*"), F.count("*")
    several = owned.groupBy("owner").agg(F.ceil(streamed / F.greatest(F.lit(STREAMED), SHARE * own)).cast("int").alias("copies"))
    several = scratch.keep(several.filter("copies > 1"), "copies")
    return owned.join(several, "owner", "left").withColumn("copies", F.coalesce("copies", F.lit(1))).drop("n")


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """doc_id, kept (the words that stay, joined by one space), n_words, n_removed for each row.

    Words are runs of bytes other than space, tab, newline, vertical tab, form feed and carriage
    return. A word goes if it lies in ``window`` consecutive words that a document with a smaller id
    has too; all windows are those of the input.

    Edge cases: a null or word-less text has no words and keeps the empty text. Texts under
    ``window`` words lose nothing. A row without id loses nothing and is no reference. Rows that
    repeat an id are taken for copies of one text: they are no reference for each other and lose the
    same words. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    known = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL")

    occurrences = scratch.keep(_anchor_rows(known, window), "occurrences")
    shared = scratch.keep(
        occurrences.groupBy("anchor")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
        .filter("owner < last")
        .select("anchor", "owner", "n"),
        "anchors",
    )
    shared = _with_copies(scratch, shared)
    per_doc = scratch.keep(
        occurrences.join(shared, "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("anchor", "owner", "copies")).alias("anchors")),
        "per-doc",
    )
    texts = within(known, "doc_id", per_doc)
    first = scratch.keep(_matched(_first_fragments(texts, window), window), "first")

    left = first.filter("words IS NOT NULL").withColumn("fragment", F.xxhash64("doc_id", "start", "words"))
    open_windows = left.select("doc_id", "start", "fragment", F.explode(F.arrays_zip("places", "hashes")).alias("w")).select(
        "doc_id", "start", "fragment", F.col("w.places").alias("place"), F.col("w.hashes").alias("hash")
    )
    again = scratch.keep(
        open_windows.groupBy("hash")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
        .filter("owner < last")
        .select("hash", "owner", "n"),
        "windows",
    )
    again = _with_copies(scratch, again)
    per_fragment = (
        open_windows.join(again, "hash")
        .groupBy("doc_id", "start", "fragment")
        .agg(F.collect_list(F.struct("place", "owner", "copies")).alias("shared"))
    )
    rest = left.select("doc_id", "start", "fragment", "words").join(per_fragment, ["doc_id", "start", "fragment"])
    second = scratch.keep(_matched(_second_fragments(rest, window), window), "second")

    removed = scratch.keep(
        first.select("doc_id", "found")
        .union(second.select("doc_id", "found"))
        .filter(F.size("found") > 0)
        .groupBy("doc_id")
        .agg(F.flatten(F.collect_list("found")).alias("removed")),
        "removed",
    )
    touched, whole = beside(rows, "doc_id", removed)
    whole = whole.withColumn("removed", F.lit(None))
    kind = removed.schema["removed"].dataType
    whole = whole.withColumn("removed", F.col("removed").cast(kind))
    return touched.unionByName(whole).select("doc_id", "text", "removed").mapInArrow(_without, KEPT)


KEPT = "doc_id long, kept string, n_words long, n_removed long"


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for text, removed in zip(bytes_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            words = (text or b"").split()
            n_words.append(len(words))
            if removed:
                stays = np.ones(len(words), bool)
                for x in removed:
                    stays[x["start"] : x["end"]] = False
                words = [words[i] for i in np.flatnonzero(stays)]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
            ],
            ["doc_id", "kept", "n_words", "n_removed"],
        )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


QUERIES = {"op6_substring_dedup": op6_substring_dedup}
SQL = {
    "op6_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        p AS (
            SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM d WHERE len(w) >= 13
        ),
        g AS (
            SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS g FROM p
        ),
        o AS (
            SELECT g, min(doc_id) AS owner FROM g GROUP BY g
        ),
        r AS (
            SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM g JOIN o USING (g) WHERE owner < doc_id
        ),
        k AS (
            SELECT x.doc_id, x.i, x.word FROM (
                SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
            ) x ANTI JOIN r ON x.doc_id = r.doc_id AND x.i = r.i
        ),
        t AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM k GROUP BY doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN t USING (doc_id)
    """,
}

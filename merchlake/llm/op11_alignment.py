"""Alignment of two tokenizers' tokens: byte overlaps and groups, by products of sparse matrices.

Both vocabularies cover a text's bytes from left to right. The incidence matrix of a tokenisation has
a row per token and a column per byte; the product of one with the other's transpose has an entry
wherever two tokens share bytes. Bytes at which tokens of both end cut the text into groups; tokens
by groups are matrices too, and their product links whatever shares a group.

Texts fall into units that begin with a space after a visible character. No token of either
vocabulary crosses such a place, so the matrices are block-diagonal: each distinct unit is a block,
multiplied once while it is remembered.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import csr
from merchlake.llm.common import Scratch, lists, slices, table

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Pairs whose corpus-wide counts go out to all tasks; pairs in fewer documents are joined.
KNOWN = 1 << 20

SPACE = "▁"
_WHITE = r"\t\n\x0b\f\r "
#: White space by which vocabularies' own splitting rules may go beyond the above: such a text is one unit.
_RARE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_UNITS = re.compile(rf"(?<=[^{_WHITE}])(?= )")
#: Units that can stand one behind the other in a text and be cut at the same places again.
_PLAIN = re.compile(rf"(?s) .*[^{_WHITE}]\Z")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 characters as they are and other bytes as U+0100 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


def _piece_bytes(pieces: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = pieces.id_to_piece(i)
    if pieces.is_byte(i):
        return bytes([int(piece[3:5], 16)])
    return b"" if pieces.is_control(i) else piece.replace(SPACE, " ").encode()


class Vocabularies:
    """Both tokenizers, and the bytes of their tokens in flat arrays."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        self.a = tokenizers.Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = _byte_letters()
        entries = {i: x for x, i in self.a.get_vocab(with_added_tokens=True).items()}
        a = [bytes(letters[c] for c in entries[i]) if i in entries else b"" for i in range(max(entries) + 1)]
        b = [_piece_bytes(self.b, i) for i in range(self.b.vocab_size())]
        self.a_bytes, self.b_bytes = a, b
        self.a_size, self.b_size = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        # Units are independent if no piece goes on with a space after another character.
        self.divisible = not any(re.search(f"[^{SPACE}]{SPACE}", self.b.id_to_piece(i)) for i in range(len(b)))
        self.space = self.b.piece_to_id(SPACE)

    def encode(self, units: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all units one after the other, and each unit's numbers of both.

        ``plain`` units begin with a space and end visibly: they are encoded as one text and cut at their bytes.
        """
        sides = self._joined(units) if plain else None
        if sides is None:
            a = [x.ids for x in self.a.encode_batch_fast(units, add_special_tokens=False)]
            b = [[self.space] if x == " " else self.b.encode(x[1:]) for x in units]
            sides = [(np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64)) for ids in (a, b)]
        return *sides[0], *sides[1]

    def _joined(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """As ``encode``, in one call per vocabulary; None if some unit's end is not the end of a token."""
        text = "".join(units)
        ends = np.cumsum([len(x.encode("utf-8", "surrogatepass")) for x in units])
        sides = []
        for ids, size in (
            (self.a.encode(text, add_special_tokens=False).ids, self.a_size),
            (self.b.encode(text[1:]), self.b_size),
        ):
            ids = np.array(ids, np.int64)
            stops = np.cumsum(size[ids])
            last = np.searchsorted(stops, ends)
            if not len(stops) or stops[-1] != ends[-1] or (stops[last] != ends).any():
                return None
            sides.append((ids, np.diff(np.append(-1, last))))
        return sides


class Aligned:
    """Tokens, groups and links of units met lately, in flat arrays with a row per unit."""

    #: Units, and bytes in them, beyond which all are forgotten.
    LIMIT, LIMIT_BYTES = 300_000, 16 << 20

    def __init__(self, vocabularies: Vocabularies):
        self.vocabularies = vocabularies
        #: How an id is written in a list of groups, with the sign behind it: code 4 * id + place.
        n = max(len(vocabularies.a_bytes), len(vocabularies.b_bytes))
        self.written = [f"{i}{sign}" for i in range(n) for sign in ",|,;"]
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.bytes = 0
        #: Per unit: tokens of A, of B, groups, links, links within groups, and whether the bytes are right.
        self.counts = np.zeros((0, 6), np.int64)
        self.starts = np.zeros(1, np.int64)
        self.link_a = self.link_b = self.codes = np.zeros(0, np.int32)
        self.code_starts = np.zeros(1, np.int64)

    def learn(self, units: set[str]) -> None:
        if len(self.rows) > self.LIMIT or self.bytes > self.LIMIT_BYTES:
            self._clear()
        new = [x for x in units if x not in self.rows]
        plain = [x for x in new if _PLAIN.match(x) and not _RARE.search(x)] if self.vocabularies.divisible else []
        joined = set(plain)
        other = [x for x in new if x not in joined]
        for part in (plain, other):
            for start, stop in slices([len(x) for x in part], 1 << 18):
                self._add(part[start:stop], part is plain)

    def _add(self, units: list[str], plain: bool) -> None:
        known = self.vocabularies
        raw = [x.encode("utf-8", "surrogatepass") for x in units]
        a, n_a, b, n_b = known.encode(units, plain)
        right = np.ones(len(units), bool)
        whole = b"".join(raw)
        if any(b"".join(map(spelled.__getitem__, ids.tolist())) != whole for spelled, ids in ((known.a_bytes, a), (known.b_bytes, b))):
            for spelled, ids, n in ((known.a_bytes, a, n_a), (known.b_bytes, b, n_b)):
                ends = np.append(0, np.cumsum(n)).tolist()
                right &= [b"".join(map(spelled.__getitem__, ids[x:y].tolist())) == r for x, y, r in zip(ends[:-1], ends[1:], raw, strict=True)]
            a, b = a[np.repeat(right, n_a)], b[np.repeat(right, n_b)]
            n_a, n_b = n_a * right, n_b * right
        counts, codes, links = blocks(a, n_a, b, n_b, known.a_size, known.b_size)
        self.rows.update(zip(units, range(len(self.rows), len(self.rows) + len(units)), strict=True))
        self.bytes += len(whole)
        self.counts = np.concatenate([self.counts, np.column_stack([counts, right])])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts[:, 3])])
        self.code_starts = np.concatenate([self.code_starts, self.code_starts[-1] + np.cumsum(n_a + n_b)])
        self.link_a = np.concatenate([self.link_a, links[0].astype(np.int32)])
        self.link_b = np.concatenate([self.link_b, links[1].astype(np.int32)])
        self.codes = np.concatenate([self.codes, codes.astype(np.int32)])

    def of(self, units: list[str]) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        """Counts, groups as text, and both ids of every link, of a text cut into ``units``."""
        rows = np.fromiter(map(self.rows.__getitem__, units), np.int64, len(units))
        counts = self.counts[rows]
        if not counts[:, 5].all():
            return np.zeros(5, np.int64), "", self.link_a[:0], self.link_b[:0]
        at = _ranges(self.starts[rows], counts[:, 3])
        codes = self.codes[_ranges(self.code_starts[rows], counts[:, 0] + counts[:, 1])]
        text = "".join(map(self.written.__getitem__, codes.tolist()))[:-1]
        return counts[:, :5].sum(axis=0), text, self.link_a[at], self.link_b[at]


def _ranges(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, ``size`` of them."""
    ends = np.cumsum(size)
    return np.repeat(starts - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


@functools.cache
def _aligned(byte_level: bytes, pieces: bytes) -> Aligned:
    # A task keeps to its thread; Spark runs several tasks side by side.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligned(Vocabularies(byte_level, pieces))


def blocks(
    a_ids: np.ndarray, n_a: np.ndarray, b_ids: np.ndarray, n_b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray
) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Products of block-diagonal matrices, a block per unit.

    Ids come one unit after the other, with each unit's numbers of them, and cover the same bytes.
    Returned are each unit's numbers of tokens, groups, links and links within groups, its groups as
    codes (ids in order of group, A before B, each with the sign behind it), and the ids of all links.
    """
    n_units = len(n_a)
    matrix_a, matrix_b = csr.covering(a_size[a_ids]), csr.covering(b_size[b_ids])
    parts = list(csr.products(matrix_a, csr.transposed(matrix_b)))
    link_i = np.concatenate([x[0] for x in parts]) if parts else np.zeros(0, np.int64)
    link_j = np.concatenate([x[1] for x in parts]) if parts else np.zeros(0, np.int64)
    unit_a = np.repeat(np.arange(n_units), n_a)
    ends_a, ends_b = matrix_a.starts[1:], matrix_b.starts[1:]
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    shared = csr.row_sums(csr.members(group_a, len(cuts)), csr.transposed(csr.members(group_b, len(cuts))))
    last_a, last_b = cuts[group_a] == ends_a, cuts[group_b] == ends_b
    n_groups = np.bincount(unit_a[last_a], minlength=n_units)
    n_links = np.bincount(unit_a[link_i], minlength=n_units)
    n_shared = np.bincount(unit_a, weights=shared, minlength=n_units).astype(np.int64)
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    codes = np.concatenate([4 * a_ids + last_a, 4 * b_ids + 2 + last_b])[order]
    return np.column_stack([n_a, n_b, n_groups, n_links, n_shared]), codes, (a_ids[link_i], b_ids[link_j])


COLUMNS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups string, "
    "link_a array<int>, link_b array<int>, link_n array<int>"
)


def _file(folder: str, name: str) -> bytes:
    with open(os.path.join(folder, name), "rb") as lines:
        return lines.read()


def align(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folder: str = TOKENIZERS,
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
) -> DataFrame:
    """Groups and links of both vocabularies' tokens for each row of ``docs``.

    ``groups`` lists ids as ``a1,a2|b1;a3|b2,b3``: groups apart by semicolons, ids of the byte-level
    vocabulary before the bar. ``link_a``, ``link_b``, ``link_n``: id pairs whose occurrences overlap,
    ascending, and how often. ``n_group_links`` counts token pairs that share a group; within a group
    that is all of them, so they are counted but not listed.

    The vocabularies' files are read where the job is planned and go out with it.

    Edge cases: a null or empty text has no tokens, nor has one that a vocabulary does not give back
    byte for byte (one with U+2581, say): zeros, empty lists and an empty text. Rows with a null or
    repeated id are aligned one by one. Other columns are ignored, whatever their names. An empty
    table gives an empty result.
    """
    files = docs.sparkSession.sparkContext.broadcast((_file(folder, byte_level), _file(folder, pieces)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _aligned(*files.value)
        for batch in batches:
            texts = [" " + x if x else None for x in batch.column(1).to_pylist()]
            for start, stop in slices([len(x or "") for x in texts], 1 << 20):
                split = [_cut(x, aligned.vocabularies.divisible) if x else [] for x in texts[start:stop]]
                aligned.learn(set().union(*split))
                found = [aligned.of(x) for x in split]
                yield _batch(batch.column(0).slice(start, stop - start), found)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, COLUMNS)


def _cut(text: str, divisible: bool) -> list[str]:
    return _UNITS.split(text) if divisible and not _RARE.search(text) else [text]


def _batch(ids: pa.Array, found: list) -> pa.RecordBatch:
    distinct = [_distinct(a, b) for _, _, a, b in found]
    sizes = np.array([len(x[0]) for x in distinct])
    numbers = np.array([x[0] for x in found]).reshape(-1, 5)
    columns = [
        ids,
        *(pa.array(numbers[:, k], pa.int64()) for k in range(5)),
        pa.array([x[1] for x in found], pa.string()),
        *(lists(np.concatenate([x[k] for x in distinct]), sizes, pa.int32()) for k in range(3)),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in COLUMNS.split(", ")])


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, times = np.unique(_key(a, b), return_counts=True)
    return (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32)


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per pair within this task, given out whenever many different pairs have come together."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append(np.unique(_key(_flat(batch.column(0)), _flat(batch.column(1))), return_counts=True))
        size += len(held[-1][0])
        if size > 1 << 22:
            held = [_summed(held)]
            size = len(held[0][0])
        if size > 1 << 21:
            yield _pairs(*_summed(held))
            held, size = [], 0
    if held:
        yield _pairs(*_summed(held))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


def _pairs(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])


def weigh(aligned: DataFrame, scratch: Scratch, known: int = KNOWN) -> DataFrame:
    """``aligned`` (a written table of ``align``'s rows) without its lists, with n_best and count_sum.

    A pair's count is the number of rows that hold it linked. The counts of the most frequent pairs,
    at most ``known``, go out to all tasks; occurrences of the others are joined with theirs, and none
    of these is in many rows.
    """
    spark = aligned.sparkSession
    rows = scratch.keep(aligned.withColumn("row", F.monotonically_increasing_id()), "rows")
    counts = rows.select("link_a", "link_b").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = scratch.keep(counts.withColumn("of_a", F.shiftright("pair", 32)), "counts")
    most = counts.groupBy("of_a").agg(F.max("n").alias("most"))
    weights = counts.join(most, "of_a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    weights = scratch.keep(weights.withColumn("level", F.length(F.bin("n"))), "weights")
    levels = {r.level: r["count"] for r in weights.groupBy("level").count().collect()}
    fitting = [k for k in levels if sum(n for other, n in levels.items() if other >= k) <= known]
    least = min(fitting, default=max(levels, default=0) + 1)
    rare_pairs = any(k < least for k in levels)
    frequent = weights.filter(F.col("level") >= least).select("pair", "n", "best").toArrow()
    order = np.argsort(frequent.column("pair").to_numpy())
    sent = spark.sparkContext.broadcast(
        tuple(frequent.column(c).to_numpy()[order].astype(t) for c, t in (("pair", np.int64), ("n", np.int64), ("best", bool)))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        for batch in batches:
            a, b, times = (_flat(batch.column(k)) for k in (1, 2, 3))
            size = np.diff(batch.column(1).offsets.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), size)
            key = _key(a, b)
            at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            found = pairs[at] == key if len(pairs) else np.zeros(len(key), bool)
            total, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, of[found], n[at[found]] * times[found])
            np.add.at(good, of[found], best[at[found]] * times[found])
            rest = np.bincount(of[~found], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(good), pa.array(total), lists(key[~found], rest, pa.int64()), lists(times[~found], rest, pa.int32())],
                ["row", "n_best", "count_sum", "rest", "rest_n"],
            )

    kinds = "row long, n_best long, count_sum long, rest array<long>, rest_n array<int>"
    sums = scratch.keep(rows.select("row", "link_a", "link_b", "link_n").mapInArrow(run, kinds), "sums")
    rare = (
        sums.select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("x"))
        .select("row", F.col("x.rest").alias("pair"), F.col("x.rest_n").alias("times"))
        .join(weights.filter(F.col("level") < least), "pair")
        .groupBy("row")
        .agg(F.sum(F.col("best").cast("long") * F.col("times")).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    )
    parts = [sums.select("row", "n_best", "count_sum")]
    if rare_pairs:
        parts.append(rare.select("row", F.col("more_best").alias("n_best"), F.col("more_sum").alias("count_sum")))
    summed = functools.reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("link_a", "link_b", "link_n").join(summed, "row").drop("row")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links, and how common its links are in the corpus."""
    aligned = align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    slim = aligned.withColumn("groups_sha256", digest).drop("groups")
    return weigh(slim, Scratch(spark, "alignment")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"
    )


QUERIES = {"op11_alignment": op11_alignment}
SQL: dict[str, str] = {}

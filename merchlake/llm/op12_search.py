"""Ranked lexical search: items times documents as blocked matrix products, in exact arithmetic.

Weights of terms and impacts of terms in documents are whole numbers. A tile of document impacts
times a tile of item weights is a product of doubles, exact because every partial sum stays below
2**53; tiles are added up as 64-bit numbers. Each task keeps the best documents per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch, bytes_of, lists, slices, table

#: Rows of a product: documents; columns: items; inner dimension: terms.
DOCUMENTS, ITEMS, TERMS = 1024, 256, 1024
#: About so many (item, term) pairs are answered by one scan of the documents.
ENTRIES = 1 << 19
EXACT = 1 << 53
#: Scale and saturation of impacts, the length share and the ends of ranking.
SCALE, GAIN, SATURATION, LENGTH = 1_000_000_000, 1000, 8, 75
MOST = SCALE // GAIN
#: Groups per item that are ranked apart before the last ranking.
GROUPS = 64

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_LETTERS).split()


class Block(NamedTuple):
    """Items of one block: their places, their terms' places in tiles, and weights by tile."""

    items: np.ndarray
    tiles: list[tuple[np.ndarray, np.ndarray]]


def blocks(item: np.ndarray, term: np.ndarray, weight: np.ndarray) -> list[Block]:
    """Cuts a sparse (item, term) matrix of weights into blocks of items with compact vocabularies.

    A tile is a set of terms and a dense matrix; it ends early if an item's weights in it, times the
    largest impact, could pass 2**53.
    """
    found = []
    names = np.unique(item)
    for start in range(0, len(names), ITEMS):
        items = names[start : start + ITEMS]
        mine = (item >= items[0]) & (item <= items[-1])
        column = np.searchsorted(items, item[mine])
        vocabulary, row = np.unique(term[mine], return_inverse=True)
        value = weight[mine]
        most = np.zeros(len(vocabulary), np.int64)
        np.maximum.at(most, row, value)
        tiles, first = [], 0
        while first < len(vocabulary):
            fits = np.searchsorted(np.cumsum(most[first : first + TERMS]), EXACT // MOST)
            last = first + max(int(fits), 1)
            inside = (row >= first) & (row < last)
            dense = np.zeros((min(last, len(vocabulary)) - first, len(items)))
            np.add.at(dense, (row[inside] - first, column[inside]), value[inside])
            tiles.append((vocabulary[first:last], dense))
            first = last
        found.append(Block(items, tiles))
    return found


class Best:
    """The ``k`` best documents per item so far: by score, then by id."""

    def __init__(self, n_items: int, k: int):
        self.k, self.n_items = k, n_items
        self.item = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.least = np.ones(n_items, np.int64)

    def add(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: a row per document, a column per item. Equal scores are taken along."""
        row, column = np.nonzero(scores >= self.least[items])
        if not len(row):
            return
        item = np.concatenate([self.item, items[column]])
        doc = np.concatenate([self.doc, docs[row]])
        score = np.concatenate([self.score, scores[row, column]])
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        self.item, self.doc, self.score = item[kept], doc[kept], score[kept]
        full = rank[kept] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def impacts(n: list[int], ids: np.ndarray, of: np.ndarray, times: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of each (document, term): saturating in the term's occurrences, less in long documents."""
    m = np.array([100 - LENGTH + (LENGTH * x * n_docs) // max(n_terms, 1) for x in n], np.int64)
    return (SCALE * times) // (GAIN * times + SATURATION * m[of])


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Number of terms of each document, and its terms of the vocabulary with their occurrences."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value.get
        for batch in batches:
            texts = [x or b"" for x in bytes_of(batch.column(1))]
            for start, stop in slices([len(x) for x in texts], 1 << 20):
                split = [terms(x) for x in texts[start:stop]]
                size = np.array([len(x) for x in split], np.int64)
                known = np.fromiter((place(w, -1) for x in split for w in x), np.int64, int(size.sum()))
                key = np.repeat(np.arange(len(split)), size) * (len(sent.value) + 1) + known
                key, times = np.unique(key[known >= 0], return_counts=True)
                number = np.bincount(key // (len(sent.value) + 1), minlength=len(split))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(size),
                        lists(key % (len(sent.value) + 1), number, pa.int32()),
                        lists(times, number, pa.int32()),
                    ],
                    ["doc_id", "n", "terms", "times"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def _frequencies(counted: DataFrame) -> dict[int, int]:
    """Documents per term of the vocabulary; summed within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            some = np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=len(total))
            some[: len(total)] += total
            total = some
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["term", "df"])

    summed = counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in summed.collect()}


def _searched(counted: DataFrame, cut: list[Block], n_items: int, n_vocabulary: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The ``k`` best documents per item of each task."""
    sent = counted.sparkSession.sparkContext.broadcast(cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k)
        place = np.full(n_vocabulary, -1, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                docs = part.column(0).fill_null(int(np.iinfo(np.int64).max)).to_numpy(zero_copy_only=False)
                size = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                ids, times = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
                of = np.repeat(np.arange(part.num_rows), size)
                impact = impacts(part.column(1).to_pylist(), ids, of, times, n_docs, n_terms).astype(np.float64)
                for block in sent.value:
                    scores = np.zeros((part.num_rows, len(block.items)), np.int64)
                    for vocabulary, weights in block.tiles:
                        place[vocabulary] = np.arange(len(vocabulary))
                        column = place[ids]
                        met = column >= 0
                        place[vocabulary] = -1
                        tile = np.zeros((part.num_rows, len(vocabulary)))
                        tile[of[met], column[met]] = impact[met]
                        scores += (tile @ weights).astype(np.int64)
                    best.add(block.items, docs, scores)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (best.item, best.doc, best.score)], ["item", "doc_id", "score"])

    return counted.filter("n > 0").mapInArrow(run, "item long, doc_id long, score long")


def _item_terms(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)), strict=True):
                words, times = np.unique(np.array(terms(text or b""), object), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(words), pa.int64()), pa.array(list(words), pa.binary()), pa.array(times, pa.int64())],
                    ["item", "term", "times"],
                )

    return items.select("item", "text").mapInArrow(run, "item long, term binary, times long")


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 10,
    item_column: str = "item_id",
    id_column: str = "doc_id",
    text_column: str = "text",
    entries: int = ENTRIES,
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    A document's score is the sum over the item's terms, repeats included, of the term's weight (rare
    terms weigh more) times its impact in the document. Only scores above 0 count; equal scores go by
    rising id. Items are answered in passes of about ``entries`` (item, term) pairs, taken by a hash of
    the item; a pass reads all documents, and its vocabulary and weights go out to all tasks.

    Edge cases: documents with a null or empty text or without terms count nowhere; items without
    terms have no rows. Rows that repeat a document's id are documents of their own; rows with a null
    id come last among equals. Rows that repeat an item as a whole are one item; items that share an
    id or have none are ranked each for itself. Other columns are ignored, whatever their names. Empty
    tables give an empty result.
    """
    scratch = Scratch(docs.sparkSession, "search")
    asked = items.select(F.col(item_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    asked = scratch.keep(asked.dropDuplicates().withColumn("item", F.monotonically_increasing_id()), "items")
    pairs = scratch.keep(_item_terms(asked), "pairs")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    passes = max(1, math.ceil(pairs.count() / entries))
    found = None
    for number in range(passes):
        part = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).toArrow()
        names, item = np.unique(part.column("item").to_numpy(), return_inverse=True)
        vocabulary: dict[bytes, int] = {}
        term = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in part.column("term").to_pylist()], np.int64)
        counted = scratch.keep(_counted(texts, vocabulary), "counted")
        n_docs, n_terms = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = _frequencies(counted)
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))]
        weights = np.array(weight, np.int64)[term] * part.column("times").to_numpy()
        cut = blocks(item, term, weights)
        best = _searched(counted, cut, len(names), len(vocabulary), n_docs, n_terms, k)
        by_number = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(names.tolist())), "item long, name long"))
        some = scratch.keep(best.join(by_number, "item").select(F.col("name").alias("item"), "doc_id", "score"), "best")
        found = some if found is None else found.unionByName(some)
    nearest = [F.col("score").desc(), F.col("doc_id").asc()]
    group = F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", group).orderBy(*nearest))).filter(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*nearest))).filter(F.col("rank") <= k)
    unknown = F.lit(int(np.iinfo(np.int64).max))
    return last.join(asked.select("item", "item_id"), "item").select("item_id", "rank", F.nullif("doc_id", unknown).alias("doc_id"), "score")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


_SPLIT = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH_SQL = f"""
    WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_SPLIT}')) AS term FROM documents
    ),
    counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id),
    corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
    weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM counted, corpus GROUP BY term, docs
    ),
    asked AS (
        SELECT item_id, term, count(*) AS times
        FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_SPLIT}')) AS term FROM benchmark) GROUP BY ALL
    ),
    scored AS (
        SELECT item_id, doc_id,
               sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total)))))::BIGINT AS score
        FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (doc_id), corpus
        GROUP BY item_id, doc_id
    ),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

QUERIES = {"op12_search": op12_search}
SQL = {"op12_search": SEARCH_SQL}

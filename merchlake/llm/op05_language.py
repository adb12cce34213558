"""Language-model scores: a gated recurrent model over frequent words, discounted counts for the rest.

1. All training words are counted by their 64-bit hash; the counts stay a distributed table. Counts of
   frequent words, a bounded number, also go to the driver; the most frequent ones are the model's
   vocabulary.
2. Words outside the vocabulary form one class of the model's softmax. Inside it a word's probability
   is its discounted count's share (absolute discounting); the discounts are the probability of
   unseen words, which count as one word, as they do in the base score.
3. The recurrent model starts from the counts. All training documents are trained on, each in one of
   ROUNDS rounds by its hash: in a round each shard of documents trains on its own for one pass, and
   the weights are averaged over shards.
4. Every text is scored as a whole in its partition. Counts of words that are not frequent are joined
   from the distributed table.
"""

from __future__ import annotations

import collections
import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import gru
from merchlake.llm.common import Hashes, Scratch, bytes_of, has_remainder, lists, slices, table

#: Words whose counts go to every task, at most.
FREQUENT = 400_000
VOCABULARY = 2046
HIDDEN = 24
CLASSES = 48
LARGEST_CLASS = 96
ROUNDS = 2
RATE = 0.2
#: Training documents per shard.
SHARD = 2000
#: Weights that are averaged in one task, and rows of weights that reach the driver, at most.
AVERAGED = 32
#: Stands for the end of a text among word hashes; no word holds a space.
END_HASH = xxhash.xxh3_64_intdigest(b" ")


def _counted(training: DataFrame) -> DataFrame:
    """Word hash and count per slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            texts = [(x or b"").lower() for x in bytes_of(batch.column(0))]
            for start, stop in slices([len(x) for x in texts], 1 << 23):
                words = [w for x in texts[start:stop] for w in x.split()]
                keys, counts = np.unique(hashes.of(words), return_counts=True)
                keys, counts = np.append(keys, np.uint64(END_HASH)), np.append(counts, stop - start)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["hash", "n"])

    return training.select("text").mapInArrow(run, "hash long, n long")


@dataclass
class Frequent:
    """Counts of frequent words by sorted hash, and the model's token of each (0: rare)."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray) -> tuple[Frequent, np.ndarray]:
        """Also gives the counts of the model's tokens but for the rare one."""
        end = np.int64(np.array([END_HASH], np.uint64).view(np.int64)[0])
        by_count = np.lexsort((hashes, -counts))
        by_count = by_count[hashes[by_count] != end][:VOCABULARY]
        tokens = np.zeros(len(hashes), np.int32)
        tokens[by_count] = np.arange(2, len(by_count) + 2)
        tokens[hashes == end] = gru.END
        order = np.argsort(hashes)
        ends = counts[hashes == end]
        model_counts = np.concatenate([[ends[0] if len(ends) else 0], counts[by_count]])
        return cls(hashes[order], counts[order], tokens[order]), model_counts

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes, -1 for the others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


@dataclass
class Rare:
    """Distribution of the words of the rare class."""

    n: float
    distinct: float
    discount: float

    def log_p(self, counts: np.ndarray) -> np.ndarray:
        """Log10 probability, given that a word is rare, by training count; 0 is the unseen word."""
        mass = np.where(counts > 0, counts - self.discount, self.unseen)
        return np.log10(mass) - np.log10(self.whole)

    @property
    def unseen(self) -> float:
        return self.discount * self.distinct + 0.5

    @property
    def whole(self) -> float:
        return self.n + 0.5


@dataclass
class Learned:
    frequent: Frequent
    rare: Rare
    model: gru.Model
    n: int
    distinct: int


class _Tokens(dict):
    """The model's token of each word, remembered for the words met lately."""

    def __init__(self, frequent: Frequent):
        shown = np.flatnonzero(frequent.tokens != gru.RARE)
        self.of_hash = dict(zip(frequent.hashes[shown].view(np.uint64).tolist(), frequent.tokens[shown].tolist(), strict=True))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= Hashes.LIMIT:
            self.clear()
        token = self[word] = self.of_hash.get(xxhash.xxh3_64_intdigest(word), gru.RARE)
        return token

    def read(self, texts: list[bytes]) -> list[np.ndarray]:
        """The tokens of each text, END at last."""
        split = [x.lower().split() for x in texts]
        for words in split:
            words.append(b" ")
        counts = np.array([len(x) for x in split])
        tokens = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(split)), np.int32, counts.sum())
        return np.split(tokens, np.cumsum(counts)[:-1])


class _Reader:
    """Tokens of texts, each distinct word looked up once per slice."""

    def __init__(self, frequent: Frequent):
        self.frequent, self.hashes = frequent, Hashes()

    def read(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words (END first), their hashes and places among the frequent ones; the distinct
        word of each token, and the number of tokens of each text. Each text ends with END."""
        rows: dict[bytes, int] = collections.defaultdict(itertools.count().__next__)
        rows[b" "]
        split = [x.lower().split() for x in texts]
        for words in split:
            words.append(b" ")
        counts = np.array([len(x) for x in split])
        tokens = np.fromiter(map(rows.__getitem__, itertools.chain.from_iterable(split)), np.int64, counts.sum())
        words = list(rows)
        hashes = self.hashes.of(words).view(np.int64)
        return words, hashes, self.frequent.find(hashes), tokens, counts


def _trained(docs: DataFrame, learned: Learned) -> gru.Model:
    """The model after one pass over some documents, trained in shards and averaged."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = sent.value
        reader, model = _Tokens(start.frequent), gru.Model(start.model.starts, {k: v.copy() for k, v in start.model.weights.items()})
        trainer, seen = gru.Trainer(model, RATE), 0
        for batch in batches:
            texts = [x or b"" for x in bytes_of(batch.column(0))]
            for first, last in slices([len(x) for x in texts], 1 << 23):
                seen += trainer.train(reader.read(texts[first:last]))
        if seen:
            part, raw = TaskContext.get().partitionId(), pickle.dumps(model.weights)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seen], pa.int64()), pa.array([raw], pa.binary())],
                ["part", "seen", "weights"],
            )

    def averaged(key: tuple, group: pa.Table) -> pa.Table:
        total, seen = None, 0
        for size, raw in zip(group.column("seen").to_pylist(), group.column("weights").to_pylist(), strict=True):
            weights = pickle.loads(raw)
            total = weights if total is None else gru.average([total, weights], [seen, size])
            seen += size
        raw = pickle.dumps(total)
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([seen], pa.int64()), pa.array([raw], pa.binary())],
            ["part", "seen", "weights"],
        )

    shape = "part int, seen long, weights binary"
    left = shards = max(1, -(-docs.count() // SHARD))
    trained = docs.select("text").repartition(shards).mapInArrow(run, shape)
    # Averages of averages, so no task and not the driver holds the weights of all shards.
    while left > AVERAGED:
        dealt = trained.withColumn("part", F.expr(f"cast(part div {AVERAGED} AS int)"))
        trained = dealt.groupBy("part").applyInArrow(averaged, shape)
        left = -(-left // AVERAGED)
    rows = trained.collect()
    if not rows:
        return learned.model
    weights = gru.average([pickle.loads(bytes(r.weights)) for r in rows], [r.seen for r in rows])
    return gru.Model(learned.model.starts, weights)


def _learned(scratch: Scratch, training: DataFrame) -> tuple[Learned, DataFrame]:
    counts = scratch.keep(_counted(training).groupBy("hash").agg(F.sum("n").alias("n")), "counts")
    whole = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count("*").alias("distinct"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
    ).first()
    # Frequent words are those over a bound; the bound follows from a histogram of logarithms.
    level = F.floor(F.log2("n") * 4).cast("int")
    histogram = sorted(((r.level, r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    kept, bound = 0, 1 << 20
    for height, number in histogram:
        if kept + number > FREQUENT and kept:
            break
        kept, bound = kept + number, height
    head = counts.filter(level >= bound).toPandas()
    frequent, model_counts = Frequent.of(head["hash"].to_numpy(np.int64), head["n"].to_numpy(np.int64))
    rare = Rare(
        float(whole.n - model_counts.sum()),
        float(max(0, whole.distinct - len(model_counts))),
        (whole.once + 0.5) / (whole.once + 2 * whole.twice + 1.0),
    )
    model = gru.Model.initial(np.concatenate([[int(rare.n)], model_counts]), HIDDEN, CLASSES, LARGEST_CLASS)
    learned = Learned(frequent, rare, model, whole.n, whole.distinct)
    pick = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(ROUNDS))
    for k in range(ROUNDS):
        learned.model = _trained(training.filter(pick == k), learned)
    return learned, counts


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, head_known long, head_log double, score double, "
    "tail array<long>, times array<int>"
)


def _scored(docs: DataFrame, learned: Learned) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        frequent, reader = known.frequent, _Reader(known.frequent)
        count_of = np.append(frequent.counts, 0)
        log_count = np.log10(count_of + 1.0)
        token_of = np.append(frequent.tokens, gru.RARE)
        for batch in batches:
            texts = [x or b"" for x in bytes_of(batch.column(2))]
            for start, stop in slices([len(x) for x in texts], 1 << 23):
                words, hashes, places, tokens, counts = reader.read(texts[start:stop])
                owner = np.repeat(np.arange(stop - start), counts)
                own = token_of[places]
                among_rare = np.where((own == gru.RARE) & (places >= 0), known.rare.log_p(count_of[places]), 0.0)
                model = gru.score(known.model, np.split(own[tokens], np.cumsum(counts)[:-1])) / np.log(10)
                bound = lambda x: np.bincount(owner, x[tokens], stop - start)  # noqa: B023, E731
                tail = places[tokens] < 0
                pairs, times = np.unique(owner[tail] * len(words) + tokens[tail], return_counts=True)
                part = batch.slice(start, stop - start)
                per_text = np.bincount(pairs // len(words), minlength=stop - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(counts, pa.int64()),
                        pa.array(bound((places >= 0).astype(float)).astype(np.int64)),
                        pa.array(bound(log_count[places])),
                        pa.array(model + bound(among_rare)),
                        lists(hashes[pairs % len(words)], per_text, pa.int64()),
                        lists(times, per_text, pa.int32()),
                    ],
                    [x.split()[0] for x in SCORED.split(", ")],
                )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCORED)


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    Learns from documents whose crc32(id as text) leaves a remainder other than 2 on division by 7;
    held_out marks the others. Scores are log10 probabilities of the whole text.

    Edge cases: a null text counts as empty; an empty text has one token, its end. Rows without id are
    scored, not held out, and not learned from. Rows that repeat an id are scored one by one. Other
    columns are ignored, whatever their names. Without training documents train_tokens is 0 and the
    scores come from the smoothed start weights. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "language")
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        has_remainder(id_column, 7, 2).alias("held_out"),
        F.col(text_column).cast("string").alias("text"),
    )
    learned, counts = _learned(scratch, rows.filter("doc_id IS NOT NULL AND NOT held_out"))
    scored = scratch.keep(_scored(rows, learned).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "row", F.col("t.tail").alias("hash"), F.col("t.times").alias("times")
    )
    rare = learned.rare
    mass = F.when(F.col("n") > 0, F.col("n") - rare.discount).otherwise(F.lit(rare.unseen))
    rest = (
        tail.join(counts, "hash", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("tail_log"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("times") * (F.log10(mass) - float(np.log10(rare.whole)))).alias("tail_score"),
        )
    )
    denominator = float(np.log10(learned.n + learned.distinct + 1.0))
    return scored.drop("tail", "times").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(learned.n).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


QUERIES = {"op5_language": op5_language}
SQL: dict[str, str] = {}

"""Quality rules by tokeniser fertility: characters per token, byte-fallback share, token entropy.

Words are encoded by public vocabularies: a piece vocabulary with byte fallback and a byte-level
vocabulary for many languages. Both cut texts at spaces, so a word's tokens do not depend on its
neighbours, and each distinct word is encoded once per task.

A document is judged against its peers: documents of the same language and main script. The bands
come from all documents of the peer group: the median, and the distance of the quartiles as width.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch, bytes_of, slices, table

TOKENIZERS = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words of a byte-level vocabulary: letters, digits or signs, each with the space before.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Band half-widths in quartile distances, and their least half-widths.
WIDTH = 4.0
MEASURES = {"chars_per_piece": 0.5, "chars_per_byte_token": 0.5, "fallback_share": 0.05, "token_entropy": 1.5}
#: Entropy of short texts is bounded by their length, so only longer ones are held to its band.
ENTROPY_TOKENS = 200

#: How piece vocabularies write a space.
SPACE = "▁"
SYMBOLS = re.compile(rb"[#*$%&|<>]")
_SCRIPTS = (
    (0x0041, 0x024F, "latin"),
    (0x0370, 0x03FF, "greek"),
    (0x0400, 0x052F, "cyrillic"),
    (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x06FF, "arabic"),
    (0x0900, 0x0DFF, "indic"),
    (0x0E00, 0x0EFF, "thai"),
    (0x3040, 0x30FF, "kana"),
    (0x3400, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"),
)
_EDGES = np.array([edge for low, high, _ in _SCRIPTS for edge in (low, high + 1)])


def main_script(text: str) -> str:
    """The script that most letters belong to; none for a text without letters of a known script."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    where = np.searchsorted(_EDGES, codes, side="right")
    counts = np.bincount(where[where % 2 == 1] // 2, minlength=len(_SCRIPTS))
    return _SCRIPTS[int(counts.argmax())][2] if counts.any() else "none"


class Fertility:
    """Tokens of words in flat arrays, one row per distinct word, for the words met lately."""

    LIMIT = 400_000

    def __init__(self, folder: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))
        with open(os.path.join(folder, RANKS), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = self.pieces.vocab_size()
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(size)])
        self.opens = np.array([self.pieces.id_to_piece(i).startswith(SPACE) for i in range(size)])
        self.opens_rank = np.zeros(max(ranks.values()) + 1, bool)
        self.opens_rank[[rank for word, rank in ranks.items() if word.startswith(b" ")]] = True
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.counts = np.zeros((0, 3), np.int64)

    def learn(self, words: set[bytes]) -> None:
        """Makes sure that all words have a row; new ones are encoded in one call per vocabulary."""
        if len(self.rows) > self.LIMIT:
            self._clear()
        new = [w for w in words if w not in self.rows]
        if not new:
            return
        texts = [w.decode("utf-8", "replace").replace(SPACE, "_") for w in new]
        ids, sizes = self._joined(texts, lambda x: self.pieces.encode(x, num_threads=1), self.opens, "")
        _, ranks = self._joined(texts, self.ranks.encode_ordinary, self.opens_rank, " ")
        fallback = np.add.reduceat(self.fallback[ids], np.cumsum(sizes) - sizes, dtype=np.int64)
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.counts = np.concatenate(
            [self.counts, np.column_stack([np.array([len(x) for x in texts]), fallback, ranks])]
        )

    @staticmethod
    def _joined(texts: list[str], encode, opens: np.ndarray, before: str) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, and the number of each word's tokens. A space begins each word."""
        ids = np.array(encode(before + " ".join(texts)), np.int32)
        begins = np.flatnonzero(opens[ids])
        if len(begins) == len(texts):
            return ids, np.diff(np.append(begins, len(ids)))
        each = [np.array(encode(before + x), np.int32) for x in texts]
        return np.concatenate(each), np.array([len(x) for x in each])

    def of(self, words: list[bytes]) -> tuple[np.ndarray, tuple[int, int, int, int, float]]:
        """The words' rows; characters, pieces, pieces that are single bytes, byte-level tokens, and
        the entropy of the pieces in bits."""
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        chars, fallback, ranks = self.counts[rows].sum(axis=0)
        size = self.starts[rows + 1] - self.starts[rows]
        n = int(size.sum())
        at = np.repeat(self.starts[rows] - (np.cumsum(size) - size), size) + np.arange(n)
        times = np.bincount(self.ids[at])
        share = times[times > 0] / n
        return rows, (int(chars), n, int(fallback), int(ranks), float(-(share * np.log2(share)).sum()))


@functools.cache
def _fertility(folder: str) -> Fertility:
    return Fertility(folder)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(rows: np.ndarray) -> int:
    """Words in windows of three words found twice or more in the text; ``rows``: a number per word."""
    n = len(rows) - 2
    if n < 2:
        return 0
    _, small = np.unique(rows, return_inverse=True)
    base = int(small.max()) + 1
    _, pairs = np.unique(small[:-1] * base + small[1:], return_inverse=True)
    _, key = np.unique(pairs[:-1] * base + small[2:], return_inverse=True)
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(rows), bool)
    for k in range(3):
        covered[k : k + n] |= again
    return int(covered.sum())


COLUMNS = (
    "doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_pieces long, n_fallback long, n_byte_tokens long, token_entropy double"
)


def measure(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """Base statistics and fertility of each row of docs (doc_id, text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = _fertility(folder)
        for batch in batches:
            rows = []
            texts = [x or b"" for x in bytes_of(batch.column(1))]
            for start, stop in slices([len(x) for x in texts], 1 << 20):
                split = [x.split() for x in texts[start:stop]]
                fertility.learn(set().union(*split))
                for text, words in zip(texts[start:stop], split, strict=True):
                    n_symbols = len(SYMBOLS.findall(text))
                    if not words:
                        rows.append(("none", 0, 0, n_symbols, 0, 0, 0, 0, 0, 0.0))
                        continue
                    numbers, (chars, pieces, fallback, tokens, entropy) = fertility.of(words)
                    rows.append(
                        (
                            main_script(text.decode("utf-8", "replace")),
                            len(words),
                            chars,
                            n_symbols,
                            repeated_lines(text),
                            repeated_words(numbers),
                            pieces,
                            fallback,
                            tokens,
                            entropy,
                        )
                    )
            columns = list(zip(*rows, strict=True)) or [()] * 10
            kinds = [pa.string(), *[pa.int64()] * 8, pa.float64()]
            names = [x.split()[0] for x in COLUMNS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names
            )

    return docs.select("doc_id", "text", "lang").mapInArrow(run, COLUMNS)


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    folder: str = TOKENIZERS,
    width: float = WIDTH,
) -> DataFrame:
    """Statistics, base_failed and kept for each row of ``docs``.

    A document fails its base if it has under 50 words, or more than half of its words lie in
    repeated windows. It is kept if it passes and every measure lies in the band of its peers
    (language and main script): the median, plus and minus ``width`` quartile distances or the
    measure's least half-width. Characters per token are held to the lower bound only, the fallback
    share to the upper one, and entropy to the lower one and from ENTROPY_TOKENS tokens on.

    Edge cases: a null or word-less text has zeros throughout, fails and is not kept. A null
    language is a peer group of its own. Rows that repeat an id are judged one by one, rows without
    id too. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "fertility")
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit("")).alias("lang"),
    )
    measured = scratch.keep(measure(rows, folder), "measured").withColumns(
        {
            "chars_per_piece": F.col("word_chars") / F.nullif("n_pieces", F.lit(0)),
            "chars_per_byte_token": F.col("word_chars") / F.nullif("n_byte_tokens", F.lit(0)),
            "fallback_share": F.col("n_fallback") / F.nullif("n_pieces", F.lit(0)),
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )
    passed = measured.filter(~F.col("base_failed"))
    bands = passed.groupBy(F.col("lang").alias("of_lang"), F.col("script").alias("of_script")).agg(
        *(
            F.percentile_approx(
                F.when(F.col("n_pieces") >= ENTROPY_TOKENS, F.col(m)) if m == "token_entropy" else F.col(m),
                [0.25, 0.5, 0.75],
                10_000,
            ).alias(f"q_{m}")
            for m in MEASURES
        )
    )
    bands = scratch.keep(bands, "bands")

    def low(m: str):
        return F.col(f"q_{m}")[1] - F.greatest(width * (F.col(f"q_{m}")[2] - F.col(f"q_{m}")[0]), F.lit(MEASURES[m]))

    def high(m: str):
        return F.col(f"q_{m}")[1] + F.greatest(width * (F.col(f"q_{m}")[2] - F.col(f"q_{m}")[0]), F.lit(MEASURES[m]))

    inside = (
        (F.col("chars_per_piece") >= low("chars_per_piece"))
        & (F.col("chars_per_byte_token") >= low("chars_per_byte_token"))
        & (F.col("fallback_share") <= high("fallback_share"))
        & ((F.col("n_pieces") < ENTROPY_TOKENS) | F.coalesce(F.col("token_entropy") >= low("token_entropy"), F.lit(True)))
    )
    joined = measured.join(bands, (F.col("lang") == F.col("of_lang")) & (F.col("script") == F.col("of_script")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        "script", "chars_per_piece", "chars_per_byte_token", "fallback_share", "token_entropy",
    )


def op8_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


QUERIES = {"op8_fertility": op8_fertility}
SQL: dict[str, str] = {}

"""URL filters: a cascade of Bloom filters gives exact membership of a list without joins.

The keys are what a list of rules can name: a host or parent domain together with the beginning of a
path. The universe is every such key of every url of the corpus. The first filter holds the listed
keys; the next one holds the keys of the universe that the first one admits by mistake; the next one
the listed keys that this one admits, and so on, until a filter makes no mistake. A key of the
universe is listed if the first filter that does not admit it has an even number (from 1). As all
keys of the universe were used to build it, this is exact for the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake.llm.common import ODD, Scratch, mix, table

#: Listed keys per cascade: bounds the broadcast filters to a few megabytes. Longer lists are cut
#: into several cascades by the key's hash.
KEYS = 1_000_000
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


#: The rules of the registered query.
RULES = (
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
)


@dataclass
class Bloom:
    """Bits with a number of hashes; works on arrays of 64-bit hashes."""

    size: int
    hashes: int
    salt: int
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))

    @classmethod
    def planned(cls, keys: int, rate: float, salt: int) -> Bloom:
        bits = max(64, math.ceil(-max(keys, 1) * math.log(rate) / math.log(2) ** 2))
        return cls(bits, max(1, round(bits / max(keys, 1) * math.log(2))), salt)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Bit numbers, one row per hash function."""
        first = mix(hashes ^ np.uint64(self.salt * int(ODD) & 0xFFFFFFFFFFFFFFFF))
        second = mix(first + ODD) | np.uint64(1)
        steps = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return (first[None, :] + steps * second[None, :]) % np.uint64(self.size)

    def admits(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


class Cascade:
    """Levels of Bloom filters; exact on the universe that it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each key is listed."""
        result = np.zeros(len(hashes), bool)
        open_ = np.arange(len(hashes))
        for number, level in enumerate(self.levels):
            admitted = level.admits(hashes[open_])
            result[open_[~admitted]] = number % 2 == 1
            open_ = open_[admitted]
        # What the last level admits belongs to the set it holds.
        result[open_] = len(self.levels) % 2 == 1
        return result


def _filled(spark: SparkSession, keys: DataFrame, level: Bloom) -> Bloom:
    """The level with the bits of all keys (column h): set per task, then joined by bitwise or."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, int] = {}
        for batch in batches:
            at = level.places(batch.column(0).to_numpy().view(np.uint64)).ravel()
            where, which = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(where), np.uint64)
            np.bitwise_or.at(bits, which, np.uint64(1) << (at & np.uint64(63)))
            for word, mask in zip(where.tolist(), bits.tolist(), strict=True):
                words[word] = words.get(word, 0) | mask
        if words:
            values = np.array(list(words.values()), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.int64()), pa.array(values)], ["word", "bits"])

    rows = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    level.words = np.zeros(-(-level.size // 64), np.uint64)
    level.words[[r.word for r in rows]] = np.array([r.bits for r in rows], np.int64).view(np.uint64)
    return level


def build_cascade(scratch: Scratch, listed: DataFrame, others: DataFrame) -> Cascade:
    """Cascade of the listed keys (column h, distinct) against the universe's other keys.

    The first level's rate balances both sides; later levels halve what is left. The listed keys
    bound every level: mistakes among the others are about as many as half of them.
    """
    spark = scratch.spark
    n_listed, n_others = listed.count(), others.count()
    levels: list[Bloom] = []
    inside, outside = listed, others
    n_inside, n_outside = n_listed, n_others
    while len(levels) < MAX_LEVELS:
        rate = 0.5 if levels else min(0.5, max(1e-6, n_inside * math.sqrt(0.5) / max(n_outside, 1)))
        level = _filled(spark, inside, Bloom.planned(n_inside, rate, len(levels) + 1))
        levels.append(level)
        mistaken = scratch.keep(outside.mapInArrow(_admitted(level), "h long"), f"level-{len(levels)}")
        n_mistaken = mistaken.count()
        if not n_mistaken:
            return Cascade(levels)
        inside, outside, n_inside, n_outside = mistaken, inside, n_mistaken, n_inside
    raise RuntimeError("Keys with equal hashes stand on both sides of the list")


def _admitted(level: Bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = level.admits(batch.column(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(keep))

    return run


def host_of(url: Column) -> Column:
    """From behind the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, "[.]", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Keys of one url that a rule may have: each domain with the path's beginning in each length."""
    heads = F.filter(
        F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths)), lambda x: x.isNotNull()
    )
    return F.flatten(
        F.transform(domains(host), lambda d: F.transform(heads, lambda h: F.struct(d.alias("host"), h.alias("path"))))
    )


def key_hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, F.lit("\u0000"), path)


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    default_allow: bool = True,
) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages``.

    A rule fits its host and all subdomains if the url's path starts with the rule's path; the
    longest fitting rule decides, among equals the one with the longer host. Urls that no rule fits
    get the default verdict.

    Edge cases: a null url or one without :// has an empty host and path and fits no rule with a
    host. Rows that repeat an id or a url and rows without id are judged one by one. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "urls")
    urls = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    lengths = sorted({len(r.path) for r in rules})
    keyed = urls.withColumn("keys", candidates(F.col("host"), F.col("path"), lengths))
    universe = scratch.keep(
        keyed.select(F.explode("keys").alias("k"))
        .select(key_hash(F.col("k.host"), F.col("k.path")).alias("h"))
        .distinct(),
        "universe",
    )
    cascades = {}
    for allow in (True, False):
        own = [(r.host, r.path) for r in rules if r.allow == allow]
        if len(own) > KEYS:
            raise ValueError(f"At most {KEYS} rules of a kind")
        named = spark.createDataFrame(own or [("", "")], "host string, path string").limit(len(own))
        named = named.select(key_hash(F.col("host"), F.col("path")).alias("h")).distinct()
        listed = scratch.keep(universe.join(F.broadcast(named), "h", "left_semi"), "listed")
        others = universe.join(F.broadcast(named), "h", "left_anti")
        cascades[allow] = build_cascade(scratch, listed, others)
    sent = spark.sparkContext.broadcast(cascades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(batch.schema.get_field_index("hashes"))
            flat = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            found = np.where(sent.value[True].listed(flat), 1, np.where(sent.value[False].listed(flat), 2, 0))
            column = pa.ListArray.from_arrays(hashes.offsets.cast(pa.int32()), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], "kinds"])

    hashed = keyed.withColumn("hashes", F.transform("keys", lambda k: key_hash(k["host"], k["path"])))
    shape = T.StructType([*hashed.drop("hashes").schema.fields, T.StructField("kinds", T.ArrayType(T.IntegerType()))])
    judged = hashed.mapInArrow(run, shape)
    fitting = F.filter(F.arrays_zip("keys", "kinds"), lambda x: x["kinds"] > 0)
    ranked = F.transform(
        fitting,
        lambda x: F.struct(
            (F.length(x["keys"]["host"]) + F.length(x["keys"]["path"])).alias("length"),
            F.length(x["keys"]["host"]).alias("host_length"),
            F.concat(x["keys"]["host"], x["keys"]["path"]).alias("rule"),
            x["kinds"].alias("kind"),
        ),
    )
    best = F.array_max(ranked)
    return judged.withColumn("best", best).select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.when(F.coalesce(F.col("best.kind"), F.lit(1 if default_allow else 2)) == 1, "allow").otherwise("block").alias("verdict"),
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


_HOST = r"coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"

QUERIES = {"op2_url_filter": op2_url_filter}
SQL = {
    "op2_url_filter": rf"""
        WITH u AS (
            SELECT page_id, {_HOST} AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ),
        r(host, path, verdict) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        ),
        m AS (
            SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
                   max_by(r.verdict, length(r.host || r.path)) AS verdict
            FROM u JOIN r ON (u.host = r.host OR u.host LIKE '%.' || r.host) AND starts_with(u.path, r.path)
            GROUP BY page_id
        )
        SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
        FROM u LEFT JOIN m USING (page_id)
    """,
}

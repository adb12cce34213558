"""Mixing sources to target weights: Poisson replication by hash-seeded inversion.

Each source has a target share of the mixture, hence a mean number of copies per document. The
number of copies of a document is Poisson with that mean, found by inverting the distribution at a
uniform number hashed from the document's id; copies are exploded and put into a global random order.

Large means are split: a mean m is the sum of ceil(m / PART) equal means, each inverted at its own
hash, so tables of cumulated probabilities stay short and a document's copies are made in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch, table

#: Largest mean that is inverted at once.
PART = 16.0
#: Terms of a cumulated distribution: its tail beyond is under 2**-53 for means up to PART.
TERMS = 72
#: Target shares are proportional to the sources' sizes to this power if none are given.
TEMPERATURE = 0.5
SEED = "mix"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of some columns, with 52 bits."""
    text = F.concat_ws("/", *(p.cast("string") for p in parts), F.lit(SEED))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def shares(sizes: DataFrame, weights: dict[str, float] | None, temperature: float) -> DataFrame:
    """(source, n, mean): copies per document that give each source its share of the total size.

    Sources missing in ``weights`` have the share 0.
    """
    if weights is None:
        wanted = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        pairs = [F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]
        wanted = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0)) if pairs else F.lit(0.0)
    sized = sizes.withColumn("wanted", wanted)
    total = sized.agg(F.sum("n").alias("all"), F.sum("wanted").alias("all_wanted"))
    return sized.crossJoin(F.broadcast(total)).select(
        "source", "n", F.when(F.col("all_wanted") > 0, F.col("all") * F.col("wanted") / F.col("all_wanted") / F.col("n")).otherwise(0.0).alias("mean")
    )


def cumulated(mean: Column) -> Column:
    """Array of the Poisson probabilities P(X <= k), k = 0 .. TERMS - 1."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    steps = F.sequence(F.lit(1), F.lit(TERMS - 1))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k.cast("double")
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(steps, start, step)["sums"]


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = TEMPERATURE,
    id_column: str = "doc_id",
    source_column: str = "source",
) -> DataFrame:
    """``docs`` with each row repeated by its count, in random order, and the columns mix_copy (1, 2, ...),
    mix_rate (the source's mean number of copies) and mix_order (the place in [0, 1)).

    ``weights`` are the target shares per source; without them a source's share is its number of
    documents to the power ``temperature``. The expected size of the mixture is the size of ``docs``.

    Edge cases: a null source is a source of its own, in ``weights`` under the empty name. Rows with a
    null id all have the same hash, and rows that repeat an id have the same count. Texts do not
    matter. Columns named like the three new ones are replaced; others pass through. An empty table
    gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    source = F.coalesce(F.col(source_column).cast("string"), F.lit(""))
    sizes = docs.groupBy(source.alias("source")).agg(F.count("*").alias("n"))
    rates = shares(sizes, weights, temperature)
    parts = F.ceil(F.col("mean") / PART)
    rates = rates.filter("mean > 0").select(
        "source", F.col("mean").alias("mix_rate"), parts.alias("parts"), cumulated(F.col("mean") / parts).alias("sums")
    )
    rates = scratch.keep(rates, "rates")
    rest = docs.drop("mix_copy", "mix_rate", "mix_order")
    # The row travels as one struct, so its names cannot clash. Counts first, on slim parts of rows;
    # the texts are repeated in the last step only.
    rows = rest.select(
        F.struct(*(F.col(f"`{c}`") for c in rest.columns)).alias("row"),
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("key"),
        source.alias("source"),
    )
    draw = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("parts")),
        F.lit(0).cast("long"),
        lambda total, part: total + F.size(F.filter("sums", lambda s: s <= uniform(F.col("key"), part))),
    )
    counted = rows.join(rates, "source").select("row", "key", "mix_rate", draw.alias("n"))
    copies = counted.filter("n > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    placed = copies.withColumn("mix_order", uniform(F.col("key"), F.lit("order"), F.col("mix_copy")))
    fields = [F.col(f"row.`{c}`").alias(c) for c in rest.columns]
    return placed.orderBy("mix_order").select(*fields, "mix_rate", "mix_copy", "mix_order")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document: doc_id, source, mix_copy, mix_order and the text's digest."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "mix_copy", "mix_order", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5")
    )


def mixing_sql(docs: str = "documents", columns: str = "doc_id, source, mix_copy, mix_order, md5(coalesce(text, '')) AS text_md5") -> str:
    """The same mixture as SQL: the k-th term of each distribution by a recursive table."""
    uniform_sql = "('0x' || substr(md5({}), 1, 13))::BIGINT / " + str(float(1 << 52))
    return f"""
        WITH RECURSIVE sizes AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM {docs} GROUP BY 1),
        rates AS (
            SELECT s, (sum(n) OVER ()) * pow(n, {TEMPERATURE}) / (sum(pow(n, {TEMPERATURE})) OVER ()) / n AS mean FROM sizes
        ),
        parts AS (SELECT s, mean, ceil(mean / {PART})::BIGINT AS parts FROM rates WHERE mean > 0),
        terms AS (
            SELECT s, 0 AS k, exp(-(mean / parts)) AS p, exp(-(mean / parts)) AS total, mean / parts AS m FROM parts
            UNION ALL
            SELECT s, k + 1, p * m / (k + 1), total + p * m / (k + 1), m FROM terms WHERE k < {TERMS - 1}
        ),
        draws AS (
            SELECT d.*, q.s AS s, unnest(range(1, parts + 1)) AS part FROM {docs} d JOIN parts q ON q.s = coalesce(d.source, '')
        ),
        counted AS (
            SELECT doc_id, s, part,
                   (SELECT count(*) FROM terms t WHERE t.s = draws.s AND t.total <= {uniform_sql.format("coalesce(doc_id::VARCHAR, '') || '/' || part || '/" + SEED + "'")}) AS c
            FROM draws
        ),
        counts AS (SELECT doc_id, sum(c)::BIGINT AS c FROM counted GROUP BY doc_id),
        copies AS (SELECT d.*, unnest(range(1, c + 1)) AS mix_copy FROM {docs} d JOIN counts USING (doc_id) WHERE c > 0),
        placed AS (
            SELECT *, {uniform_sql.format("coalesce(doc_id::VARCHAR, '') || '/order/' || mix_copy || '/" + SEED + "'")} AS mix_order FROM copies
        )
        SELECT {columns} FROM placed
    """


QUERIES = {"op7_mixing": op7_mixing}
SQL = {"op7_mixing": mixing_sql()}

"""Embedding near-duplicates: cover trees, dual traversal, exact threshold pairs.

Distances are Euclidean on unit vectors; a cosine of at least c is a distance of at most
sqrt(2 - 2 c). Equal vectors are one node with a weight.

The top of the tree is shared: pivots picked far from each other out of a bounded sample, and every
node belongs to its nearest pivot's cell. Cells are cut into blocks of bounded size. A node meets the
blocks of another cell only if it is no farther from the pivot than the cell's covering radius plus
the threshold, so far cells never meet. Below, each pair of blocks is one group: both sides build
nested levels with halving radii, and pairs of tree nodes are dropped when their centers are farther
apart than both covering radii plus the threshold. Where halving does not split a node (few distinct
neighbours in many dimensions), it is a leaf and its vectors are compared as one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch, mix, sorted_groups, table
from merchlake.llm.graph import components

COSINE = 0.95
#: Vectors the pivots are picked from; all vectors are compared, whatever the sample.
SAMPLE = 8192
MAX_PIVOTS = 2048
BLOCK = 4096
LEAF = 64
#: A node with more children than this at half its radius stays a leaf.
CHILDREN = 32
_SLACK = 1e-9


@dataclass
class Node:
    center: np.ndarray
    radius: float
    members: np.ndarray
    children: list


def cover_tree(points: np.ndarray, members: np.ndarray | None = None) -> Node:
    """Nested levels: each node's children cover its points with half its radius."""
    members = np.arange(len(points)) if members is None else members
    own = points[members]
    center = own[0]
    away = _distances(own, center)
    node = Node(center, float(away.max()) + _SLACK, members, [])
    if len(members) <= LEAF or node.radius <= 4 * _SLACK:
        return node
    centers, nearest, closest = [0], np.zeros(len(members), np.int64), away
    while closest.max() > node.radius / 2:
        if len(centers) == CHILDREN:
            return node
        pick = int(closest.argmax())
        to_pick = _distances(own, own[pick])
        nearer = to_pick < closest
        nearest[nearer], closest = len(centers), np.minimum(closest, to_pick)
        centers.append(pick)
    for k, pick in enumerate(centers):
        inside = np.flatnonzero(nearest == k)
        first = np.concatenate([[pick], inside[inside != pick]])
        node.children.append(cover_tree(points, members[first]))
    return node


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - center) ** 2).sum(axis=1), 0.0))


def node_pairs(left: Node, right: Node, reach: float) -> Iterator[tuple[Node, Node]]:
    """Pairs of leaves that may hold points within ``reach`` of each other."""
    stack = [(left, right)]
    while stack:
        a, b = stack.pop()
        if np.sqrt(((a.center - b.center) ** 2).sum()) > a.radius + b.radius + reach:
            continue
        if not a.children and not b.children:
            yield a, b
        elif b.children and (not a.children or b.radius > a.radius):
            stack += [(a, child) for child in b.children]
        else:
            stack += [(child, b) for child in a.children]


class _Links:
    """Number of linked vectors and local component of each point of one group."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.numbers = np.zeros(len(weights), np.int64)
        self.labels = np.arange(len(weights))

    def compare(self, points: np.ndarray, norms: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float) -> None:
        for start in range(0, len(a), 512):
            rows = a[start : start + 512]
            near = (points[rows] @ points[b].T) / (norms[rows][:, None] * norms[b][None, :]) >= cosine
            near &= rows[:, None] != b[None, :]
            if not near.any():
                continue
            self.numbers[rows] += near @ self.weights[b]
            for k in np.flatnonzero(near.any(axis=1)):
                labels = np.unique(np.append(self.labels[b[near[k]]], self.labels[rows[k]]))
                if len(labels) > 1:
                    self.labels[np.isin(self.labels, labels)] = labels[0]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]


def _compared(groups: DataFrame, cosine: float) -> DataFrame:
    """(id, root, n) of the nodes with links, per pair of blocks: n counts linked vectors."""
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["low", "high"]):
            ids, weights, own = (group.column(k).to_numpy() for k in ("id", "weight", "own"))
            points = np.frombuffer(b"".join(group.column("vector").to_pylist()), np.float64).reshape(len(ids), -1)
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            norms, unit = np.sqrt((points**2).sum(axis=1)), _unit(points)
            left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
            if not len(left) or not len(right):
                continue
            links = _Links(weights)
            tree = cover_tree(unit, left)
            other = tree if low == high else cover_tree(unit, right)
            for a, b in node_pairs(tree, other, reach):
                links.compare(points, norms, a.members, b.members, cosine)
                if low != high:
                    links.compare(points, norms, b.members, a.members, cosine)
            some = np.flatnonzero(links.numbers > 0)
            if len(some):
                smallest = np.full(len(ids), np.iinfo(np.int64).max)
                np.minimum.at(smallest, links.labels, ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(smallest[links.labels[some]]), pa.array(links.numbers[some])],
                    ["id", "root", "n"],
                )

    placed = groups.repartition("low", "high").sortWithinPartitions("low", "high")
    return placed.select("low", "high", "own", "id", "weight", "vector").mapInArrow(run, "id long, root long, n long")


def _read(rows: DataFrame) -> DataFrame:
    """vec_id, the two halves of the vector's key, and its doubles; null where it can not be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, found = [], [], []
            column = batch.column(1)
            offsets = column.offsets.to_numpy()
            values = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
            for i, there in enumerate(column.is_valid().to_pylist()):
                v = values[offsets[i] : offsets[i + 1]]
                if there and len(v) and np.isfinite(v).all() and np.isfinite(s := float((v * v).sum())) and s > 0:
                    raw = v.tobytes()
                    key = np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64)
                    h1.append(int(key[0]))
                    h2.append(int(key[1]))
                    found.append(raw)
                else:
                    h1.append(None)
                    h2.append(None)
                    found.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(found, pa.binary())],
                ["vec_id", "h1", "h2", "vector"],
            )

    return rows.mapInArrow(run, "vec_id long, h1 long, h2 long, vector binary")


def _pivots(nodes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Per vector length, unit vectors far from each other, about one per block of nodes."""
    sample = nodes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
    by_length: dict[int, list[np.ndarray]] = {}
    for row in sample:
        v = np.frombuffer(bytes(row.vector), np.float64)
        by_length.setdefault(len(v), []).append(v)
    found = {}
    for length, vectors in by_length.items():
        unit = _unit(np.array(vectors))
        wanted = min(len(unit), MAX_PIVOTS, max(1, -(-count // BLOCK)))
        picked, closest = [0], _distances(unit, unit[0])
        while len(picked) < wanted and closest.max() > _SLACK:
            picked.append(int(closest.argmax()))
            closest = np.minimum(closest, _distances(unit, unit[picked[-1]]))
        found[length] = unit[picked]
    return found


def _axis(length: int) -> np.ndarray:
    """Pivot of vector lengths that the sample does not have."""
    return np.eye(1, length)


def _placed(nodes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Nodes with their cell (vector length and number of the nearest pivot) and distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, away = [], []
            for raw in batch.column(2).to_pylist():
                v = np.frombuffer(raw, np.float64)[None, :]
                d = _distances(pivots[v.shape[1]] if v.shape[1] in pivots else _axis(v.shape[1]), _unit(v))
                k = int(d.argmin())
                cells.append(v.shape[1] * MAX_PIVOTS + k)
                away.append(float(d[k]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int64()), pa.array(away, pa.float64())], [*batch.schema.names, "cell", "away"]
            )

    return nodes.select("id", "weight", "vector").mapInArrow(
        run, "id long, weight long, vector binary, cell long, away double"
    )


def _dealt(placed: DataFrame, pivots: dict[int, np.ndarray], cells: dict[int, tuple[float, int]], reach: float) -> DataFrame:
    """Each node once per pair of blocks (low, high) it takes part in; ``own`` is its block.

    A block is a cell's number times a fixed factor plus the chunk. A pair is formed by the block with
    the smaller number and one with a greater or the same number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.array(sorted(cells), np.int64)
        radius = np.array([cells[int(c)][0] for c in numbers])
        chunks = np.array([cells[int(c)][1] for c in numbers])
        first = np.cumsum(chunks) - chunks
        lengths, pivot = numbers // MAX_PIVOTS, numbers % MAX_PIVOTS
        centers = {
            int(n): (pivots[int(n)] if int(n) in pivots else _axis(int(n)))[pivot[lengths == n]] for n in np.unique(lengths)
        }
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            at = np.searchsorted(numbers, cell)
            own = first[at] + (mix(ids.view(np.uint64)) % chunks[at].astype(np.uint64)).astype(np.int64)
            rows, low, high = [], [], []
            for i, raw in enumerate(batch.column(2).to_pylist()):
                v = np.frombuffer(raw, np.float64)
                same = np.flatnonzero(lengths == len(v))
                meets = _distances(centers[len(v)], _unit(v[None, :])) <= radius[same] + reach
                meets |= same == at[i]
                blocks = np.concatenate([np.arange(first[c], first[c] + chunks[c]) for c in same[meets]])
                rows.append(np.full(len(blocks), i))
                low.append(np.minimum(blocks, own[i]))
                high.append(np.maximum(blocks, own[i]))
            if not rows:
                continue
            rows, low, high = np.concatenate(rows), np.concatenate(low), np.concatenate(high)
            for start in range(0, len(rows), 20_000):
                part = slice(start, start + 20_000)
                taken = batch.take(pa.array(rows[part]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(low[part]),
                        pa.array(high[part]),
                        pa.array(own[rows[part]]),
                        *taken.columns[:3],
                    ],
                    ["low", "high", "own", "id", "weight", "vector"],
                )

    return placed.mapInArrow(run, "low long, high long, own long, id long, weight long, vector binary")


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors``.

    n_links counts the other rows whose vector has a cosine of at least ``cosine``; component_id is
    the smallest id reachable over links; kept says that it is the row's own.

    Edge cases: vectors that are null, empty or zero, or hold null or non-finite components, link
    with nothing, nor do vectors of different lengths. A row without id links with nothing:
    component_id is null and kept true. Rows that repeat an id are vectors of their own with the same
    component. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding")
    )
    read = scratch.keep(_read(rows), "read")
    nodes = scratch.keep(
        read.filter("vec_id IS NOT NULL AND h1 IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("owner"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    pivots = _pivots(nodes, nodes.count())
    placed = scratch.keep(_placed(nodes, pivots), "placed")
    # One row per cell, so at most MAX_PIVOTS rows per vector length.
    radii = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect()
    cells = {r.cell: (r.radius + _SLACK, -(-r.n // BLOCK)) for r in radii}
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK
    found = scratch.keep(_compared(_dealt(placed, pivots, cells, reach), cosine), "found")

    numbers = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(scratch, found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    known = (
        nodes.select("id", "h1", "h2", "owner", "weight")
        .join(numbers, "id", "left")
        .join(roots, "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    known = scratch.keep(known, "known")
    smallest = known.groupBy("root").agg(F.min("owner").alias("component"))
    of_node = scratch.keep(
        known.join(smallest, "root").select(
            "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component"
        ),
        "of-node",
    )
    return (
        read.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("h1")).alias("h1"), "h2")
        .join(of_node, ["h1", "h2"], "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_near_vectors": op9_near_vectors}
SQL = {
    "op9_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) > 0
        ),
        l AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95
        ),
        r AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
        ),
        c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM c
    """,
}

"""Similarity components from sketches: banding, estimates, exact checks, union-find.

Works on nodes (id long, size long, sig binary), one per distinct set, and on their bodies
(id long, body binary). Used by the document and the line near-duplicate operators.

How large buckets are kept cheap without losing a link between different sets:

1. Inside a bucket every node is paired with the bucket's smallest id only, so a bucket of n nodes
   makes n - 1 pairs. Pairs whose sketches rule the threshold out are dropped; each node's best pair
   is checked exactly and the links are contracted to components.
2. Buckets that still hold several components are compared block by block: each node meets every
   node of other components in its bucket, as sketches in numpy arrays of bounded size. Two nodes
   are compared in the first bucket that both are in, and in no other. A first pass keeps the nodes
   for which some pair is possible; only these get their bodies, and a second pass over the same
   blocks compares them exactly. Out of a block come only links that join two components.

Pairs inside one component need no check, since they can not change it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch, sorted_groups
from merchlake.llm.graph import components
from merchlake.llm.sketch import estimate

#: Nodes of one side of a block, and the elements of their sets: a few megabytes of sketches and bodies.
BLOCK = 2048
ELEMENTS = 1 << 20

Bodies = Callable[[DataFrame], DataFrame]
Expand = Callable[[bytes], np.ndarray]


def link(
    scratch: Scratch, nodes: DataFrame, bodies: Bodies, expand: Expand, percent: int, floor: float, bands: int, width: int
) -> DataFrame:
    """(id, root) of the nodes that are similar to another one, directly or through others.

    Two nodes are similar when 100 * |intersection| >= percent * |union| of their sets. ``size`` is that
    of the set; ``sig`` its sketch, whose first ``bands`` parts of ``width`` bytes are the bands.
    ``bodies`` gives (id, body) for a table of wanted ids; ``expand`` makes a body the sorted array of
    its set; estimates under ``floor`` rule a pair out.
    """
    keys = F.array(*(F.expr(f"xxhash64({k}, substring(sig, {width * k} + 1, {width}))") for k in range(bands)))
    banded = nodes.select("id", F.col("size").cast("int").alias("size"), F.posexplode(keys).alias("part", "band"))
    shared = banded.groupBy("band").agg(F.min("id").alias("center"), F.count("*").alias("n"), F.sum("size").alias("sizes"))
    members = scratch.keep(banded.drop("size").join(shared.filter("n > 1"), "band"), "members")
    # The sketches of all nodes are too many to broadcast at the sizes this is made for.
    sigs = nodes.select("id", "sig").hint("merge")

    pairs = members.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    best = _estimated(pairs, sigs, floor).groupBy("b").agg(F.max_by("a", "est").alias("a")).select("a", "b")
    stars = _checked(scratch, best, bodies, expand, percent)
    with scratch.inner() as step:
        roots = scratch.keep(components(step, stars), "roots")

    dealt = _dealt(members, roots).join(sigs, "id")
    possible = scratch.keep(_possible(dealt, floor, bands, width), "possible")
    scratch.drop(members, stars)
    texts = scratch.keep(bodies(possible.select("id").distinct()), "bodies")
    found = scratch.keep(_linked(possible.join(texts.hint("merge"), "id"), expand, percent, floor, bands, width), "links")
    scratch.drop(possible, texts)
    with scratch.inner() as step:
        known = roots.select(F.col("root").alias("a"), F.col("id").alias("b"))
        return scratch.keep(components(step, known.union(found)), "roots")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(a), len(b)))
    if 100 * least < percent * most:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _estimated(pairs: DataFrame, sigs: DataFrame, floor: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3)
            )
            est = estimate((left == right).mean(axis=1))
            keep = pa.array(est >= floor)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(est)], ["a", "b", "est"])
            yield out.filter(keep)

    of_a = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
    of_b = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    joined = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "sig_a", "sig_b")
    return joined.mapInArrow(run, "a long, b long, est double")


def _checked(scratch: Scratch, pairs: DataFrame, bodies: Bodies, expand: Expand, percent: int) -> DataFrame:
    """The pairs that are similar by their whole bodies. Only the bodies of these pairs are fetched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A body of a large group takes part in many pairs.
        sets = functools.lru_cache(512)(expand)
        for batch in batches:
            pairs_of = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            keep = pa.array([similar(sets(left), sets(right), percent) for left, right in pairs_of], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    pairs = scratch.keep(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = scratch.keep(bodies(wanted), "bodies")
    of_a = texts.select(F.col("id").alias("a"), F.col("body").alias("body_a")).hint("merge")
    of_b = texts.select(F.col("id").alias("b"), F.col("body").alias("body_b")).hint("merge")
    joined = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "body_a", "body_b")
    links = scratch.keep(joined.mapInArrow(run, "a long, b long"), "links")
    scratch.drop(pairs, texts)
    return links


def _dealt(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes of buckets with several components, once per pair of chunks (i, j) they take part in.

    A bucket is dealt over chunks by the id's hash, as many as its nodes and their sizes ask for, and
    every pair of chunks is one group of rows; so no task ever holds a whole large bucket.
    """
    known = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = known.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    chunks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("sizes") / ELEMENTS))
    own = F.pmod(F.xxhash64("id"), chunks)
    return (
        known.join(mixed.select("band"), "band")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "root", "part")
    )


class _Block:
    """Nodes of two chunks of a bucket (or of one chunk), and which of their pairs are to be compared."""

    def __init__(self, group: pa.Table, floor: float, bands: int, width: int):
        self.ids, self.root, self.own = (group.column(k).to_numpy().copy() for k in ("id", "root", "own"))
        self.part, self.floor = group.column("part")[0].as_py(), floor
        self.sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(self.ids), -1)
        # Bands of the bucket's predecessors: a pair that shares one of them was compared there.
        self.before = self.sig[:, : self.part * width].reshape(len(self.ids), self.part, width)
        self.i, self.j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        self.left = np.flatnonzero(self.own == self.i)
        self.right = self.left if self.i == self.j else np.flatnonzero(self.own == self.j)

    def possible(self, k: int) -> np.ndarray:
        """The nodes of other components that node k is to be compared with, by falling estimate."""
        others = self.right[self.root[self.right] != self.root[k]]
        if self.i == self.j:
            others = others[others > k]
        est = estimate((self.sig[others] == self.sig[k]).mean(axis=1)) if len(others) else np.zeros(0)
        near = np.flatnonzero(est >= self.floor)
        if self.part and len(near):
            near = near[~(self.before[others[near]] == self.before[k]).all(axis=2).any(axis=1)]
        return others[near[np.argsort(-est[near], kind="stable")]]


BLOCKED = ["band", "i", "j", "own", "id", "root", "part", "sig"]


def _placed(rows: DataFrame) -> DataFrame:
    return rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")


def _possible(dealt: DataFrame, floor: float, bands: int, width: int) -> DataFrame:
    """The rows of each block whose node has a possible pair there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["band", "i", "j"]):
            block = _Block(group, floor, bands, width)
            taken = np.zeros(len(block.ids), bool)
            for k in block.left:
                others = block.possible(k)
                taken[others] = True
                taken[k] |= len(others) > 0
            if taken.any():
                yield from group.filter(pa.array(taken)).to_batches()

    return _placed(dealt.select(*BLOCKED)).mapInArrow(
        run, "band long, i long, j long, own long, id long, root long, part int, sig binary"
    )


def _linked(rows: DataFrame, expand: Expand, percent: int, floor: float, bands: int, width: int) -> DataFrame:
    """Links (a, b) that join two components of a block; pairs whose components have met by then need
    no check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["band", "i", "j"]):
            block = _Block(group, floor, bands, width)
            sets = [expand(x) for x in group.column("body").to_pylist()]
            sizes = np.array([len(x) for x in sets])
            distinct, places = np.unique(np.concatenate(sets), return_inverse=True)
            ends = np.cumsum(sizes)
            marked, found = np.zeros(len(distinct), bool), []
            for k in block.left:
                others = block.possible(k)
                least, most = np.minimum(sizes[others], sizes[k]), np.maximum(sizes[others], sizes[k])
                others = others[100 * least >= percent * most]
                if not len(others):
                    continue
                own = places[ends[k] - sizes[k] : ends[k]]
                marked[own] = True
                common = np.array([np.count_nonzero(marked[places[ends[o] - sizes[o] : ends[o]]]) for o in others])
                marked[own] = False
                for o in others[100 * common >= percent * (sizes[others] + sizes[k] - common)]:
                    if block.root[o] != block.root[k]:
                        block.root[block.root == block.root[o]] = block.root[k]
                        found.append((block.ids[k], block.ids[o]))
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return _placed(rows.select(*BLOCKED, "body")).mapInArrow(run, "a long, b long")

"""Connected components of a link table, by stars that shrink towards the smallest id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaceta import session

EDGES = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (smallest member, member) that connect what the links (a, b) connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        # Hang the root of either end below the smaller of the two roots.
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    apart = root != np.arange(len(nodes))
    return nodes[root[apart]], nodes[apart]


def fold_links(links: DataFrame) -> DataFrame:
    """Each batch of links becomes a forest of stars; what is connected stays so."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            low, high = forest(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, EDGES)


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that a link (a, b) names.

    Large-star and small-star steps in turn. In each, a node's links are regrouped around
    the smallest id next to it; the number of links never grows, and after about
    log(nodes) rounds every component is one star. The neighbours of a node are never
    brought together: minima are aggregated in two steps and joined back, and the join may
    split a node with very many links. Every round is written to the shared folder.
    """
    pairs = session.materialize(fold_links(links.where("a <> b")).distinct())
    before = None
    while True:
        # Large star: every larger neighbour of u goes to the smallest id around u.
        both = pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a")))
        both = both.toDF("u", "v")
        low = session.materialize(both.groupBy("u").agg(
            F.least(F.min("v"), F.col("u")).alias("m")))
        large = session.materialize(
            both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
            .where("a <> b").distinct())
        # Small star: u and its smaller neighbours go to the smallest of them.
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = session.materialize(down.groupBy("u").agg(F.min("v").alias("m")))
        moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        pairs = session.materialize(
            fold_links(moved.union(least.select(F.col("m"), F.col("u"))).where("a <> b")).distinct())
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    members = pairs.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return members.union(pairs.select("a", "a").distinct().toDF("id", "component"))

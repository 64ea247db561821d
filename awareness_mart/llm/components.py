"""Connected components of links: forests within tasks, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

AT_ONCE = 1 << 20  # links that a task contracts at a time


def least_of_parts(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of links and the smallest node that each reaches."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(new, end, low)
        while not np.array_equal(hop := new[new], new):
            new = hop
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's links as links of every node to the smallest that it reaches there."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        nodes, least = least_of_parts(table["u"].to_numpy(), table["v"].to_numpy())
        child = nodes != least
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[child]), pa.array(least[child])], names=["u", "v"]
        )

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= AT_ONCE:
            yield stars(held)
            held, n = [], 0
    if n:
        yield stars(held)


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands the smallest id it knows to its larger neighbours."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    known = both.join(least, "u").where("v > u")
    return known.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), "m")
    return least.union(others).select("u", F.col("m").alias("v")).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node without one."""
    ends = links.select("u", "v").union(
        links.select("v", F.lit(None).cast("bigint"))
    )
    nodes = ends.groupBy("u").agg(
        F.min("v").alias("least"), F.max("v").alias("most"), F.count("*").alias("n"),
        F.count("v").alias("up"),
    )
    return not nodes.where("up > 0 and (least != most or n > up)").count()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is its smallest node.

    Tasks first replace their links by a forest. Each round is two joins and two sums by key
    over rows that never outnumber the links; rounds grow with the logarithm of the longest
    path between forests. A link with a null end or of a node to itself is ignored; no links
    give no rows.
    """
    links = links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    given = written(links, "links")
    now = written(given.mapInArrow(_forests, "u bigint, v bigint"), "forests")
    discard(given)
    while not _settled(now):
        old, now = now, written(_small_star(_large_star(now)), "stars")
        discard(old)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).distinct().union(
        now.select("v", "v").distinct()
    )

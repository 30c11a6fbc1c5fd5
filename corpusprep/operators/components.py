"""Connected components: contraction inside partitions, then alternating large-star and small-star steps.

Edges are dealt to partitions by range, ``LOCAL_EDGES`` to one, and each contracts its
own to stars by union-find. A node that only one partition has, and that is no root, is
settled there; the edges of the others, those that cross partitions, go on to the next
round, and the settled nodes take the labels of their roots at the end. Between
contractions a large-star and a small-star step link what the cuts separate. When one
partition holds what is left it is done. Nodes that are no integers take the star steps
alone; there the graph is done when every edge is settled.

Both star steps are an aggregation (``min`` per node, combined map-side) and a join
of the edges with it, so a node of any degree is handled by partial aggregation
and by AQE's skew join. Edges always point from the larger to the smaller node;
each round connects every node to the smallest node it has seen, so components
become stars, whose edges are settled, in a number of rounds logarithmic in their
size. Every round's edges are written to the shared checkpoint folder, so a
lost executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_materialized, materialize

#: Edges that one task contracts (16 bytes each, and a few work arrays of that size).
LOCAL_EDGES = 1 << 18


def _star_round(e: DataFrame) -> DataFrame:
    """The edges (u, v), u > v, after one large-star and one small-star step."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = (both.where(F.col("v") > F.col("u")).join(low, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return small.select("e.*").where(F.col("u") != F.col("v")).distinct()


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of these edges that are not the smallest themselves."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    comp = np.arange(len(nodes))
    while True:
        ra, rb = comp[a], comp[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b = a[apart], b[apart]  # the others are joined for good
        np.minimum.at(comp, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while not np.array_equal(up := comp[comp], comp):
            comp = up
    moved = np.flatnonzero(comp != np.arange(len(nodes)))
    return nodes[moved], nodes[comp[moved]]


def _local_stars(e: DataFrame, parts: int) -> DataFrame:
    """(node, root): every partition's edges contracted to stars; neighbours by range, so that a hub is cut anywhere."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got)
            node, root = _forest(t.column("u").to_numpy(), t.column("v").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["node", "root"])

    kind = e.schema["u"].dataType.simpleString()
    return e.repartitionByRange(parts, "v", "u").mapInArrow(run, f"node {kind}, root {kind}")


def component_roots(edges: DataFrame, src_col: str = "src", dst_col: str = "dst") -> DataFrame:
    """(node, root) for every node that has an edge to another one; root = smallest node of its component."""
    a, b = F.col(src_col), F.col(dst_col)
    e = materialize(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                    "edges")
    contracts = isinstance(e.schema["u"].dataType, T.IntegralType)
    aside = []
    while (n := e.count()) > (LOCAL_EDGES if contracts else 0):
        linked = e
        if contracts:
            local = _local_stars(e, -(-n // LOCAL_EDGES))
            linked = materialize(local.select(F.col("node").alias("u"), F.col("root").alias("v")), "stars")
            drop_materialized(e)
        stars = materialize(_star_round(linked), "edges")
        drop_materialized(linked)
        # a node with one edge that no other edge leads to is settled with that edge's end: only the others go on
        seen = stars.select("u").unionAll(stars.select(F.col("v").alias("u")).distinct())
        busy = seen.groupBy("u").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("u")
        aside.append(stars.join(busy, "u", "left_anti").select(F.col("u").alias("node"), F.col("v").alias("root")))
        e = materialize(stars.join(busy, "u", "left_semi"), "edges")
    labels = materialize(_local_stars(e, 1), "labels") if contracts else e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for leaves in reversed(aside):
        of = labels.select(F.col("node").alias("root"), F.col("root").alias("r"))
        settled = leaves.join(of, "root", "left").select("node", F.coalesce("r", "root").alias("root"))
        labels = labels.unionByName(materialize(settled, "labels"))  # each node's label is written once
    roots = labels.select(F.col("root").alias("node")).distinct()
    return labels.unionByName(roots.withColumn("root", F.col("node")))


def connected_components(nodes: DataFrame, edges: DataFrame, node_col: str = "node", src_col: str = "src",
                         dst_col: str = "dst") -> DataFrame:
    """(node, label) with label = smallest node id in the node's component; nodes without edges label themselves."""
    roots = component_roots(edges, src_col, dst_col)
    return nodes.select(F.col(node_col).alias("node")).join(roots, "node", "left").select(
        F.col("node").alias(node_col), F.coalesce("root", "node").alias("label"))

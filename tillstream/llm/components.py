"""Connected components of a graph held as a table of links, for graphs of any size.

Links are first thinned inside each task to a spanning forest of what the task holds. Then two
steps alternate on checkpointed tables until nothing changes: every node hands its larger
neighbours to its smallest neighbour, and every node hands its smaller-or-equal neighbours to the
smallest of them. Both keep the components and never add links; after a number of rounds that
grows with the logarithm of the size, every node is linked to the smallest node of its component.
Nothing is gathered by node: each step is a minimum per node, reduced before the shuffle, and a
join back, whose hot nodes AQE can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillstream.operators.keyed import same_key
from tillstream.session import run_dir
from tillstream.streaming.runtime import discard


def spanning_forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) equivalent to the given links."""
    nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = flat[:len(left)], flat[len(left):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, least = spanning_forest(batch["node"].to_numpy(), batch["least"].to_numpy())
        yield pa.RecordBatch.from_pydict({"node": node, "least": least})


def _stored(links: DataFrame) -> tuple[DataFrame, str]:
    """The links as a table in the shared folder, and where it is."""
    spark, path = links.sparkSession, run_dir(links.sparkSession, "links")
    links.write.parquet(path)
    return spark.read.schema(links.schema).parquet(path), path


def _to_least(links: DataFrame, both_ways: bool) -> DataFrame:
    """One step: for every node the smallest of itself and its neighbours, handed to them."""
    if both_ways:
        seen = links.unionAll(links.select(F.col("least").alias("node"), F.col("node").alias("least")))
    else:
        seen = links
    least = (seen.groupBy("node").agg(F.min("least").alias("low"))
             .select(F.col("node").alias("hub"), F.least("node", "low").alias("low")))
    told = seen.join(least, same_key(F.col("node"), F.col("hub")))
    if both_ways:  # larger neighbours go to the smallest
        told = told.where("least > node").selectExpr("least AS node", "low AS least")
    else:  # the node itself and its smaller neighbours do
        told = told.selectExpr("explode(array(node, least)) AS node", "low AS least")
    return told.where("node != least").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``least``, the smallest node reachable from it, for each node with a link to
    another one. Columns are longs without nulls."""
    now, path = _stored(links.where(F.col(left) != F.col(right))
                  .select(F.greatest(left, right).alias("node"), F.least(left, right).alias("least"))
                  .mapInArrow(_thinned, "node long, least long").distinct())
    mark = None
    while True:
        before = path
        now, path = _stored(_to_least(_to_least(now, both_ways=True), both_ways=False))
        discard(links.sparkSession, before)  # a round reads nothing but the last round's table
        # Sums of hashes tell whether the set of links is still the same.
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "least").cast("decimal(38,0)")),
                       F.sum(F.xxhash64("least", "node").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now
        mark = tuple(seen)

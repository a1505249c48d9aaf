"""Connected components of an edge table, by alternating star contraction.

Each round links every node's larger neighbours, then its smaller ones, to the least
node it knows. The number of rounds grows with the logarithm of the longest path. No
adjacency list is ever gathered: a round is two minimum aggregations, combined before
the shuffle, and two joins. Rounds are written to the shared folder, so a lost
executor costs at most the round at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import materialize

#: Edges reduced to a spanning forest at a time within a task.
_EDGES_AT_ONCE = 200_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of the input replaced by (node, root), chunk by chunk; keeps what is connected."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= _EDGES_AT_ONCE:
            yield _stars(pd.concat(held))
            held, size = [], 0
    if held:
        yield _stars(pd.concat(held))


def _stars(edges: pd.DataFrame) -> pd.DataFrame:
    nodes, flat = np.unique(edges[["src", "dst"]].to_numpy(np.int64), return_inverse=True)
    a, b = flat.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    kept = root != np.arange(len(nodes))
    return pd.DataFrame({"src": nodes[kept], "dst": nodes[root[kept]]})


def component_ids(edges: DataFrame) -> DataFrame:
    """``node`` and ``component_id``, the least node reachable, for every node of ``edges``.

    ``edges`` has ``src`` and ``dst``, bigint and not null; direction, repeats and
    loops do not matter. Nodes whose only edges are loops are left out.
    """
    stars = edges.select("src", "dst").mapInPandas(_forest, "src bigint, dst bigint")
    stars = materialize(stars.distinct(), "component-edges")
    seen = None
    while True:
        both = stars.unionByName(stars.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("root"))
        large = (
            both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("root").alias("dst"))
        )
        large = large.where("src != dst").distinct()
        down = large.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        low = down.groupBy("src").agg(F.min("dst").alias("root"))
        small = (
            down.join(low, "src")
            .select(F.explode(F.array(F.struct("src", "root"), F.struct(F.col("dst").alias("src"), "root"))).alias("e"))
            .select(F.col("e.src").alias("src"), F.col("e.root").alias("dst"))
        )
        stars = materialize(small.where("src != dst").distinct(), "component-edges")
        state = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            return stars.select(F.col("src").alias("node"), F.col("dst").alias("component_id"))
        seen = state

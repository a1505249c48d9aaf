"""Exact top-k search by a Voronoi join.

Queries and data are grouped by their nearest pivot. Summaries of the groups (radius,
distances of the nearest members to the pivot) bound each query group's k-th best
distance, and the triangle inequality then tells which data a query group can need;
only those are sent to it. Each group is solved in cells of bounded size, and the
cells' best are merged.

The score is an inner product. Vectors get one more component, which brings all data to
the same length; the nearest by distance then has the greatest inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import hash_sample
from quotemill.session import materialize

SCALE = 1024
#: Rows of one cell: queries and data that a task compares.
_QUERY_ROWS = 2048
_DATA_ROWS = 16_384
#: Pivots travel to every task and their pairs are compared on the driver.
_MOST_PIVOTS = 1024
_COMPARED_AT_ONCE = 1 << 22
#: Below it doubles hold whole numbers, with room for rounded lengths.
_EXACT = 2.0**52
_LEAST, _MOST = -(2**63), 2**63 - 1


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vec``: components as floor(1024 * x), for rows that take part.

    Left out are rows with a null id, a null vector, or a vector that holds a null or
    a component that is not finite. Beyond the range of a bigint its ends stand for it.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
        .where(finite)
        .select(F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE)).alias("vec"))
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal length, as integers; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for at, vector in enumerate(vectors):
        out[at, : len(vector)] = vector
    return out


def _lifted(points: np.ndarray, square: float) -> np.ndarray:
    """The added component of data points: what is missing to the common length."""
    return np.sqrt(np.maximum(square - (points * points).sum(axis=1), 0.0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest scores, ties to the smaller id; ``ids`` ascend."""
    if len(scores) > k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= bound)
    else:
        places = np.arange(len(scores))
    return places[np.argsort(-scores[places], kind="stable")[:k]]


def voronoi_top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k greatest inner products.

    ``vectors`` has ``vec_id`` and ``vec`` (array of bigint), as from
    ``integer_vectors``; ``is_query`` is an expression on ``vec_id``. A query's
    candidates are all rows with another id; ties go to the smaller id. Fewer than k
    candidates are all returned; a table without queries gives no rows.

    Vectors of different lengths are compared as if the shorter ended in zeros. A
    repeated id is answered once, for its least vector, while every row stays a
    candidate, so an id may come twice in one result. Scores are exact: where the lengths of
    two vectors show that doubles could round their product, it is formed with integers of
    any size. A score beyond the range of a bigint is ranked as it is and returned as the
    range's end.
    """
    spark = vectors.sparkSession
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    stored = materialize(
        vectors.select("vec_id", "vec", square.alias("square"), is_query.alias("is_query")), "knn-vectors"
    )
    rows, asked, width, longest = stored.agg(
        F.count(F.lit(1)),
        F.count_if("is_query"),
        F.max(F.size("vec")),
        F.max("square"),
    ).first()
    empty = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not asked or rows < 2:
        return spark.createDataFrame([], empty)
    width = max(width, 1)
    # About one group of queries for the square root of their number.
    wanted = min(_MOST_PIVOTS, max(1, math.isqrt(asked)))
    sample = hash_sample(stored.select("vec_id", "vec"), F.col("vec_id"), (2 * wanted + 16) / rows)
    found = sample.toPandas().sort_values("vec_id").drop_duplicates("vec_id")
    pivots = _matrix(found["vec"][:wanted], width).astype(float) if len(found) else np.zeros((1, width))
    pivots = np.unique(pivots, axis=0)
    points = np.column_stack([pivots, _lifted(pivots, longest)])
    across = _distances(points, points)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            whole = _matrix(batch["vec"], width)
            data = whole.astype(float)
            lifted = np.column_stack([data, _lifted(data, longest)])
            asking = np.column_stack([data, np.zeros(len(data))])
            near, far = _distances(lifted, points), _distances(asking, points)
            own, other = near.argmin(axis=1), far.argmin(axis=1)
            at = np.arange(len(data))
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "is_query": batch["is_query"],
                    "v": [row.tobytes() for row in whole.astype(np.int32 if np.abs(data).max(initial=0) < 2**31 else np.int64)],
                    "cell": own,
                    "dist": near[at, own],
                    "query_cell": other,
                    "query_dist": far[at, other],
                }
            )

    schema = "vec_id bigint, is_query boolean, v binary, cell int, dist double, query_cell int, query_dist double"
    assigned = materialize(stored.select("vec_id", "vec", "is_query").mapInPandas(nearest, schema), "knn-assigned")

    # Summaries: per data group its members nearest to the pivot, per query group its radius.
    once = assigned.groupBy("cell", "vec_id").agg(F.min("dist").alias("dist"))
    order = Window.partitionBy("cell").orderBy("dist")
    closest = (
        once.select("cell", "vec_id", "dist", F.row_number().over(order).alias("n")).where(F.col("n") <= k + 1).toPandas()
    )
    sizes = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).toPandas()
    radius = (
        assigned.where("is_query").groupBy("query_cell").agg(F.max("query_dist").alias("radius"), F.count(F.lit(1)).alias("rows")).toPandas()
    )
    slack = 1e-6 * max(1.0, math.sqrt(longest))
    cells, distances = closest["cell"].to_numpy(), closest["dist"].to_numpy()
    _, named = np.unique(closest["vec_id"].to_numpy(np.int64), return_inverse=True)
    groups = radius["query_cell"].to_numpy()
    radii = np.zeros(len(points))
    radii[groups] = radius["radius"]
    members = np.zeros(len(points))
    members[sizes["cell"].to_numpy()] = sizes["rows"]
    low, high = np.full((len(points), len(points)), np.inf), np.full((len(points), len(points)), -np.inf)
    for group in groups:
        # An id that several cells hold counts once; one may be the query's own, hence k + 1.
        nearest_of = np.full(named.max(initial=-1) + 1, np.inf)
        np.minimum.at(nearest_of, named, radii[group] + across[group, cells] + distances)
        reach = np.sort(nearest_of)
        bound = (reach[k] if len(reach) > k else np.inf) + slack
        low[group] = across[group] - radii[group] - bound - slack
        high[group] = across[group] + radii[group] + bound + slack
    bundle_of, bundles = _bundled(groups, radius["rows"].to_numpy(), across)
    # A bundle needs what one of its groups needs.
    low = np.array([low[own].min(axis=0) for own, _ in bundles])
    high = np.array([high[own].max(axis=0) for own, _ in bundles])
    blocks = np.array([-(-rows_ // _QUERY_ROWS) for _, rows_ in bundles])
    sent = np.array([members[lo <= hi].sum() for lo, hi in zip(low, high, strict=True)])
    chunks = np.maximum(1, -(-sent.astype(np.int64) // _DATA_ROWS))
    first = np.concatenate(([0], np.cumsum(blocks * chunks)[:-1]))

    def hashed(ids: np.ndarray) -> np.ndarray:
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(33)).astype(np.int64)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, group = batch["vec_id"].to_numpy(np.int64), bundle_of[batch["query_cell"].to_numpy(np.int64)]
            block = hashed(ids) % blocks[group]
            count = chunks[group]
            at = np.repeat(np.arange(len(ids)), count)
            chunk = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            place = first[group][at] + block[at] * count[at] + chunk
            yield pd.DataFrame({"place": place, "vec_id": ids[at], "v": batch["v"].to_numpy()[at]})

    def offer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, cell = batch["vec_id"].to_numpy(np.int64), batch["cell"].to_numpy(np.int64)
            dist, vectors_ = batch["dist"].to_numpy(), batch["v"].to_numpy()
            spread = hashed(ids)
            for group in range(len(blocks)):
                needed = np.flatnonzero((dist >= low[group, cell]) & (dist <= high[group, cell]))
                for block in range(blocks[group]):
                    place = first[group] + block * chunks[group] + spread[needed] % chunks[group]
                    yield pd.DataFrame({"place": place, "vec_id": ids[needed], "v": vectors_[needed]})

    limbs = ("high", "middle", "low")

    def numbers(values: pd.Series) -> np.ndarray:
        if len({len(v) for v in values}) == 1:
            kind = np.int32 if len(values.iloc[0]) == 4 * width else np.int64
            return np.frombuffer(b"".join(values), kind).reshape(len(values), width).astype(np.int64)
        return np.array([np.frombuffer(v, np.int32 if len(v) == 4 * width else np.int64) for v in values], dtype=np.int64)

    def solve(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "vec_id": [], **{name: [] for name in ("score", *limbs)}}, dtype=np.int64)]
        if len(asking) and len(offered):
            offered = offered.sort_values("vec_id", kind="stable")
            ids, askers = offered["vec_id"].to_numpy(np.int64), asking["vec_id"].to_numpy(np.int64)
            whole, asked_for = numbers(offered["v"]), numbers(asking["v"])
            data, queries = whole.astype(float), asked_for.astype(float)
            reach, span = np.sqrt((data * data).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
            step = max(1, _COMPARED_AT_ONCE // len(ids))
            for at in range(0, len(queries), step):
                scores = queries[at : at + step] @ data.T
                for row, own in enumerate(range(at, min(at + step, len(queries)))):
                    other = ids != askers[own]
                    # No sum within a product exceeds the product of the lengths.
                    rounded = np.flatnonzero(other & (reach * span[own] >= _EXACT))
                    if len(rounded):
                        other[rounded] = False
                    near = np.flatnonzero(other)
                    best = near[_best(scores[row][near], ids[near], k)]
                    ranked = [(-int(scores[row][n]), int(ids[n])) for n in best]
                    if len(rounded):
                        asker = [int(x) for x in asked_for[own]]
                        ranked += [(-sum(a * int(b) for a, b in zip(asker, whole[n], strict=True)), int(ids[n])) for n in rounded]
                        ranked = sorted(ranked)[:k]
                    told = [(max(_LEAST, min(_MOST, -score)), *_in_order(-score)) for score, _ in ranked]
                    parts = {name: [t[n] for t in told] for n, name in enumerate(("score", *limbs))}
                    found.append(
                        pd.DataFrame({"query_id": askers[own], "vec_id": [n for _, n in ranked], **parts}, dtype=np.int64)
                    )
        return pd.concat(found, ignore_index=True)

    # A repeated query id is asked once.
    asked_once = (
        assigned.where("is_query").groupBy("vec_id").agg(F.min(F.struct("v", "query_cell")).alias("q")).select("vec_id", "q.v", "q.query_cell")
    )
    queries = asked_once.mapInPandas(ask, "place bigint, vec_id bigint, v binary")
    data = assigned.select("vec_id", "v", "cell", "dist").mapInPandas(offer, "place bigint, vec_id bigint, v binary")
    local = queries.groupBy("place").cogroup(data.groupBy("place")).applyInPandas(
        solve, "query_id bigint, vec_id bigint, score bigint, high bigint, middle bigint, low bigint"
    )
    ranking = Window.partitionBy("query_id").orderBy(*(F.desc(name) for name in limbs), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _in_order(score: int) -> tuple[int, int, int]:
    """Three bigints whose order is that of scores of any size that bigint vectors can have."""
    return score >> 96, (score >> 48) & (2**48 - 1), score & (2**48 - 1)


def _bundled(groups: np.ndarray, sizes: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, list]:
    """Query groups that lie near each other, put together up to one block of queries.

    Data are sent once to a bundle, not once to each of its groups. Returns the bundle
    of each pivot and, per bundle, its groups and their queries.
    """
    bundle_of, bundles = np.zeros(len(across), np.int64), []
    order = np.argsort(across[groups[0], groups], kind="stable")
    for group, size in zip(groups[order], sizes[order], strict=True):
        if not bundles or bundles[-1][1] + size > _QUERY_ROWS:
            bundles.append(([], 0))
        own, held = bundles[-1]
        bundles[-1] = ([*own, group], held + size)
        bundle_of[group] = len(bundles) - 1
    return bundle_of, bundles


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``a`` to the bounded number of rows of ``b``."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))

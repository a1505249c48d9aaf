"""Centroid clustering by Orchard search.

Each centroid keeps the others in a list sorted by their distance from it. The search
for a vector's nearest centroid starts at some centroid and walks its list; whenever a
closer centroid is found it goes on in that one's list, centroids met before are not
measured again, and it stops as soon as the list is strictly beyond twice the current
distance, since by the triangle inequality nothing nearer can follow. Centroids at
exactly twice the distance can tie, so they are still measured.

Vectors stay in Spark: a round is one pass that assigns every vector and adds up its
components in the task, and one aggregation of a row per task, centroid and component.
Only sums per centroid reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import materialize

#: Centroids and their lists, a square of this side, travel to every task.
MOST_CENTROIDS = 2048
LONGEST = 2**63 - 1
#: Below this size of every component, doubles hold squared distances exactly.
_EXACT = 2.0**52
#: Values searched at a time, in rows times components.
_VALUES_AT_ONCE = 1 << 18
_LIMB = 40


def scaled_vectors(
    vectors: DataFrame, *, scale: int = 64, width: int = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id`` and ``vec``: components as floor(scale * x), whole numbers held as doubles.

    Left out are null vectors, vectors that have not exactly ``width`` components, and
    vectors that hold a null or a component for which scale * x is not finite.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < float("inf")))
    kept = vectors.where((F.size(vector) == width) & finite)

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.floor(_matrix(batch.column(1), width) * scale) + 0.0  # no negative zero
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, width, dtype=np.int32)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["vec_id", "vec"])

    return kept.select(F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("vec")).mapInArrow(
        floored, "vec_id bigint, vec array<double>"
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _whole(values: np.ndarray) -> np.ndarray:
    """Doubles without a fraction as Python integers, exact at any size."""
    return np.array([int(v) for v in values.ravel()], dtype=object).reshape(values.shape)


class Orchard:
    """Centroids, and per centroid all others in the order of their distance from it."""

    def __init__(self, centroids: list[list[int]]):
        self.whole = np.array(centroids, dtype=object).reshape(len(centroids), -1)
        between = [[int(((a - b) ** 2).sum()) for b in self.whole] for a in self.whole]
        self.lists = np.array(
            [sorted((n for n in range(len(row)) if n != own), key=lambda n: (row[n], n)) for own, row in enumerate(between)], dtype=np.int64
        ).reshape(len(between), -1)
        self.small = 4 * self.whole.shape[1] * int(np.abs(self.whole).max(initial=0)) ** 2 < _EXACT
        kind = float if self.small else object
        self.points = self.whole.astype(kind)
        self.far = np.array([[row[n] for n in order] for row, order in zip(between, self.lists, strict=True)], dtype=kind)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid; ties to the smaller number.

        ``vectors`` are doubles without a fraction. Rows so long that doubles could round
        are searched with integers of any size.
        """
        number = np.zeros(len(vectors), dtype=np.int64)
        square = np.zeros(len(vectors), dtype=object)
        longest = np.abs(vectors).max(axis=1, initial=0.0)
        plain = np.full(len(vectors), self.small) & (4 * vectors.shape[1] * longest * longest < _EXACT)
        step = max(1, _VALUES_AT_ONCE // max(1, vectors.shape[1]))
        for rows, convert in ((np.flatnonzero(plain), lambda v: v), (np.flatnonzero(~plain), _whole)):
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                number[part], square[part] = self._search(convert(vectors[part]))
        return number, square

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows walk their lists side by side."""
        whole = vectors.dtype == object
        points, far = (self.whole, self.far.astype(object)) if whole else (self.points, self.far)
        best = np.zeros(len(vectors), dtype=np.int64)
        square = ((vectors - points[0]) ** 2).sum(axis=1)
        visited = np.zeros((len(vectors), len(points)), dtype=bool)
        visited[:, 0] = True
        place = np.zeros(len(vectors), dtype=np.int64)
        rows = np.arange(len(vectors)) if self.lists.shape[1] else np.empty(0, dtype=np.int64)
        while len(rows):
            # Distances are squared: beyond twice the distance is beyond four times the square.
            on = (far[best[rows], place[rows]] <= 4 * square[rows]).astype(bool)
            rows = rows[on]
            other = self.lists[best[rows], place[rows]]
            place[rows] += 1
            fresh = ~visited[rows, other]
            asked, other = rows[fresh], other[fresh]
            visited[asked, other] = True
            reach = ((vectors[asked] - points[other]) ** 2).sum(axis=1)
            closer = ((reach < square[asked]) | ((reach == square[asked]) & (other < best[asked]))).astype(bool)
            moved = asked[closer]
            best[moved], square[moved], place[moved] = other[closer], reach[closer], 0
            rows = rows[place[rows] < self.lists.shape[1]]
        return best, square


def _first_centroids(vectors: DataFrame, count: int, salt: str) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of salt and id; equal ids in the order of their components.

    A null id has no hash and comes last.
    """
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select("vec", order.alias("order")).orderBy(F.col("order").asc_nulls_last(), "vec").limit(count)
    return [[int(x) for x in row.vec] for row in rows.collect()]


def _sums(vectors: DataFrame, orchard: Orchard) -> dict[int, tuple[int, list[int]]]:
    """Members and componentwise sums of each centroid that has members; exact at any size.

    Sums leave a task as limbs of 40 bits, so that decimals hold their totals.
    """
    width = orchard.whole.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = np.zeros(len(orchard.whole), dtype=np.int64)
        totals = np.zeros(orchard.whole.shape, dtype=object)
        for batch in batches:
            values = _matrix(batch.column(0), width)
            number, _ = orchard.nearest(values)
            members += np.bincount(number, minlength=len(members))
            small = np.abs(values).max(axis=1, initial=0.0) * (len(values) + 1) < 2.0**53
            part = np.zeros(orchard.whole.shape)
            np.add.at(part, number[small], values[small])
            totals = totals + _whole(part)
            for row in np.flatnonzero(~small):
                totals[number[row]] = totals[number[row]] + _whole(values[row])
        out = [(int(own), -1, 0, int(members[own])) for own in np.flatnonzero(members)]
        for own in np.flatnonzero(members):
            for at, total in enumerate(totals[own]):
                sign, rest, limb = (-1, -total, 0) if total < 0 else (1, total, 0)
                while rest or not limb:
                    out.append((int(own), at, limb, sign * (rest & ((1 << _LIMB) - 1))))
                    rest, limb = rest >> _LIMB, limb + 1
        columns = [pa.array(column, pa.int64()) for column in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "at", "limb", "total"])

    parts = vectors.select("vec").mapInArrow(add, "cluster bigint, at bigint, limb bigint, total bigint")
    found: dict[int, tuple[int, list[int]]] = {}
    for row in parts.groupBy("cluster", "at", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        count, totals = found.get(row.cluster, (0, [0] * width))
        if row.at < 0:
            count = int(row.total)
        else:
            totals[row.at] += int(row.total) << (_LIMB * row.limb)
        found[row.cluster] = (count, totals)
    return found


def cluster(vectors: DataFrame, *, centroids: int = 16, rounds: int = 3, salt: str = "1") -> DataFrame:
    """Lloyd's rounds from hashed starting vectors: each vector's centroid and distance.

    ``vectors`` has ``vec_id`` and ``vec``, arrays of one length that hold whole numbers, as
    from ``scaled_vectors``. Starts are the ``centroids`` vectors with the smallest hash (all,
    if fewer); a round replaces each centroid that has members by floor(sum / count) of every
    component, and leaves the others as they are. The result has, per vector, ``vec_id``,
    ``cluster`` int, ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances
    summed over the cluster and over all), and ``centroid`` (its components as decimal text,
    joined by commas).

    Distances and sums are computed exactly whatever the size of the components; a value
    beyond a bigint is returned as the largest bigint, so that one very long vector spoils
    neither the clusters nor the other rows. Repeated rows count and come back as often as
    they are there, also as starting vectors; a null id has no hash, so its vector starts
    last. Vectors at the same distance of several centroids go to the smallest number. An
    empty table gives no rows. Other columns are not looked at.
    """
    if not 0 < centroids <= MOST_CENTROIDS:
        raise ValueError(f"between 1 and {MOST_CENTROIDS} centroids can be sent to every task")
    spark = vectors.sparkSession
    stored = materialize(vectors.select("vec_id", "vec"), "cluster-vectors")
    points = _first_centroids(stored, centroids, salt)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid string"
    if not points:
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        for own, (count, totals) in _sums(stored, Orchard(points)).items():
            points[own] = [total // count for total in totals]
    orchard, width = Orchard(points), len(points[0])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, square = orchard.nearest(_matrix(batch.column(1), width))
            longs = pa.array([min(int(s), LONGEST) for s in square], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), longs], names=["vec_id", "cluster", "distance"]
            )

    assigned = materialize(stored.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = min(sum(int(row.total) for row in sums), LONGEST)
    told = spark.createDataFrame(
        [(row.cluster, min(int(row.total), LONGEST), whole, ",".join(map(str, points[row.cluster]))) for row in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid string",
    )
    # One row per centroid, of which there are at most MOST_CENTROIDS.
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

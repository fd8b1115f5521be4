"""Clusters around centroids, in whole numbers: rounds of assignment and averaging, with an equal-average equal-variance search for the nearest."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .job import ship, stored

#: Components beyond this have squared distances that 64 bits don't hold (with 64 of them).
LARGEST = 1 << 27
#: Bounds are taken in floating point and may only reject what is farther beyond any rounding.
_SLACK = 1e-9
_CHUNK = 4096


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and v, the integers floor(scale * x), of the vectors with exactly ``dim`` components, all of them finite numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    of_size = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).where(F.size("x") == dim)
    kept = of_size.where(F.forall("x", fine))
    scaled = F.transform("x", lambda x: F.floor(x * float(scale)))
    too_large = F.exists("x", lambda x: F.abs(x) > LARGEST / scale)
    error = F.raise_error(F.lit(f"a component beyond {LARGEST} after scaling: its squared distances don't fit in 64 bits")).cast("array<bigint>")
    return kept.select("vec_id", F.when(too_large, error).otherwise(scaled).alias("v"))


def first_centroids(whole: DataFrame, k: int = 16, seed: int = 1) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``<seed>:<vec_id>``, or all of fewer: k rows reach the driver. A null id is an empty number; equal ids go by their components."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = whole.select(hashed.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in found], dtype=np.int64) if found else np.zeros((0, 0), np.int64)


class NearestCentroid:
    """The nearest of some centroids for each vector of a block, by squared distance; of equally near ones the one with the smaller number.

    With n components, S their sum and V the root of their squared deviations from the mean, d2(x, c) >= (S_x - S_c)^2 / n + (V_x - V_c)^2. Centroids are in
    order of their sums; from where a vector's own sum belongs the search goes outward, to the closer side first. A centroid whose
    sum alone is too far off ends its side, one whose bound with both terms is above the best distance is passed over, and for the others the distance is
    taken in whole numbers. ``compared`` counts those.
    """

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.centroids, self.sums = centroids[self.number], sums[self.number]
        self.deviation = _deviation(self.centroids)
        self.compared = 0

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the centroid, squared distance) of each row."""
        parts = [self._nearest(x[i : i + _CHUNK]) for i in range(0, len(x), _CHUNK)] or [(np.zeros(0, np.int64),) * 2]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, dim, k = len(x), x.shape[1], len(self.sums)
        total, deviation = x.sum(axis=1), _deviation(x)
        best, chosen = np.full(rows, np.iinfo(np.int64).max), np.full(rows, k)
        up = np.searchsorted(self.sums, total)
        down = up - 1
        # How far off the next sum on either side is; beyond the ends, and on a side that has ended, infinitely.
        ends = np.concatenate([[-np.inf], self.sums.astype(float), [np.inf]])
        above, below = ends[up + 1] - total, total - ends[down + 1]
        active = np.arange(rows)
        while len(active):
            rising = above[active] <= below[active]
            off = np.where(rising, above[active], below[active])
            limit = best[active] * (1 + _SLACK) + 1
            mean_bound = off * off / dim
            going = mean_bound <= limit
            active, rising, mean_bound, limit = active[going], rising[going], mean_bound[going], limit[going]
            at = np.where(rising, up[active], down[active])
            near = mean_bound * (1 - _SLACK) + (deviation[active] - self.deviation[at]) ** 2 * (1 - _SLACK) <= limit
            who, which = active[near], at[near]
            self.compared += len(who)
            distance = ((x[who] - self.centroids[which]) ** 2).sum(axis=1)
            number = self.number[which]
            better = (distance < best[who]) | ((distance == best[who]) & (number < chosen[who]))
            best[who[better]], chosen[who[better]] = distance[better], number[better]
            one, other = active[rising], active[~rising]
            up[one] += 1
            above[one] = ends[up[one] + 1] - total[one]
            down[other] -= 1
            below[other] = total[other] - ends[down[other] + 1]
        return chosen, best


def _deviation(x: np.ndarray) -> np.ndarray:
    y = x.astype(float)
    return np.sqrt(((y - y.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))


def _blocks(whole: DataFrame, run: Callable[[pa.RecordBatch, np.ndarray], Iterator[pa.RecordBatch]], dim: int, schema: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from run(batch, np.asarray(batch.column(1).flatten()).reshape(-1, dim))

    return whole.mapInArrow(each, schema)


def _sums(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, place, total, vectors): the sum of each component in each cluster, added up in the tasks first."""
    k, dim = centroids.shape

    def run(batch: pa.RecordBatch, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        chosen, _ = NearestCentroid(centroids)(x)
        order = np.argsort(chosen, kind="stable")
        there, first, count = np.unique(chosen[order], return_index=True, return_counts=True)
        total = np.add.reduceat(x[order], first, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(list(total), pa.list_(pa.int64())), pa.array(count)], names=["cluster", "total", "vectors"])

    found = _blocks(whole, run, dim, "cluster int, total array<long>, vectors long")
    placed = found.select("cluster", "vectors", F.posexplode("total").alias("place", "part"))
    return placed.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("vectors").alias("vectors"))


def moved(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor of the mean of each one's vectors, by component; one without vectors stays. k * dim numbers reach the driver."""
    out = centroids.copy()
    for r in _sums(whole, centroids).collect():
        out[r.cluster, r.place] = int(r.total) // r.vectors
    return out


def centroids_of(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, scale: int = 64) -> tuple[DataFrame, np.ndarray]:
    """The whole-number vectors, stored, and the centroids after some rounds."""
    ship(vectors.sparkSession)
    whole = stored(whole_vectors(vectors, id_col, vector_col, dim, scale))
    centroids = first_centroids(whole, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(whole, centroids)
        if (after == centroids).all():
            break
        centroids = after
    return whole, centroids


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, scale: int = 64
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid (its components) of every vector that ``whole_vectors`` keeps.

    Vectors that are null, of another size, or with a component that is null or not finite are left out; repeated rows count as often as they are there;
    other columns aren't read. Fewer vectors than k make as many centroids; none at all give no rows. A component that is too large for
    64-bit distances (LARGEST) is an error.

    Each round reads the vectors once; a task sends one row for each batch and cluster, and the driver holds k centroids. They reach the tasks with the
    function: k * dim numbers, whatever the data.
    """
    spark = vectors.sparkSession
    whole, centroids = centroids_of(vectors, k, rounds, seed, id_col, vector_col, dim, scale)
    id_type = whole.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")

    def run(batch: pa.RecordBatch, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        chosen, distance = NearestCentroid(centroids)(x)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = stored(_blocks(whole, run, dim, f"vec_id {id_type}, cluster int, distance long"))
    inertia = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(n, inertia.get(n, 0), sum(inertia.values()), c.tolist()) for n, c in enumerate(centroids)]
    # k rows.
    shown = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(shown), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def duckdb_sql(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1) -> str:
    """The query in DuckDB: distances to all centroids, by joins on the place of a component; every round written out."""
    assign = lambda n: f"""d{n} AS MATERIALIZED (SELECT x.row, c.number, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM e x JOIN c{n} c USING (place) GROUP BY 1, 2),
a{n} AS MATERIALIZED (SELECT row, arg_min(number, d * 1000 + number) AS number, min(d) AS d FROM d{n} GROUP BY 1)"""  # noqa: E731
    step = lambda n: f"""{assign(n)},
m{n} AS (SELECT a.number, e.place, sum(e.v) AS total, count(*) AS n FROM a{n} a JOIN e USING (row) GROUP BY 1, 2),
c{n + 1} AS MATERIALIZED (SELECT number, place, coalesce((total - ((total % n) + n) % n) // n, c.v) AS v FROM c{n} c LEFT JOIN m{n} USING (number, place))"""  # noqa: E731
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dim} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
e AS MATERIALIZED (SELECT row, unnest(range({dim})) AS place, floor(unnest(embedding)::DOUBLE * {scale})::BIGINT AS v FROM w),
o AS (SELECT row, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR)) - 1 AS number FROM w QUALIFY number < {k}),
c0 AS MATERIALIZED (SELECT number, place, v FROM o JOIN e USING (row)),
{", ".join(step(n) for n in range(rounds))},
{assign(rounds)},
s AS (SELECT number, sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{rounds} GROUP BY 1)
SELECT vec_id, number::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY number))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN w USING (row) JOIN s USING (number)
"""

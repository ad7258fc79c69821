"""Centroid clustering on integer vectors with geometrically tightened lower bounds.

Each round assigns every vector to its nearest centroid and moves the centroids to the floor of their members' means. A
vector keeps, for every centroid, a lower bound on its distance. When centroid j moves from a to b, the plain rule loosens
the bound to j by the whole drift |a - b|. Here all members of a cluster lie in the sphere around its old centroid, and in
the plane through that sphere's middle and the line a-b the loss is bounded by the angle under which the sphere is seen
from the middle of a and b: a point at angle w from the direction of the move loses at most |a - b| cos w. A vector whose
distance to its own centroid, computed exactly, is below all other bounds stays; all others are scanned exactly.

All distances are exact integers: float64 products are used only where every term stays below 2**53.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lossgrid.llm.common import written

CLUSTERS, DIMS, ROUNDS, SCALE, SALT = 16, 64, 3, 64, "1:"
#: Components beyond this have no distance that fits a long.
LARGEST = 1 << 27
#: Bounds are moved by this share to the safe side of rounding.
SLACK = 1e-6
STATE = "vec_id bigint, q array<int>, cluster int, distance bigint, lower array<float>, scans int"


def lattice(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): vectors of ``dims`` finite components as integers floor(scale * x); all other rows take no part."""
    whole = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("x"))
    whole = whole.where(f"size(x) = {dims} and forall(x, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))")
    large = "cast(raise_error('a component is too large for distances of 64 bits') as int)"
    return whole.select("vec_id", F.expr(f"transform(x, v -> if(abs(v * {scale}) < {LARGEST}, cast(floor(v * {scale}) as int), {large}))").alias("q"))


def squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, centers), both int64."""
    top = max(np.abs(x).max(initial=0), np.abs(centers).max(initial=0))
    if 4 * int(top) * int(top) * x.shape[1] < 1 << 53:
        a, b = x.astype(np.float64), centers.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For members of each old cluster (row), how much closer each moved centroid (column) can be at most.

    ``radius[i]`` bounds the distance of the members of cluster i to ``old[i]``. Points p with |p - a| - |p - b| >= t lie
    within the asymptotes of a hyperbola with foci a and b, whose angle from the direction of the move has cosine t / |a - b|.
    So the loss is at most |a - b| times the cosine of the smallest angle at which the sphere is seen, and never above the drift.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    move = new - old
    drift = np.sqrt((move * move).sum(axis=1))
    rest = old[:, None, :] - (old + new)[None, :, :] / 2  # from the middle of a and b to each sphere
    away = np.sqrt((rest * rest).sum(axis=2))
    along = np.einsum("ijd,jd->ij", rest, move)
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip(along / (away * drift[None, :]), -1, 1))
        seen = np.arcsin(np.clip(radius[:, None] / away, 0, 1))
    nearest = np.where(away > radius[:, None], np.maximum(angle - seen - SLACK, 0), 0.0)
    cosine = np.maximum(np.cos(np.nan_to_num(nearest)), 0)
    return drift[None, :] * np.minimum(cosine + SLACK, 1) * (1 + SLACK)


def _down(values: np.ndarray) -> np.ndarray:
    """float32 not above the values."""
    return np.maximum(values * (1 - SLACK), 0).astype(np.float32)


def assign(x: np.ndarray, centers: np.ndarray, cluster: np.ndarray | None, lower: np.ndarray | None, loose: np.ndarray | None):
    """(cluster, exact squared distance, lower bounds, which vectors were scanned) for one block of vectors."""
    n = len(x)
    if cluster is None:
        cluster, lower = np.zeros(n, np.int32), np.zeros((n, len(centers)), np.float32)
        own, doubt = np.zeros(n, np.int64), np.ones(n, bool)
    else:
        own = ((x - centers[cluster]) ** 2).sum(axis=1)
        lower = _down(lower - loose[cluster])
        at = np.arange(n)
        lower[at, cluster] = np.inf
        doubt = lower.min(axis=1) <= np.sqrt(own) * (1 + SLACK)
        lower[at, cluster] = _down(np.sqrt(own))
    rows = np.flatnonzero(doubt)
    if len(rows):
        exact = squared(x[rows], centers)
        cluster, own = cluster.copy(), own.copy()
        cluster[rows] = exact.argmin(axis=1)
        own[rows] = exact[np.arange(len(rows)), cluster[rows]]
        lower[rows] = _down(np.sqrt(exact))
    return cluster, own, lower, doubt


def _pass(centers: np.ndarray, loose: np.ndarray | None):
    k, dims = centers.shape

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, dims)
            if loose is None:
                cluster, own, lower, doubt = assign(x, centers, None, None, None)
                scans = np.ones(n, np.int32)
            else:
                before = batch.column("lower").flatten().to_numpy(zero_copy_only=False).reshape(n, k)
                cluster, own, lower, doubt = assign(x, centers, batch.column("cluster").to_numpy(), before, loose)
                scans = batch.column("scans").to_numpy() + doubt.astype(np.int32)
            arrays = [
                batch.column("vec_id"), pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dims, pa.array(x.ravel(), pa.int32())), pa.array(cluster, pa.int32()),
                pa.array(own, pa.int64()), pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * k, pa.array(lower.ravel(), pa.float32())), pa.array(scans, pa.int32()),
            ]
            yield pa.record_batch(arrays, names=["vec_id", "q", "cluster", "distance", "lower", "scans"])

    return run


def clusters(points: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """(state of every vector, final centroids) for rows (vec_id, q) of equal length.

    The first centroids are the k vectors with the smallest sha256 of salt and vec_id; null ids come last, ties go by
    components. Ties of distance go to the smaller number; an empty cluster keeps its centroid. The state holds the cluster,
    the squared distance and how often a vector was scanned. Centroids, sums and radii are k rows each, whatever the input.
    """
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(digest.asc_nulls_last(), "q").limit(k).select("q").collect()
    centers = np.array([row.q for row in first], np.int64)
    if not len(centers):
        return points.sparkSession.createDataFrame([], STATE), centers
    dims = centers.shape[1]
    state = written(points.mapInArrow(_pass(centers, None), STATE))
    for _ in range(rounds):
        sums = [F.sum(F.col("q")[i].cast("bigint")).alias(f"s{i}") for i in range(dims)]
        stats = state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("distance").alias("far"), *sums).collect()
        moved, radius = centers.copy(), np.zeros(len(centers))
        for row in stats:
            moved[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
            radius[row.cluster] = np.sqrt(row.far) * (1 + SLACK)
        loose = loosening(centers, moved, radius)
        centers = moved
        state = written(state.mapInArrow(_pass(centers, loose), STATE))
    return state, centers


def op12(vectors: DataFrame) -> DataFrame:
    """Cluster and inertia of every vector that takes part, with the digest of its final centroid.

    Rows whose vector is null, has not 64 components or holds a null or non-finite one take no part. A null vec_id takes
    part as any row, repeated rows each count; other columns are not read. Fewer than 16 rows give as many clusters, none
    an empty result. A component beyond 2**21 raises, since squared distances would not fit a long.
    """
    state, centers = clusters(lattice(vectors))
    result = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centers):
        return vectors.sparkSession.createDataFrame([], result)
    sums = {row.cluster: row.s for row in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    each = F.array(*[F.lit(sums.get(i, 0)).cast("bigint") for i in range(len(centers))])
    names = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centers.tolist()])
    return state.select(
        "vec_id", "cluster", "distance", F.element_at(each, F.col("cluster") + 1).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"), F.element_at(names, F.col("cluster") + 1).alias("centroid_sha256"),
    )


def _sql() -> str:
    steps = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q, row_number() OVER () AS row_id
FROM embeddings WHERE len(embedding) = {DIMS} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{SALT}' || vec_id) NULLS LAST, q) - 1 AS INTEGER) AS cluster, q AS center
FROM kept QUALIFY row_number() OVER (ORDER BY sha256('{SALT}' || vec_id) NULLS LAST, q) <= {CLUSTERS})""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS (SELECT row_id, q, vec_id, cluster, center, d FROM (
SELECT k.row_id, k.q, k.vec_id, c.cluster, c.center, CAST(list_sum(list_transform(list_zip(k.q, c.center), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
FROM kept k CROSS JOIN c{i} c) QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d, cluster) = 1)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS center FROM (
SELECT cluster, place, CAST(sum(v) AS BIGINT) AS s, CAST(count(*) AS BIGINT) AS n FROM (SELECT cluster, unnest(q) AS v, generate_subscripts(q, 1) AS place FROM a{i}) GROUP BY cluster, place) GROUP BY cluster)""")
            steps.append(f"c{i + 1} AS (SELECT c.cluster, coalesce(m.center, c.center) AS center FROM c{i} c LEFT JOIN m{i} m USING (cluster))")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(center, ',')) AS centroid_sha256 FROM a{ROUNDS}"""


SQL_OP12 = _sql()

"""Centroid clustering with an incremental distance matrix in whole numbers.

Each vector keeps the exact dot products of its components, floor(scale x), with all centroids. When centroids move, the
products change by the products with the differences alone, and of a difference only the components that are not zero are
multiplied; a centroid that stays costs nothing. The nearest centroid is then the least of |c|^2 - 2 c.v. A round is one pass
over the stored matrix, rewritten in the shared folder, and one pass that adds up the vectors of each cluster; the driver holds
``k`` centroids.

A vector that is null, holds a null or non-finite component or has another number of components than ``width`` takes no part
and is not in the result. Rows that repeat a vec_id count each; a null vec_id counts as an empty string where the first
centroids are picked. Of equal hashes the smaller vector comes first. With fewer than ``k`` vectors there are as many
centroids. A component whose distances could leave 64 bits (741,455 and more with the defaults) is held at that bound. Totals
beyond 64 bits are the largest long. No other column is read. An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import job
from .vectors import LONG_MAX, group_sums, largest, matrix, pieces, takes_part, whole

SCHEMA = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def update(dots: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Adds to ``dots`` the products with the changes of the centroids, skipping components that did not change."""
    columns = np.ascontiguousarray(vectors.T)
    for j in np.flatnonzero(change.any(axis=1)):
        moved = np.flatnonzero(change[j])
        dots[:, j] += change[j, moved] @ columns[moved]
    return dots


def assign(dots: np.ndarray, vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller of equals, and the squared distance."""
    rest = (centroids * centroids).sum(axis=1)[None, :] - 2 * dots
    nearest = rest.argmin(axis=1)
    return nearest, rest[np.arange(len(rest)), nearest] + (vectors * vectors).sum(axis=1)


def _moved(state: DataFrame, centroids: np.ndarray, change: np.ndarray) -> DataFrame:
    k, width = centroids.shape

    def run(batches):
        for batch in pieces(batches):
            vectors = matrix(batch.column(1), width, np.int64)
            dots = update(matrix(batch.column(2), k, np.int64), vectors, change)
            nearest, distance = assign(dots, vectors, centroids)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(dots.ravel()), k).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), flat, pa.array(nearest.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "vec", "dots", "cluster", "distance"],
            )

    return state.select("vec_id", "vec", "dots").mapInArrow(
        run, "vec_id bigint, vec array<bigint>, dots array<bigint>, cluster int, distance bigint"
    )


def cluster(
    vectors: DataFrame, *, k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, salt: str = "2",
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector."""
    spark = vectors.sparkSession
    stages = job(spark, "centroids")
    rows = vectors.filter(takes_part(F.col(vector)) & (F.size(vector) == width)).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), whole(F.col(vector), scale, largest(width)).alias("vec"),
        F.array().cast("array<bigint>").alias("dots"),
    )
    state = stages.keep("state", rows)
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.orderBy(order, "vec").limit(k).select("vec").collect()
    if not first:
        return spark.createDataFrame([], SCHEMA)
    new = np.array([r["vec"] for r in first], dtype=np.int64)
    old = np.zeros_like(new)
    for step in range(rounds + 1):
        # The first products are the change from centroids at zero.
        if step and not (new != old).any():
            break
        state = stages.keep("state", _moved(state, new, new - old))
        if step == rounds:
            break
        sums = group_sums(
            state.select("cluster", "vec"), len(new), width, lambda b: (b.column(0).to_numpy(), matrix(b.column(1), width, np.int64))
        )
        old = new
        new = old.copy()
        for j, (n, total) in sums.items():
            new[j] = [x // n for x in total]
    found = state.select("vec_id", "cluster", "distance")
    within = {
        r["cluster"]: int(r["total"])
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    used, whole_sum = sorted(within), min(sum(within.values()), LONG_MAX)
    facts = spark.createDataFrame(pa.table({
        "cluster": pa.array(used, pa.int32()),
        "cluster_inertia": pa.array([min(within[j], LONG_MAX) for j in used], pa.int64()),
        "inertia": pa.array([whole_sum] * len(used), pa.int64()),
        "centroid_sha256": pa.array([sha256(",".join(map(str, new[j].tolist())).encode()).hexdigest() for j in used], pa.string()),
    }))
    # At most k rows.
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(k: int = 40, rounds: int = 5, width: int = 64, scale: int = 256, salt: str = "2") -> str:
    """The same in DuckDB's SQL, with plain distances, for vec_ids that do not repeat."""
    steps = [
        f"v as materialized (select vec_id, [floor({scale} * x::double) for x in embedding] as vec from embeddings where len(embedding) = {width} "
        "and len([x for x in embedding if x is null or not isfinite(x)]) = 0)",
        f"c0 as materialized (select row_number() over (order by sha256('{salt}:' || vec_id)) - 1 as cluster, vec from v "
        f"order by cluster limit {k})",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} as materialized (select vec_id, v.vec, arg_min(cluster, (d, cluster)) as cluster, min(d)::bigint as distance from (select v.vec_id, v.vec, "
            "c.cluster, list_inner_product(v.vec, v.vec) + list_inner_product(c.vec, c.vec) - 2 * list_inner_product(v.vec, c.vec) as d "
            f"from v cross join c{r} c) v group by all)"
        )
        if r < rounds:
            steps += [
                f"p{r} as (select cluster, generate_subscripts(vec, 1) as place, unnest(vec)::hugeint as x from a{r})",
                f"s{r} as (select cluster, place, sum(x)::hugeint as s, count(*) as n from p{r} group by all)",
                f"m{r} as (select cluster, list(((s - ((s % n) + n) % n) // n)::double order by place) as vec from s{r} group by cluster)",
                f"c{r + 1} as materialized (select c.cluster, coalesce(m.vec, c.vec) as vec from c{r} c left join m{r} m using (cluster))",
            ]
    return (
        f"with {', '.join(steps)} select a.vec_id, a.cluster::int as cluster, a.distance, "
        "(sum(a.distance) over (partition by a.cluster))::bigint as cluster_inertia, (sum(a.distance) over ())::bigint as inertia, "
        "sha256(array_to_string([x::bigint for x in c.vec], ',')) as centroid_sha256 "
        f"from a{rounds} a join c{rounds} c using (cluster)"
    )

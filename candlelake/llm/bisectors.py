"""Centroid clustering in integers; a tournament of bisectors finds the nearest centroid.

For centroids ``a`` before ``b`` the plane half way between them has the normal ``2 (b - a)`` and the threshold
``|b|^2 - |a|^2``; both are integers. ``normal . x - threshold`` is positive exactly if ``b`` is nearer to ``x``, and zero for a tie, which the
smaller number wins. So a vector meets the centroids in turn, each time the winner so far against the next one: ``k - 1`` linear tests
and no distance. One exact distance follows, to the final winner. All sums are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.stages import drop, stage

SIZE, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
# components up to which all tests and distances of SIZE components fit 64 bits
LARGEST = 1 << 27
_ROWS = 4096


def integers(table: DataFrame, id_column: str, vector_column: str, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """``vec_id, vec``: vectors of exactly ``size`` components, none null or non-finite, as ``floor(scale * x)``.

    A row per such row: repeated ids and repeated vectors all count, and so do rows without an id. A component beyond
    ``LARGEST`` has no exact distance in 64 bits; the job then fails with that reason, for a wrong distance would be worse.
    """
    raw = F.col(vector_column).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    reason = F.lit(f"a component times {scale} exceeds {LARGEST}: its distances do not fit 64 bits")
    whole = lambda x: F.when(F.abs(x * scale) <= LARGEST, F.floor(x * scale)).otherwise(F.raise_error(reason).cast("long"))
    return (
        table.select(F.col(id_column).cast("long").alias("vec_id"), raw.alias("vec"))
        .where(F.when(F.size("vec") == size, finite).otherwise(F.lit(False)))
        .select("vec_id", F.transform("vec", whole).alias("vec"))
    )


class Tournament:
    """Normals and thresholds of all pairs of centroids, and the tests."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, np.int64)
        squares = (self.centroids * self.centroids).sum(1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        best = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", self.normals[best, rival], vectors) - self.thresholds[best, rival]
            best[side > 0] = rival
        return best

    def distances(self, vectors: np.ndarray, winners: np.ndarray) -> np.ndarray:
        apart = vectors - self.centroids[winners]
        return np.einsum("ij,ij->i", apart, apart)


def _blocks(batches, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            part = batch.slice(low, _ROWS)
            yield part["vec_id"], np.asarray(part["vec"].flatten(), np.int64).reshape(-1, size)


def starts(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors (all, if fewer) of the least SHA-256 of ``<seed>:<vec_id>``; of equal ids the least vectors. Rows without an id start no cluster."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    named = vectors.where("vec_id is not null").select(key.alias("key"), "vec")
    return [list(r["vec"]) for r in named.orderBy("key", "vec").limit(k).collect()]


def _moved(vectors: DataFrame, centroids: list[list[int]], size: int) -> list[list[int]]:
    """Centroids of the next round. A task sends one row per cluster and component, and Spark adds them up."""
    send = vectors.sparkSession.sparkContext.broadcast(centroids)

    def add_up(batches):
        tournament = Tournament(send.value)
        k = len(tournament.centroids)
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for _, found in _blocks(batches, size):
            best = tournament.winners(found)
            np.add.at(sums, best, found)
            counts += np.bincount(best, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, size), pa.int32()),
                pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
                pa.array(sums[used].ravel(), pa.int64()),
                pa.array(np.repeat(counts[used], size), pa.int64()),
            ],
            names=["cluster", "place", "total", "n"],
        )

    parts_ = vectors.mapInArrow(add_up, "cluster int, place int, total long, n long")
    # k * size rows at most
    totals = parts_.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    moved = [list(c) for c in centroids]
    for r in totals:
        moved[r["cluster"]][r["place"]] = r["total"] // r["n"]
    return moved


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every row of ``vectors`` (as ``integers`` gives them), and the final centroids.

    Each round assigns every vector to its nearest centroid (the smaller number at ties) and replaces every non-empty centroid by the floors of
    its vectors' component means; vectors are assigned once more at the end. Without a vector that has an id there are no
    centroids: ``cluster`` and ``distance`` are null then. An empty table gives no rows.
    """
    held = stage(vectors.select("vec_id", "vec"), "integers")
    centroids = starts(held, k, seed)
    schema = "vec_id long, cluster int, distance long"
    if not centroids:
        return held.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = _moved(held, centroids, size)
    send = vectors.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches):
        tournament = Tournament(send.value)
        for ids, found in _blocks(batches, size):
            best = tournament.winners(found)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(best, pa.int32()), pa.array(tournament.distances(found, best), pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    assigned = stage(held.mapInArrow(assign, schema), "clusters")
    drop(held)
    return assigned, centroids


def report(table: DataFrame) -> DataFrame:
    """Clusters of a table of ``vec_id, embedding``, with the inertia of each cluster and of all, and a digest of each centroid."""
    assigned, centroids = cluster(integers(table, "vec_id", "embedding"))
    spark = table.sparkSession
    # a row per cluster
    wide = F.sum(F.col("distance").cast("decimal(20,0)"))
    inertia = {r["cluster"]: int(r["inertia"]) for r in assigned.where("cluster is not null").groupBy("cluster").agg(wide.alias("inertia")).collect()}
    total = sum(inertia.values())
    rows = [
        (i, own, total, hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()) for i, own in inertia.items()
    ]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle(k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE, scale: int = SCALE) -> str:
    """The same clusters by all distances, in SQL; round ``i`` is ``nearest_i`` and ``centroids_(i + 1)``."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        nearest_{i} AS MATERIALIZED (
            SELECT row, min({{'d': distance, 'cluster': cluster}}) AS best FROM (
                SELECT v.row, c.cluster,
                    list_sum([(v.vec[p] - c.vec[p]) * (v.vec[p] - c.vec[p]) FOR p IN range(1, {size} + 1)])::BIGINT AS distance
                FROM vectors v CROSS JOIN centroids_{i} c
            ) GROUP BY row
        )""")
        if i < rounds:
            steps.append(f"""
        centroids_{i + 1} AS MATERIALIZED (
            SELECT c.cluster, coalesce(m.vec, c.vec) AS vec FROM centroids_{i} c LEFT JOIN (
                SELECT cluster, list(mean ORDER BY p) AS vec FROM (
                    SELECT cluster, p, ((total - ((total % n) + n) % n) // n)::BIGINT AS mean FROM (
                        SELECT n.best.cluster AS cluster, p, sum(v.vec[p]) AS total, count(*) AS n
                        FROM nearest_{i} n JOIN vectors v USING (row), range(1, {size} + 1) AS places(p)
                        GROUP BY 1, 2
                    )
                ) GROUP BY cluster
            ) m USING (cluster)
        )""")
    return f"""
        WITH vectors AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec
            FROM embeddings
            WHERE len(embedding) = {size} AND len([x FOR x IN embedding IF isfinite(x)]) = {size}
        ),
        centroids_0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1)::INT AS cluster, vec
            FROM vectors QUALIFY cluster < {k}
        ),{",".join(steps)}
        SELECT v.vec_id, n.best.cluster AS cluster, n.best.d AS distance,
            (sum(n.best.d) OVER (PARTITION BY n.best.cluster))::BIGINT AS cluster_inertia,
            (sum(n.best.d) OVER ())::BIGINT AS inertia,
            sha256(array_to_string(c.vec, ',')) AS centroid_sha256
        FROM nearest_{rounds} n JOIN vectors v USING (row) JOIN centroids_{rounds} c ON c.cluster = n.best.cluster
    """

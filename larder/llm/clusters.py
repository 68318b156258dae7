"""Centroid clustering in whole numbers, all of it as JVM expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import written
from larder.llm.vectors import floor_mean, vectors, whole

CLUSTERS, ROUNDS, SCALE, DIMENSIONS, SEED = 8, 10, 1024, 64, 3

Centroids = list[list[int]]


def seeds(rows: DataFrame, k: int, seed: int) -> Centroids:
    """The ``k`` vectors whose ids have the smallest hashes, in that order; null ids come last, equal ones by components."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    order = [F.col("mark").asc_nulls_last(), "v"]
    least = rows.select(mark.alias("mark"), "v").orderBy(*order).limit(k)
    return [r.v for r in least.orderBy(*order).collect()]  # k rows at most


def nearest(vector: Column, centroids: Centroids) -> Column:
    """The struct (distance, cluster) of the nearest centroid; of equally near ones the first."""

    def distance(centroid: list[int]) -> Column:
        point = F.expr(f"array({', '.join(f'{x}L' for x in centroid)})")  # one expression: a call for each number takes long
        squares = F.zip_with(vector, point, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, x: total + x)

    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(i).alias("cluster")) for i, c in enumerate(centroids)]))


def next_centroids(rows: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid as the componentwise floored mean of its vectors; one without vectors stays.

    Sums are plain column sums, added up in every task first, so a shuffle has one row for each task and cluster.
    """
    placed = rows.select("v", nearest(F.col("v"), centroids).alias("near"))
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    after = list(centroids)
    for r in placed.groupBy(F.col("near.cluster").alias("cluster")).agg(F.count("*").alias("n"), *sums).collect():  # k rows
        after[r.cluster] = floor_mean((r[f"s{i}"] for i in range(len(sums))), r.n)
    return after


def clusters(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, distance) of every vector and the centroids, after ``rounds`` rounds over all vectors.

    Vectors that are null, have another number of components than ``dimensions`` or a null, NaN or infinite one go. Null ids
    stay; repeated rows count as often as they occur. With fewer vectors than ``k`` there are fewer clusters; an empty table
    gives no rows. Other columns are not looked at. A component of more than 2^26 steps ends the job with an error.
    """
    named = df.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"))
    rows = vectors(named, "_id", "_v").where(F.size("v") == dimensions).withColumn("v", whole("v", scale))
    centroids = seeds(rows, k, seed)
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)
    near = rows.select("vec_id", nearest(F.col("v"), centroids).alias("near"))
    return near.select("vec_id", "near.cluster", "near.distance"), centroids


def cluster_digests(df: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia (distances summed over the cluster and over all), centroid_sha256."""
    placed, centroids = clusters(df, **options)
    rows = written(placed, "clusters")
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        listed = F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array(F.lit(None).cast(kind))
        return F.get(listed, F.col("cluster"))

    return rows.select(
        "vec_id", "cluster", "distance", of_cluster([sums.get(i, 0) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"), of_cluster(digests, "string").alias("centroid_sha256"),
    )

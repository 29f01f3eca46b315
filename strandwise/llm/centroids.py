"""Centroid clustering in integers, with JVM expressions.

Vectors of DIMENSIONS finite components become arrays of floor(SCALE * x). Each
round gives every vector to the nearest centroid, the least of a few structs of
(squared distance, number) where the distances come from zip_with and aggregate
over literal arrays; then a sum for each component and cluster moves the
centroids, by exact floor division. What comes to the driver is one row of sums
for each centroid; the vectors stay where they are, in a table written once.

Defined results: vectors that are null, of another length, or with a component
that is null or not finite take no part; with fewer vectors than centroids each
starts one; a null vec_id starts last, and of equal ids the smaller vector first;
repeated rows are rows of their own; without vectors there are no rows; a
distance that passes 64 bits is an error, not a wrong number; other columns
aren't read, so their names are free.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_position, materialise, table

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, "3"


def _literal(centroid: list[int]) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in centroid])


def nearest(vector: str, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid, the smaller number on ties."""

    def to(k: int, centroid: list[int]) -> Column:
        squares = F.zip_with(vector, _literal(centroid), lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(squares, F.lit(0).cast("long"), lambda s, x: s + x).alias("distance"), F.lit(k).alias("cluster"))

    return F.array_min(F.array(*[to(k, c) for k, c in enumerate(centroids)]))


def kept_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, x (array of long) of the rows that take part."""
    plain, (of, at) = by_position(rows, vec_id, vector)
    finite = F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = plain.where((F.size(at) == dimensions) & finite)
    return kept.select(F.col(of).alias("vec_id"), F.transform(at, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("x"))


def _moved(assigned: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; an empty one stays."""
    dimensions = len(centroids[0])
    sums = assigned.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"x{i}") for i in range(dimensions)])
    out = list(centroids)
    for r in sums.collect():  # a row for each centroid
        out[r["cluster"]] = [r[f"x{i}"] // r["n"] for i in range(dimensions)]
    return out


def cluster(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each
    vector that takes part, and the final centroids."""
    held = materialise(kept_vectors(rows, vec_id, vector, dimensions))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    at = [list(r["x"]) for r in held.select("x", drawn.alias("drawn")).orderBy(F.asc_nulls_last("drawn"), "x").limit(centroids).collect()]
    empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not at:
        return rows.sparkSession.createDataFrame([], empty), []
    for _ in range(rounds):
        at = _moved(held.select("x", nearest("x", at)["cluster"].alias("cluster")), at)
    near = nearest("x", at)
    final = materialise(held.select(F.col("vec_id").cast("long").alias("vec_id"), near["cluster"].alias("cluster"), near["distance"].alias("distance")))
    of = dict.fromkeys(range(len(at)), 0) | {r["cluster"]: r["d"] for r in final.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    inertia = F.get(F.array(*[F.lit(of[k]).cast("long") for k in range(len(at))]), F.col("cluster"))
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("cluster"))
    out = final.select("vec_id", "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(sum(of.values())).cast("long").alias("inertia"), name.alias("centroid_sha256"))
    return out, at


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))[0]


def op12_sql() -> str:
    """A pair of queries for each round: the nearest centroid, then the floor of the means."""
    distance = "list_sum(list_transform(range(1, {n} + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT".format(n=DIMENSIONS)
    rounds = []
    for k in range(ROUNDS + 1):
        rounds.append(f"a{k} AS MATERIALIZED (SELECT rid, vec_id, x, cluster, d FROM (SELECT v.*, c.cluster, {distance} AS d, row_number() OVER (PARTITION BY v.rid ORDER BY {distance}, c.cluster) AS nth FROM v, c{k} c) WHERE nth = 1)")
        if k < ROUNDS:
            rounds.append(f"m{k} AS MATERIALIZED (SELECT cluster, list(m ORDER BY i) AS x FROM (SELECT cluster, i, floor_div(sum(x)::HUGEINT, count(*)) AS m FROM (SELECT cluster, unnest(x) AS x, unnest(range({DIMENSIONS})) AS i FROM a{k}) GROUP BY cluster, i) GROUP BY cluster)".replace("floor_div(sum(x)::HUGEINT, count(*))", "((sum(x)::HUGEINT - ((sum(x)::HUGEINT % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"))
            rounds.append(f"c{k + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON m.cluster = c.cluster)")
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR), x) - 1 AS cluster, x FROM v QUALIFY cluster < {CENTROIDS}),
{", ".join(rounds)},
h AS (SELECT cluster, sha256(array_to_string(x, ',')) AS name FROM c{ROUNDS})
SELECT vec_id, a.cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, h.name AS centroid_sha256 FROM a{ROUNDS} a JOIN h ON h.cluster = a.cluster"""

"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is padded to a power of two, turned by three rounds of random
signs and fast Hadamard transforms, and named by its nearest signed axis. A
table's bucket joins as many such names as bring about BUCKET_VECTORS vectors
to a bucket; a query looks into the likeliest buckets of each of TABLES tables,
PROBES for PROBES_VECTORS vectors and more as they grow. Each run compares up to
SAMPLE queries with all vectors and doubles the probes until LEAST_RECALL of
their neighbours are found. The candidates are ranked by exact Euclidean
distance on the original vectors, in double precision.

Equal vectors are hashed once; each stands for its smallest K+1 ids, which are
all that a list of K can need. A query that finds fewer than K candidates is
compared with all vectors, in blocks. Directions decide the buckets, so the
lists are near exact for vectors of like length.

Defined results: vectors null, zero, or with null or non-finite components
take no part; rows with equal id and vector count once; with fewer than K other
vectors all are listed; ties go to the smaller id; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, table

K, EVERY = 10, 100
TABLES, PROBES, BUCKET_VECTORS = 24, 12, 64
PROBES_VECTORS, PROBES_POWER = 12_500, 0.4
SAMPLE, LEAST_RECALL = 200, 0.95
#: Vectors of a block that ranks its candidates.
BLOCK_VECTORS = 2048
SEED = 65_537


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, of a power of two columns."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        h *= 2
    return x.reshape(n, d)


def axes(wanted: int, d: int) -> list[int]:
    """Axes of each cross-polytope so that their signed names make ``wanted`` buckets."""
    out, have = [], 1
    while have < wanted:
        n = min(d, 1 << max(0, math.ceil(math.log2(wanted / have)) - 1))
        out.append(n)
        have *= 2 * n
    return out or [1]


def probes_for(n: int, probes: int = PROBES) -> int:
    """Probes of a table of ``n`` vectors; a bucket's share of them shrinks as they grow."""
    return max(probes, math.ceil(probes * (n / PROBES_VECTORS) ** PROBES_POWER))


def scores(x: np.ndarray, nth_table: int, use: list[int]) -> list[np.ndarray]:
    """For each cross-polytope of a table, how near each row is to each signed axis."""
    d = 1 << max(0, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), d))
    padded[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = []
    for k, n in enumerate(use):
        signs = np.random.default_rng([SEED, nth_table, k]).integers(0, 2, (3, d)) * 2.0 - 1
        y = padded
        for s in signs:
            y = _hadamard(y * s) / math.sqrt(d)
        out.append(np.concatenate([y[:, :n], -y[:, :n]], axis=1))
    return out


def best_buckets(parts: list[np.ndarray], probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the ``probes`` likeliest buckets of each row: names
    ordered by the sum of what each loses against the nearest axis."""
    names = np.zeros((len(parts[0]), 1), np.int64)
    loss = np.zeros((len(parts[0]), 1))
    for p in parts:
        least = (p.max(axis=1, keepdims=True) - p) ** 2
        top = np.argpartition(least, min(probes, p.shape[1]) - 1, axis=1)[:, :probes]
        least = np.take_along_axis(least, top, axis=1)
        names = (names[:, :, None] * p.shape[1] + top[:, None, :]).reshape(len(p), -1)
        loss = (loss[:, :, None] + least[:, None, :]).reshape(len(p), -1)
        keep = np.argpartition(loss, min(probes, loss.shape[1]) - 1, axis=1)[:, :probes]
        names, loss = np.take_along_axis(names, keep, axis=1), np.take_along_axis(loss, keep, axis=1)
    return np.repeat(np.arange(len(names)), names.shape[1]), names.ravel()


def _vectors(column: pa.ListArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _hash(wanted: int, tables: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for d in np.unique(sizes):  # vectors of other dimensions have buckets of their own
                part = batch.filter(pa.array(sizes == d))
                for i in range(0, part.num_rows, 1024):
                    ids, x = part.column(0).slice(i, 1024).to_numpy(), _vectors(part.column(1).slice(i, 1024))
                    use = axes(wanted, 1 << max(0, (int(d) - 1).bit_length()))
                    for t in range(tables):
                        row, name = best_buckets(scores(x, t, use), probes)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(np.full(len(row), t * 100_000 + int(d), np.int64)), pa.array(name)], ["lead", "nth", "bucket"])

    return run


def _closest(k: int):
    """The k classes of a block that are nearest to each query, of its candidates
    there; of all its classes where the candidates are null."""

    def run(block: pa.Table, looks: pa.Table) -> pa.Table:
        queries, leads, gaps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        sizes = block.column("vector").combine_chunks().value_lengths().to_numpy()
        asked = looks.column("query_vector").combine_chunks().value_lengths().to_numpy()
        for d in np.intersect1d(sizes, asked):
            own, rows = block.filter(pa.array(sizes == d)), looks.filter(pa.array(asked == d))
            lead = own.column("lead").to_numpy()
            order = np.argsort(lead)
            lead, x = lead[order], _vectors(own.column("vector"))[order]
            q = _vectors(rows.column("query_vector"))
            for i, (query, wanted) in enumerate(zip(rows.column("query").to_pylist(), rows.column("leads"), strict=True)):
                if wanted.is_valid:
                    ids = np.sort(wanted.values.to_numpy())
                    at = np.minimum(np.searchsorted(lead, ids), len(lead) - 1)
                    at = at[lead[at] == ids]  # candidates of other dimensions are elsewhere
                else:
                    at = np.arange(len(lead))
                gap = x[at] - q[i]
                gap = np.sqrt((gap * gap).sum(axis=1))
                best = np.lexsort((lead[at], gap))[:k]
                queries.append(np.full(len(best), query))
                leads.append(lead[at][best])
                gaps.append(gap[best])
        return pa.table({"query": np.concatenate(queries), "lead": np.concatenate(leads), "score": np.concatenate(gaps)})

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = K, tables: int = TABLES, probes: int = PROBES, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each query."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"), is_query.alias("asks")).where("vec_id is not null").where(usable(F.col("vector")))
    classes = rows.groupBy("vector").agg(F.min("vec_id").alias("lead"), F.max("asks").alias("asks"))
    classes = materialise(classes)
    least = Window.partitionBy("vector").orderBy("vec_id")
    ids = rows.select("vec_id", "vector", "asks").distinct()
    members = ids.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1)
    members = materialise(members.join(classes.select("vector", "lead"), "vector").select("lead", "vec_id"))
    askers = materialise(ids.where("asks").join(classes.select("vector", "lead"), "vector").select("lead", F.col("vec_id").alias("query_id")))
    n = classes.count()
    wanted = max(1, n // BUCKET_VECTORS)
    index = materialise(classes.select("lead", "vector").mapInArrow(_hash(wanted, tables, 1), "lead long, nth long, bucket long"))
    asking = classes.where("asks").select(F.col("lead").alias("query"), F.col("vector").alias("query_vector"))
    n_blocks = max(1, -(-n // BLOCK_VECTORS))
    block_of = F.pmod(F.xxhash64("lead"), F.lit(n_blocks)).cast("int")
    vectors_of = classes.select("lead", "vector", block_of.alias("block"))

    def ranked(met: DataFrame) -> DataFrame:
        """The k+1 nearest classes of each query: the best of each block, then of all.
        A query meets a block as one row, with its candidates there."""
        near = vectors_of.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(_closest(k + 1), "query long, lead long, score double")
        return near.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy("score", "lead"))).where(F.col("nth") <= k + 1).drop("nth")

    def looked_up(queries: DataFrame, probes: int) -> DataFrame:
        looks = queries.select("query", "query_vector").mapInArrow(_hash(wanted, tables, probes), "lead long, nth long, bucket long").withColumnRenamed("lead", "query")
        pairs = looks.join(index, ["nth", "bucket"]).select("query", "lead", block_of.alias("block"))
        return ranked(pairs.groupBy("query", "block").agg(F.collect_set("lead").alias("leads")).join(queries, "query"))

    def compared(queries: DataFrame) -> DataFrame:
        """As ``looked_up``, but against all vectors."""
        blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
        return ranked(queries.select("query", blocks.alias("block"), F.lit(None).cast("array<long>").alias("leads"), "query_vector"))

    sample = materialise(asking.orderBy(F.xxhash64("query")).limit(SAMPLE))
    exact = materialise(compared(sample).where("lead != query").select("query", "lead"))
    need, probes = LEAST_RECALL * exact.count(), probes_for(n, probes)
    # ``axes`` makes less than twice the wanted buckets; then all are looked into.
    while looked_up(sample, probes).join(exact, ["query", "lead"], "left_semi").count() < need and probes < 2 * wanted:
        probes *= 2
    found = materialise(looked_up(asking, probes))
    sizes = members.groupBy("lead").agg(F.count("*").alias("size"))
    reach = found.join(sizes, "lead").groupBy("query").agg(F.sum("size").alias("reach"))
    short = materialise(asking.join(reach, "query", "left").where(F.coalesce("reach", F.lit(0)) < k + 1).select("query", "query_vector"))
    if short.head(1):
        found = found.join(short, "query", "left_anti").unionByName(compared(short))
    listed = askers.join(found.withColumnRenamed("lead", "near"), F.col("lead") == F.col("query")).join(members.select(F.col("lead").alias("near"), "vec_id"), "near").where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return listed.select("query_id", "vec_id", "score").distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)

"""Conflict-constrained best-fit packing.

Documents are dealt by an MD5 bucket into groups of about GROUP_ROWS rows, so
neither a source nor a cluster of copies makes a group large. In a group,
documents go by falling size into bins kept in the order of their residual.
A bin carries bitmaps of its sources and duplicate clusters; the search starts
at the tightest bin that has room and goes on to its successors until one is
compatible, else a bin is opened. A bin holds no two documents of one
duplicate cluster and at most MOST_OF_SOURCE of one source. A document longer
than a bin fills bins alone and packs only its rest.

Defined results: a document without words has one row with no bin; a null
source is a source of its own, a null cluster is in no cluster; repeated rows
are rows of their own (of one cluster, if their texts are equal); an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, by_position, materialise, md5_number, table, word_count

CAPACITY, MOST_OF_SOURCE, GROUP_ROWS = 2048, 2, 4096
PACKED = "doc_id long, source string, piece long, first_word long, n_words long, bin_id long, bin_offset long"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, most_of_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, in the given order; clusters: -1 for none.

    level[k] of a bin has a bit for each source that it holds more than k times."""
    levels: list[list[int]] = []
    held: list[int] = []
    residual: list[int] = []
    order: list[tuple[int, int]] = []  # (residual, bin) of the bins with room
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        source_bit, cluster_bit = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order) and (levels[order[at][1]][-1] & source_bit or held[order[at][1]] & cluster_bit):
            at += 1
        if at < len(order):
            _, b = order.pop(at)
        else:
            b = len(residual)
            residual.append(capacity)
            levels.append([0] * most_of_source)
            held.append(0)
        out.append((b, capacity - residual[b]))
        residual[b] -= size
        held[b] |= cluster_bit
        k = next(k for k in range(most_of_source) if not levels[b][k] & source_bit)
        levels[b][k] |= source_bit
        if residual[b]:
            insort(order, (residual[b], b))
    return out


def _pack_group(capacity: int, most_of_source: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        base = int(key[0]) << 32
        rows = rows.sort_values(["size", "rid"], ascending=[False, True], kind="stable")
        full, rest = rows["size"] // capacity, rows["size"] % capacity
        alone = rows.loc[rows.index.repeat(full)]
        nth = alone.groupby("rid").cumcount()
        pieces = [pd.DataFrame({"doc_id": alone["doc_id"], "source": alone["source"], "piece": nth, "first_word": nth * capacity, "n_words": capacity, "bin_id": range(base, base + len(alone)), "bin_offset": 0})]
        some = rows[rest > 0].assign(rest=rest[rest > 0], full=full[rest > 0]).sort_values(["rest", "rid"], ascending=[False, True], kind="stable")
        sources = pd.factorize(some["source"].fillna("").where(some["source"].notna(), "\0null"))[0]
        many = some["cluster"].where(some["cluster"].duplicated(keep=False) & some["cluster"].notna())
        placed = best_fit(some["rest"].tolist(), sources.tolist(), pd.factorize(many)[0].tolist(), capacity, most_of_source)
        bins = pd.DataFrame(placed, columns=["bin", "offset"], index=some.index, dtype="int64")
        pieces.append(pd.DataFrame({"doc_id": some["doc_id"], "source": some["source"], "piece": some["full"], "first_word": some["full"] * capacity, "n_words": some["rest"], "bin_id": base + len(alone) + bins["bin"], "bin_offset": bins["offset"]}))
        none = rows[rows["size"] == 0]
        pieces.append(pd.DataFrame({"doc_id": none["doc_id"], "source": none["source"], "piece": 0, "first_word": 0, "n_words": 0, "bin_id": pd.array([None] * len(none), "Int64"), "bin_offset": pd.array([None] * len(none), "Int64")}))
        return pd.concat([p.astype({"bin_id": "Int64", "bin_offset": "Int64", "doc_id": "Int64"}) for p in pieces])

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, most_of_source: int = MOST_OF_SOURCE) -> DataFrame:
    """Rows of PACKED from items (rid, unique; doc_id, source, size, cluster)."""
    items = materialise(items)
    groups = bucket_count(items.count(), GROUP_ROWS)
    dealt = items.withColumn("pack_group", md5_number(F.col("rid").cast("string")) % groups)
    return dealt.groupBy("pack_group").applyInPandas(_pack_group(capacity, most_of_source), PACKED)


def documents_as_items(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Items of a documents table: sizes in words, clusters of equal texts."""
    plain, (of, at, by) = by_position(docs, doc_id, text, source)
    cluster = F.when(F.col(at).isNotNull(), F.xxhash64(at)).alias("cluster")
    return plain.select(F.monotonically_increasing_id().alias("rid"), F.col(of).cast("long").alias("doc_id"), F.col(by).cast("string").alias("source"), word_count(F.col(at)).alias("size"), cluster)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents_as_items(table(spark, sf_dir, "documents")))

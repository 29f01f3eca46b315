"""Shared pieces of the corpus operators: table readers, shared-folder
materialisation, distributed ranks and numpy helpers for text blocks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A word is a maximal run of bytes that are neither space nor TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of text that one numpy step works on (one longer text is a step of its own).
BLOCK_CHARS = 1 << 20

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_position(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns c0, c1, ... by position, and what ``names`` are called
    there. So a table's other columns never clash with helper columns, nor with
    each other where they differ by case only; ``toDF(*docs.columns)`` undoes it."""
    given = docs.columns
    at = [given.index(n) if n in given else [c.lower() for c in given].index(n.lower()) for n in names]
    return docs.toDF(*[f"c{i}" for i in range(len(given))]), [f"c{i}" for i in at]


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset a local
    session (tests) gets one of our own, and any other an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder, read back. Survives the
    loss of any executor and is not recomputed by later consumers."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def md5_number(text: Column) -> Column:
    """The first 32 bits of the MD5 as a number; a hash that SQL engines share."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with ``value`` computed once a row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """SQL settings of what runs inside."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def arrow_batches(spark: SparkSession, rows: int):
    """Rows of an Arrow batch of what runs inside; for rows that carry whole texts."""
    return settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def bucket_count(rows: int, per_bucket: int = 20_000) -> int:
    return max(1, -(-rows // per_bucket))


#: Buckets whose totals one task adds up.
FAN = 1024


def _equal_keys(keys: list[str], renamed: list[str]) -> Column:
    out = F.lit(True)
    for k, r in zip(keys, renamed, strict=True):
        out = out & F.col(k).eqNullSafe(F.col(r))
    return out


def _bases(totals: DataFrame, keys: list[str], bucket: str, total: str, base: str, buckets: int) -> DataFrame:
    """``totals`` (keys, bucket, total) with the sum of the earlier buckets of equal keys."""
    before = lambda part: Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if buckets <= FAN:
        return totals.withColumn(base, F.coalesce(F.sum(total).over(before(keys)), F.lit(0)))
    fan, upper = f"{bucket}_fan", [f"__u{i}" for i in range(len(keys) + 1)]
    totals = totals.withColumn(fan, F.floor(F.col(bucket) / FAN))
    above = _bases(totals.groupBy(*keys, fan).agg(F.sum(total).alias(total)), keys, fan, total, f"{base}_above", -(-buckets // FAN))
    above = above.select(*[F.col(k).alias(u) for k, u in zip([*keys, fan], upper, strict=True)], f"{base}_above")
    joined = totals.withColumn(base, F.coalesce(F.sum(total).over(before([*keys, fan])), F.lit(0))).join(above, _equal_keys([*keys, fan], upper))
    return joined.withColumn(base, F.col(base) + F.col(f"{base}_above")).drop(*upper, f"{base}_above", fan)


def distributed_offsets(df: DataFrame, keys: list[str], order: list[str], measure: str, out: str, buckets: int) -> DataFrame:
    """Adds ``out``: the sum of ``measure`` over the rows before this one among
    those with equal ``keys`` (null equals null), in the order (MD5 bucket of
    order[0], *order). No task holds a whole key: rows are dealt by (key,
    bucket), and of a key only FAN totals meet, in as many levels as it takes."""
    b, base, total = f"__{out}_bucket", f"__{out}_base", f"__{out}_total"
    df = df.withColumn(b, md5_number(F.coalesce(F.col(order[0]).cast("string"), F.lit(""))) % F.lit(buckets))
    totals = _bases(df.groupBy(*keys, b).agg(F.sum(measure).alias(total)), keys, b, total, base, buckets)
    renamed = [f"__k{i}" for i in range(len(keys) + 1)]
    bases = totals.select(*[F.col(k).alias(r) for k, r in zip([*keys, b], renamed, strict=True)], base)
    within = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum(measure).over(within), F.lit(0)).cast("long")
    joined = df.withColumn(f"__{out}_in", running).join(bases, _equal_keys([*keys, b], renamed), "left")
    return joined.withColumn(out, (F.col(base) + F.col(f"__{out}_in")).cast("long")).drop(b, base, f"__{out}_in", *renamed)


# ---- numpy helpers -------------------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: The low k bytes of a 64-bit number.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**0..P**n and their inverses, modulo 2**64."""
    if len(_powers[0]) <= n:
        with np.errstate(over="ignore"):
            for i, p in enumerate((_P, _P_INV)):
                full = np.full(n + 1, p, np.uint64)
                full[0] = 1
                _powers[i] = np.cumprod(full, dtype=np.uint64)
    return _powers[0][: n + 1], _powers[1][: n + 1]


def rolling_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial rolling hash of words[start:end] for each span, from one prefix
    sum, finished with the length. For windows of a few ``byte_hashes``: a
    polynomial modulo 2**64 is no hash of long runs of a few symbols."""
    n = len(words)
    pw, inv = powers(n)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((words + np.uint64(1)) * pw[:n], out=prefix[1:])
        h = (prefix[ends] - prefix[starts]) * inv[starts]
        return mix(h + mix((ends - starts).astype(np.uint64) + np.uint64(77)))


def byte_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of symbols[start:end] for each span: its bytes in eights, two
    neighbours mixed into one until one is left, finished with the length."""
    raw = np.append(np.ascontiguousarray(symbols).view(np.uint8), np.zeros(8, np.uint8))
    eights = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    at, size = starts * symbols.itemsize, (ends - starts) * symbols.itemsize
    count = np.maximum(1, (size + 7) >> 3)
    last = at + 8 * (count - 1)
    out = eights[last] & _LOW_BYTES[size - 8 * (count - 1)]
    with np.errstate(over="ignore"):
        many = np.flatnonzero(count > 1)
        if len(many):
            count, tail = count[many], out[many]
            base = np.cumsum(count) - count
            value = eights[np.repeat(at[many] - 8 * base, count) + 8 * np.arange(count.sum())]
            value[base + count - 1] = tail
            while count.max() > 1:
                half = (count + 1) >> 1
                half_base = np.cumsum(half) - half
                first = np.repeat(base - 2 * half_base, half) + 2 * np.arange(half.sum())
                paired = np.ones(len(first), bool)
                paired[(half_base + half - 1)[count & 1 == 1]] = False
                left, first = value[first], first[paired]
                left[paired] = mix(mix(left[paired] + _P) + value[first + 1])
                value, count, base = left, half, half_base
            out[many] = value
        return mix(out + mix(size.astype(np.uint64) + np.uint64(77 + (seed << 32))))


def same_spans(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Is each span equal, symbol for symbol, to the span numbered ``other``?"""
    size = ends - starts
    if (size != size[other]).any():
        return False
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return bool((symbols[np.repeat(starts, size) + nth] == symbols[np.repeat(starts[other], size) + nth]).all())


def blocks(lengths: np.ndarray, most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths sum to ``most`` at most; a
    longer row makes a range of its own."""
    ends = np.cumsum(lengths)
    i, n = 0, len(lengths)
    while i < n:
        before = ends[i] - lengths[i]
        j = max(i + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield i, j
        i = j


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes ``data``, and the row of
    each; row r covers bounds[r]:bounds[r+1] and words do not cross rows."""
    n = len(data)
    inside = np.zeros(n + 2, np.bool_)
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = inside[1:] != inside[:-1]  # edge[i]: between byte i-1 and byte i
    starts, ends = edge & inside[1:], edge & inside[:-1]
    cut = bounds[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = cut[inside[cut] & inside[cut + 1]]
    starts[both] = True
    ends[both] = True
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    return s, e, np.searchsorted(bounds, s, side="right") - 1


def utf8_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of an Arrow string array (null counts as empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]

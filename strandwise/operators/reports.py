"""Quality control and statistics reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.align import with_pair_errors
from ..functions.seq import mean_phred


def read_errors(reads: DataFrame) -> DataFrame:
    """Errors of each read (read_id, sample, marker, seq, ref) against its expected sequence."""
    return with_pair_errors(reads, "seq", "ref").select("read_id", "sample", "marker", "qual", "e.*")


def error_totals(errors: DataFrame, scale: float = 1.0) -> DataFrame:
    """Reads, reads with errors, bases, and errors by kind, times ``scale``; mean qualities."""
    wrong = F.col("subs") + F.col("ins") + F.col("dels")
    sums = {"reads": F.count("*"), "reads_with_errors": F.count_if(wrong > 0), "bases": F.sum("aligned"), **{c: F.sum(c) for c in ("subs", "ins", "dels", "homo")}}
    scaled = [(F.round(v * scale)).cast("long").alias(k) for k, v in sums.items()]
    return errors.agg(*scaled, F.avg(mean_phred("qual")).alias("mean_quality"), F.avg(F.when(wrong > 0, mean_phred("qual"))).alias("mean_quality_with_errors"))


def error_classes(errors: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Of the reads of errors (read_id, side F or R, errors by kind), by ``keys``: all, those
    with both primers, and those wrong on the forward side only, the reverse only, both, none."""
    wrong = F.col("subs") + F.col("ins") + F.col("dels") > 0
    has = lambda test: F.bool_or(test)
    each = errors.groupBy(*keys, "read_id").agg(*[has(F.col("side") == x).alias(f"has_{x}") for x in "FR"], *[has((F.col("side") == x) & wrong).alias(f"bad_{x}") for x in "FR"])
    f, r = F.col("bad_F"), F.col("bad_R")
    classes = {"reads": F.lit(True), "both_primers": F.col("has_F") & F.col("has_R"), "forward_errors": f & ~r, "reverse_errors": r & ~f, "both_errors": f & r, "no_errors": ~f & ~r}
    return each.groupBy(*keys).agg(*[F.count_if(v).alias(k) for k, v in classes.items()])


def assignment_matrix(rows: DataFrame) -> DataFrame:
    """Reads by sample and marker with totals (null: all)."""
    return rows.cube("sample", "marker").agg(F.count("*").alias("reads"))


def basic_statistics(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.avg(x).alias("mean"), F.median(x).alias("median"), F.var_samp(x).alias("variance"), F.stddev_samp(x).alias("stdev"), F.corr(x, y).alias("correlation"), F.covar_samp(x, y).alias("covariance"))

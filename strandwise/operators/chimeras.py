"""Chimeras by keys of prefixes and suffixes.

A variant's left parents are the earlier variants that share its first n bases and
no more; they are found by an equi-join on (n, hash of the prefix), grouped by the
base that follows. Of each group only the few earliest members matter, so a prefix
that all variants of an amplicon share makes no pairs. Right parents are the same
on the reversed sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .folders import stored
from .near import PRIORITY, near_pairs
from .variants import AMPLICON


def least_length(least: int | str, n: Column) -> Column:
    """A number of bases, or a percentage of the length ("15%"), rounded down."""
    return F.floor(n * float(least.rstrip("%")) / 100).cast("int") if isinstance(least, str) else F.lit(least)


def _parents(variants: DataFrame, parents: DataFrame, least: int | str, number: int, skipped: DataFrame | None) -> DataFrame:
    """vid and the two best parents by prefix: n shared bases (below the length), rank."""
    n = F.length("seq")

    def prefixes(rows: DataFrame, start: Column, end: Column) -> DataFrame:
        spans = rows.where(end >= start).withColumn("n", F.explode(F.sequence(start, end)))
        return spans.withColumns({"key": F.xxhash64(*AMPLICON, "n", F.substr("seq", F.lit(1), F.col("n"))), "next": F.substr("seq", F.col("n") + 1, F.lit(1))})

    shortest = F.lit(1) if isinstance(least, str) else F.greatest(F.lit(least), F.lit(1))
    first = F.row_number().over(Window.partitionBy("key", "next").orderBy("rank"))
    groups = prefixes(parents.withColumn("rank", F.expr(PRIORITY)), shortest, n).withColumn("nth", first).where(F.col("nth") <= number)
    groups = groups.groupBy("key").agg(F.collect_list(F.struct("next", "rank", F.col("vid").alias("parent"))).alias("members"))  # ``number`` for each base
    asked = prefixes(variants.withColumn("rank", F.expr(PRIORITY)), F.greatest(least_length(least, n), F.lit(1)), n - 1)
    met = asked.join(groups, "key").select("vid", "n", F.col("rank").alias("own"), F.col("next").alias("goes_on"), F.explode("members").alias("m"))
    met = met.where((F.col("m.next") != F.col("goes_on")) & (F.col("m.rank") < F.col("own"))).select("vid", "n", "m.rank", "m.parent")
    if skipped is not None:
        met = met.join(skipped, ["vid", "parent"], "left_anti")
    nth = F.row_number().over(Window.partitionBy("vid").orderBy(F.desc("n"), "rank"))
    return met.withColumn("nth", nth).where("nth <= 2").drop("nth")


def chimeras(variants: DataFrame, least: int | str = 10, similar: int | None = None, parents: DataFrame | None = None) -> DataFrame:
    """Variants that a prefix of one deeper variant and a suffix of another cover, each
    ``least`` long (bases, or percent of the length): md5 with both parents (the
    longest prefix, then depth). Parents with at most ``similar`` errors against the
    variant are skipped. parents: the variants that may be parents, if not all."""
    columns = [F.xxhash64(*AMPLICON, "md5").alias("vid"), *AMPLICON, "md5", "seq", "depth"]
    own, of = variants.select(*columns), (parents if parents is not None else variants).select(*columns)
    skipped, number = None, 2
    if similar is not None:
        pairs = near_pairs(variants if parents is None else variants.select(*AMPLICON, "md5", "seq", "depth").unionByName(parents.select(*AMPLICON, "md5", "seq", "depth")).distinct(), similar)
        vid = lambda k: F.xxhash64(*AMPLICON, f"md5_{k}")
        skipped = stored(pairs.select(vid(2).alias("vid"), vid(1).alias("parent")).distinct())
        # So many of a group that two are left whichever are skipped.
        number += skipped.groupBy("vid").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    turned = lambda rows: rows.withColumn("seq", F.reverse("seq"))
    left = _parents(own, of, least, number, skipped).select("vid", F.col("n").alias("prefix"), F.col("rank").alias("left_rank"), F.col("parent").alias("left"))
    right = _parents(turned(own), turned(of), least, number, skipped).select("vid", F.col("n").alias("suffix"), F.col("rank").alias("right_rank"), F.col("parent").alias("right"))
    both = left.join(right, "vid").where("left <> right").join(own.select("vid", *AMPLICON, "md5", F.length("seq").alias("len")), "vid")
    both = both.where(F.col("prefix") + F.col("suffix") >= F.col("len"))
    best = F.min(F.struct((-F.col("prefix")).alias("p"), "left_rank", (-F.col("suffix")).alias("s"), "right_rank")).alias("x")
    found = both.groupBy(*AMPLICON, "md5").agg(best)
    return found.select(*AMPLICON, "md5", F.col("x.left_rank.md5").alias("left_parent"), F.col("x.right_rank.md5").alias("right_parent"))

"""Result sets: comparing, combining, replicates, shared variants, sets of markers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["marker", "sample", "md5"]


def compare(first: DataFrame, second: DataFrame) -> DataFrame:
    """marker, sample, md5, depth_1, depth_2 and state: common, only_1 or only_2."""
    a, b = (x.select(*KEY, F.col("depth").alias(f"depth_{k}")) for k, x in ((1, first), (2, second)))
    state = F.when(F.col("depth_2").isNull(), "only_1").when(F.col("depth_1").isNull(), "only_2").otherwise("common")
    return a.join(b, KEY, "full_outer").withColumn("state", state)


def compare_statistics(first: DataFrame, second: DataFrame, min_depth: int = 0) -> DataFrame:
    """Counts per marker; samples below ``min_depth`` in either set are left out."""
    deep = lambda x: x.groupBy("marker", "sample").agg(F.sum("depth").alias("d")).where(F.col("d") >= min_depth).select("marker", "sample")
    fine = deep(first).intersect(deep(second))
    compared = compare(first, second).join(fine, ["marker", "sample"], "left_semi")
    return compared.groupBy("marker").agg(*[F.count_if(F.col("state") == x).alias(x) for x in ("common", "only_1", "only_2")], F.countDistinct("sample").alias("samples"), F.countDistinct("md5").alias("sequences"))


def explain_missing(missing: DataFrame, clustered: DataFrame, demultiplexed: DataFrame) -> DataFrame:
    """Where an assignment got lost: at filtering (clustering had it), clustering
    (assignment had it) or assignment."""
    out = missing.join(clustered.select(*KEY, F.lit(True).alias("c")).distinct(), KEY, "left").join(demultiplexed.select(*KEY, F.lit(True).alias("d")).distinct(), KEY, "left")
    return out.withColumn("lost_at", F.when(F.col("c"), "filtering").when(F.col("d"), "clustering").otherwise("demultiplexing")).drop("c", "d")


def combine(sets: list[DataFrame], min_reads: int = 0) -> DataFrame:
    """Summed depths of several result sets, for samples with ``min_reads`` in all of them together."""
    every = sets[0]
    for x in sets[1:]:
        every = every.unionByName(x, allowMissingColumns=True)
    summed = every.groupBy(*KEY).agg(F.first("seq").alias("seq"), F.sum("depth").alias("depth"))
    deep = summed.groupBy("marker", "sample").agg(F.sum("depth").alias("d")).where(F.col("d") >= min_reads).select("marker", "sample")
    return summed.join(deep, ["marker", "sample"], "left_semi")


def side_by_side(sets: dict[str, DataFrame], min_reads: int = 0) -> DataFrame:
    """Assignments of several result sets kept apart: marker, sample, md5, depths (a map
    from the name of a set to its depth) and the sum, for samples with ``min_reads``."""
    every = None
    for name, x in sets.items():
        x = x.select(*KEY, F.lit(name).alias("source"), "depth")
        every = x if every is None else every.unionByName(x)
    once = every.groupBy(*KEY, "source").agg(F.sum("depth").alias("depth"))
    per = once.groupBy(*KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "depth")))).alias("depths"), F.sum("depth").alias("depth"))
    deep = per.groupBy("marker", "sample").agg(F.sum("depth").alias("d")).where(F.col("d") >= min_reads).select("marker", "sample")
    return per.join(deep, ["marker", "sample"], "left_semi")


def consistent_names(named: DataFrame) -> DataFrame:
    """(name, md5) kept where a name stands for one sequence; others are named by their md5."""
    clash = named.select("name", "md5").distinct().groupBy("name").agg(F.count("*").alias("n"))
    return named.select("name", "md5").distinct().join(clash, "name").select("md5", F.when(F.col("n") == 1, F.col("name")).otherwise(F.concat_ws("-", "name", F.substring("md5", 1, 8))).alias("name"))


def replicates(variants: DataFrame, other_run: DataFrame) -> DataFrame:
    """Adds in_replicate (same marker, sample) and in_other_sample (same marker, another sample)."""
    twin = other_run.select(*KEY, F.lit(True).alias("in_replicate")).distinct()
    spread = variants.groupBy("marker", "md5").agg(F.countDistinct("sample").alias("n"))
    out = variants.join(twin, KEY, "left").join(spread, ["marker", "md5"])
    return out.withColumns({"in_replicate": F.coalesce("in_replicate", F.lit(False)), "in_other_sample": F.col("n") > 1}).drop("n")


def markers_in(sets: list[DataFrame], every: bool) -> DataFrame:
    """Markers in every set (intersect) or in any."""
    out = sets[0].select("marker").distinct()
    for x in sets[1:]:
        other = x.select("marker").distinct()
        out = out.intersect(other) if every else out.union(other).distinct()
    return out


SITE = ["chrom", "pos", "id", "ref", "alt"]


def common_variants(vcf: DataFrame, least: int) -> DataFrame:
    """Sites with the number of files that hold them; common if at least ``least``."""
    return vcf.groupBy(*SITE).agg(F.countDistinct("source").alias("files")).withColumn("common", F.col("files") >= least)


def text_variants(lines: DataFrame, pattern: str = r"([A-Z0-9]+)\S*\s.*(c\.\S+)") -> DataFrame:
    """Distinct (gene, change) in free text lines (value)."""
    found = lines.select(F.regexp_extract("value", pattern, 1).alias("gene"), F.regexp_extract("value", pattern, 2).alias("change"))
    return found.where("change <> ''").distinct()


def compare_text_variants(first: DataFrame, second: DataFrame) -> DataFrame:
    a, b = text_variants(first), text_variants(second)
    key = ["gene", "change"]
    return a.join(b, key, "left_semi").withColumn("state", F.lit("common")).unionByName(a.join(b, key, "left_anti").withColumn("state", F.lit("only_1"))).unionByName(b.join(a, key, "left_anti").withColumn("state", F.lit("only_2")))

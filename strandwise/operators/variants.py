"""Variants of amplicons: counting, statistics, naming, gates, degree of change.

Tables: reads or inserts (marker, sample, seq), variants (marker, sample, md5,
seq, depth), amplicons (marker, sample, depth_amplicon). Ties go by md5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s
from ..functions.align import with_pair_errors

AMPLICON = ("marker", "sample")


def by_depth(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy(F.desc("depth"), "md5")


def dereplicate(inserts: DataFrame, weight: Column | None = None) -> DataFrame:
    """Equal sequences of an amplicon become one variant; the shuffle key is the md5."""
    keyed = inserts.withColumn("md5", s.sequence_key("seq"))
    return keyed.groupBy(*AMPLICON, "md5").agg(F.first(F.upper("seq")).alias("seq"), (F.count("*") if weight is None else F.sum(weight)).alias("depth"))


def amplicon_depths(variants: DataFrame) -> DataFrame:
    return variants.groupBy(*AMPLICON).agg(F.sum("depth").alias("depth_amplicon"))


def shared_between_markers(variants: DataFrame) -> DataFrame:
    """Sequences that several markers hold."""
    return variants.groupBy("md5").agg(F.countDistinct("marker").alias("n_markers"), F.sum("depth").alias("depth")).where("n_markers > 1")


def marker_statistics(variants: DataFrame, amplicons: DataFrame) -> DataFrame:
    """Depth, samples and percent frequencies of each variant of a marker."""
    freq = 100 * F.col("depth") / F.col("depth_amplicon")
    joined = variants.join(amplicons, list(AMPLICON)).withColumn("freq", freq)
    return joined.groupBy("marker", "md5").agg(
        F.first("seq").alias("seq"), F.length(F.first("seq")).alias("len"), F.sum("depth").alias("depth"), F.countDistinct("sample").alias("samples"),
        F.avg("freq").alias("mean_freq"), F.max("freq").alias("max_freq"), F.min("freq").alias("min_freq"),
    )


def name_variants(marker_variants: DataFrame, known: DataFrame | None = None, width: int = 7) -> DataFrame:
    """``marker-0000001``: numbers by falling depth, then MD5, that run on across markers;
    a variant with a known name keeps that and uses up its number. Numbers are sums of
    counts: of markers, of a marker's greater depths, of a depth's lower MD5 prefixes; only
    variants of one depth and prefix are sorted together."""
    cell = ["marker", "depth", "prefix"]
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = marker_variants.groupBy("marker", "depth", F.substring("md5", 1, 3).alias("prefix")).agg(F.count("*").alias("n"))
    depths = cells.groupBy("marker", "depth").agg(F.sum("n").alias("n"))
    markers = depths.groupBy("marker").agg(F.sum("n").alias("n")).select("marker", before(Window.orderBy("marker")).alias("of_marker"))
    deeper = depths.select("marker", "depth", before(Window.partitionBy("marker").orderBy(F.desc("depth"))).alias("of_depth"))
    lower = cells.select(*cell, before(Window.partitionBy("marker", "depth").orderBy("prefix")).alias("of_prefix"))
    offsets = lower.join(deeper, ["marker", "depth"]).join(markers, "marker").select(*cell, (F.col("of_marker") + F.col("of_depth") + F.col("of_prefix")).alias("offset"))
    numbered = marker_variants.withColumn("prefix", F.substring("md5", 1, 3)).withColumn("nth", F.row_number().over(Window.partitionBy(*cell).orderBy("md5"))).join(offsets, cell).drop("prefix")
    number = F.col("nth") + F.col("offset")
    name = F.concat_ws("-", "marker", F.lpad(number.cast("string"), width, "0"))
    if known is None:
        return numbered.withColumn("name", name).drop("nth", "offset")
    given = known.select("md5", F.col("name").alias("__known"))
    return numbered.join(given, "md5", "left").withColumn("name", F.coalesce("__known", name)).drop("nth", "offset", "__known")


def gate(variants: DataFrame, amplicons: DataFrame, min_depth: int, markers: list[str] | None = None, samples: list[str] | None = None) -> DataFrame:
    """Variants of allowed markers and samples in amplicons deep enough; an amplicon without a depth is rejected."""
    deep = amplicons.where(F.col("depth_amplicon") >= min_depth)
    for column, allowed in (("marker", markers), ("sample", samples)):
        if allowed is not None:
            deep = deep.where(F.col(column).isin(allowed))
    return variants.join(deep, list(AMPLICON), "left_semi")


def low_amplicons(markers: DataFrame, samples: DataFrame, amplicons: DataFrame, min_depth: int) -> DataFrame:
    """Every sample x marker (two short lists) below ``min_depth``, the missing ones too."""
    every = markers.select("marker").withColumn("k", F.lit(1)).join(samples.select("sample").withColumn("k", F.lit(1)), "k").drop("k")
    depth = F.coalesce("depth_amplicon", F.lit(0)).cast("long")
    return every.join(amplicons, list(AMPLICON), "left").select(*AMPLICON, depth.alias("depth_amplicon")).where(F.col("depth_amplicon") < min_depth)


def frequency_to_top(variants: DataFrame) -> DataFrame:
    """``per_dominant``: percent of the depth of the amplicon's deepest variant."""
    return variants.withColumn("per_dominant", 100 * F.col("depth") / F.first("depth").over(by_depth(*AMPLICON)))


def major_variants(variants: DataFrame, percent: float = 25, most: int = 10) -> DataFrame:
    """Variants by depth while the depth before them is below ``percent`` of the amplicon, ``most`` at most."""
    before = by_depth(*AMPLICON).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("depth").over(Window.partitionBy(*AMPLICON))
    part = 100 * F.coalesce(F.sum("depth").over(before), F.lit(0)) / total
    return variants.withColumns({"nth": F.row_number().over(by_depth(*AMPLICON)), "before": part}).where((F.col("before") < percent) & (F.col("nth") <= most)).drop("nth", "before")


def capped_reads(reads: DataFrame, most: int, order: str = "read_id") -> DataFrame:
    """The first ``most`` reads of each amplicon: a cap is the feature here."""
    return reads.withColumn("nth", F.row_number().over(Window.partitionBy(*AMPLICON).orderBy(order))).where(F.col("nth") <= most).drop("nth")


def degree_of_change(variants: DataFrame, max_alleles: int = 10) -> DataFrame:
    """doc: the ratio to the next depth as percent of all ratios, over the first
    max_alleles + 1 positive depths; n_alleles: the last position of the maximum."""
    top = variants.where("depth > 0").withColumn("nth", F.row_number().over(by_depth(*AMPLICON))).where(F.col("nth") <= max_alleles + 1)
    amplicon = Window.partitionBy(*AMPLICON)
    ratio = F.col("depth") / F.lead("depth").over(by_depth(*AMPLICON))
    top = top.withColumn("ratio", ratio).where("ratio is not null")
    top = top.withColumn("doc", 100 * F.col("ratio") / F.sum("ratio").over(amplicon))
    best = F.max(F.struct("ratio", "nth")).over(amplicon)["nth"]
    return top.withColumn("n_alleles", best)


def stage_summary(amplicons: DataFrame, stages: dict[str, DataFrame]) -> DataFrame:
    """Reads and variants of each amplicon after each stage, 0 where it has none."""
    out = amplicons
    for name, variants in stages.items():
        counts = variants.groupBy(*AMPLICON).agg(F.sum("depth").alias(f"reads_{name}"), F.count("*").alias(f"variants_{name}"))
        out = out.join(counts, list(AMPLICON), "left")
    filled = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in out.columns if c.startswith(("reads_", "variants_"))]
    return out.select(*amplicons.columns, *filled)


def rescue(before: DataFrame, kept: DataFrame, min_samples: int, min_freq: float | None = None) -> DataFrame:
    """``kept`` plus rejected variants that passed in ``min_samples`` samples, in
    amplicons that kept some, if their frequency (percent) here suffices."""
    often = kept.groupBy("marker", "md5").agg(F.countDistinct("sample").alias("n")).where(F.col("n") >= min_samples).select("marker", "md5")
    lost = before.join(kept.select(*AMPLICON, "md5"), [*AMPLICON, "md5"], "left_anti").join(often, ["marker", "md5"], "left_semi").join(kept.select(*AMPLICON).distinct(), list(AMPLICON), "left_semi")
    if min_freq is not None:
        lost = lost.where(F.col("freq") >= min_freq)
    return kept.withColumn("rescued", F.lit(False)).unionByName(lost.withColumn("rescued", F.lit(True)))


def automatic_lengths(variants: DataFrame, cover: float = 95) -> DataFrame:
    """Per marker: lengths of major variants, and whether they cover ``cover`` percent of the depth."""
    majors = major_variants(variants).select("marker", F.length("seq").alias("len")).distinct()
    depth = variants.groupBy("marker", F.length("seq").alias("len")).agg(F.sum("depth").alias("depth"))
    joined = depth.join(majors.withColumn("major", F.lit(True)), ["marker", "len"], "left")
    covered = 100 * F.sum(F.when(F.col("major"), F.col("depth")).otherwise(0)) / F.sum("depth")
    return joined.groupBy("marker").agg(F.array_sort(F.collect_set(F.when(F.col("major"), F.col("len")))).alias("lengths"), (covered >= cover).alias("exact"))


def automatic_min_frequency(variants: DataFrame, amplicons: DataFrame, max_alleles: int = 10) -> DataFrame:
    """Per marker 0.9 x the median frequency of the allele that ends the degree of
    change; amplicons with one allele count only where a marker has no other."""
    last = degree_of_change(variants, max_alleles).where("nth = n_alleles").join(amplicons, list(AMPLICON)).withColumn("freq", 100 * F.col("depth") / F.col("depth_amplicon"))
    some = F.max("n_alleles").over(Window.partitionBy("marker")) > 1
    return last.withColumn("some", some).where("n_alleles > 1 or not some").groupBy("marker").agg((0.9 * F.median("freq")).alias("min_freq"))


def automatic_errors(variants: DataFrame) -> DataFrame:
    """One row: the mean rates of indels and substitutions (percent of aligned columns)
    between an amplicon's top variant and its rarest near copy (2 % of the length, 98 %
    identical, at most a tenth of the depth), limits of 1.1 times the largest, and the
    platform that makes such errors."""
    ranked = variants.withColumn("nth", F.row_number().over(by_depth(*AMPLICON)))
    top = ranked.where("nth = 1").select(*AMPLICON, F.col("seq").alias("top_seq"), F.col("depth").alias("top_depth"))
    n = F.length("top_seq")
    rare = ranked.join(top, list(AMPLICON)).where((F.col("nth") > 1) & (F.abs(n - F.length("seq")) <= 0.02 * n) & (F.col("top_depth") - F.col("depth") >= 0.9 * F.col("top_depth")))
    near = with_pair_errors(rare, "seq", "top_seq").where(F.col("e.ident") >= 0.98 * F.col("e.aligned"))
    last = near.groupBy(*AMPLICON).agg(F.max_by("e", "nth").alias("e"))
    rates = last.select(F.round(100 * (F.col("e.ins") + F.col("e.dels")) / F.col("e.aligned"), 2).alias("indels"), F.round(100 * F.col("e.subs") / F.col("e.aligned"), 2).alias("subs"))
    least = F.lit(0.001)
    out = rates.agg(*[F.coalesce(F.round(F.avg(c), 2), least).alias(f"mean_{c}") for c in ("indels", "subs")], *[F.coalesce(F.round(1.1 * F.max(c), 2), least).alias(f"limit_{c}") for c in ("indels", "subs")])
    platform = F.when(F.col("mean_indels") > F.col("mean_subs"), "454/IonTorrent").when(F.col("mean_subs") > 100 * F.col("mean_indels"), "Illumina").otherwise("Unknown")
    return out.withColumn("platform", platform)


def automatic_ratio(variants: DataFrame, most: float = 50, percent: float = 25) -> DataFrame:
    """Per marker the least percent of depth between two major variants (see there) of an
    amplicon that are less than 95 % identical, ``most`` at most."""
    majors = major_variants(variants, percent).select(*AMPLICON, "md5", "seq", "depth")
    other = majors.select(*AMPLICON, F.col("md5").alias("md5_2"), F.col("seq").alias("seq_2"), F.col("depth").alias("depth_2"))
    pairs = with_pair_errors(majors.join(other, list(AMPLICON)).where("md5 <> md5_2"), "seq", "seq_2").where(F.col("e.ident") < 0.95 * F.col("e.aligned"))
    return pairs.groupBy("marker").agg(F.least(F.min(F.round(100 * F.col("depth_2") / F.col("depth"), 2)), F.lit(float(most))).alias("ratio"))

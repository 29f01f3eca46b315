"""Taxonomic profiles: consensus taxonomy, roll-ups, diversity, OTU tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s
from .folders import stored


def consensus(hits: DataFrame, level: str = "species") -> DataFrame:
    """Per otu the levels, down to ``level``, while all its assignments agree."""
    used = s.LEVELS[: s.LEVELS.index(level) + 1]
    parsed = hits.withColumn("t", s.read_taxonomy("taxonomy"))
    text = lambda x: F.coalesce(f"t.{x}", F.lit(""))
    one = parsed.groupBy("otu").agg(*[F.max(f"t.{x}").alias(f"c_{x}") for x in used], *[(F.min(text(x)) == F.max(text(x))).alias(f"a_{x}") for x in used])
    agreed, out = F.lit(True), []
    for x in used:
        agreed = agreed & F.col(f"a_{x}")
        out.append(F.when(agreed, F.col(f"c_{x}")).alias(x))
    rest = [F.lit(None).cast("string").alias(x) for x in s.LEVELS[len(used) :]]
    return one.select("otu", F.struct(*out, *rest).alias("taxonomy"))


def latest_database(*matches: DataFrame) -> DataFrame:
    """Union of (otu, name) of several databases; the later one wins."""
    every = matches[0].withColumn("priority", F.lit(0))
    for k, m in enumerate(matches[1:], 1):
        every = every.unionByName(m.withColumn("priority", F.lit(k)))
    return every.groupBy("otu").agg(F.max_by("name", F.struct("priority", "name")).alias("name"))


def roll_up(otus: DataFrame, taxonomy: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """level, taxon, sample, depth, otus: depths of taxa at each level (unassigned where null)."""
    joined = otus.join(taxonomy, "otu", "left")
    named = F.array(*[F.struct(F.lit(x).alias("level"), F.coalesce(F.col(f"taxonomy.{x}"), F.lit("unassigned")).alias("taxon")) for x in levels])
    return joined.select("otu", "sample", "depth", F.explode(named).alias("n")).groupBy("n.level", "n.taxon", "sample").agg(F.sum("depth").alias("depth"), F.countDistinct("otu").alias("otus"))


def taxon_summary(otus: DataFrame, taxonomy: DataFrame, levels: tuple[str, ...], assignments: DataFrame | None = None) -> DataFrame:
    """level, taxon: otus, depth, samples, mean_freq (percent of a sample's depth, over the
    samples of the table) and, with assignments (otu, taxonomy text), ambiguous: how many
    OTUs of the taxon have assignments that differ at the level."""
    total = otus.groupBy("sample").agg(F.sum("depth").alias("total"))
    number = otus.select(F.countDistinct("sample").alias("all_samples"))
    rolled = roll_up(otus, taxonomy, levels).join(total, "sample").groupBy("level", "taxon").agg(F.sum("depth").alias("depth"), F.countDistinct("sample").alias("samples"), F.sum(100 * F.col("depth") / F.col("total")).alias("freqs"))
    named = F.array(*[F.struct(F.lit(x).alias("level"), F.coalesce(F.col(f"taxonomy.{x}"), F.lit("unassigned")).alias("taxon")) for x in levels])
    per = otus.select("otu").distinct().join(taxonomy, "otu", "left").select("otu", F.explode(named).alias("n")).select("otu", "n.level", "n.taxon")
    if assignments is not None:
        parsed = assignments.withColumn("t", s.read_taxonomy("taxonomy"))
        differ = parsed.groupBy("otu").agg(*[(F.countDistinct(F.coalesce(f"t.{x}", F.lit(""))) > 1).alias(x) for x in levels])
        flags = differ.select("otu", F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.col(x).alias("differs")) for x in levels])).alias("f")).select("otu", "f.level", "f.differs")
        per = per.join(flags, ["otu", "level"], "left")
    else:
        per = per.withColumn("differs", F.lit(False))
    counts = per.groupBy("level", "taxon").agg(F.count("*").alias("otus"), F.count_if(F.coalesce("differs", F.lit(False))).alias("ambiguous"))
    out = rolled.join(counts, ["level", "taxon"]).crossJoin(F.broadcast(number))  # one row
    return out.select("level", "taxon", "otus", "depth", "samples", (F.col("freqs") / F.col("all_samples")).alias("mean_freq"), "ambiguous")


def alpha_diversity(otus: DataFrame, keys: tuple[str, ...] = ("sample",), strict: bool = False) -> DataFrame:
    """Observed OTUs and Chao1 = S + f1^2 / 2 f2, rounded half to even. f2 counts
    every abundance over 1 unless ``strict`` asks for exactly 2."""
    double = F.col("depth") == 2 if strict else F.col("depth") > 1
    per = otus.where("depth > 0").groupBy(*keys).agg(F.count("*").alias("observed"), F.count_if(F.col("depth") == 1).alias("f1"), F.count_if(double).alias("f2"))
    bias_free = F.col("f1") * (F.col("f1") - 1) / 2
    return per.withColumn("chao1", F.bround(F.col("observed") + F.when(F.col("f2") > 0, F.col("f1") * F.col("f1") / (2 * F.col("f2"))).otherwise(bias_free)).cast("long"))


#: OTUs of a sample that a task draws together.
BUCKET_OTUS = 4096


def rarefaction_depths(otus: DataFrame) -> tuple[int, int]:
    """The step between depths, a tenth of the mean depth of samples down to its first
    digit, and the common depth: the first step above the lowest depth."""
    per = otus.groupBy("sample").agg(F.sum("depth").alias("depth"))
    mean, low = per.agg(F.avg("depth"), F.min("depth")).first()
    tenth = round((mean or 0) / 10)
    step = max(1, int(str(tenth)[0]) * 10 ** (len(str(tenth)) - 1))
    return step, ((low or 0) // step + 1) * step


def rarefied_counts(otus: DataFrame, depths: list[int], replicates: int, seed: int = 1) -> DataFrame:
    """sample, step, replicate, otu, n: seeded multinomial draws of each depth. A draw is
    a tree: a sample's reads are dealt to buckets of OTUs by conditional binomials, then
    those of a bucket to its OTUs, each with a seed of its own, so a sample may fill many
    tasks and reruns agree."""

    def drawn(rows: pd.DataFrame, name: str, many: int, *node) -> np.ndarray:
        import zlib

        own = np.random.default_rng([seed, zlib.crc32("/".join(map(str, node)).encode())])
        weights = rows[name].to_numpy()
        return own.multinomial(many, weights / weights.sum())

    def dealt(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bucket")
        parts = [rows.assign(step=n, replicate=k, many=drawn(rows, "weight", n, key[0], n, k)) for n in depths for k in range(replicates)]
        return pd.concat(parts)[["sample", "bucket", "step", "replicate", "many"]]

    def leaves(key: tuple, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("otu")
        out = [pd.DataFrame({"sample": [], "step": [], "replicate": [], "otu": [], "n": []})]
        for a in asked.itertuples(index=False):
            n = drawn(rows, "depth", int(a.many), *key, a.step, a.replicate)
            some = n > 0
            out.append(pd.DataFrame({"sample": a.sample, "step": a.step, "replicate": a.replicate, "otu": rows["otu"][some], "n": n[some]}))
        return pd.concat(out)

    weighed = otus.where("depth > 0").groupBy("sample", "otu").agg(F.sum("depth").alias("depth"))
    sizes = weighed.groupBy("sample").agg(F.ceil(F.count("*") / BUCKET_OTUS).alias("buckets"))
    cells = weighed.join(sizes, "sample").withColumn("bucket", F.pmod(F.xxhash64("otu"), "buckets")).drop("buckets")
    weights = cells.groupBy("sample", "bucket").agg(F.sum("depth").alias("weight"))
    asked = weights.groupBy("sample").applyInPandas(dealt, "sample string, bucket long, step long, replicate int, many long").where("many > 0")
    return cells.groupBy("sample", "bucket").cogroup(asked.groupBy("sample", "bucket")).applyInPandas(leaves, "sample string, step long, replicate int, otu string, n long")


def rarefy(otus: DataFrame, depths: list[int], replicates: int, seed: int = 1) -> DataFrame:
    """sample, step, observed and Chao1 means over seeded multinomial draws of each depth."""
    counts = rarefied_counts(otus, depths, replicates, seed).withColumnRenamed("n", "depth")
    draws = alpha_diversity(counts, ("sample", "step", "replicate"))
    return draws.groupBy("sample", "step").agg(F.avg("observed").alias("observed"), F.stddev_samp("observed").alias("observed_sd"), F.avg("chao1").alias("chao1"))


def wide_table(otus: DataFrame, samples: list[str], value: str = "depth") -> DataFrame:
    return otus.groupBy("otu").pivot("sample", samples).agg(F.first(value)).na.fill(0)


def _numbered(ids: DataFrame, column: str) -> DataFrame:
    """column and its number from 0, by the first bytes of its MD5, then itself; only ids
    of one such cell are sorted together."""
    cell = F.substring(F.md5(column), 1, 3).alias("cell")
    ids = ids.select(column, cell).distinct()
    before = F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # 4,096 rows at most
    offsets = ids.groupBy("cell").agg(F.count("*").alias("n")).select("cell", before.alias("offset"))
    nth = F.row_number().over(Window.partitionBy("cell").orderBy(column)) - 1
    return ids.withColumn("nth", nth).join(offsets, "cell").select(column, (F.col("nth") + F.col("offset")).alias("number"))


def write_biom(otus: DataFrame, path: str) -> None:
    """A BIOM 1.0 object as text in parts that follow each other: head, row ids, column
    ids, sparse [row, column, value] triples, each a line, and tail. No value or task
    holds the table; the parts in their order are one JSON text."""
    cells = stored(otus.groupBy("otu", "sample").agg(F.sum("depth").alias("depth")))
    rows, columns = stored(_numbered(cells, "otu")), stored(_numbered(cells, "sample"))
    shape = f"[{rows.count()}, {columns.count()}]"
    spark = otus.sparkSession
    fixed = [(0, '{"format": "Biological Observation Matrix 1.0.0", "type": "OTU table", "matrix_type": "sparse", "matrix_element_type": "int", "shape": ' + shape + ', "rows": ['), (2, '], "columns": ['), (4, '], "data": ['), (6, "]}")]
    lines = spark.createDataFrame([(k, 0, 0, text) for k, text in fixed], "section int, r long, c long, text string")
    comma = lambda first: F.when(first, "").otherwise(",")
    for section, ids, name, kind in ((1, rows, "otu", "row"), (3, columns, "sample", "column")):
        text = F.concat(comma(F.col("number") == 0), F.to_json(F.struct(F.col(name).alias("id"), F.struct(F.col("number").alias(kind)).alias("metadata"))))
        lines = lines.unionByName(ids.select(F.lit(section).alias("section"), F.col("number").alias("r"), F.lit(0).cast("long").alias("c"), text.alias("text")))
    triples = cells.join(rows.withColumnRenamed("number", "r"), "otu").join(columns.withColumnRenamed("number", "c"), "sample")
    least = triples.agg(F.min(F.struct("r", "c")).alias("m")).first()["m"]
    at = (least["r"], least["c"]) if least else (0, 0)
    text = F.concat(comma((F.col("r") == at[0]) & (F.col("c") == at[1])), F.format_string("[%d, %d, %d]", "r", "c", "depth"))
    lines = lines.unionByName(triples.select(F.lit(5).alias("section"), "r", "c", text.alias("text")))
    lines.orderBy("section", "r", "c").select("text").write.text(path)


def read_biom(spark: SparkSession, path: str) -> DataFrame:
    """otu, sample, depth of what write_biom wrote: ids carry their number, so lines may be read in any order."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^,", "").alias("text"))
    triple = r"^\[(\d+), (\d+), (\d+)\]$"
    cells = lines.where(F.rlike("text", F.lit(triple))).select(*[F.regexp_extract("text", triple, k).cast("long").alias(n) for k, n in ((1, "r"), (2, "c"), (3, "depth"))])
    ids = lines.where(F.startswith("text", F.lit('{"id":'))).select(F.from_json("text", "id string, metadata struct<row: long, column: long>").alias("x"))
    side = lambda kind, number, name: ids.where(f"x.metadata.{kind} is not null").select(F.col(f"x.metadata.{kind}").alias(number), F.col("x.id").alias(name))
    return cells.join(side("row", "r", "otu"), "r").join(side("column", "c", "sample"), "c").select("otu", "sample", "depth")


def biom_json(otus: DataFrame) -> DataFrame:
    """One BIOM 1.0 object per table: sparse [row, column, value] triples. The
    whole table is one value, as the format asks."""
    rows = otus.agg(F.array_sort(F.collect_set("otu")).alias("rows"), F.array_sort(F.collect_set("sample")).alias("columns"), F.array_sort(F.collect_list(F.struct("otu", "sample", "depth"))).alias("cells"))
    named = lambda c: F.transform(c, lambda x: F.struct(x.alias("id")))
    data = F.transform("cells", lambda c: F.array(F.array_position("rows", c["otu"]) - 1, F.array_position("columns", c["sample"]) - 1, c["depth"]))
    shape = F.array(F.size("rows"), F.size("columns"))
    return rows.select(F.to_json(F.struct(F.lit("Biological Observation Matrix 1.0.0").alias("format"), F.lit("OTU table").alias("type"), F.lit("sparse").alias("matrix_type"), F.lit("int").alias("matrix_element_type"), shape.alias("shape"), named("rows").alias("rows"), named("columns").alias("columns"), data.alias("data"))).alias("value"))

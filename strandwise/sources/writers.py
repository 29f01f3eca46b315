"""Writers: tables to files through Spark's sinks, a folder of files each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta_lines(variants: DataFrame) -> DataFrame:
    """marker, sample, value: ``>name | hash= | len= | depth= | freq=`` and the sequence."""
    parts = [F.coalesce(F.col("name"), F.col("md5")) if "name" in variants.columns else F.col("md5"), F.concat(F.lit("hash="), "md5"), F.concat(F.lit("len="), F.length("seq")), F.concat(F.lit("depth="), "depth")]
    if "freq" in variants.columns:
        parts.append(F.concat(F.lit("freq="), F.format_number("freq", 2)))
    return variants.select("marker", "sample", F.concat(F.lit(">"), F.concat_ws(" | ", *parts), F.lit("\n"), "seq").alias("value"))


def write_fasta(variants: DataFrame, path: str, per_sample: bool = False) -> None:
    keys = ["marker", "sample"] if per_sample else ["marker"]
    fasta_lines(variants).select(*keys, "value").write.partitionBy(*keys).option("compression", "gzip").text(path)


def write_fastq(reads: DataFrame, path: str) -> None:
    reads.select(F.concat(F.lit("@"), F.coalesce("header", "read_id"), F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")).write.text(path)


def result_matrix(variants: DataFrame, samples: list[str], value: str = "depth") -> DataFrame:
    """marker, md5, seq and a column for each of the known samples."""
    return variants.groupBy("marker", "md5", "seq").pivot("sample", samples).agg(F.first(value))


def matrix_totals(variants: DataFrame, amplicons: DataFrame, samples: list[str]) -> DataFrame:
    """Rows DEPTH_AMPLICON, DEPTH_ALLELES and COUNT_ALLELES of each marker over the samples."""
    per = variants.groupBy("marker", "sample").agg(F.sum("depth").alias("DEPTH_ALLELES"), F.count("*").alias("COUNT_ALLELES"))
    rows = amplicons.select("marker", "sample", F.col("depth_amplicon").alias("DEPTH_AMPLICON")).join(per, ["marker", "sample"], "left").na.fill(0)
    return rows.unpivot(["marker", "sample"], ["DEPTH_AMPLICON", "DEPTH_ALLELES", "COUNT_ALLELES"], "row", "n").groupBy("marker", "row").pivot("sample", samples).agg(F.first("n"))


def write_table(df: DataFrame, path: str, by: list[str] | None = None, sep: str = "\t") -> None:
    writer = df.write.option("sep", sep).option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def sheet_lines(markers: DataFrame, samples: DataFrame, params: DataFrame, alleles: DataFrame) -> DataFrame:
    """The sections of an experiment sheet as lines (section, nth, value); small tables."""
    row = lambda *c: F.concat_ws(",", *[F.coalesce(x, F.lit("")) for x in c])
    text = lambda c: F.array_join(F.col(c), " ")
    numbers = F.array_join(F.transform("lengths", lambda x: x.cast("string")), " ")
    parts = [
        (">marker,length,primer_f,primer_r", markers.select(row(F.col("marker"), numbers, text("primer_f"), text("primer_r")).alias("value"))),
        (">sample,tag_f,tag_r", samples.select(row(F.col("sample"), F.col("tag_f"), F.col("tag_r")).alias("value"))),
        (">param,marker,value", params.select(row(F.col("param"), F.col("marker"), F.array_join("values", ",")).alias("value"))),
        (">allele,sequence", alleles.select(row(F.col("name"), F.col("seq")).alias("value"))),
    ]
    out = None
    for k, (head, rows) in enumerate(parts):
        both = markers.sparkSession.createDataFrame([(k, 0, head)], "section int, nth int, value string").unionByName(rows.select(F.lit(k).alias("section"), F.lit(1).alias("nth"), "value"))
        out = both if out is None else out.unionByName(both)
    return out


def write_sheet(markers: DataFrame, samples: DataFrame, params: DataFrame, alleles: DataFrame, path: str) -> None:
    sheet_lines(markers, samples, params, alleles).orderBy("section", "nth", "value").select("value").coalesce(1).write.text(path)

"""Queries that write files of each format and read them with the library's readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.alleles import exact_matches
from ..operators.folders import work_folder
from ..sources import readers, writers
from .fixtures import view, with_views
from .registry import query


#: The twelve samples of the fixture.
SAMPLES = [f"S{k}" for k in range(12)]
_WIDE = lambda value: ", ".join(f"max({value}) FILTER (sample = '{x}') AS \"{x}\"" for x in SAMPLES)


def _text(spark, lines) -> str:
    path = work_folder(spark)
    lines.write.text(path)
    return path


@query("s01_read_fastq", with_views("SELECT read_id, seq, qual FROM reads", "reads"))
def s01(spark, d):
    path = work_folder(spark)
    writers.write_fastq(view(spark, d, "reads").select("read_id", F.lit(None).cast("string").alias("header"), "seq", "qual"), path)
    return readers.read_fastq(spark, path).select("read_id", "seq", "qual")


@query("s02_read_fasta", with_views("SELECT name, seq FROM alleles", "alleles"))
def s02(spark, d):
    path = _text(spark, view(spark, d, "alleles").select(F.concat(F.lit(">"), "name", F.lit(" some words\n"), F.substring("seq", 1, 30), F.lit("\n 31 "), F.substr("seq", F.lit(31))).alias("value")))
    return readers.read_fasta(spark, path, "first")


@query("s03_read_sheet", with_views("SELECT sample, tag AS tag_f, 6 AS n FROM samples", "samples"))
def s03(spark, d):
    lines = spark.createDataFrame([(">sample,tag_f,tag_r",)], "value string").unionByName(view(spark, d, "samples").select(F.concat("sample", F.lit(","), "tag", F.lit(",")).alias("value"))).coalesce(1)
    sheet = readers.read_sheet(spark, _text(spark, lines.orderBy(F.desc("value")).coalesce(1).orderBy(~F.col("value").startswith(">"))))
    return sheet["samples"].select("sample", "tag_f", F.length("tag_f").alias("n"))


@query("s04_read_compressed", with_views("SELECT marker, sample, seq, depth AS weight FROM variants", "variants"))
def s04(spark, d):
    path = work_folder(spark)
    x = view(spark, d, "variants")
    x.select("marker", "sample", F.concat(F.lit(">v | depth="), "depth", F.lit("\n"), "seq").alias("value")).repartition("marker", "sample").write.partitionBy("marker", "sample").text(path)
    return readers.read_compressed(spark, path)


@query("s05_read_result_matrix", with_views("SELECT marker, md5, sample, depth, round(depth / 7.0, 2) AS freq, 'ok' AS note FROM variants", "variants"))
def s05(spark, d):
    return matrix_read_back(spark, d)


@query("s05_variant_table", with_views("SELECT marker, md5, sum(depth)::BIGINT AS depth, count(*) AS samples, round(avg(round(depth / 7.0, 2)), 4) AS mean_freq, max(round(depth / 7.0, 2)) AS max_freq, min(round(depth / 7.0, 2)) AS min_freq FROM variants GROUP BY ALL", "variants"))
def s05v(spark, d):
    return readers.matrix_tables(matrix_read_back(spark, d), ["marker", "md5"])[0].withColumn("mean_freq", F.round("mean_freq", 4))


@query("s05_sample_table", with_views("SELECT sample, sum(depth)::BIGINT AS depth_alleles, count(*) AS count_alleles FROM variants GROUP BY sample", "variants"))
def s05s(spark, d):
    return readers.matrix_tables(matrix_read_back(spark, d), ["marker", "md5"])[1]


def matrix_read_back(spark, d):
    x = view(spark, d, "variants").withColumn("cell", F.concat("depth", F.lit("; "), F.round(F.col("depth") / 7, 2), F.lit("%; ok")))
    wide = writers.result_matrix(x, SAMPLES, "cell").drop("seq")
    path = work_folder(spark)
    writers.write_table(wide, path)
    back = spark.read.option("sep", "\t").option("header", True).csv(path)
    return readers.read_matrix(back, ["marker", "md5"])


@query("s06_result_matrix", with_views(f"SELECT marker, md5, {_WIDE('depth')} FROM variants GROUP BY marker, md5", "variants"))
def s06(spark, d):
    return writers.result_matrix(view(spark, d, "variants"), SAMPLES).drop("seq")


@query("s06_matrix_totals", with_views(f"p AS (SELECT marker, sample, sum(depth)::BIGINT AS a, count(*) AS c FROM variants GROUP BY ALL), q AS (SELECT p.*, depth_amplicon AS d FROM p JOIN amplicons USING (marker, sample)), r AS (SELECT marker, sample, 'DEPTH_AMPLICON' AS row, d AS n FROM q UNION ALL SELECT marker, sample, 'DEPTH_ALLELES', a FROM q UNION ALL SELECT marker, sample, 'COUNT_ALLELES', c FROM q) SELECT marker, row, {_WIDE('n')} FROM r GROUP BY ALL", "variants", "amplicons"))
def s06t(spark, d):
    return writers.matrix_totals(view(spark, d, "variants"), view(spark, d, "amplicons"), SAMPLES)


@query("s07_write_fasta", with_views("SELECT marker, concat(md5, ' | hash=', md5, ' | len=', length(seq), ' | depth=', depth) AS name, seq FROM variants", "variants"))
def s07(spark, d):
    path = work_folder(spark)
    writers.write_fasta(view(spark, d, "variants"), path)
    back = spark.read.option("lineSep", "\n>").text(path).select("marker", F.regexp_replace("value", "^>", "").alias("value")).where("length(trim(value)) > 0")
    return back.select("marker", F.regexp_extract("value", r"^([^\n]*)\n", 1).alias("name"), F.regexp_extract("value", r"\n([ACGT]+)", 1).alias("seq"))


@query("s10_read_vcf", with_views("SELECT regexp_extract(source, '\\d+', 0) AS file, chrom, pos, ref, alt, filter, dp::VARCHAR AS dp FROM calls", "calls"))
def s10(spark, d):
    """A folder of files, each with its own header and sample name."""
    x = view(spark, d, "calls").withColumn("n", F.regexp_extract("source", r"\d+", 0))
    rows = x.select("source", F.lit(2).alias("k"), F.concat_ws("\t", "chrom", "pos", "id", "ref", "alt", F.lit("."), "filter", F.lit("."), F.lit("GT:DP"), F.concat(F.lit("0/1:"), "dp")).alias("value"))
    names = x.select("source", "n").distinct()
    head = names.select("source", F.inline(F.array(F.struct(F.lit(0).alias("k"), F.lit("##fileformat=VCFv4.2").alias("value")), F.struct(F.lit(1).alias("k"), F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tTUMOR"), "n").alias("value")))))
    path = work_folder(spark)
    head.unionByName(rows).repartition("source").sortWithinPartitions("source", "k").drop("k").write.partitionBy("source").text(path)
    gt = F.map_entries("gt")[0]
    return readers.read_vcf(spark, path).select(F.replace(gt["key"], F.lit("TUMOR"), F.lit("")).alias("file"), "chrom", "pos", "ref", "alt", "filter", gt["value"]["DP"].alias("dp"))


@query("s10_native_calls", with_views("SELECT source, chrom, pos, ref, alt, dp::VARCHAR AS tumor_reads2 FROM calls", "calls"))
def s10n(spark, d):
    """A caller's own table, with columns in another order in every other file."""
    x = view(spark, d, "calls").withColumn("odd", F.regexp_extract("source", r"\d+", 0).cast("int") % 2 == 1)
    both = lambda a, b: F.when(F.col("odd"), F.concat_ws("\t", *a)).otherwise(F.concat_ws("\t", *b))
    rows = x.select("source", F.lit(1).alias("k"), both(["chrom", "pos", "ref", "alt", "dp"], ["chrom", "dp", "pos", "ref", "alt"]).alias("value"))
    names = [[F.lit(c) for c in cs] for cs in (("chrom", "position", "ref", "var", "tumor_reads2"), ("chrom", "tumor_reads2", "position", "ref", "var"))]
    head = x.select("source", "odd").distinct().select("source", F.lit(0).alias("k"), both(*names).alias("value"))
    path = work_folder(spark)
    head.unionByName(rows).withColumn("file", F.col("source")).repartition("file").sortWithinPartitions("file", "k").select("file", "value").write.partitionBy("file").text(path)
    return readers.read_native_calls(spark, path).select(F.regexp_extract("source", "file=([^/]+)/", 1).alias("source"), "chrom", "pos", "ref", "alt", F.col("fields")["tumor_reads2"].alias("tumor_reads2"))


@query("s11_read_sam", with_views("SELECT read_id AS qname, marker AS rname, seq, tax % 3 AS xm FROM inserts", "inserts"))
def s11(spark, d):
    x = view(spark, d, "inserts").select(F.concat_ws("\t", "read_id", F.lit("0"), "marker", F.lit("1"), F.lit("60"), F.concat(F.length("seq"), F.lit("M")), F.lit("*"), F.lit("0"), F.lit("0"), "seq", F.lit("*"), F.concat(F.lit("XM:i:"), (F.col("tax") % 3).cast("string"))).alias("value"))
    return readers.read_sam(spark, _text(spark, x)).select("qname", "rname", "seq", "xm")


@query("s12_read_gff", with_views("SELECT gene AS id, chrom AS seq_id, start, stop AS \"end\", strand FROM genes", "genes"))
def s12(spark, d):
    x = view(spark, d, "genes").select(F.concat_ws("\t", "chrom", F.lit("x"), F.lit("gene"), F.col("start").cast("string"), F.col("stop").cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit("ID="), "gene", F.lit(";biotype=protein_coding"))).alias("value"))
    return readers.read_gff(spark, _text(spark, x)).select("id", "seq_id", "start", "end", "strand")


@query("s13_id_map", "SELECT concat('P', p_size) AS key, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS values FROM part WHERE p_size < 20 GROUP BY 1")
def s13(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    path = _text(spark, part.select(F.concat_ws("\t", F.concat(F.lit("P"), "p_size"), F.lit("DB"), "p_brand").alias("value")))
    wanted = part.where("p_size < 20").select(F.concat(F.lit("P"), "p_size").alias("key"))
    return readers.read_id_map(spark, path, "DB", wanted).select("key", F.array_join("values", ",").alias("values"))


@query("s14_protein_entries", "SELECT concat('PROT', p_partkey) AS name, concat('A', p_partkey, ',B', p_partkey) AS accessions, p_type AS function FROM part")
def s14(spark, d):
    x = spark.read.parquet(f"{d}/part.parquet").select(F.concat(F.lit("ID   PROT"), "p_partkey", F.lit(" Reviewed\nAC   A"), "p_partkey", F.lit("; B"), "p_partkey", F.lit(";\nCC   -!- FUNCTION: "), "p_type", F.lit("\n//")).alias("value"))
    out = readers.read_protein_entries(spark, _text(spark, x))
    return out.select("name", F.array_join("accessions", ",").alias("accessions"), F.get("functions", F.lit(0)).alias("function"))


@query("s15_taxonomy_forms", "SELECT form, concat('ACC', p_partkey, ';tax=k:K', p_partkey % 2, ',p:P', p_partkey % 4, CASE WHEN form = 'table' THEN ',c:C' ELSE '' END) AS name, 'ACGT' AS seq FROM part, (SELECT unnest(['prefixed', 'levels', 'unite', 'table']) AS form)")
def s15(spark, d):
    """Prefixes, bare levels, the last of several bars, and levels from a table of ids."""
    part = spark.read.parquet(f"{d}/part.parquet")
    texts = {
        "prefixed": "concat('ACC', p_partkey, ' k__K', p_partkey % 2, '; p__P', p_partkey % 4, '; c__')",
        "levels": "concat('ACC', p_partkey, ' K', p_partkey % 2, '; P', p_partkey % 4)",
        "unite": "concat('ACC', p_partkey, '|SH', p_size, '|reps|k__K', p_partkey % 2, ';p__P', p_partkey % 4, ';c__')",
        "table": "concat('ACC', p_partkey, ' some words')",
    }
    table = part.select(F.expr("concat('ACC', p_partkey)").alias("id"), F.expr("concat('K', p_partkey % 2, ';P', p_partkey % 4, ';C')").alias("taxonomy"))
    out = None
    for form, text in texts.items():
        x = readers.normalise_taxonomy(part.select(F.expr(text).alias("name"), F.lit("ACGU").alias("seq")), "levels" if form == "table" else form, table if form == "table" else None)
        x = x.select(F.lit(form).alias("form"), "name", "seq")
        out = x if out is None else out.unionByName(x)
    return out


@query("s16_read_blast", with_views("SELECT md5 AS query, marker AS subject, length(seq)::INT AS aligned, round_even(90.0 * length(seq) / 100, 0)::INT AS ident FROM (SELECT DISTINCT md5, marker, seq FROM variants)", "variants"))
def s16(spark, d):
    x = view(spark, d, "variants").select("md5", "marker", "seq").distinct().select(F.concat_ws("\t", "md5", "marker", F.lit("90.0"), F.length("seq").cast("string"), F.lit("6"), F.lit("0"), F.lit("1"), F.lit("60"), F.lit("1"), F.lit("60"), F.lit("1e-9"), F.lit("99")).alias("value"))
    return readers.read_blast(spark, _text(spark, x)).select("query", "subject", "aligned", "ident")


@query("s16_read_clusters", "SELECT p_size AS cluster, concat('seq', p_partkey) AS name, p_partkey = min(p_partkey) OVER (PARTITION BY p_size) AS head FROM part")
def s16c(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    lines = part.groupBy("p_size").agg(F.array_sort(F.collect_list("p_partkey")).alias("k"))
    body = F.array_join(F.transform("k", lambda x, i: F.concat(i.cast("string"), F.lit("\t60nt, >seq"), x.cast("string"), F.when(i == 0, "... *").otherwise("... at 98%"))), "\n")
    return readers.read_clusters(spark, _text(spark, lines.select(F.concat(F.lit(">Cluster "), "p_size", F.lit("\n"), body).alias("value"))))


@query("s17_paired_files", with_views("SELECT concat('run/', sample) AS prefix, sample <> 'S3' AS complete FROM samples", "samples"))
def s17(spark, d):
    names = [f"run/{x['sample']}_R{k}.fastq.gz" for x in view(spark, d, "samples").collect() for k in (1, 2) if (x["sample"], k) != ("S3", 2)]
    return readers.paired_files(spark, names).select("prefix", "complete")


@query("s18_write_sheet", with_views("SELECT concat(sample, ',', tag, ',') AS value FROM samples UNION ALL SELECT concat(name, ',', seq) FROM alleles UNION ALL SELECT unnest(['>marker,length,primer_f,primer_r', '>sample,tag_f,tag_r', '>param,marker,value', '>allele,sequence', 'M0,60 61,ACGT,', 'min,all,5'])", "samples", "alleles"))
def s18(spark, d):
    markers = spark.createDataFrame([("M0", [60, 61], ["ACGT"], [])], "marker string, lengths array<int>, primer_f array<string>, primer_r array<string>")
    params = spark.createDataFrame([("min", "all", ["5"])], "param string, marker string, values array<string>")
    samples = view(spark, d, "samples").select("sample", F.col("tag").alias("tag_f"), F.lit(None).cast("string").alias("tag_r"))
    return writers.sheet_lines(markers, samples, params, view(spark, d, "alleles")).select("value")


@query("s19_typing_table", with_views("SELECT substr(name, 1, 2) AS locus, " + ", ".join(f"max(seq) FILTER (name LIKE '%-{k}') AS a{k}" for k in range(5)) + " FROM alleles GROUP BY 1", "alleles"))
def s19(spark, d):
    x = view(spark, d, "alleles").select(F.substring("name", 1, 2).alias("locus"), F.concat(F.lit("a"), F.substring("name", 4, 1)).alias("allele"), "seq")
    path = work_folder(spark)
    writers.write_table(x.groupBy("locus").pivot("allele", [f"a{k}" for k in range(5)]).agg(F.max("seq")), path)
    return spark.read.option("sep", "\t").option("header", True).csv(path)


@query("s20_reference_set", with_views("SELECT name, seq, false AS repeated FROM alleles", "alleles"))
def s20(spark, d):
    x = view(spark, d, "alleles")
    lines = x.select(F.concat(F.lit(">"), "name", F.lit(" | x\n"), F.substring("seq", 1, 10), F.lit("--"), F.substr("seq", F.lit(11))).alias("value"))
    return readers.read_alleles(spark, _text(spark, lines.unionByName(lines)))


@query("x02_parameters", with_views("SELECT marker, 'min_depth' AS param, CASE WHEN marker = 'M1' THEN '7' ELSE '5' END AS value FROM (SELECT DISTINCT marker FROM alleles) UNION ALL SELECT marker, 'errors', '1' FROM (SELECT DISTINCT marker FROM alleles)", "alleles"))
def x02(spark, d):
    params = spark.createDataFrame([("min_depth", "all", ["5"]), ("min_depth", "M1", ["7"])], "param string, marker string, values array<string>")
    out = readers.resolve_params(params, view(spark, d, "alleles").select("marker"), {"errors": "1", "min_depth": "0"})
    return out.select("marker", "param", F.get("values", F.lit(0)).alias("value"))


@query("s13_catalogue", "SELECT p_partkey::VARCHAR AS id, p_brand AS brand, p_type AS kind FROM part WHERE p_brand LIKE '%2'")
def s13c(spark, d):
    """Chosen columns of a headed table for the ids that another table asks for."""
    part = spark.read.parquet(f"{d}/part.parquet")
    path = work_folder(spark)
    writers.write_table(part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").alias("size")), path)
    wanted = part.where("p_brand like '%2'").select(F.col("p_partkey").cast("string").alias("id"))
    return readers.read_catalogue(spark, path, ["id", "brand", "kind"], wanted, "id")


@query("x03_reference_set", with_views("SELECT DISTINCT v.md5, a.name FROM variants v JOIN alleles a ON contains(v.seq, a.seq) OR contains(a.seq, v.seq)", "variants", "alleles"))
def x03(spark, d):
    """A user's references, from a FASTA file, in the place of the built-in ones."""
    x = view(spark, d, "alleles")
    path = _text(spark, x.select(F.concat(F.lit(">"), "name", F.lit(" user set\n"), F.lower("seq")).alias("value")))
    return exact_matches(view(spark, d, "variants"), readers.read_alleles(spark, path), 30)

"""Readers: text files to DataFrames through Spark's own sources, so any Hadoop
file system, compression and folder of files works. Records that span lines are
split by a record separator or numbered inside their file."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """read_id, header, seq, qual, source. The text source cuts records at ``\\n@``, also
    where that starts a quality line; such a record is in two pieces, whose lines tell
    which is which: a head has its header, bases and ``+``, a tail only the quality. Pieces
    meet in their order in a split, and those that a split's end parts in the order of
    splits. A head without its tail raises an error."""
    text = spark.read.option("lineSep", "\n@").text(path)
    lines = F.split(F.rtrim(F.replace("value", F.lit("\r"), F.lit("")), F.lit("\n ")), "\n")
    lines = F.filter(lines, lambda x, k: ~(x.startswith("#") & (k % 4 != 3)))
    at = [F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth")]
    pieces = text.select(*at, lines.alias("lines"))
    line = lambda k: F.get("lines", F.lit(k))
    header = F.when(F.col("block") == 0, F.regexp_replace(line(0), "^@", "")).otherwise(line(0))
    record = lambda header, qual: [F.regexp_extract(header, r"^(\S*)", 1).alias("read_id"), header.alias("header"), F.col("seq"), qual.alias("qual"), F.col("source")]
    # An explode, not a filter, which would be pushed down and the lines be cut twice.
    whole = pieces.withColumn("lines", F.explode(F.filter(F.array("lines"), lambda x: F.size(x) >= 4))).withColumn("seq", line(1)).select(*record(header, line(3)))
    parts = pieces.where(F.size("lines") < 4).select("source", "block", "nth", (F.size("lines") > 1).alias("head"), header.alias("header"), line(0).alias("text"), line(1).alias("seq"))
    after = lambda w: {"then": F.lead("head").over(w), "tail": F.lead("text").over(w)}
    split = Window.partitionBy("source", "block").orderBy("nth")
    met = parts.withColumns(after(split) | {"before": F.lag("head").over(split)})
    # Of a split at most its first tail and its last head are left.
    left = met.where((F.col("head") & F.col("then").isNull()) | (~F.col("head") & F.col("before").isNull())).select(*parts.columns)
    left = left.withColumns(after(Window.partitionBy("source").orderBy("block", "nth"))).where("head")
    glued = met.where("head and then is not null").drop("before").unionByName(left)
    qual = F.when(~F.col("then"), F.concat(F.lit("@"), "tail")).otherwise(F.raise_error(F.concat(F.lit("a record is cut short: "), "header")))
    return whole.unionByName(glued.select(*record(F.col("header"), qual)))


ID_PATTERNS = {"genbank": r"gi\|(\d+)", "ensembl": r"(ENS\w+)", "uniprot": r"(?:sp|tr)\|(\w+)", "first": r"^(\S+)"}


def read_fasta(spark: SparkSession, path: str, id_type: str = "") -> DataFrame:
    """name, seq: lines joined, digits and blanks dropped; id_type cuts the name by ID_PATTERNS."""
    text = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value"))
    name = F.trim(F.substring_index("value", "\n", 1))
    body = F.when(F.contains("value", F.lit("\n")), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n", ""), r"[\s\d]", "")).otherwise("")
    out = text.where(F.length(F.trim("value")) > 0).select(name.alias("name"), body.alias("seq"))
    return out.withColumn("name", F.coalesce(F.nullif(F.regexp_extract("name", ID_PATTERNS[id_type], 1), F.lit("")), "name")) if id_type else out


def read_alleles(spark: SparkSession, path: str, name_pattern: str = r"^([^|\s]+)") -> DataFrame:
    """name, seq, repeated: gaps removed; a repeated sequence goes, a repeated name gets ``_2``, ``_3``."""
    rows = read_fasta(spark, path).select(F.regexp_extract("name", name_pattern, 1).alias("name"), F.upper(F.regexp_replace("seq", r"[.-]", "")).alias("seq"))
    one = rows.withColumn("k", F.row_number().over(Window.partitionBy("seq").orderBy("name"))).where("k = 1")
    nth = F.row_number().over(Window.partitionBy("name").orderBy("seq"))
    return one.withColumn("k", nth).select(F.when(F.col("k") > 1, F.concat_ws("_", "name", F.col("k").cast("string"))).otherwise(F.col("name")).alias("name"), "seq", (F.col("k") > 1).alias("repeated"))


def parse_sheet(text: str) -> dict[str, list[dict[str, str]]]:
    """Sections of an experiment sheet (marker, sample, param, allele): rows by column
    name. Separators: comma, semicolon, tab or bar. ``#`` starts a comment. Repeated
    names of a section raise a ValueError."""
    out: dict[str, list[dict[str, str]]] = {}
    section, columns = "", []
    for line in text.splitlines():
        cells = [c.strip().strip('"') for c in re.split(r"[,;\t|]", line.strip())]
        if not line.strip() or line.startswith("#"):
            continue
        if line.startswith(">"):
            section, columns = cells[0][1:].lower(), [cells[0][1:].lower(), *[c.lower() for c in cells[1:]]]
            out.setdefault(section, [])
        elif section:
            row = {c: v for c, v in zip(columns, cells, strict=False) if c}
            if section in ("param", "allele") and len(cells) > len(columns):
                row["values"] = ",".join(cells[2:] if section == "param" else cells[1:])
            if section in ("marker", "sample") and any(r[section] == row[section] and r.get("primer_f") == row.get("primer_f") for r in out[section]):
                raise ValueError(f"{section} {row[section]} is repeated")
            out[section].append(row)
    return out


def expand_lengths(text: str) -> list[int]:
    """``200-205 210`` to every length."""
    out: list[int] = []
    for part in re.split(r"[\s,]+", text.strip()):
        if m := re.fullmatch(r"(\d+)-(\d+)", part):
            out += range(int(m[1]), int(m[2]) + 1)
        elif part:
            out.append(int(part))
    return sorted(set(out))


def read_sheet(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """DataFrames markers, samples, params and alleles of a (small) sheet file."""
    text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())
    parts = parse_sheet(text)
    known = {"marker", "primer_f", "primer_r", "length"}
    split = lambda v: v.split() if v else []
    rc = lambda p: p[::-1].translate(str.maketrans(s.IUPAC, s.COMPLEMENT))
    merged: dict[str, dict] = {}
    for r in parts.get("marker", []):
        m = merged.setdefault(r["marker"], {"f": [], "r": [], "n": [], "attrs": {}})
        m["f"] += [x for x in split(r.get("primer_f")) if x not in m["f"]]
        m["r"] += [x for x in split(r.get("primer_r")) if x not in m["r"]]
        m["n"] += expand_lengths(r.get("length") or "")
        m["attrs"] |= {k: v for k, v in r.items() if k not in known}
    markers = [(k, m["f"], m["r"], [rc(x) for x in m["r"]], m["n"], m["attrs"]) for k, m in merged.items()]
    samples = [(r["sample"], r.get("tag_f"), r.get("tag_r"), rc(r["tag_r"]) if r.get("tag_r") else None, {k: v for k, v in r.items() if k not in ("sample", "tag_f", "tag_r")}) for r in parts.get("sample", [])]
    params = [(r["param"], r.get("marker") or "all", (r.get("values") or r.get("value") or "").split(",")) for r in parts.get("param", [])]
    alleles = [(r["allele"], (r.get("sequence") or r.get("values") or "").upper()) for r in parts.get("allele", [])]
    return {
        "markers": spark.createDataFrame(markers, "marker string, primer_f array<string>, primer_r array<string>, primer_rc array<string>, lengths array<int>, attrs map<string,string>"),
        "samples": spark.createDataFrame(samples, "sample string, tag_f string, tag_r string, tag_rc string, attrs map<string,string>"),
        "params": spark.createDataFrame(params, "param string, marker string, values array<string>"),
        "alleles": spark.createDataFrame(alleles, "name string, seq string"),
    }


def resolve_params(params: DataFrame, markers: DataFrame, presets: dict[str, str] | None = None) -> DataFrame:
    """A row per marker and parameter: the marker's value, else that of ``all``, else the preset."""
    own = params.where("marker <> 'all'").select("marker", "param", F.col("values").alias("own"))
    common = params.where("marker = 'all'").select("param", F.col("values").alias("common"))
    spark = params.sparkSession
    preset = spark.createDataFrame([(k, [v]) for k, v in (presets or {}).items()], "param string, preset array<string>")
    names = params.select("param").union(preset.select("param")).distinct()
    every = markers.select("marker").distinct().crossJoin(names)  # two short lists
    joined = every.join(own, ["marker", "param"], "left").join(common, "param", "left").join(preset, "param", "left")
    return joined.select("marker", "param", F.coalesce("own", "common", "preset").alias("values"))


def read_compressed(spark: SparkSession, path: str) -> DataFrame:
    """marker, sample, seq, weight (``| depth=N`` of the header, else 1) of FASTA files in
    folders ``marker=../sample=..``, or else of a folder for each marker and a file for each sample."""
    text = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", True).text(path).select(F.regexp_replace("value", "^>", "").alias("value"), F.col("_metadata.file_path").alias("f"))
    depth = F.try_to_number(F.regexp_extract("value", r"depth=(\d+)", 1), F.lit("999999999")).cast("long")
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    named = lambda key, other: F.coalesce(F.nullif(F.regexp_extract("f", f"/{key}=([^/]+)/", 1), F.lit("")), F.regexp_extract("f", other, 1))
    return text.where(F.length(F.trim("value")) > 0).select(named("marker", r"([^/]+)/[^/]+$").alias("marker"), named("sample", r"([^/.]+)[^/]*$").alias("sample"), body.alias("seq"), F.coalesce(depth, F.lit(1)).alias("weight"))


def read_matrix(wide: DataFrame, variant_columns: list[str]) -> DataFrame:
    """Long (variant columns, sample, depth, freq, note) of a variants x samples sheet whose cells are ``123; 4.5%; note``."""
    samples = [c for c in wide.columns if c not in variant_columns]
    long = wide.unpivot(variant_columns, samples, "sample", "cell").where("cell is not null and cell <> ''")
    cell = F.col("cell").cast("string")
    number = lambda p: F.nullif(F.regexp_extract(cell, p, 1), F.lit(""))
    note = F.trim(F.array_join(F.filter(F.split(cell, ";"), lambda x: ~x.rlike(r"^\s*[\d.]+\s*%?\s*$")), ";"))
    return long.select(*variant_columns, "sample", number(r"^\s*(\d+)").cast("long").alias("depth"), number(r"([\d.]+)\s*%").cast("double").alias("freq"), F.nullif(note, F.lit("")).alias("note"))


def matrix_tables(assignments: DataFrame, variant_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of the long table of a result matrix: a row for each variant (depth, samples, mean,
    greatest and least freq) and for each sample (depth and number of its variants)."""
    variants = assignments.groupBy(*variant_columns).agg(F.sum("depth").alias("depth"), F.count("*").alias("samples"), F.avg("freq").alias("mean_freq"), F.max("freq").alias("max_freq"), F.min("freq").alias("min_freq"))
    return variants, assignments.groupBy("sample").agg(F.sum("depth").alias("depth_alleles"), F.count("*").alias("count_alleles"))


def read_native_calls(spark: SparkSession, path: str) -> DataFrame:
    """Calls in a caller's own table, with a header line that begins with ``chrom`` and
    names the columns: source, chrom, pos, ref, alt (columns chrom, position, ref, var)
    and all fields as a map. Each file has its own header."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source"))
    header = F.lower("value").startswith("chrom\t")
    head = lines.where(header).groupBy("source").agg(F.split(F.lower(F.first("value")), "\t").alias("h"))
    rows = lines.where(~header & (F.col("value") != "") & ~F.startswith("value", F.lit("#"))).select("source", F.split("value", "\t").alias("c")).join(head, "source")
    whole = rows.select("source", F.map_from_arrays("h", F.transform("h", lambda _, i: F.get("c", i))).alias("fields"))
    return whole.select("source", F.col("fields")["chrom"].alias("chrom"), F.col("fields")["position"].cast("int").alias("pos"), F.col("fields")["ref"].alias("ref"), F.col("fields")["var"].alias("alt"), "fields")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """source, chrom, pos, id, ref, alt, filter, info and gt (sample -> field -> value); each file's own header names its samples."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source"))
    head = lines.where("value like '#CHROM%'").groupBy("source").agg(F.split(F.first("value"), "\t").alias("h"))
    c = F.split("value", "\t")
    rows = lines.where("value <> '' and not startswith(value, '#')").select("source", c.alias("c")).join(head, "source")
    fields = F.split(F.get("c", F.lit(8)), ":")
    names, cells = F.slice("h", 10, F.greatest(F.size("h") - 9, F.lit(0))), F.slice("c", 10, F.greatest(F.size("c") - 9, F.lit(0)))
    gt = F.map_from_arrays(names, F.transform(cells, lambda x: F.map_from_entries(F.zip_with(fields, F.split(x, ":"), lambda k, v: F.struct(k, v)))))
    g = lambda i: F.get("c", F.lit(i))
    return rows.select("source", g(0).alias("chrom"), g(1).cast("int").alias("pos"), g(2).alias("id"), g(3).alias("ref"), g(4).alias("alt"), g(6).alias("filter"), g(7).alias("info"), F.when(F.size("h") > 9, gt).alias("gt"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Aligned rows with at least ten columns, and their XM and XO tags (0 if absent)."""
    c = F.split("value", "\t")
    rows = spark.read.text(path).where("not startswith(value, '@')").select("value", c.alias("c")).where((F.size("c") >= 10) & (F.get("c", F.lit(2)) != "*"))
    tag = lambda t: F.coalesce(F.nullif(F.regexp_extract("value", rf"\t{t}:i:(\d+)", 1), F.lit("")).cast("int"), F.lit(0))
    g = lambda i: F.get("c", F.lit(i))
    return rows.select(g(0).alias("qname"), g(1).cast("int").alias("flag"), g(2).alias("rname"), g(3).cast("int").alias("pos"), g(5).alias("cigar"), g(9).alias("seq"), tag("XM").alias("xm"), tag("XO").alias("xo"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """seq_id, type, id (ID or Parent), start, end, strand of protein-coding genes and their parts."""
    schema = "seq_id string, source string, type string, start int, end int, score string, strand string, phase string, attrs string"
    rows = spark.read.schema(schema).option("sep", "\t").option("comment", "#").csv(path)
    ident = lambda k: F.nullif(F.regexp_extract("attrs", rf"(?:^|;){k}=([^;]+)", 1), F.lit(""))
    kinds = ["gene", "mRNA", "CDS", "exon", "five_prime_UTR", "three_prime_UTR"]
    coding = (F.col("type") != "gene") | F.contains("attrs", F.lit("protein_coding"))
    return rows.where(F.col("type").isin(kinds) & coding).select("seq_id", "type", F.when(F.col("type").isin("gene", "mRNA"), ident("ID")).otherwise(ident("Parent")).alias("id"), "start", "end", "strand")


def read_id_map(spark: SparkSession, path: str, database: str, wanted: DataFrame | None = None, reverse: bool = False) -> DataFrame:
    """key and the list of its ids in ``database`` of an (accession, database, id) table; reverse: id -> accessions."""
    rows = spark.read.schema("accession string, database string, id string").option("sep", "\t").csv(path).where(F.col("database") == database)
    key, value = ("id", "accession") if reverse else ("accession", "id")
    out = rows.select(F.col(key).alias("key"), F.col(value).alias("value"))
    out = out.join(wanted.select("key").distinct(), "key", "left_semi") if wanted is not None else out
    return out.groupBy("key").agg(F.array_sort(F.collect_set("value")).alias("values"))


def read_catalogue(spark: SparkSession, path: str, columns: list[str], wanted: DataFrame | None = None, key: str = "") -> DataFrame:
    """Chosen columns of a headed TSV, for wanted keys."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    rows = rows.join(wanted.select(key).distinct(), key, "left_semi") if wanted is not None else rows
    return rows.select(*columns)


def read_protein_entries(spark: SparkSession, path: str) -> DataFrame:
    """name, accessions, genes, functions, diseases, references, variants of a protein flat file."""
    rows = spark.read.option("lineSep", "\n//\n").text(path).where("length(trim(value)) > 5")
    every = lambda p: F.regexp_extract_all("value", F.lit(p), F.lit(1))
    return rows.select(
        F.regexp_extract("value", r"(?m)^ID\s+(\S+)", 1).alias("name"),
        F.filter(F.flatten(F.transform(every(r"(?m)^AC\s+(.*)$"), lambda x: F.split(x, r";\s*"))), lambda x: x != "").alias("accessions"),
        every(r"(?m)^GN\s+Name=([^;{ ]+)").alias("genes"),
        every(r"-!- FUNCTION: ([^\n]*)").alias("functions"),
        every(r"-!- DISEASE: ([^\n]*)").alias("diseases"),
        every(r"(?m)^DR\s+([^;]+; [^;]+)").alias("references"),
        every(r"(?m)^FT\s+VARIANT\s+(.*)$").alias("variants"),
    )


TAXONOMY_LETTERS = "kpcofgs"


def normalise_taxonomy(rows: DataFrame, form: str, table: DataFrame | None = None) -> DataFrame:
    """name (``acc;tax=k:..,p:..``) and seq (U to T) of rows (name, seq). form: levels
    (``acc A;B;C`` or with a table id -> taxonomy), prefixed (``k__A;p__B``) or unite (bars)."""
    acc = F.regexp_extract("name", r"^([^\s|;]+)", 1)
    rows = rows.withColumn("acc", acc)
    rows = rows.join(table.select(F.col("id").alias("acc"), "taxonomy"), "acc", "left") if table is not None else rows.withColumn("taxonomy", F.trim(F.regexp_replace("name", r"^[^\s|;]+[\s|;]+", "")))
    tax = F.regexp_extract("taxonomy", r"([^|]*)$", 1) if form == "unite" else F.col("taxonomy")
    levels = F.filter(F.transform(F.split(tax, r"\s*;\s*"), lambda x: F.trim(x)), lambda x: x != "")
    letters = F.array(*[F.lit(x) for x in TAXONOMY_LETTERS])
    pairs = F.transform(levels, lambda x: F.regexp_replace(x, "__", ":")) if form in ("prefixed", "unite") else F.transform(F.slice(levels, 1, len(TAXONOMY_LETTERS)), lambda x, i: F.concat(F.get(letters, i), F.lit(":"), x))
    text = F.array_join(F.filter(pairs, lambda x: ~x.rlike(":$")), ",")
    return rows.select(F.concat("acc", F.lit(";tax="), text).alias("name"), F.translate("seq", "Uu", "Tt").alias("seq"))


def read_blast(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """query, subject, ident (count, half to even), aligned, evalue of a tabular BLAST file."""
    schema = "query string, subject string, percent double, aligned int, mismatches int, gaps int, q_start int, q_end int, s_start int, s_end int, evalue double, score double"
    rows = spark.read.schema(schema).option("sep", sep).option("comment", "#").csv(path)
    strand = F.when(F.col("s_start") <= F.col("s_end"), "+").otherwise("-")
    return rows.select("query", "subject", F.bround(F.col("percent") * F.col("aligned") / 100).cast("int").alias("ident"), "aligned", "evalue", "q_start", "s_start", strand.alias("strand"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """cluster, name, head of a CD-HIT cluster file: one record per cluster."""
    text = spark.read.option("lineSep", "\n>Cluster ").text(path).select(F.regexp_replace("value", "^>Cluster ", "").alias("value"))
    members = text.where(F.length(F.trim("value")) > 0).select(F.regexp_extract("value", r"^(\d+)", 1).cast("int").alias("cluster"), F.explode(F.regexp_extract_all("value", F.lit(r"(>[^\n]+)"), F.lit(1))).alias("line"))
    return members.select("cluster", F.regexp_extract("line", r">(.*?)\.\.\.", 1).alias("name"), F.col("line").rlike(r"\*\s*$").alias("head"))


def paired_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """prefix, r1, r2, complete of read files named ``_R1``/``_R2`` or ``_1``/``_2``."""
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    name = r"^(.*?)_R?([12])((?:_\d+)?\.f(?:ast)?q(?:\.gz|\.bz2)?)$"
    f = files.select("path", F.regexp_extract("path", name, 1).alias("prefix"), F.regexp_extract("path", name, 2).alias("mate")).where("mate <> ''")
    side = lambda k: F.min(F.when(F.col("mate") == k, F.col("path")))
    return f.groupBy("prefix").agg(side("1").alias("r1"), side("2").alias("r2")).withColumn("complete", F.col("r1").isNotNull() & F.col("r2").isNotNull())


def unequal_pairs(files: DataFrame, counts: DataFrame) -> DataFrame:
    """The pairs of ``paired_files`` that can't be read together: a mate is missing, or
    their numbers of reads (path, reads) differ: prefix, reads_1, reads_2."""
    side = lambda k: counts.select(F.col("path").alias(f"r{k}"), F.col("reads").alias(f"reads_{k}"))
    told = files.join(side(1), "r1", "left").join(side(2), "r2", "left")
    return told.where(~F.col("reads_1").eqNullSafe(F.col("reads_2")) | ~F.col("complete")).select("prefix", "reads_1", "reads_2")

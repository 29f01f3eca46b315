"""Mutations: variant calls, pile-ups, annotation by genes, exons and codons."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s
from ..functions.align import rows_of, texts_of

#: Columns of rows from caller_depths.
DEPTHS = ("somatic", "passed", "dp", "ad")


def caller_of(header: list[str]) -> str:
    """The caller that wrote a VCF, from its header lines."""
    text = "\n".join(header).lower()
    return next((c for c in ("mutect2", "somaticsniper", "strelka", "varscan") if c in text), "unknown")


def caller_depths(vcf: DataFrame, caller: str, tumor: str = "TUMOR", normal: str = "NORMAL") -> DataFrame:
    """Adds somatic, passed, dp, ad by the fields that the caller writes; gt maps sample -> field -> value."""
    t = lambda f: F.try_element_at(F.try_element_at("gt", F.lit(tumor)), F.lit(f))
    number = lambda c: F.try_to_number(F.regexp_extract(c, r"^(\d+)", 1), F.lit("999999999")).cast("long")
    part = lambda c, i: number(F.get(F.split(c, ","), F.lit(i)))
    passed = F.col("filter") == "PASS"
    if caller == "mutect2":
        ad = part(t("AD"), 1)
        dp, somatic = part(t("AD"), 0) + ad, F.lit(True)
    elif caller == "somaticsniper":
        four = F.transform(F.split(t("DP4"), ","), lambda x: x.cast("long"))
        ad, dp, somatic, passed = F.get(four, F.lit(2)) + F.get(four, F.lit(3)), number(t("DP")), t("SS") == "2", F.lit(True)
    elif caller == "strelka":
        base = F.concat(F.col("alt"), F.lit("U"))
        snv = part(F.try_element_at(F.try_element_at("gt", F.lit(tumor)), base), 0)
        ad, dp, somatic = F.when(F.length("alt") == F.length("ref"), snv).otherwise(part(t("TIR"), 0)), number(t("DP")), F.lit(True)
    else:
        ad, dp, somatic = part(t("AD"), 0), number(t("DP")), F.contains("info", F.lit("SOMATIC")) | F.contains("info", F.lit("SS=2"))
    return vcf.withColumns({"somatic": F.coalesce(somatic, F.lit(False)), "passed": passed, "dp": dp, "ad": ad})


def filter_calls(calls: DataFrame, kind: str = "all", pass_only: bool = False, min_depth: int = 0, min_variant_depth: int = 0, min_percent: float = 0.0) -> DataFrame:
    """kind: all, snp or indel. Null depths fail a depth test."""
    out = calls.where("somatic") if "somatic" in calls.columns else calls
    same = F.length("ref") == F.length("alt")
    if kind != "all":
        out = out.where(same if kind == "snp" else ~same)
    if pass_only:
        out = out.where("passed")
    return out.where((F.col("dp") >= min_depth) & (F.col("ad") >= min_variant_depth) & (100 * F.col("ad") >= min_percent * F.col("dp")))


def genotype_rows(calls: DataFrame, min_samples: int = 1, min_pos: int = 0, min_depth: int = 0, min_quality: float = 0, inside: DataFrame | None = None, outside: DataFrame | None = None) -> DataFrame:
    """Sites in at least ``min_samples`` samples, from min_pos on, at least min_depth deep
    (and of min_quality, a column ``quality``) in each; of the sites (chrom, pos, ref, alt) of
    ``inside`` and not of ``outside``."""
    site = ["chrom", "pos", "ref", "alt"]
    deep = calls.where((F.col("pos") >= min_pos) & (F.col("dp") >= min_depth))
    deep = deep.where(F.col("quality") >= min_quality) if min_quality else deep
    found = deep.groupBy(*site).agg(F.countDistinct("source").alias("samples")).where(F.col("samples") >= min_samples)
    found = found.join(inside.select(*site).distinct(), site, "left_semi") if inside is not None else found
    return found.join(outside.select(*site).distinct(), site, "left_anti") if outside is not None else found


def consequence(ref: Column, alt: Column, position: Column, cds: Column) -> Column:
    """Struct kind and label of REF -> ALT at 1-based ``position`` of a coding sequence."""
    grown = F.length(alt) - F.length(ref)
    first = F.floor((position - 1) / 3).cast("int") * 3 + 1
    changed = F.concat(F.substr(cds, F.lit(1), position - 1), alt, F.substr(cds, position + F.length(ref), F.length(cds)))
    a, b = s.translate_dna(F.substr(cds, first, F.lit(3))), s.translate_dna(F.substr(changed, first, F.lit(3)))
    kind = (
        F.when((grown != 0) & (grown % 3 != 0), F.when(grown > 0, "frameshift insertion").otherwise("frameshift deletion"))
        .when(grown > 0, "in-frame insertion")
        .when(grown < 0, "in-frame deletion")
        .when(a == b, "synonymous")
        .when(b == "*", "nonsense")
        .otherwise("missense")
    )
    return F.struct(kind.alias("kind"), F.concat(a, F.floor((position + 2) / 3).cast("int").cast("string"), b).alias("label"))


def zygosity(genotypes: Column) -> Column:
    """Of an array of genotype texts: one means homozygous."""
    return F.when(F.size(F.array_distinct(genotypes)) == 1, "Homozygous").otherwise("Heterozygous")


def within_errors(sam: DataFrame, errors: int | None = None, substitutions: int | None = None, indels: int | None = None) -> DataFrame:
    for limit, value in ((errors, F.col("xm") + F.col("xo")), (substitutions, F.col("xm")), (indels, F.col("xo"))):
        if limit is not None:
            sam = sam.where(value <= limit)
    return sam


_CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")


GAP = ord("-")


@lru_cache(4096)
def cigar_columns(cigar: str) -> tuple[np.ndarray, np.ndarray]:
    """For each column of a CIGAR's alignment the base of the read and, from the
    alignment's first, of the reference; -1 for a gap."""
    q, r, i, j = [], [], 0, 0
    for n, op in ((int(n), op) for n, op in _CIGAR.findall(cigar)):
        if op in "M=XIDN":
            q.append(np.full(n, -1) if op in "DN" else np.arange(i, i + n))
            r.append(np.full(n, -1) if op == "I" else np.arange(j, j + n))
        i += n if op in "M=XIS" else 0
        j += n if op in "M=XDN" else 0
    return (np.concatenate(q), np.concatenate(r)) if q else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def aligned_rows(rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Alignments (seq, ref_seq, pos, cigar) of one shape at a time: the rows, the byte
    matrices of reads and references, and the reference base of each column (from 0)."""
    for (cigar, pos, _, _), same in rows.groupby(["cigar", "pos", rows["seq"].str.len(), rows["ref_seq"].str.len()], sort=False):
        q, r = cigar_columns(cigar)
        at = np.where(r < 0, -1, r + pos - 1)
        gapped = lambda texts, index: np.where(index < 0, GAP, rows_of(texts.tolist())[:, index])
        yield same, gapped(same["seq"], q), gapped(same["ref_seq"], at), at


def align_cigars(sam: DataFrame, references: DataFrame) -> DataFrame:
    """qname, rname, q_aln, r_aln, ident of each alignment. References, of which each row
    gets its own, are sent to all executors: a few of them have all reads, which a shuffle
    by reference would put into a few tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for same, q, r, _ in aligned_rows(rows):
                yield pd.DataFrame({"qname": same["qname"], "rname": same["rname"], "q_aln": texts_of(q), "r_aln": texts_of(r), "ident": (q == r).sum(axis=1)})

    ref = references.select(F.col("name").alias("rname"), F.col("seq").alias("ref_seq"))
    return sam.join(F.broadcast(ref), "rname").select("qname", "rname", "seq", "ref_seq", "pos", "cigar").mapInPandas(run, "qname string, rname string, q_aln string, r_aln string, ident int")


def _changes(same: pd.DataFrame, q: np.ndarray, r: np.ndarray, at: np.ndarray, ends: int) -> Iterator[tuple]:
    """(rows, position, change, terminal) of the alignments of one shape."""
    n = q.shape[1]
    bases = (q != GAP) & (r != GAP) & (q != r)
    row, col = np.nonzero(bases)
    for k in np.unique(col).tolist():
        here = row[col == k]
        for pair in np.unique(r[here, k].astype(np.int64) << 8 | q[here, k]).tolist():
            yield here[(r[here, k] == pair >> 8) & (q[here, k] == pair & 255)], int(at[k]) + 1, f"{chr(pair >> 8)}->{chr(pair & 255)}", min(k, n - 1 - k) < ends
    gaps = np.where((r == GAP).any(axis=0), 1, np.where((q == GAP).any(axis=0), 2, 0))  # gaps are where the CIGAR has them
    edges = np.flatnonzero(np.diff(gaps, prepend=0, append=0))
    for k, stop in zip(edges, edges[1:], strict=False):
        if not gaps[k]:
            continue
        earlier, bases = at[:k][at[:k] >= 0], at[at >= 0]
        before = int(earlier[-1] if len(earlier) else bases[0] - 1 if len(bases) else -1)  # reference base before the gap
        texts = texts_of((q if gaps[k] == 1 else r)[:, k:stop])
        plain = [not _RUN.search(ref[max(0, before - 2) : before + 4]) for ref in same["ref_seq"]]
        for text in sorted(set(texts)):
            here = np.array([i for i, (x, ok) in enumerate(zip(texts, plain, strict=True)) if ok and x == text], np.int64)
            if len(here):
                yield here, before + (1 if gaps[k] == 1 else 2), ("ins" if gaps[k] == 1 else "del") + text, min(int(k), n - int(stop)) < ends


_RUN = re.compile(r"(.)\1\1")


def pile_up(sam: DataFrame, references: DataFrame, ends: int = 5) -> DataFrame:
    """ref, pos, change, var_depth, terminal, coverage. Equal alignments are counted
    first; the changes of all of one CIGAR and place come from byte matrices; indels next
    to a run of three equal bases in the six around are left out; coverage is a running
    sum of starts and ends."""
    names = ["ref", "pos", "change", "var_depth", "terminal"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for same, q, r, at in aligned_rows(rows):
                name, times = same["rname"].to_numpy(), same["times"].to_numpy()
                for here, pos, change, end in _changes(same, q, r, at, ends):
                    for ref in np.unique(name[here]):
                        depth = int(times[here][name[here] == ref].sum())
                        out.append((ref, pos, change, depth, depth if end else 0))
            yield pd.DataFrame(out, columns=names).groupby(["ref", "pos", "change"], as_index=False).sum() if out else pd.DataFrame(out, columns=names).astype({"ref": "str", "change": "str"})

    ref = references.select(F.col("name").alias("rname"), F.col("seq").alias("ref_seq"))
    once = sam.groupBy("rname", "pos", "cigar", "seq").agg(F.count("*").alias("times"))
    found = once.join(ref, "rname").mapInPandas(run, "ref string, pos int, change string, var_depth long, terminal long")
    changes = found.groupBy("ref", "pos", "change").agg(F.sum("var_depth").alias("var_depth"), F.sum("terminal").alias("terminal"))
    return changes.join(coverage(sam), ["ref", "pos"], "left")


def aligned_length(cigar: Column) -> Column:
    """Reference bases that a CIGAR covers."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0), lambda a, x: a + x.cast("int"))


#: Positions of a stretch whose coverage one task sums.
STRETCH = 1 << 16


def coverage(sam: DataFrame) -> DataFrame:
    """ref, pos, coverage: starts and ends first meet as counts, which run along each
    stretch of a reference from what the stretches before it leave."""
    end = F.col("pos") + aligned_length(F.col("cigar"))
    steps = sam.select(F.col("rname").alias("ref"), F.explode(F.array(F.struct(F.col("pos"), F.lit(1).alias("step")), F.struct(end.alias("pos"), F.lit(-1).alias("step")))).alias("x"))
    steps = steps.groupBy("ref", "x.pos").agg(F.sum("x.step").alias("step")).withColumn("stretch", F.floor(F.col("pos") / STRETCH))
    # A row for each stretch that a reference has.
    spans = steps.groupBy("ref").agg(F.min("stretch").alias("low"), F.max("stretch").alias("high")).select("ref", F.explode(F.sequence("low", "high")).alias("stretch"))
    sums = spans.join(steps.groupBy("ref", "stretch").agg(F.sum("step").alias("change")), ["ref", "stretch"], "left")
    before = F.sum("change").over(Window.partitionBy("ref").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    heads = sums.select("ref", (F.col("stretch") * STRETCH).cast("int").alias("pos"), F.coalesce(before, F.lit(0)).alias("step"), "stretch")
    along = Window.partitionBy("ref", "stretch").orderBy("pos")
    rows = steps.unionByName(heads).groupBy("ref", "stretch", "pos").agg(F.sum("step").alias("step"))
    runs = rows.withColumns({"coverage": F.sum("step").over(along), "next": F.coalesce(F.lead("pos").over(along), ((F.col("stretch") + 1) * STRETCH).cast("int"))}).where("coverage > 0")
    return runs.select("ref", F.explode(F.sequence(F.col("pos"), F.col("next") - 1)).alias("pos"), "coverage")


def coverage_summary(cover: DataFrame) -> DataFrame:
    """Mean, least, most and nearest-rank p90 and p95 of each reference, from counts of equal coverages."""
    counts = cover.groupBy("ref", "coverage").agg(F.count("*").alias("n"))
    up = Window.partitionBy("ref").orderBy("coverage")
    ranked = counts.withColumns({"upto": F.sum("n").over(up), "total": F.sum("n").over(Window.partitionBy("ref"))})
    at = lambda p: F.min(F.when(F.col("upto") > F.bround(F.lit(p) / 100 * (F.col("total") - 1)), F.col("coverage")))
    return ranked.groupBy("ref").agg((F.sum(F.col("coverage") * F.col("n")) / F.sum("n")).alias("mean"), F.min("coverage").alias("least"), F.max("coverage").alias("most"), at(90).alias("p90"), at(95).alias("p95"))


def filter_pile_up(pile: DataFrame, min_percent: float, min_coverage: int, keep_rare: bool = False) -> DataFrame:
    """Frequent and covered changes; those with over 90 % of support near read ends
    and under 20 % of the coverage go, unless rare ones are kept."""
    out = pile.where((100 * F.col("var_depth") >= min_percent * F.col("coverage")) & (F.col("coverage") >= min_coverage))
    biased = (F.col("terminal") > 0.9 * F.col("var_depth")) & (F.col("var_depth") < 0.2 * F.col("coverage"))
    return out if keep_rare else out.where(~biased)


def merge_adjacent(positions: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of neighbouring positions (keys, pos, base) as one event: pos, length, bases."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))
    islands = positions.withColumn("__island", F.col("pos") - nth)
    bases = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda x: x["base"]), "")
    return islands.groupBy(*keys, "__island").agg(F.min("pos").alias("first"), F.count("*").alias("length"), bases.alias("bases")).drop("__island")


def in_ranges(points: DataFrame, ranges: DataFrame, skip: str = r"^(OR\d|IG|TR[ABDG][VDJC])") -> DataFrame:
    """points (chrom, pos) inside ranges (gene, chrom, start, stop): an equi-join on
    position bins; gene names that match ``skip`` are left out. A range has bins of the
    power of four that is as long as it, so two at most; a point looks in a bin of each
    such size that occurs."""
    level = F.greatest(F.ceil(F.log(4.0, F.greatest(F.col("stop") - F.col("start") + 1, F.lit(1)))), F.lit(3)).cast("int")
    ranges = ranges.where(~F.col("gene").rlike(skip)).withColumn("__level", level)
    levels = sorted(r[0] for r in ranges.select("__level").distinct().collect())  # some thirty at most
    bin_of = lambda c: F.floor(F.col(c) / F.pow(F.lit(4.0), F.col("__level")))
    binned = ranges.withColumn("__bin", F.explode(F.sequence(bin_of("start"), bin_of("stop"))))
    asked = points.withColumn("__level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumn("__bin", bin_of("pos"))
    joined = asked.join(binned, ["chrom", "__level", "__bin"])
    return joined.where("pos between start and stop").drop("__bin", "__level")


def transcript_positions(points: DataFrame, exons: DataFrame) -> DataFrame:
    """Position in the joined exons (transcript, chrom, start, stop, strand), mirrored on the minus strand."""
    along = Window.partitionBy("transcript").orderBy("start")
    length = F.col("stop") - F.col("start") + 1
    offset = F.coalesce(F.sum(length).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = exons.withColumns({"offset": offset, "total": F.sum(length).over(Window.partitionBy("transcript"))}).withColumn("gene", F.col("transcript"))
    hit = in_ranges(points, placed)
    forward = F.col("offset") + F.col("pos") - F.col("start") + 1
    return hit.withColumn("t_pos", F.when(F.col("strand") == "-", F.col("total") - forward + 1).otherwise(forward)).drop("gene", "offset")


def coding_effect(hits: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Consequence of (transcript, t_pos, ref, alt) on transcripts (transcript, seq)."""
    flip = F.col("strand") == "-"
    ref, alt = (F.when(flip, s.reverse_complement(c)).otherwise(F.col(c)) for c in ("ref", "alt"))
    return hits.join(transcripts, "transcript").withColumn("effect", consequence(ref, alt, F.col("t_pos").cast("int"), F.col("seq"))).drop("seq")


def catalogue(points: DataFrame, known: DataFrame) -> DataFrame:
    """Left join on chrom and pos: adds the catalogue's mutation_id and class."""
    return points.join(known.select("chrom", "pos", "mutation_id", "class").distinct(), ["chrom", "pos"], "left")


def mutation_classes(hits: DataFrame) -> DataFrame:
    """Class by the median frequency of catalogue hits: where that is under 0.4, those
    within a fifth of it are somatic, the others germline."""
    middle = hits.where("mutation_id is not null").groupBy("source").agg(F.median("freq").alias("middle"))
    near = (F.col("middle") < 0.4) & F.col("freq").between(0.8 * F.col("middle"), 1.2 * F.col("middle"))
    return hits.join(middle, "source", "left").withColumn("origin", F.when(near, "somatic").otherwise("germline"))


def burden(classes: DataFrame, coding_length: int) -> DataFrame:
    """Somatic positions for a million mapped coding bases."""
    return classes.groupBy("source").agg((F.count_distinct(F.when(F.col("origin") == "somatic", F.concat_ws(":", "chrom", "pos"))) * 1e6 / coding_length).alias("burden"))


def protein_facts(hits: DataFrame, ids: DataFrame, facts: DataFrame) -> DataFrame:
    """Transcript -> protein (the first mapping) -> facts; the variant at the exact
    change, else one at the same position."""
    first = ids.groupBy("transcript").agg(F.min_by("protein", "line").alias("protein"))
    joined = hits.join(first, "transcript", "left")
    exact = facts.select("protein", F.col("aa_pos").alias("p"), F.col("label").alias("l"), F.col("note").alias("exact")).distinct()
    near = facts.groupBy("protein", "aa_pos").agg(F.min("note").alias("near"))
    out = joined.join(exact, (joined["protein"] == exact["protein"]) & (F.col("aa_pos") == F.col("p")) & (F.col("label") == F.col("l")), "left").drop(exact["protein"]).drop("p", "l")
    return out.join(near, ["protein", "aa_pos"], "left").withColumn("note", F.coalesce("exact", "near")).drop("exact", "near")


def allele_coverage(sam: DataFrame, min_percent: float = 0, min_reads: int = 0) -> DataFrame:
    """Reads, errors, covered length and share of reads of each reference."""
    per = sam.groupBy(F.col("rname").alias("ref")).agg(F.count("*").alias("reads"), F.sum(F.col("xm") + F.col("xo")).alias("errors"))
    length = coverage(sam).groupBy("ref").agg(F.count("*").alias("covered"), F.sum("coverage").alias("area"))
    out = per.join(length, "ref").withColumn("percent", 100 * F.col("reads") / F.sum("reads").over(Window.partitionBy(F.lit(1))))
    return out.where((F.col("percent") >= min_percent) & (F.col("reads") >= min_reads))


def pile_up_hits(hits: DataFrame, max_errors: int = 2) -> DataFrame:
    """ref, pos, change, var_depth of aligned pairs (subject, s_start, q_aln, s_aln,
    depth) with at most ``max_errors`` differing columns, weighted by depth."""
    columns = F.zip_with(s.letters("q_aln"), s.letters("s_aln"), lambda q, r: F.struct(q.alias("q"), r.alias("r")))
    fine = hits.withColumn("c", columns).where(F.size(F.filter("c", lambda x: x["q"] != x["r"])) <= max_errors)
    each = fine.select(F.col("subject").alias("ref"), "s_start", "s_aln", "depth", F.posexplode("c").alias("k", "x")).where("x.q <> x.r")
    before = F.length(F.replace(F.substr("s_aln", F.lit(1), F.col("k") + 1), F.lit("-"), F.lit("")))
    change = F.concat("x.r", F.lit("->"), "x.q")
    return each.groupBy("ref", (F.col("s_start") - 1 + before).alias("pos"), change.alias("change")).agg(F.sum("depth").alias("var_depth"))

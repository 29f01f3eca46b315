"""Queries on variant calls, pile-ups and annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.align import pair_alignment
from ..functions.seq import GENETIC_CODE
from ..operators import mutations as m
from .fixtures import view, with_views
from .registry import query

CDS = "ATGGCTTGCGACGAATTTGGTCACATTAAACTTATGAACCCACAACGTTCAACTGTTTGGTATTAA" * 10


def calls(spark, d):
    return view(spark, d, "calls")


def vcf(spark, d):
    """Calls as rows of a variant file of the first caller."""
    ad = F.concat_ws(",", (F.col("dp") - F.col("ad")).cast("string"), F.col("ad").cast("string"))
    return calls(spark, d).withColumns({"info": F.lit("."), "gt": F.create_map(F.lit("TUMOR"), F.create_map(F.lit("AD"), ad, F.lit("DP"), F.col("dp").cast("string")))}).drop("dp", "ad")


def of_caller(spark, d, caller):
    """Calls in the fields that a caller writes; its header names it."""
    x, text = calls(spark, d), lambda c: F.col(c).cast("string")
    ref_depth = (F.col("dp") - F.col("ad")).cast("string")
    fields = {
        "mutect2": {"AD": F.concat_ws(",", ref_depth, text("ad"))},
        "somaticsniper": {"DP": text("dp"), "DP4": F.concat_ws(",", ref_depth, F.lit("0"), F.lit("1"), (F.col("ad") - 1).cast("string")), "SS": F.expr("CASE WHEN order_id % 2 = 0 THEN '2' ELSE '1' END")},
        "strelka": {"DP": text("dp"), "TIR": F.concat(text("ad"), F.lit(",7")), **{f"{b}U": F.when(F.col("alt") == b, F.concat(text("ad"), F.lit(",9"))).otherwise("0,0") for b in "ACGT"}},
        "varscan": {"AD": text("ad"), "DP": text("dp")},
    }[caller]
    gt = F.create_map(F.lit("TUMOR"), F.create_map(*[y for k, v in fields.items() for y in (F.lit(k), v)]))
    info = F.expr("CASE WHEN order_id % 3 = 0 THEN 'SOMATIC;SS=2' ELSE 'SS=1' END")
    rows = x.withColumns({"info": info, "gt": gt}).drop("dp", "ad")
    return m.caller_depths(rows, m.caller_of([f"##source={caller.upper()}"])).withColumn("caller", F.lit(caller))


_DEEP = "length(alt) = 1 AND dp >= 20 AND ad >= 5 AND 100 * ad >= 10 * dp"


@query("f13_somatic_filter", with_views(f"SELECT 'mutect2' AS caller, order_id, dp, ad FROM calls WHERE {_DEEP} AND filter = 'PASS' UNION ALL SELECT 'somaticsniper', order_id, dp, ad FROM calls WHERE {_DEEP} AND order_id % 2 = 0 UNION ALL SELECT 'strelka', order_id, dp, ad FROM calls WHERE {_DEEP} AND filter = 'PASS' UNION ALL SELECT 'varscan', order_id, dp, ad FROM calls WHERE {_DEEP} AND filter = 'PASS' AND order_id % 3 = 0", "calls"))
def f13(spark, d):
    first, *rest = (m.filter_calls(of_caller(spark, d, c), "snp", True, 20, 5, 10).select("caller", "order_id", "dp", "ad") for c in ("mutect2", "somaticsniper", "strelka", "varscan"))
    for x in rest:
        first = first.unionByName(x)
    return first


@query("f15_genotype_rows", with_views("SELECT chrom, pos, ref, alt, count(DISTINCT source) AS samples FROM calls WHERE pos >= 50 AND dp >= 30 AND ad >= 2 GROUP BY ALL HAVING count(DISTINCT source) >= 2 INTERSECT SELECT DISTINCT chrom, pos, ref, alt, x.n FROM calls, (SELECT unnest([2, 3, 4, 5]) AS n) x WHERE (chrom, pos, ref, alt) IN (SELECT (chrom, pos, ref, alt) FROM calls WHERE filter = 'PASS') AND (chrom, pos, ref, alt) NOT IN (SELECT (chrom, pos, ref, alt) FROM calls WHERE order_id % 7 = 0)", "calls"))
def f15(spark, d):
    """Sites that passed somewhere and aren't on a list of sites to leave out."""
    x = calls(spark, d)
    return m.genotype_rows(x.withColumn("quality", F.col("ad")), 2, 50, 30, 2, x.where("filter = 'PASS'"), x.where("order_id % 7 = 0"))


_POS = "CAST(order_id % 600 AS INT) + 1"


def _aa(codon: str) -> str:
    """SQL for the amino acid of a codon."""
    at = [f"(instr('TCAG', substr({codon}, {k}, 1)) - 1)" for k in (1, 2, 3)]
    return f"substr('{GENETIC_CODE}', (16 * {at[0]} + 4 * {at[1]} + {at[2]} + 1)::INT, 1)"


def _effect_sql(source: str, cds: str) -> str:
    """CTEs ``ef`` (all of ``source``, kind, label) for rows with p, ref and alt of one base or, as an insertion, more."""
    return f"""e1 AS (SELECT *, ((p - 1) // 3 * 3 + 1)::INT AS first, concat(substr('{cds}', 1, (p - 1)::INT), alt, substr('{cds}', (p + length(ref))::INT)) AS changed FROM {source}),
e2 AS (SELECT *, {_aa(f"substr('{cds}', first, 3)")} AS a, {_aa("substr(changed, first, 3)")} AS b FROM e1),
ef AS (SELECT *, CASE WHEN length(alt) > length(ref) THEN 'frameshift insertion' WHEN a = b THEN 'synonymous' WHEN b = '*' THEN 'nonsense' ELSE 'missense' END AS kind, concat(a, (p + 2) // 3, b) AS label FROM e2)"""


@query("c22_consequence", with_views(f"x AS (SELECT order_id, alt, order_id % 600 + 1 AS p, substr('{CDS}', (order_id % 600 + 1)::INT, 1) AS ref FROM calls), {_effect_sql('x', CDS)} SELECT order_id, kind, label, CASE WHEN ref = alt THEN 'Homozygous' ELSE 'Heterozygous' END AS zygosity FROM ef", "calls"))
def c22(spark, d):
    x = calls(spark, d).withColumn("p", F.expr(_POS)).withColumn("ref", F.substr(F.lit(CDS), F.col("p"), F.lit(1)))
    e = m.consequence(F.col("ref"), F.col("alt"), F.col("p"), F.lit(CDS))
    return x.select("order_id", e["kind"].alias("kind"), e["label"].alias("label"), m.zygosity(F.array("ref", "alt")).alias("zygosity"))


def sam(spark, d):
    """Inserts aligned to allele 0 of their marker; deletions of one base as the fixture makes them."""
    x = view(spark, d, "inserts")
    n = F.length("seq")
    return x.select(F.col("read_id").alias("qname"), F.lit(0).alias("flag"), F.concat("marker", F.lit("-0")).alias("rname"), F.when(F.col("sample") > "S5", 3).otherwise(1).alias("pos"), F.when(F.col("sample") > "S5", F.concat((n - 2).cast("string"), F.lit("M"))).when(n == 59, "20M1D39M").otherwise("60M").alias("cigar"), F.when(F.col("sample") > "S5", F.substr("seq", F.lit(3))).otherwise(F.col("seq")).alias("seq"), (F.col("tax") % 3).alias("xm"), (F.col("tax") % 2).alias("xo"))


def refs(spark, d):
    return view(spark, d, "alleles").select("name", "seq")


_SAM = "sm AS (SELECT *, concat(marker, '-0') AS rname, CASE WHEN sample > 'S5' THEN 3 ELSE 1 END AS pos, CASE WHEN sample > 'S5' THEN length(seq) ELSE 60 END AS stop FROM inserts), cv AS (SELECT rname AS ref, p AS pos, count(*) AS coverage FROM sm, (SELECT unnest(range(1, 61)) AS p) WHERE p BETWEEN sm.pos AND sm.stop GROUP BY ALL)"


# Each read's CIGAR has one shape of three: shift 0 before a deletion of base 21, 1 after it.
_PILE = """sp AS (SELECT sm.*, a.seq AS r, CASE WHEN length(sm.seq) = 59 AND sample <= 'S5' THEN 1 ELSE 0 END AS gap, CASE WHEN sample > 'S5' THEN length(sm.seq) - 2 ELSE 60 END AS cols FROM sm JOIN alleles a ON a.name = sm.rname),
bs AS (SELECT rname AS ref, pos + k AS pos, substr(r, (pos + k)::INT, 1) AS r, substr(CASE WHEN sample > 'S5' THEN substr(seq, 3) ELSE seq END, (k + 1 - CASE WHEN gap = 1 AND k >= 21 THEN 1 ELSE 0 END)::INT, 1) AS q, CASE WHEN least(k, cols - 1 - k) < 5 THEN 1 ELSE 0 END AS edge FROM (SELECT *, unnest(range(cols)) AS k FROM sp) WHERE NOT (gap = 1 AND k = 20)),
pc AS (SELECT ref, pos, concat(r, '->', q) AS change, count(*) AS var_depth, sum(edge)::BIGINT AS terminal FROM bs WHERE r <> q GROUP BY ALL UNION ALL SELECT rname, 21, concat('del', substr(r, 21, 1)), count(*), 0 FROM sp WHERE gap = 1 AND NOT regexp_matches(substr(r, 18, 6), 'AAA|CCC|GGG|TTT') GROUP BY ALL),
pu AS (SELECT pc.*, cv.coverage::BIGINT AS coverage FROM pc LEFT JOIN cv ON cv.ref = pc.ref AND cv.pos = pc.pos)"""


@query("f12_mapped_read_filter", with_views("SELECT read_id FROM inserts WHERE tax % 3 + tax % 2 <= 1 AND tax % 3 <= 1", "inserts"))
def f12(spark, d):
    return m.within_errors(sam(spark, d), 1, 1).select(F.col("qname").alias("read_id"))


@query("c26_cigar_alignment", with_views(_SAM + ", " + _PILE + ", i AS (SELECT rname, (SELECT count(*) FROM (SELECT unnest(range(cols)) AS k) WHERE NOT (gap = 1 AND k = 20) AND substr(r, (pos + k)::INT, 1) = substr(CASE WHEN sample > 'S5' THEN substr(seq, 3) ELSE seq END, (k + 1 - CASE WHEN gap = 1 AND k >= 21 THEN 1 ELSE 0 END)::INT, 1)) AS ident FROM sp) SELECT rname, ident, count(*) AS n FROM i GROUP BY ALL", "inserts", "alleles"))
def c26(spark, d):
    return m.align_cigars(sam(spark, d), refs(spark, d)).groupBy("rname", "ident").agg(F.count("*").alias("n"))


@query("g30_coverage", with_views(_SAM + " SELECT * FROM cv", "inserts"))
def g30c(spark, d):
    return m.coverage(sam(spark, d))


@query("g30_pile_up", with_views(_SAM + ", " + _PILE + " SELECT * FROM pu", "inserts", "alleles"))
def g30(spark, d):
    return m.pile_up(sam(spark, d), refs(spark, d))


@query("f11_pile_up_filter", with_views(_SAM + ", " + _PILE + " SELECT * FROM pu WHERE 100 * var_depth >= 5 * coverage AND coverage >= 100 AND NOT (terminal > 0.9 * var_depth AND var_depth < 0.2 * coverage)", "inserts", "alleles"))
def f11(spark, d):
    return m.filter_pile_up(m.pile_up(sam(spark, d), refs(spark, d)), 5, 100)


@query("g31_coverage_summary", with_views(_SAM + ", k AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY coverage) AS nth, count(*) OVER (PARTITION BY ref) AS n FROM cv) SELECT ref, round(avg(coverage), 6) AS mean, min(coverage) AS least, max(coverage) AS most, max(coverage) FILTER (nth = round_even(0.9 * (n - 1), 0) + 1) AS p90, max(coverage) FILTER (nth = round_even(0.95 * (n - 1), 0) + 1) AS p95 FROM k GROUP BY ref", "inserts"))
def g31(spark, d):
    return m.coverage_summary(m.coverage(sam(spark, d))).withColumn("mean", F.round("mean", 6))


@query("g34_allele_coverage", with_views(_SAM + ", p AS (SELECT rname AS ref, count(*) AS reads, sum(tax % 3 + tax % 2)::BIGINT AS errors FROM sm GROUP BY rname) SELECT p.ref, p.reads, p.errors, count(*) AS covered, sum(coverage)::BIGINT AS area FROM p JOIN cv ON cv.ref = p.ref GROUP BY ALL", "inserts"))
def g34(spark, d):
    return m.allele_coverage(sam(spark, d)).drop("percent")


@query("w06_merge_adjacent", with_views("x AS (SELECT DISTINCT chrom, source, pos, ref AS base FROM calls WHERE ad > 15), i AS (SELECT *, pos - row_number() OVER (PARTITION BY chrom, source ORDER BY pos) AS g FROM x) SELECT chrom, source, min(pos) AS first, count(*) AS length, string_agg(base, '' ORDER BY pos) AS bases FROM i GROUP BY chrom, source, g", "calls"))
def w06(spark, d):
    x = calls(spark, d).where("ad > 15").select("chrom", "source", "pos", F.col("ref").alias("base")).distinct()
    return m.merge_adjacent(x, ["chrom", "source"])


@query("j14_range_join", with_views("SELECT order_id, gene FROM calls c JOIN genes g ON g.chrom = c.chrom AND c.pos BETWEEN g.start AND g.stop", "calls", "genes"))
def j14(spark, d):
    return m.in_ranges(calls(spark, d).select("order_id", "chrom", "pos"), view(spark, d, "genes")).select("order_id", "gene")


_EXON = "ex AS (SELECT concat('T', substr(gene, 2)::INT // 4) AS transcript, concat('chr', substr(gene, 2)::INT // 80) AS chrom, (substr(gene, 2)::INT % 4) * 90 + 1 AS start, (substr(gene, 2)::INT % 4) * 90 + 30 AS stop, CASE WHEN (substr(gene, 2)::INT // 4) % 2 = 0 THEN '+' ELSE '-' END AS strand FROM genes)"


def exons(spark, d):
    n = F.substring("gene", 2, 9).cast("int")
    t = F.floor(n / 4).cast("int")
    return view(spark, d, "genes").select(F.concat(F.lit("T"), t).alias("transcript"), F.concat(F.lit("chr"), F.floor(t / 20)).alias("chrom"), ((n % 4) * 90 + 1).alias("start"), ((n % 4) * 90 + 30).alias("stop"), F.when(t % 2 == 0, "+").otherwise("-").alias("strand"))


_PLACED = _EXON + """, o AS (SELECT *, coalesce(sum(stop - start + 1) OVER (PARTITION BY transcript ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(stop - start + 1) OVER (PARTITION BY transcript) AS total FROM ex),
tp AS (SELECT c.*, transcript, strand, CASE WHEN strand = '-' THEN total - (before + pos - start) ELSE before + pos - start + 1 END::BIGINT AS t_pos FROM calls c JOIN o ON o.chrom = c.chrom AND c.pos BETWEEN o.start AND o.stop),
tx AS (SELECT order_id, transcript, t_pos, t_pos AS p, filter, dp, ad, CASE WHEN strand = '-' THEN reverse(translate(ref, 'ACGT', 'TGCA')) ELSE ref END AS ref, CASE WHEN strand = '-' THEN reverse(translate(alt, 'ACGT', 'TGCA')) ELSE alt END AS alt FROM tp)"""


@query("w11_transcript_position", with_views(_PLACED + " SELECT order_id, transcript, t_pos FROM tp", "calls", "genes"))
def w11(spark, d):
    return m.transcript_positions(calls(spark, d).select("order_id", "chrom", "pos"), exons(spark, d)).select("order_id", "transcript", "t_pos")


@query("j15_coding_effect", with_views(_PLACED + ", " + _effect_sql("tx", CDS[:120]) + " SELECT order_id, transcript, t_pos, kind, label FROM ef", "calls", "genes"))
def j15(spark, d):
    hits = m.transcript_positions(calls(spark, d).select("order_id", "chrom", "pos", "ref", "alt"), exons(spark, d))
    transcripts = exons(spark, d).select("transcript").distinct().withColumn("seq", F.lit(CDS[:120]))
    return m.coding_effect(hits, transcripts).select("order_id", "transcript", "t_pos", "effect.kind", "effect.label")


@query("j25_annotate_calls", with_views(_PLACED + ", " + _effect_sql("tx", CDS[:120]) + " SELECT order_id, transcript, kind FROM ef WHERE filter = 'PASS' AND dp >= 20 AND ad >= 5", "calls", "genes"))
def j25(spark, d):
    fine = m.filter_calls(m.caller_depths(vcf(spark, d), "mutect2"), "all", True, 20, 5)
    hits = m.transcript_positions(fine.select("order_id", "chrom", "pos", "ref", "alt"), exons(spark, d))
    transcripts = exons(spark, d).select("transcript").distinct().withColumn("seq", F.lit(CDS[:120]))
    return m.coding_effect(hits, transcripts).select("order_id", "transcript", "effect.kind")


_KNOWN = "kn AS (SELECT DISTINCT chrom, pos, concat('COSM', pos) AS mutation_id, CASE WHEN pos % 2 = 0 THEN 'driver' ELSE 'passenger' END AS class FROM calls WHERE pos % 7 = 0)"


def known(spark, d):
    return calls(spark, d).where("pos % 7 = 0").select("chrom", "pos", F.concat(F.lit("COSM"), "pos").alias("mutation_id"), F.when(F.col("pos") % 2 == 0, "driver").otherwise("passenger").alias("class"))


@query("j16_catalogue", with_views(_KNOWN + " SELECT order_id, mutation_id, class FROM calls c LEFT JOIN kn ON kn.chrom = c.chrom AND kn.pos = c.pos", "calls"))
def j16(spark, d):
    return m.catalogue(calls(spark, d), known(spark, d)).select("order_id", "mutation_id", "class")


@query("g33_mutation_classes", with_views(_KNOWN + ", h AS (SELECT c.*, mutation_id, ad::DOUBLE / dp AS freq FROM calls c LEFT JOIN kn ON kn.chrom = c.chrom AND kn.pos = c.pos), md AS (SELECT source, median(freq) AS middle FROM h WHERE mutation_id IS NOT NULL GROUP BY source) SELECT source, count(DISTINCT CASE WHEN middle < 0.4 AND freq BETWEEN 0.8 * middle AND 1.2 * middle THEN concat(chrom, ':', pos) END) * 1e6 / 36000 AS burden FROM h LEFT JOIN md USING (source) GROUP BY source", "calls"))
def g33(spark, d):
    hits = m.catalogue(calls(spark, d), known(spark, d)).withColumn("freq", F.col("ad") / F.col("dp"))
    return m.burden(m.mutation_classes(hits), 36_000)


@query("j17_protein_facts", with_views("h AS (SELECT order_id, concat('T', order_id % 30) AS transcript, pos % 50 AS aa_pos, concat('A', pos % 50, 'V') AS label FROM calls), f AS (SELECT DISTINCT concat('P', p_partkey % 30) AS protein, p_partkey % 50 AS aa_pos, concat('A', p_partkey % 50, CASE WHEN p_partkey % 4 = 0 THEN 'V' ELSE 'L' END) AS label, concat('note', p_partkey % 90) AS note FROM part) SELECT h.order_id, coalesce((SELECT min(note) FROM f WHERE f.protein = concat('P', h.order_id % 30) AND f.aa_pos = h.aa_pos AND f.label = h.label), (SELECT min(note) FROM f WHERE f.protein = concat('P', h.order_id % 30) AND f.aa_pos = h.aa_pos)) AS note FROM h", "calls"))
def j17(spark, d):
    hits = calls(spark, d).select("order_id", F.expr("concat('T', order_id % 30)").alias("transcript"), F.expr("pos % 50").alias("aa_pos"), F.expr("concat('A', pos % 50, 'V')").alias("label"))
    part = spark.read.parquet(f"{d}/part.parquet")
    facts = part.select(F.expr("concat('P', p_partkey % 30)").alias("protein"), F.expr("cast(p_partkey % 50 as int)").alias("aa_pos"), F.expr("concat('A', p_partkey % 50, CASE WHEN p_partkey % 4 = 0 THEN 'V' ELSE 'L' END)").alias("label"), F.expr("concat('note', p_partkey % 90)").alias("note"))
    facts = facts.groupBy("protein", "aa_pos", "label").agg(F.min("note").alias("note"))
    ids = part.select(F.expr("concat('T', p_partkey % 30)").alias("transcript"), F.expr("concat('P', p_partkey % 30)").alias("protein"), F.col("p_partkey").alias("line"))
    return m.protein_facts(hits, ids, facts).select("order_id", "note")


# A deletion of one base is aligned at the start of its run of equal bases.
@query("g32_pile_up_hits", with_views("""p AS (SELECT v.seq, v.depth, a.name AS ref, a.seq AS r FROM variants v JOIN alleles a ON a.marker = v.marker AND a.name LIKE '%-0'), e AS (SELECT *, (SELECT count(*) FROM (SELECT unnest(range(1, 61)) AS i) WHERE substr(p.seq, i, 1) <> substr(p.r, i, 1)) AS n FROM p WHERE length(seq) = 60)
SELECT ref, i AS pos, concat(substr(r, i::INT, 1), '->', substr(seq, i::INT, 1)) AS change, sum(depth)::BIGINT AS var_depth FROM e, (SELECT unnest(range(1, 61)) AS i) WHERE n <= 2 AND substr(r, i::INT, 1) <> substr(seq, i::INT, 1) GROUP BY ALL
UNION ALL SELECT ref, (SELECT min(k) FROM (SELECT unnest(range(1, 22)) AS k) WHERE substr(p.r, k::INT, 22 - k::INT) = repeat(substr(p.r, 21, 1), 22 - k::INT)) AS pos, concat(substr(r, 21, 1), '->-'), sum(depth)::BIGINT FROM p WHERE seq = concat(substr(r, 1, 20), substr(r, 22)) GROUP BY ALL""", "variants", "alleles"))
def g32(spark, d):
    a = view(spark, d, "alleles").where("name like '%-0'").select("marker", F.col("name").alias("subject"), "seq")
    v = view(spark, d, "variants").select("marker", F.col("seq").alias("q"), "depth")
    pairs = v.join(a, "marker").withColumn("aln", pair_alignment("q", "seq"))
    return m.pile_up_hits(pairs.select("subject", "depth", "aln.*", F.lit(1).alias("s_start")))

"""Queries on repertoires, taxonomic profiles and result sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as s
from ..operators import compare as c
from ..operators import repertoire as r
from ..operators import taxonomy as t
from ..operators.folders import stored, work_folder
from .fixtures import view, with_views
from .registry import query
from .scalars import CODE_CTE, protein_sql


def rows(spark, d):
    return view(spark, d, "cdr3")


_AA = f"u AS (SELECT DISTINCT cdr3 FROM cdr3), {CODE_CTE}, pr AS ({protein_sql('u', 'cdr3', 'cdr3').replace('SELECT cdr3, cdr3 AS seq', 'SELECT cdr3, cdr3 AS seq')}), x AS (SELECT cdr3.*, aa, contains(aa, '*') AS stop FROM cdr3 JOIN pr USING (cdr3)), ok AS (SELECT * FROM x WHERE length(cdr3) BETWEEN 20 AND 60 AND length(cdr3) % 3 = 0 AND NOT stop)"


@query("f09_cdr3_validity", with_views(_AA + " SELECT sample, marker, count(*) AS reads, count(*) FILTER (length(cdr3) < 20) AS short, count(*) FILTER (length(cdr3) > 60) AS long, count(*) FILTER (length(cdr3) % 3 <> 0) AS frameshift, count(*) FILTER (stop) AS stop, count(*) FILTER (length(cdr3) BETWEEN 20 AND 60 AND length(cdr3) % 3 = 0 AND NOT stop) AS valid FROM x GROUP BY ALL", "cdr3"))
def f09(spark, d):
    return r.validity_counts(rows(spark, d), 20, 60)


@query("c24_extract_cdr3", with_views("SELECT event_id::VARCHAR AS read_id, umi, concat('TGT', cdr3, 'GGG') AS cdr3, 'ACCA' AS tcrv_seq, 'CCC' AS tcrj_seq FROM cdr3", "cdr3"))
def c24(spark, d):
    x = rows(spark, d).select(F.col("event_id").cast("string").alias("read_id"), F.concat("umi", F.lit("ACCATGT"), "cdr3", F.lit("GGGCCC")).alias("seq"))
    out = r.extract_cdr3(x, "^[ACGTN]{8}ACCATGT([ACGTN]+)GGGCCC$", 0, 8)
    return out.withColumn("tcrv_seq", F.substr("tcrv_seq", F.lit(9)))


@query("c25_orientation", "SELECT 'R1+R2-' AS sense, count(*) AS n FROM events")
def c25(spark, d):
    x = rows(spark, d).select(F.lit("AAAA").alias("seq1"), s.reverse_complement(F.concat(F.lit("ACCATGT"), "cdr3", F.lit("GGGCCCA"))).alias("seq2"))
    return r.best_orientation(x, "AAAA-----ACCATGT([ACGTN]+)GGGCCCA$")


_UMI = "n AS (SELECT sample, marker, umi, cdr3, count(*) AS n FROM cdr3 GROUP BY ALL), m AS (SELECT sample, marker, umi, sum(n)::BIGINT AS reads, max(n) AS clustered, arg_min(cdr3, (-n, cdr3)) AS top FROM n GROUP BY ALL HAVING sum(n) > 1), um AS (SELECT *, 2 * clustered > reads AS correct FROM m)"


@query("g08_umi_consensus", with_views(_UMI + " SELECT sample, marker, umi, reads, top, clustered, correct FROM um", "cdr3"))
def g08(spark, d):
    return r.umi_consensus(rows(spark, d))


@query("t04_capped_umis", with_views(_UMI + " SELECT sample, umi FROM (SELECT *, row_number() OVER (PARTITION BY sample, marker ORDER BY umi) AS nth FROM um WHERE correct) WHERE nth <= 50", "cdr3"))
def t04(spark, d):
    return r.capped_umis(r.umi_consensus(rows(spark, d)), 50).select("sample", "umi")


@query("g08_umi_letters", with_views("SELECT sample, count(*) FILTER (event_id % 23 <> 0) AS used, count(*) FILTER (event_id % 23 = 0) AS left_out FROM cdr3 GROUP BY sample", "cdr3"))
def g08l(spark, d):
    """One UMI in 23 has an unknown base."""
    x = rows(spark, d).withColumn("umi", F.when(F.col("event_id") % 23 == 0, F.overlay("umi", F.lit("N"), 3)).otherwise(F.col("umi")))
    return r.umi_letters(x)


@query("g09_reads_per_umi", with_views("p AS (SELECT sample, reads, count(*) AS umis FROM (SELECT sample, umi, count(*) AS reads FROM cdr3 GROUP BY ALL) GROUP BY ALL), st AS (SELECT sample, unnest(range(1, max(reads) + 1)) AS reads FROM p GROUP BY sample) SELECT st.sample, st.reads, coalesce(umis, 0) AS umis FROM st LEFT JOIN p USING (sample, reads)", "cdr3"))
def g09(spark, d):
    return r.reads_per_umi(rows(spark, d))


@query("g07_equal_length_clusters")
def g07(spark, d):
    counts = rows(spark, d).groupBy("sample", "marker", "cdr3").agg(F.count("*").alias("depth"))
    return r.cluster_equal_length(counts, 1, ["sample", "marker"]).groupBy("sample", "head").agg(F.sum("depth").alias("depth"), F.count("*").alias("members"))


@query("g13_length_histogram", with_views("SELECT sample, length(cdr3) AS len, count(*) AS n FROM cdr3 GROUP BY ALL", "cdr3"))
def g13(spark, d):
    return r.length_counts(rows(spark, d))


@query("g14_segment_usage", with_views("SELECT concat_ws(', ', CASE WHEN grouping(sample) = 0 THEN 'sample' END, CASE WHEN grouping(v) = 0 THEN 'v' END, CASE WHEN grouping(j) = 0 THEN 'j' END) AS level, sample, v, j, count(*) AS n FROM cdr3 GROUP BY GROUPING SETS ((sample, v, j), (sample, v), (sample, j), (v, j), (v), (j))", "cdr3"))
def g14(spark, d):
    return r.segment_usage(rows(spark, d))


@query("g14_usage_by_length", with_views("SELECT length(cdr3) AS len, v, j, count(*) AS n FROM cdr3 GROUP BY GROUPING SETS ((len, v), (len, j))", "cdr3"))
def g14l(spark, d):
    return r.usage_by_length(rows(spark, d))


@query("g13_depth_histogram", with_views("SELECT sample, marker, 'reads' AS step, depth, count(*) AS n FROM (SELECT sample, marker, cdr3, count(*) AS depth FROM cdr3 GROUP BY ALL) GROUP BY ALL", "cdr3"))
def g13d(spark, d):
    return r.depth_counts(rows(spark, d).groupBy("sample", "marker", "cdr3").agg(F.count("*").alias("depth")), "reads")


_SETS = "st AS (SELECT DISTINCT marker, individual, sample, cdr3 FROM cdr3), pa AS (SELECT DISTINCT x.marker, x.individual, x.sample AS a, y.sample AS b FROM st x JOIN st y ON y.marker = x.marker AND y.individual = x.individual AND y.sample > x.sample), nn AS (SELECT sample, marker, count(*) AS n FROM st GROUP BY ALL), cc AS (SELECT x.marker, x.individual, x.sample AS a, y.sample AS b, count(*) AS c FROM st x JOIN st y ON y.marker = x.marker AND y.individual = x.individual AND y.cdr3 = x.cdr3 AND y.sample > x.sample GROUP BY ALL), pc AS (SELECT pa.*, coalesce(c, 0) AS c, na.n + nb.n - 2 * coalesce(c, 0) AS u FROM pa LEFT JOIN cc USING (marker, individual, a, b) JOIN nn na ON na.sample = a AND na.marker = pa.marker JOIN nn nb ON nb.sample = b AND nb.marker = pa.marker)"


@query("g27_chao2_pairs", with_views(_SETS + " SELECT marker, individual, a, b, u, c, CASE WHEN c > 0 THEN u + c + u * u / (2.0 * c) END AS chao2 FROM pc", "cdr3"))
def g27p(spark, d):
    return r.shared_pairs(rows(spark, d))


@query("g19_shared_by_number", with_views("SELECT marker, k, count(*) AS n FROM (SELECT marker, cdr3, count(DISTINCT individual) AS k FROM cdr3 GROUP BY ALL) GROUP BY ALL", "cdr3"))
def g19k(spark, d):
    return r.shared_by_number(rows(spark, d))


@query("g09_variants_per_umi", with_views("SELECT sample, variants, count(*) AS umis FROM (SELECT sample, umi, count(DISTINCT cdr3) AS variants FROM cdr3 GROUP BY ALL) GROUP BY ALL", "cdr3"))
def g09v(spark, d):
    return r.variants_per_umi(rows(spark, d))


_BY_UMI = "n AS (SELECT sample, marker, umi, cdr3, count(*) AS n FROM cdr3 GROUP BY ALL), m AS (SELECT sample, marker, umi, sum(n)::BIGINT AS reads, max(n) AS clustered, arg_min(cdr3, (-n, cdr3)) AS top FROM n GROUP BY ALL), uc AS (SELECT sample, top AS cdr3, count(*) AS umis, sum(clustered)::BIGINT AS reads FROM m WHERE 2 * clustered > reads GROUP BY ALL)"


@query("s09_umi_clonotypes", with_views(_BY_UMI + " SELECT sample, cdr3 AS \"nSeqCDR3\", umis AS \"cloneCount\", round(umis::DOUBLE / sum(umis) OVER (PARTITION BY sample), 6) AS \"cloneFraction\", reads AS \"totalReads\", round(reads::DOUBLE / sum(reads) OVER (PARTITION BY sample), 6) AS \"readFraction\" FROM uc", "cdr3"))
def s09u(spark, d):
    return r.umi_clonotypes(rows(spark, d)).select("sample", "nSeqCDR3", "cloneCount", "cloneFraction", "totalReads", "readFraction")


@query("g16_stage_counts", with_views(_AA + ", cl AS (SELECT sample, cdr3, aa, count(*) AS n FROM ok GROUP BY ALL), p AS (SELECT sample, count(*) AS clones, count(*) FILTER (n = 1) AS singletons, count(DISTINCT aa) AS proteins FROM cl GROUP BY sample) SELECT x.sample, count(*) AS reads, (SELECT count(*) FROM ok WHERE ok.sample = x.sample) AS valid, coalesce(any_value(clones), 0) AS clones, coalesce(any_value(singletons), 0) AS singletons, coalesce(any_value(proteins), 0) AS proteins FROM x LEFT JOIN p ON p.sample = x.sample GROUP BY x.sample", "cdr3"))
def g16(spark, d):
    return r.stage_counts(rows(spark, d), 20, 60)


@query("g17_shared_within", with_views("SELECT marker, individual, k, count(*) AS n FROM (SELECT marker, individual, cdr3, count(DISTINCT sample) AS k FROM cdr3 GROUP BY ALL) GROUP BY ALL", "cdr3"))
def g17(spark, d):
    return r.shared_within(rows(spark, d))


@query("g18_shared_near")
def g18(spark, d):
    return r.shared_near(rows(spark, d), 1)


@query("g19_overlap_matrix", with_views("q AS (SELECT DISTINCT marker, individual, cdr3 FROM cdr3) SELECT a.marker, a.individual AS a, b.individual AS b, count(*) AS shared FROM q a JOIN q b ON a.marker = b.marker AND a.cdr3 = b.cdr3 AND a.individual < b.individual GROUP BY ALL", "cdr3"))
def g19(spark, d):
    return r.overlap_matrix(rows(spark, d), "individual")


@query("g20_translate_collapse", with_views(_AA + " SELECT sample, marker, aa, count(*) AS depth, count(DISTINCT cdr3) AS n_sequences FROM x WHERE NOT stop GROUP BY ALL", "cdr3"))
def g20(spark, d):
    return r.translate_and_collapse(rows(spark, d))




@query("g21_protein_groups", with_views(_AA + ", sg AS (SELECT 'V' AS segment, v, aa, substr(md5(cdr3), 1, 6) AS name, count(*) AS depth FROM x GROUP BY ALL) SELECT segment, aa, sum(depth)::BIGINT AS depth, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM sg GROUP BY ALL", "cdr3"))
def g21(spark, d):
    x = rows(spark, d).groupBy(F.lit("V").alias("segment"), "v", s.translate_dna("cdr3").alias("aa"), F.substring(F.md5("cdr3"), 1, 6).alias("name")).agg(F.count("*").alias("depth"))
    return r.protein_groups(x)


@query("g22_reference_counts", with_views("y AS (SELECT v AS ref, cdr3 AS name, count(*) AS depth FROM cdr3 GROUP BY ALL) SELECT ref, sum(depth)::BIGINT AS depth, count(*) AS matches, count(DISTINCT name) AS distinct_matches FROM y GROUP BY ref", "cdr3"))
def g22(spark, d):
    return r.reference_counts(rows(spark, d).groupBy(F.col("v").alias("ref"), F.col("cdr3").alias("name")).agg(F.count("*").alias("depth")))


@query("g27_chao2", with_views("k AS (SELECT marker, individual, count(*) FILTER (k = 1) AS u, count(*) FILTER (k >= 2) AS c FROM (SELECT marker, individual, cdr3, count(DISTINCT sample) AS k FROM cdr3 GROUP BY ALL) GROUP BY ALL) SELECT *, CASE WHEN c > 0 THEN u + c + u * u / (2.0 * c) END AS chao2 FROM k", "cdr3"))
def g27(spark, d):
    return r.chao2(rows(spark, d))


_CLONE = _AA + """, cl AS (SELECT sample, cdr3, aa, count(*) AS n FROM x GROUP BY ALL), a AS (SELECT *, max(n) OVER p AS top, first_value(cdr3) OVER (PARTITION BY sample, aa ORDER BY n DESC, cdr3) AS lead_seq, row_number() OVER (PARTITION BY sample, aa ORDER BY n DESC, cdr3) AS k, count(*) OVER p AS forms, round(n::DOUBLE / sum(n) OVER (PARTITION BY sample), 6) AS fraction FROM cl WINDOW p AS (PARTITION BY sample, aa)),
b AS (SELECT *, dense_rank() OVER (PARTITION BY sample ORDER BY top DESC, lead_seq)::VARCHAR AS rank FROM a)"""


@query("w08_clone_ids", with_views(_CLONE + " SELECT sample, CASE WHEN forms > 1 THEN concat(rank, '.', k) ELSE rank END AS \"cloneId\", n AS \"cloneCount\", cdr3 AS \"nSeqCDR3\" FROM b", "cdr3"))
def w08(spark, d):
    return r.clonotypes(rows(spark, d)).select("sample", "cloneId", "cloneCount", "nSeqCDR3")


@query("w07_clone_fractions", with_views(_CLONE + " SELECT sample, cdr3 AS \"nSeqCDR3\", fraction AS \"cloneFraction\" FROM b", "cdr3"))
def w07(spark, d):
    return r.clonotypes(rows(spark, d)).select("sample", "nSeqCDR3", "cloneFraction")


@query("s09_clonotype_table", with_views(_CLONE + ", vj AS (SELECT sample, cdr3, arg_min(v, (-c, v)) AS v FROM (SELECT sample, cdr3, v, count(*) AS c FROM cdr3 GROUP BY ALL) GROUP BY ALL), jj AS (SELECT sample, cdr3, arg_min(j, (-c, j)) AS j FROM (SELECT sample, cdr3, j, count(*) AS c FROM cdr3 GROUP BY ALL) GROUP BY ALL) SELECT b.sample, CASE WHEN forms > 1 THEN concat(rank, '.', k) ELSE rank END AS \"cloneId\", n AS \"cloneCount\", fraction AS \"cloneFraction\", b.cdr3 AS \"nSeqCDR3\", aa AS \"aaSeqCDR3\", split_part(v, '*', 1) AS \"vHits\", j AS \"jHits\" FROM b JOIN vj USING (sample, cdr3) JOIN jj USING (sample, cdr3)", "cdr3"))
def s09(spark, d):
    return r.clonotypes(rows(spark, d))


@query("t05_top_clones", with_views(_CLONE + " SELECT sample, cdr3 AS \"nSeqCDR3\", nth FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC, cdr3) AS nth FROM b) WHERE nth <= 20", "cdr3"))
def t05(spark, d):
    return r.top_clones(r.clonotypes(rows(spark, d)), 20).select("sample", "nSeqCDR3", "nth")


@query("w09_percentile_groups", with_views(_CLONE + ", q AS (SELECT sample, quantile_cont(n, [0.2, 0.4, 0.6, 0.8]) AS cuts FROM b GROUP BY sample) SELECT b.sample, cdr3 AS \"nSeqCDR3\", len(list_filter(cuts, lambda c: c < n)) + 1 AS fifth FROM b JOIN q USING (sample)", "cdr3"))
def w09(spark, d):
    return r.percentile_group(r.clonotypes(rows(spark, d))).select("sample", "nSeqCDR3", "fifth")


_MOTIFS = {"V": "..", "CDR3": "[A-Z]{3,}", "J": "[A-Z]{2}$"}


_SEGMENTS = f"""{CODE_CTE}, fr AS (SELECT event_id, k, k % 3 AS off, CASE WHEN k < 3 THEN cdr3 ELSE reverse(translate(cdr3, 'ACGT', 'TGCA')) END AS dna FROM (SELECT event_id, cdr3, unnest(range(6)) AS k FROM cdr3)),
cn AS (SELECT event_id, k, string_agg(aa, '' ORDER BY i) AS aa FROM (SELECT event_id, k, off, dna, unnest(range((length(dna) - off) // 3)) AS i FROM fr) JOIN code ON codon = substr(dna, (i * 3 + off + 1)::INT, 3) GROUP BY ALL),
op AS (SELECT fr.*, length(aa) AS n FROM fr JOIN cn USING (event_id, k) WHERE NOT contains(aa, '*')), hit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY k) AS nth FROM op WHERE n >= 7) WHERE nth = 1),
sg AS (SELECT c.event_id::VARCHAR AS read_id, CASE WHEN h.k IS NOT NULL THEN 'valid' WHEN c.event_id IN (SELECT event_id FROM op) THEN 'no_pattern' ELSE 'no_frame' END AS status, (CASE WHEN h.k < 3 THEN h.k + 1 ELSE 2 - h.k END)::INT AS frame, substr(dna, (off + 1)::INT, 6) AS v, substr(dna, (off + 7)::INT, (3 * n - 12)::INT) AS cdr3, substr(dna, (off + 3 * n - 5)::INT, 6) AS j FROM cdr3 c LEFT JOIN hit h USING (event_id))"""


def _with_pattern(v: int, least: int, j: int) -> str:
    """SQL of the segments when V has v letters, J the last j and CDR3 ``least`` at least."""
    return _SEGMENTS.replace("n >= 7", f"n >= {v + least + j}").replace("::INT, 6) AS v", f"::INT, {3 * v}) AS v").replace("off + 7)::INT, (3 * n - 12)", f"off + {3 * v + 1})::INT, (3 * n - {3 * (v + j)})").replace("off + 3 * n - 5)::INT, 6)", f"off + 3 * n - {3 * j - 1})::INT, {3 * j})")


def tcr_reads(spark, d):
    return rows(spark, d).select(F.col("event_id").cast("string").alias("read_id"), F.col("cdr3").alias("seq"))


@query("c23_segment_reads", with_views(_SEGMENTS + " SELECT * FROM sg", "cdr3"))
def c23(spark, d):
    return r.segment_reads(tcr_reads(spark, d), _MOTIFS).drop("marked")


@query("c23_constant_and_d", with_views(_with_pattern(2, 3, 4) + """, dd AS (SELECT sg.*, (SELECT string_agg(aa, '' ORDER BY i) FROM (SELECT unnest(range(length(cdr3) // 3)) AS i) JOIN code ON codon = substr(cdr3, (i * 3 + 1)::INT, 3)) AS p FROM sg),
de AS (SELECT *, (SELECT x FROM (SELECT unnest(regexp_extract_all(p, '[A-M]+')) AS x, unnest(range(len(regexp_extract_all(p, '[A-M]+')))) AS i) ORDER BY length(x) DESC, i LIMIT 1) AS dm FROM dd)
SELECT read_id, status, frame, v, cdr3, substr(j, 1, 6) AS j, substr(j, 7, 6) AS c, substr(cdr3, (3 * instr(p, dm) - 2)::INT, (3 * length(dm))::INT) AS d, lower(v) || cdr3 || lower(j) AS marked FROM de""", "cdr3"))
def c23c(spark, d):
    return r.segment_reads(tcr_reads(spark, d), {"V": "..", "CDR3": "[A-Z]{3,}", "J": "[A-Z]{2}", "C": "[A-Z]{2}$"}, "[A-M]+")


@query("x01_user_patterns", with_views(_with_pattern(3, 2, 1) + " SELECT * FROM sg", "cdr3"))
def x01(spark, d):
    """Segments by a pattern that the user gives."""
    return r.segment_reads(tcr_reads(spark, d), {"V": "[A-Z]{3}", "CDR3": "[A-Z]{2,}", "J": "[A-Z]$"}).drop("marked")


@query("g44_parse_totals", with_views(_SEGMENTS + " SELECT count(*) AS reads, (SELECT count(*) FROM cdr3 WHERE contains(cdr3, 'ACGT') OR contains(cdr3, 'GATTA') OR contains(cdr3, 'TAATC')) AS with_primer, count(*) FILTER (status = 'valid') AS valid, count(*) FILTER (status = 'no_pattern') AS no_pattern, count(*) FILTER (status = 'no_frame') AS no_frame FROM sg", "cdr3"))
def g44(spark, d):
    return r.parse_totals(r.segment_reads(tcr_reads(spark, d), _MOTIFS, primers=["ACGT", "GATTA"]))


_LCA = "z AS (SELECT otu, count(DISTINCT regexp_extract(taxonomy, 'k:([^,]*)', 1)) AS k, min(regexp_extract(taxonomy, 'k:([^,]*)', 1)) AS kingdom, min(regexp_extract(taxonomy, 'p:([^,]*)', 1)) AS phylum, count(DISTINCT regexp_extract(taxonomy, 'p:([^,]*)', 1)) AS p, count(DISTINCT regexp_extract(taxonomy, 'g:([^,]*)', 1)) AS g, min(regexp_extract(taxonomy, 'f:([^,]*)', 1)) AS family, min(regexp_extract(taxonomy, 'g:([^,]*)', 1)) AS genus FROM taxa GROUP BY otu)"


@query("g23_consensus_taxonomy", with_views(_LCA + " SELECT otu, kingdom, family, CASE WHEN g = 1 THEN genus END AS genus FROM z", "taxa"))
def g23(spark, d):
    return t.consensus(view(spark, d, "taxa")).select("otu", "taxonomy.kingdom", "taxonomy.family", "taxonomy.genus")


@query("g24_roll_up", with_views(_LCA + " SELECT 'phylum' AS level, phylum AS taxon, sample, sum(depth)::BIGINT AS depth, count(DISTINCT otu) AS otus FROM otus JOIN z USING (otu) GROUP BY ALL UNION ALL SELECT 'genus', coalesce(CASE WHEN g = 1 THEN genus END, 'unassigned'), sample, sum(depth)::BIGINT, count(DISTINCT otu) FROM otus JOIN z USING (otu) GROUP BY ALL", "otus", "taxa"))
def g24(spark, d):
    return t.roll_up(view(spark, d, "otus"), t.consensus(view(spark, d, "taxa")), ("phylum", "genus"))


@query("g26_chao1", with_views("SELECT marker, sample, count(*) AS observed, count(*) FILTER (depth = 1) AS f1, count(*) FILTER (depth > 1) AS f2, round_even(count(*) + (count(*) FILTER (depth = 1)) ** 2 / (2.0 * count(*) FILTER (depth > 1)), 0)::BIGINT AS chao1 FROM variants GROUP BY ALL", "variants"))
def g26(spark, d):
    return t.alpha_diversity(view(spark, d, "variants"), ("marker", "sample"))


@query("g25_rarefaction")
def g25(spark, d):
    return t.rarefy(view(spark, d, "otus"), [50, 100, 200], 5)


@query("u04_latest_database", with_views("SELECT otu, CASE WHEN min(hit) % 3 = 0 THEN concat('B', otu) ELSE concat('A', otu) END AS name FROM taxa GROUP BY otu", "taxa"))
def u04(spark, d):
    x = view(spark, d, "taxa").groupBy("otu").agg(F.min("hit").alias("hit"))
    return t.latest_database(x.select("otu", F.concat(F.lit("A"), "otu").alias("name")), x.where("hit % 3 = 0").select("otu", F.concat(F.lit("B"), "otu").alias("name")))


_SAMPLES = [f"S{k}" for k in range(12)]


@query("s08_otu_table", with_views("SELECT otu, " + ", ".join(f"coalesce(sum(depth) FILTER (sample = '{x}'), 0)::BIGINT AS \"{x}\"" for x in _SAMPLES) + " FROM otus GROUP BY otu", "otus"))
def s08(spark, d):
    return t.wide_table(view(spark, d, "otus"), _SAMPLES)


@query("s08_biom_round_trip", with_views("SELECT otu, sample, depth FROM otus", "otus"))
def s08b(spark, d):
    path = work_folder(spark)
    t.write_biom(view(spark, d, "otus"), path)
    return t.read_biom(spark, path)


_SUMMARY = _LCA + """, nt AS (SELECT otu, 'phylum' AS level, phylum AS taxon, p > 1 AS differs FROM z UNION ALL SELECT otu, 'genus', coalesce(CASE WHEN g = 1 THEN genus END, 'unassigned'), g > 1 FROM z),
tt AS (SELECT sample, sum(depth) AS total FROM otus GROUP BY sample), ts AS (SELECT level, taxon, sample, sum(depth) AS depth FROM otus JOIN nt USING (otu) GROUP BY ALL),
tx AS (SELECT level, taxon, sum(depth)::BIGINT AS depth, count(*) AS samples, round(sum(100.0 * depth / total) / (SELECT count(*) FROM tt), 6) AS mean_freq FROM ts JOIN tt USING (sample) GROUP BY ALL),
oc AS (SELECT level, taxon, count(*) AS otus, count(*) FILTER (differs) AS ambiguous FROM nt WHERE otu IN (SELECT otu FROM otus) GROUP BY ALL)"""


@query("g24_taxon_summary", with_views(_SUMMARY + " SELECT level, taxon, otus, depth, samples, mean_freq, ambiguous FROM tx JOIN oc USING (level, taxon)", "otus", "taxa"))
def g24s(spark, d):
    taxa = stored(view(spark, d, "taxa"))
    return t.taxon_summary(stored(view(spark, d, "otus")), t.consensus(taxa), ("phylum", "genus"), taxa).withColumn("mean_freq", F.round("mean_freq", 6))


_DEPTH = "sd AS (SELECT sample, sum(depth) AS depth FROM otus GROUP BY sample), sg AS (SELECT round_even(avg(depth) / 10, 0)::BIGINT::VARCHAR AS tenth, min(depth) AS low FROM sd), sp AS (SELECT greatest(1, substr(tenth, 1, 1)::BIGINT * (10 ** (length(tenth) - 1))::BIGINT) AS step, low FROM sg)"


@query("g25_common_depth", with_views(_DEPTH + " SELECT sample, r.k::INTEGER AS replicate, ((low // step + 1) * step)::BIGINT AS reads FROM sd, sp, (SELECT unnest(range(3)) AS k) r", "otus"))
def g25c(spark, d):
    """Reads of each draw at the common depth; the counts themselves are random."""
    otus = stored(view(spark, d, "otus"))
    _, common = t.rarefaction_depths(otus)
    return t.rarefied_counts(otus, [common], 3).groupBy("sample", "replicate").agg(F.sum("n").alias("reads"))


_RUNS = "r1 AS (SELECT * FROM runs WHERE run = 'F'), r2 AS (SELECT * FROM runs WHERE run <> 'F'), cp AS (SELECT coalesce(a.marker, b.marker) AS marker, coalesce(a.sample, b.sample) AS sample, coalesce(a.md5, b.md5) AS md5, a.depth AS depth_1, b.depth AS depth_2, CASE WHEN b.md5 IS NULL THEN 'only_1' WHEN a.md5 IS NULL THEN 'only_2' ELSE 'common' END AS state FROM r1 a FULL JOIN r2 b ON a.marker = b.marker AND a.sample = b.sample AND a.md5 = b.md5)"


def two(spark, d):
    x = view(spark, d, "runs")
    return x.where("run = 'F'"), x.where("run <> 'F'")


@query("j08_compare_results", with_views(_RUNS + " SELECT * FROM cp", "runs"))
def j08(spark, d):
    return c.compare(*two(spark, d))


@query("j08_compare_statistics", with_views(_RUNS + ", e AS (SELECT marker, sample FROM r1 GROUP BY ALL HAVING sum(depth) >= 820 INTERSECT SELECT marker, sample FROM r2 GROUP BY ALL HAVING sum(depth) >= 820) SELECT marker, count(*) FILTER (state = 'common') AS common, count(*) FILTER (state = 'only_1') AS only_1, count(*) FILTER (state = 'only_2') AS only_2, count(DISTINCT sample) AS samples, count(DISTINCT md5) AS sequences FROM cp JOIN e USING (marker, sample) GROUP BY marker", "runs"))
def j08s(spark, d):
    return c.compare_statistics(*two(spark, d), 820)


@query("j09_explain_missing", with_views(_RUNS + " SELECT marker, sample, md5, CASE WHEN depth_1 >= 3 THEN 'filtering' WHEN depth_1 >= 2 THEN 'clustering' ELSE 'demultiplexing' END AS lost_at FROM cp WHERE state = 'only_1'", "runs"))
def j09(spark, d):
    a, b = two(spark, d)
    missing = c.compare(a, b).where("state = 'only_1'").select("marker", "sample", "md5")
    return c.explain_missing(missing, a.where("depth >= 3"), a.where("depth >= 2"))


@query("j10_combine_results", with_views("SELECT marker, sample, md5, sum(depth)::BIGINT AS depth FROM runs r WHERE (SELECT sum(depth) FROM runs q WHERE q.marker = r.marker AND q.sample = r.sample) >= 1660 GROUP BY ALL", "runs"))
def j10(spark, d):
    return c.combine(list(two(spark, d)), 1660).select("marker", "sample", "md5", "depth")


@query("j10_side_by_side", with_views("SELECT marker, sample, md5, max(depth) FILTER (run = 'F') AS depth_f, max(depth) FILTER (run <> 'F') AS depth_o, sum(depth)::BIGINT AS depth FROM runs r WHERE (SELECT sum(depth) FROM runs q WHERE q.marker = r.marker AND q.sample = r.sample) >= 1660 GROUP BY ALL", "runs"))
def j10s(spark, d):
    a, b = two(spark, d)
    out = c.side_by_side({"F": a, "O": b}, 1660)
    return out.select("marker", "sample", "md5", F.col("depths")["F"].alias("depth_f"), F.col("depths")["O"].alias("depth_o"), "depth")


@query("j10_consistent_names", with_views("nm AS (SELECT DISTINCT md5, concat(marker, length(seq), substr(md5, 1, 1)) AS name FROM runs), k AS (SELECT name, count(DISTINCT md5) AS n FROM nm GROUP BY name) SELECT md5, CASE WHEN n = 1 THEN name ELSE concat(name, '-', substr(md5, 1, 8)) END AS name FROM nm JOIN k USING (name)", "runs"))
def j10n(spark, d):
    return c.consistent_names(view(spark, d, "runs").select(F.expr("concat(marker, length(seq), substr(md5, 1, 1))").alias("name"), "md5"))


@query("j11_replicates", with_views(_RUNS + " SELECT a.marker, a.sample, a.md5, b.md5 IS NOT NULL AS in_replicate, (SELECT count(DISTINCT sample) FROM r1 q WHERE q.marker = a.marker AND q.md5 = a.md5) > 1 AS in_other_sample FROM r1 a LEFT JOIN r2 b ON a.marker = b.marker AND a.sample = b.sample AND a.md5 = b.md5", "runs"))
def j11(spark, d):
    return c.replicates(*two(spark, d)).select("marker", "sample", "md5", "in_replicate", "in_other_sample")


@query("u01_markers_in_both", with_views("SELECT DISTINCT marker FROM runs WHERE marker <> 'M2'", "runs"))
def u01(spark, d):
    a, b = two(spark, d)
    return c.markers_in([a, b.where("marker <> 'M2'")], True)


_COMMON = "cm AS (SELECT chrom, pos, id, ref, alt, count(DISTINCT source) AS files FROM calls GROUP BY ALL)"


@query("j12_common_variants", with_views(_COMMON + " SELECT *, files >= 4 AS common FROM cm", "calls"))
def j12(spark, d):
    return c.common_variants(view(spark, d, "calls"), 4)


@query("u02_non_common_variants", with_views(_COMMON + " SELECT chrom, pos, ref, alt FROM cm WHERE files < 4", "calls"))
def u02(spark, d):
    return c.common_variants(view(spark, d, "calls"), 4).where(~F.col("common")).select("chrom", "pos", "ref", "alt")


@query("j13_compare_text_variants", "SELECT concat('GENE', o_custkey % 50) AS gene, concat('c.', o_orderkey % 90, 'A>T') AS change, CASE WHEN max(o_orderstatus = 'F') AND max(o_orderstatus = 'O') THEN 'common' WHEN max(o_orderstatus = 'F') THEN 'only_1' ELSE 'only_2' END AS state FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2")
def j13(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    lines = lambda status: o.where(F.col("o_orderstatus") == status).select(F.expr("concat('GENE', o_custkey % 50, ' NM_01:', 'exon2: c.', o_orderkey % 90, 'A>T het')").alias("value"))
    return c.compare_text_variants(lines("F"), lines("O"))

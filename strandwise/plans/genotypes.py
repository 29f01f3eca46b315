"""Queries on clustering, filters, genotyping, alleles and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.align import error_positions, pair_alignment, pair_errors
from ..operators import alleles as a
from ..operators import chimeras as h
from ..operators import clustering as c
from ..operators import near as n
from ..operators import reports as p
from ..operators.folders import stored
from .fixtures import view, with_views
from .registry import query
from .scalars import CODE_CTE, pairs, protein_sql


def variants(spark, d):
    """The variants as a table, as they would be after dereplication."""
    return stored(view(spark, d, "variants"))


def freqs(spark, d):
    v = variants(spark, d)
    total = v.groupBy("marker", "sample").agg(F.sum("depth").alias("depth_amplicon"))
    return v.join(total, ["marker", "sample"]).withColumn("freq", 100 * F.col("depth") / F.col("depth_amplicon"))


_FREQ = "fr AS (SELECT v.*, 100.0 * depth / depth_amplicon AS freq FROM variants v JOIN amplicons USING (marker, sample))"


@query("c09_global_alignment")
def c09(spark, d):
    return pairs(spark, d).select("md5", pair_alignment("seq", "ref").alias("p")).select("md5", "p.*")


@query("c10_pair_errors")
def c10(spark, d):
    """Counts and columns of the errors of each pair."""
    x = pairs(spark, d).select("md5", pair_errors("seq", "ref").alias("e"), pair_alignment("seq", "ref").alias("p"))
    at = x.withColumn("at", error_positions("p.q_aln", "p.s_aln"))
    text = lambda c: F.array_join(F.transform(f"at.{c}", lambda x: x.cast("string")), ",")
    return at.select("md5", "e.*", *[text(c).alias(f"{c}_at") for c in ("subs", "ins", "dels", "homo")])


@query("g04_guided_clusters")
def g04(spark, d):
    return c.cluster_guided(variants(spark, d), 2, 2)


_HEADS = "hd AS (SELECT marker, sample, cluster, max(md5) FILTER (role = 'head') AS md5, max(seq) FILTER (role = 'head') AS seq, sum(CASE WHEN counted THEN depth ELSE 0 END)::BIGINT AS depth, count(*) AS size FROM members WHERE cluster > 0 GROUP BY ALL)"


@query("g10_cluster_depths", with_views(_HEADS + " SELECT * FROM hd", "members"))
def g10(spark, d):
    return c.cluster_depths(view(spark, d, "members"))


_CONSENSUS = _HEADS + f""", bs AS (SELECT h.marker, h.sample, h.cluster, h.seq AS head_seq, h.size, i, substr(m.seq, i::INT, 1) AS b, sum(m.depth) AS d FROM members m JOIN hd h ON h.marker = m.marker AND h.sample = m.sample AND h.cluster = m.cluster AND length(h.seq) = length(m.seq), (SELECT unnest(range(1, 61)) AS i) WHERE m.cluster > 0 AND counted AND i <= length(h.seq) GROUP BY ALL),
be AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY marker, sample, cluster, i ORDER BY d DESC, b) AS k FROM bs) WHERE k = 1), co AS (SELECT marker, sample, cluster, head_seq, size, string_agg(b, '' ORDER BY i) AS seq FROM be GROUP BY marker, sample, cluster, head_seq, size),
cs AS (SELECT DISTINCT seq FROM co), {CODE_CTE}, pt AS (SELECT seq, aa FROM ({protein_sql('(SELECT seq AS k, seq FROM cs)', 'k')}) JOIN cs ON cs.seq = k),
fn AS (SELECT marker, sample, cluster, head_seq, CASE WHEN size >= 3 AND length(co.seq) % 3 = 0 AND NOT contains(aa, '*') THEN co.seq ELSE head_seq END AS consensus FROM co JOIN pt USING (seq))"""


@query("g05_consensus", with_views(_CONSENSUS + " SELECT marker, sample, cluster, consensus, consensus <> head_seq AS changed, (SELECT min(m.cluster) FROM members m WHERE m.cluster > 0 AND m.marker = fn.marker AND m.sample = fn.sample AND m.seq = fn.consensus AND m.cluster < fn.cluster) AS merged_into FROM fn", "members"))
def g05(spark, d):
    return c.consensus(stored(view(spark, d, "members")), 3, [60])


@query("g05_gapped_consensus")
def g05g(spark, d):
    """Of guided clusters: members with a deletion vote for a gap."""
    return c.consensus(stored(c.cluster_guided(variants(spark, d), 2, 2)), 3, [60], gapped=True)


@query("g06_denovo_clusters")
def g06(spark, d):
    return c.cluster_denovo(variants(spark, d))


@query("g11_identity_clusters")
def g11(spark, d):
    return c.cluster_by_identity(variants(spark, d), 95, ["marker", "sample"], 0.2)


@query("g12_segment_clusters")
def g12(spark, d):
    return c.cluster_segments(variants(spark, d), ["marker", "sample"], 0.3)


@query("j23_known_heads", with_views("k AS (SELECT m.*, row_number() OVER (PARTITION BY marker, sample, cluster ORDER BY CASE WHEN m.seq IN (SELECT seq FROM alleles) THEN 0 ELSE 1 END, CASE WHEN role = 'head' THEN 0 ELSE 1 END, depth DESC, md5) AS nth FROM members m) SELECT marker, sample, cluster, CASE WHEN cluster = 0 THEN 'none' WHEN nth = 1 THEN 'head' ELSE 'member' END AS role, md5, seq, depth, counted FROM k", "members", "alleles"))
def j23(spark, d):
    return c.prefer_known_heads(view(spark, d, "members"), view(spark, d, "alleles"))


# Within two errors an alignment has as many errors as the edit distance; what the lengths differ by is gaps.
_PAIRS = f"""pr AS (SELECT x.marker, x.sample, x.md5, y.md5 AS of, x.depth, y.depth AS depth_of, length(x.seq) AS nx, length(y.seq) AS ny, CASE WHEN length(x.seq) = length(y.seq) THEN hamming(x.seq, y.seq) END AS h, levenshtein(x.seq, y.seq) AS lev FROM variants x JOIN variants y ON y.marker = x.marker AND y.sample = x.sample AND y.md5 <> x.md5),
er AS (SELECT *, CASE WHEN h <= greatest(2, nx // 10) THEN h ELSE lev END AS errors, CASE WHEN h <= greatest(2, nx // 10) THEN 0 WHEN nx = ny THEN 1 ELSE greatest(ny - nx, 0) END AS ins, CASE WHEN h <= greatest(2, nx // 10) THEN 0 WHEN nx = ny THEN 1 ELSE greatest(nx - ny, 0) END AS dels FROM pr)"""


@query("j20_pairwise_comparison", with_views(_PAIRS + " SELECT marker, sample, md5, of, depth, depth_of, errors - ins - dels AS subs, ins, dels FROM er WHERE errors <= 2", "variants"))
def j20(spark, d):
    return n.compare_within(variants(spark, d), 2).select("marker", "sample", "md5", "of", "depth", "depth_of", "subs", "ins", "dels")


@query("j20_similar_variants")
def j20s(spark, d):
    """With limits in percent, and the error label."""
    return n.compare_within(variants(spark, d), 4, 3.5, 2, 95)


_CHIM = """rk AS (SELECT *, row_number() OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS nth FROM variants),
pf AS (SELECT q.marker, q.sample, q.md5, length(q.seq) AS n, p.md5 AS parent, coalesce((SELECT min(i) - 1 FROM (SELECT unnest(range(1, least(length(q.seq), length(p.seq)) + 1)) AS i) WHERE substr(q.seq, i, 1) <> substr(p.seq, i, 1)), least(length(q.seq), length(p.seq))) AS pre,
coalesce((SELECT min(i) - 1 FROM (SELECT unnest(range(1, least(length(q.seq), length(p.seq)) + 1)) AS i) WHERE substr(reverse(q.seq), i, 1) <> substr(reverse(p.seq), i, 1)), least(length(q.seq), length(p.seq))) AS suf FROM rk q JOIN rk p ON p.marker = q.marker AND p.sample = q.sample AND p.nth < q.nth)
SELECT DISTINCT x.marker, x.sample, x.md5 FROM pf x JOIN pf y ON y.marker = x.marker AND y.sample = x.sample AND y.md5 = x.md5 AND y.parent <> x.parent WHERE x.pre >= 10 AND y.suf >= 10 AND x.pre + y.suf >= x.n AND x.pre < x.n AND y.suf < x.n"""


def _chim_of(source: str) -> str:
    """The chimeras of a table like variants, as one query."""
    return "WITH " + _CHIM.replace("FROM variants)", f"FROM {source})")


def _near(errors: int) -> str:
    """Is x within so many errors of the deeper y? Equal lengths with up to six differences are compared without gaps."""
    h = "(SELECT count(*) FROM (SELECT unnest(range(1, length(x.seq) + 1)) AS i) WHERE substr(x.seq, i::INT, 1) <> substr(y.seq, i::INT, 1))"
    return f"CASE WHEN length(x.seq) <> length(y.seq) THEN levenshtein(x.seq, y.seq) <= {errors} WHEN {h} <= 6 THEN {h} <= {errors} ELSE levenshtein(x.seq, y.seq) <= {errors} END"


def _copies(source: str, errors: int) -> str:
    """CTE body: copies (marker, sample, md5) of a deeper variant of the amplicon and the least percent of its depth."""
    return f"SELECT x.marker, x.sample, x.md5, min(100.0 * x.depth / y.depth) AS ratio FROM {source} x JOIN {source} y ON y.marker = x.marker AND y.sample = x.sample AND (y.depth > x.depth OR (y.depth = x.depth AND y.md5 < x.md5)) WHERE {_near(errors)} GROUP BY ALL"


@query("j21_chimeras", with_views(_CHIM, "variants"))
def j21(spark, d):
    return h.chimeras(variants(spark, d), 10).select("marker", "sample", "md5")


# The frame of an amplicon is the first one without a stop of its deepest variant that has one.
_FILTER = _FREQ + f""", u AS (SELECT DISTINCT md5, seq FROM variants), {CODE_CTE}, {", ".join(f"f{f} AS ({protein_sql('u', 'md5', frame=f)})" for f in (1, 2, 3))},
fs AS (SELECT f1.md5, contains(f1.aa, '*') AS s1, contains(f2.aa, '*') AS s2, contains(f3.aa, '*') AS s3 FROM f1 JOIN f2 USING (md5) JOIN f3 USING (md5)),
t AS (SELECT fr.*, s1, s2, s3, length(md5) - length(replace(md5, '0', '')) + 1 AS cluster_size, first_value(freq) OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS top, first_value(CASE WHEN NOT s1 THEN 1 WHEN NOT s2 THEN 2 WHEN NOT s3 THEN 3 END IGNORE NULLS) OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS frame FROM fr JOIN fs USING (md5))"""


@query("f07_artefact_filters", with_views(_FILTER + " SELECT marker, sample, md5, concat_ws(',', CASE WHEN depth < 2 THEN 'depth' END, CASE WHEN freq < 0.5 THEN 'frequency' END, CASE WHEN 100 * freq < 2 * top THEN 'dominant frequency' END, CASE WHEN length(seq) <> 60 THEN 'length' END, CASE WHEN (length(seq) - 60) % 3 <> 0 THEN 'frameshift' END, CASE WHEN cluster_size < 2 THEN 'cluster size' END, CASE WHEN CASE frame WHEN 1 THEN s1 WHEN 2 THEN s2 WHEN 3 THEN s3 ELSE true END THEN 'stop' END) AS reasons FROM t", "variants", "amplicons"))
def f07(spark, d):
    sized = freqs(spark, d).withColumn("cluster_size", F.length("md5") - F.length(F.replace("md5", F.lit("0"), F.lit(""))) + 1)
    out = c.filter_artefacts(sized, 2, 0.5, 2, [60], 0, True, stops=True, min_cluster_size=2)
    return out.select("marker", "sample", "md5", F.array_join("reasons", ",").alias("reasons"))


_DOC = "k AS (SELECT *, row_number() OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS nth FROM variants), dr AS (SELECT *, depth::DOUBLE / lead(depth) OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS ratio FROM k WHERE nth <= 11), be AS (SELECT marker, sample, max(nth) AS n FROM (SELECT *, max(ratio) OVER (PARTITION BY marker, sample) AS best FROM dr WHERE ratio IS NOT NULL) WHERE ratio = best GROUP BY ALL)"


@query("f07_degree_filter", with_views(_DOC + " SELECT marker, sample, md5, nth <= coalesce(n, 1) AS kept FROM k LEFT JOIN be USING (marker, sample)", "variants"))
def f07d(spark, d):
    return c.filter_artefacts(freqs(spark, d), degree=True).select("marker", "sample", "md5", "kept")


@query("f07_identity_filter", with_views("k AS (SELECT *, first_value(seq) OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS top FROM variants) SELECT marker, sample, md5, CASE WHEN length(seq) = length(top) THEN (SELECT count(*) FROM (SELECT unnest(range(1, 61)) AS i) WHERE substr(k.seq, i::INT, 1) = substr(k.top, i::INT, 1)) >= 54 ELSE levenshtein(seq, top) <= 6 END AS kept FROM k", "variants"))
def f07i(spark, d):
    return c.filter_artefacts(freqs(spark, d), min_identical=54).select("marker", "sample", "md5", "kept")


@query("f07_ordered_filters")
def f07o(spark, d):
    return c.filter_artefacts(freqs(spark, d), 2, 0.5, max_alleles=4, chimera=10).select("marker", "sample", "md5", "kept", F.array_join("reasons", ",").alias("reasons"))


@query("f10_dominance", with_views(f"u AS (SELECT DISTINCT md5, seq FROM variants), {CODE_CTE}, pr AS ({protein_sql('u', 'md5')}) SELECT md5, length(seq) = 60 AND NOT contains(aa, '*') AS dominant FROM u JOIN pr USING (md5)", "variants"))
def f10(spark, d):
    return variants(spark, d).select("md5", "seq").distinct().select("md5", c.is_dominant("seq", F.array(F.lit(60))).alias("dominant"))


@query("f10_reference_dominance", with_views("r AS (SELECT p_partkey AS k, p_partkey % 4 AS n_ins, p_size % 4 AS n_del, p_partkey % 13 AS gap FROM part) SELECT k, (n_ins = 1 AND n_del = 1 AND abs(20 - 30 - gap) <= 9) OR (n_ins % 3 = 0 AND n_del % 3 = 0 AND (n_del <> 3 OR gap = 0)) AS dominant FROM r"))
def f10r(spark, d):
    """Indels against a reference: insertions side by side, the last deletion some bases away."""
    x = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("k"), (F.col("p_partkey") % 4).cast("int").alias("n_ins"), (F.col("p_size") % 4).cast("int").alias("n_del"), (F.col("p_partkey") % 13).cast("int").alias("gap"))
    ins = F.slice(F.array(F.lit(20), F.lit(21), F.lit(22)), 1, F.col("n_ins"))
    dels = F.transform(F.slice(F.array(F.lit(30), F.lit(31), F.lit(32)), 1, F.col("n_del")), lambda at, i: F.when(i + 1 == F.col("n_del"), at + F.col("gap")).otherwise(at))
    seq = F.lit("ACG" * 20)
    return x.select("k", c.is_dominant(seq, F.array(F.lit(60)), ins, dels).alias("dominant"))


@query("g38_threshold_zones", with_views(_FREQ + f", cp AS ({_copies('variants', 1)}), ch AS ({_chim_of('variants')}) SELECT marker, sample, md5, CASE WHEN freq < 1 THEN 'artefact' WHEN freq > 5 OR (ratio IS NULL AND ch.md5 IS NULL) THEN 'allele' ELSE 'artefact' END AS verdict FROM fr LEFT JOIN cp USING (marker, sample, md5) LEFT JOIN ch USING (marker, sample, md5)", "variants", "amplicons"))
def g38(spark, d):
    return c.genotype_threshold_zones(freqs(spark, d)).select("marker", "sample", "md5", "verdict")


@query("g39_folding")
def g39(spark, d):
    return c.genotype_folding(variants(spark, d))


_RUNS = f"""a1 AS (SELECT marker, sample, md5, seq, depth, 100.0 * depth / sum(depth) OVER (PARTITION BY marker, sample) AS freq FROM runs WHERE run = 'F'), cp AS ({_copies('a1', 2)}), ch AS ({_chim_of('a1')}),
tw AS (SELECT DISTINCT marker, sample, md5 FROM runs WHERE run <> 'F'), sn AS (SELECT marker, md5, count(DISTINCT sample) AS n FROM a1 GROUP BY ALL),
lb AS (SELECT a1.*, CASE WHEN ch.md5 IS NOT NULL THEN 'chimera' WHEN cp.md5 IS NOT NULL THEN 'copy' ELSE 'distinct' END AS label, tw.md5 IS NOT NULL OR n > 1 AS found FROM a1 JOIN sn USING (marker, md5) LEFT JOIN tw USING (marker, sample, md5) LEFT JOIN cp USING (marker, sample, md5) LEFT JOIN ch USING (marker, sample, md5)),
st AS (SELECT *, CASE WHEN NOT found THEN 'artefact' WHEN label = 'distinct' THEN 'candidate' ELSE 'doubtful' END AS step FROM lb),
wo AS (SELECT *, max(CASE WHEN step = 'artefact' THEN freq END) OVER (PARTITION BY marker, sample) AS worst FROM st)"""


@query("g40_replicates", with_views(_RUNS + " SELECT marker, sample, md5, depth, round(freq, 6) AS freq, label, CASE WHEN step = 'artefact' THEN 'artefact' WHEN step = 'candidate' AND freq > coalesce(worst, 0) THEN 'allele' WHEN step = 'doubtful' THEN 'artefact' ELSE 'unclassified' END AS verdict FROM wo", "runs"))
def g40(spark, d):
    runs = stored(view(spark, d, "runs"))
    total = runs.groupBy("run", "marker", "sample").agg(F.sum("depth").alias("total"))
    runs = runs.join(total, ["run", "marker", "sample"]).withColumn("freq", 100 * F.col("depth") / F.col("total")).drop("total")
    return c.genotype_replicates(runs.where("run = 'F'").drop("run"), runs.where("run <> 'F'").drop("run")).withColumn("freq", F.round("freq", 6))


_RANK = _FREQ + ", b AS (SELECT marker, md5, max(freq) AS best FROM fr WHERE freq >= 0.5 GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS rank, avg(best) OVER (PARTITION BY marker ORDER BY best DESC, md5 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS below, avg(best) OVER (PARTITION BY marker ORDER BY best DESC, md5 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above FROM b WINDOW w AS (PARTITION BY marker ORDER BY best DESC, md5))"


@query("g41_rank_genotypes", with_views(_RANK + ", e AS (SELECT marker, min(rank) AS stop FROM r WHERE coalesce(below, 0) < 1 GROUP BY marker) SELECT r.marker, md5, rank, rank <= coalesce(stop, rank) AS allele FROM r LEFT JOIN e USING (marker)", "variants", "amplicons"))
def g41(spark, d):
    return c.genotype_by_rank(freqs(spark, d), 0.5).select("marker", "md5", "rank", "allele")


_REPAIRED = _FREQ + """, rp AS (SELECT x.marker, x.sample, x.md5, arg_min(y.md5, (-y.depth, y.md5)) AS to FROM fr x JOIN fr y ON y.marker = x.marker AND y.sample = x.sample AND (y.depth > x.depth OR (y.depth = x.depth AND y.md5 < x.md5)) AND abs(length(y.seq) - length(x.seq)) = 1 WHERE x.freq < 2 AND levenshtein(x.seq, y.seq) = 1 GROUP BY ALL)"""


@query("g41_repaired_indels", with_views(_REPAIRED + " SELECT fr.marker, fr.sample, coalesce(rp.to, fr.md5) AS md5, sum(fr.depth)::BIGINT AS depth, round(sum(fr.freq), 6) AS freq FROM fr LEFT JOIN rp ON rp.marker = fr.marker AND rp.sample = fr.sample AND rp.md5 = fr.md5 GROUP BY ALL", "variants", "amplicons"))
def g41i(spark, d):
    return c.repaired_indels(stored(freqs(spark, d)), 2).select("marker", "sample", "md5", "depth", F.round("freq", 6).alias("freq"))


@query("w10_running_means", with_views(_RANK + " SELECT marker, md5, round(above, 6) AS above, round(below, 6) AS below FROM r", "variants", "amplicons"))
def w10(spark, d):
    return c.genotype_by_rank(freqs(spark, d), 0.5).select("marker", "md5", F.round("above", 6).alias("above"), F.round("below", 6).alias("below"))


@query("g42_check_verdicts", with_views(f"cp AS ({_copies('variants', 1)}), ch AS ({_chim_of('variants')}), sta AS (SELECT marker, md5, CASE WHEN ch.md5 IS NOT NULL OR ratio < 25 THEN 'bad' WHEN ratio IS NOT NULL THEN 'suspicious' ELSE 'good' END AS state FROM variants LEFT JOIN cp USING (marker, sample, md5) LEFT JOIN ch USING (marker, sample, md5)), per AS (SELECT marker, md5, count(*) FILTER (state = 'good') AS good, count(*) FILTER (state = 'suspicious') AS suspicious, count(*) FILTER (state = 'bad') AS bad FROM sta GROUP BY ALL) SELECT *, CASE WHEN good > 5 * (bad + suspicious) THEN 'good' WHEN good + suspicious > bad THEN 'suspicious' ELSE 'bad' END AS verdict FROM per", "variants"))
def g42(spark, d):
    x = variants(spark, d)
    return c.check_verdicts(x, n.near_pairs(x, 1), h.chimeras(x))


@query("j04_exact_allele_matches", with_views("SELECT DISTINCT v.md5, a.name FROM variants v JOIN (SELECT name, substr(seq, 6, 40) AS ref FROM alleles) a ON contains(v.seq, a.ref) OR contains(a.ref, v.seq)", "variants", "alleles"))
def j04(spark, d):
    return a.exact_matches(variants(spark, d), view(spark, d, "alleles").withColumn("seq", F.substring("seq", 6, 40)), 30)


def lengths(variants, alleles):
    v = variants.select(F.col("md5").alias("id"), F.length("seq").alias("len")).distinct()
    return v.unionByName(alleles.select(F.col("name").alias("id"), F.length("seq").alias("len")))


@query("j06_seed_hits", with_views("""q AS (SELECT DISTINCT md5 AS query, seq AS qs FROM variants), qw AS (SELECT *, substr(qs, qa::INT, 10) AS w FROM (SELECT *, unnest(range(1, length(qs) - 8)) AS qa FROM q)), sw AS (SELECT *, substr(ss, sa::INT, 10) AS w FROM (SELECT name AS subject, seq AS ss, unnest(range(1, length(seq) - 8)) AS sa FROM alleles)),
dg AS (SELECT DISTINCT query, subject, qa - sa AS diagonal, substr(qs, (greatest(qa - sa, 0) + 1)::INT) AS a, substr(ss, (greatest(sa - qa, 0) + 1)::INT) AS b FROM qw JOIN sw USING (w)), dl AS (SELECT *, least(length(a), length(b)) AS n FROM dg)
SELECT query, subject, (SELECT count(*) FROM (SELECT unnest(range(1, n + 1)) AS i) WHERE substr(a, i::INT, 1) = substr(b, i::INT, 1)) AS ident, n AS aligned FROM dl""", "variants", "alleles"))
def j06(spark, d):
    return a.seed_hits(variants(spark, d), view(spark, d, "alleles"))


_LOCAL = """q AS (SELECT DISTINCT md5 AS query, seq AS qs FROM variants), sb AS (SELECT name AS subject, '+' AS strand, seq AS ss FROM alleles UNION ALL SELECT name, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM alleles),
qw AS (SELECT *, substr(qs, qa::INT, 10) AS w FROM (SELECT *, unnest(range(1, length(qs) - 8)) AS qa FROM q)), sw AS (SELECT *, substr(ss, sa::INT, 10) AS w FROM (SELECT *, unnest(range(1, length(ss) - 8)) AS sa FROM sb)),
dg AS (SELECT DISTINCT query, subject, strand, qs, ss, greatest(qa - sa, 0) AS a, greatest(sa - qa, 0) AS b FROM qw JOIN sw USING (w)),
po AS (SELECT *, CASE WHEN substr(qs, (a + i + 1)::INT, 1) = substr(ss, (b + i + 1)::INT, 1) THEN 1 ELSE -3 END AS v FROM (SELECT *, unnest(range(least(length(qs) - a, length(ss) - b))) AS i FROM dg)),
pr AS (SELECT *, sum(v) OVER w - v AS prev FROM po WINDOW w AS (PARTITION BY query, subject, strand, a, b ORDER BY i)), mi AS (SELECT *, min(prev) OVER w AS low FROM pr WINDOW w AS (PARTITION BY query, subject, strand, a, b ORDER BY i)),
st AS (SELECT *, prev + v - low AS score, max(CASE WHEN prev = low THEN i END) OVER w AS first FROM mi WINDOW w AS (PARTITION BY query, subject, strand, a, b ORDER BY i)),
be AS (SELECT *, row_number() OVER (PARTITION BY query, subject, strand, a, b ORDER BY score DESC, i) AS nth FROM st)"""


@query("j06_local_segments", with_views(_LOCAL + " SELECT query, subject, strand, (a + first + 1)::INT AS q_start, (CASE strand WHEN '+' THEN b + first + 1 ELSE length(ss) - (b + i) END)::INT AS s_start, (i - first + 1)::INT AS aligned, ((score + 3 * (i - first + 1)) // 4)::INT AS ident, score::INT AS score FROM be WHERE nth = 1 AND score >= 10", "variants", "alleles"))
def j06l(spark, d):
    return a.local_hits(variants(spark, d), view(spark, d, "alleles"), both_strands=True)


@query("j05_best_names", with_views("""h AS (SELECT DISTINCT v.md5 AS query, a.name AS subject, v.seq, a.seq AS ref FROM variants v JOIN alleles a ON length(v.seq) = length(a.seq) OR v.seq = concat(substr(a.seq, 1, 20), substr(a.seq, 22))),
k AS (SELECT query, subject, length(ref) AS n, CASE WHEN length(seq) < length(ref) THEN length(seq) ELSE (SELECT count(*) FROM (SELECT unnest(range(1, length(seq) + 1)) AS i) WHERE substr(seq, i, 1) = substr(ref, i, 1)) END AS ident FROM h), m AS (SELECT *, rank() OVER (PARTITION BY query ORDER BY ident DESC) AS r FROM k WHERE ident >= 0.9 * n) SELECT query, string_agg(subject, ' | ' ORDER BY subject) AS name, max(ident) AS ident FROM m WHERE r = 1 GROUP BY query""", "variants", "alleles"))
def j05(spark, d):
    v, alleles = variants(spark, d), stored(view(spark, d, "alleles"))
    return a.best_names(a.word_hits(v, alleles), lengths(v, alleles))


@query("j07_segment_names")
def j07(spark, d):
    x = view(spark, d, "inserts").select(F.concat_ws("-", "sample", "marker").alias("clone"), F.col("seq").alias("segment"))
    return a.name_segments(x, view(spark, d, "alleles"))


@query("j24_locus_vote", with_views("SELECT marker, marker AS locus FROM alleles GROUP BY marker", "alleles"))
def j24(spark, d):
    return a.locus_of_markers(view(spark, d, "alleles").select("marker", "name"))


@query("j22_alleles_over_exons")
def j22(spark, d):
    x = freqs(spark, d).select(F.lit("L").alias("locus"), "sample", "marker", "md5", "freq", F.array(F.expr("concat('A*', cast(depth % 4 as int))"), F.expr("concat('A*', cast(depth % 3 as int))")).alias("alleles"))
    return a.alleles_over_exons(x)


_LOC = "ht AS (SELECT DISTINCT marker AS locus, concat('A', x) AS allele, read_id AS read FROM (SELECT marker, read_id, unnest([substr(sample, 2)::INT % 5, substr(sample, 2)::INT % 3]) AS x FROM inserts)), ct AS (SELECT locus, allele, count(*) AS reads FROM ht GROUP BY ALL), fi AS (SELECT locus, read, allele FROM (SELECT *, row_number() OVER (PARTITION BY locus, read ORDER BY reads DESC, allele) AS k FROM ht JOIN ct USING (locus, allele)) WHERE k = 1), ow AS (SELECT locus, allele, reads, count(*) AS corrected FROM fi JOIN ct USING (locus, allele) GROUP BY ALL), rk AS (SELECT *, row_number() OVER w AS k, coalesce(lag(corrected) OVER w < 5 * corrected, true) AS fine FROM ow WINDOW w AS (PARTITION BY locus ORDER BY reads DESC, allele))"


@query("g35_corrected_coverage", with_views(_LOC + " SELECT locus, allele, reads, corrected, fine AND coalesce(sum(fine::INT) OVER (PARTITION BY locus ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 2 AS kept FROM rk", "inserts"))
def g35(spark, d):
    x = view(spark, d, "inserts").select("read_id", "marker", "sample")
    hits = x.select(F.col("marker").alias("locus"), F.explode(F.array(F.concat(F.lit("A"), F.expr("cast(substr(sample, 2) as int) % 5")), F.concat(F.lit("A"), F.expr("cast(substr(sample, 2) as int) % 3")))).alias("allele"), F.col("read_id").alias("read"))
    return a.corrected_coverage(hits)


_EQUAL = "ht AS (SELECT DISTINCT marker AS locus, concat('A', x) AS allele, read_id AS read FROM (SELECT marker, read_id, unnest([substr(sample, 2)::INT % 5, substr(sample, 2)::INT % 3, 100 + substr(sample, 2)::INT % 3]) AS x FROM inserts)), sg AS (SELECT locus, allele, string_agg(read, ',' ORDER BY read) AS reads FROM ht GROUP BY ALL), nm AS (SELECT locus, reads, string_agg(allele, ' | ' ORDER BY allele) AS entry FROM sg GROUP BY ALL)"


def read_sets(spark, d):
    """Each read supports an allele by its sample modulo 5, and two by it modulo 3."""
    x = view(spark, d, "inserts").select("read_id", "marker", F.expr("cast(substr(sample, 2) as int)").alias("k"))
    alleles = F.array(*[F.concat(F.lit("A"), e.cast("string")) for e in (F.col("k") % 5, F.col("k") % 3, F.col("k") % 3 + 100)])
    return x.select(F.col("marker").alias("locus"), F.explode(alleles).alias("allele"), F.col("read_id").alias("read"))


@query("g35_equal_alleles", with_views(_EQUAL + " SELECT locus, allele, entry FROM sg JOIN nm USING (locus, reads)", "inserts"))
def g35e(spark, d):
    return a.equal_alleles(read_sets(spark, d))


@query("g35_allele_numbers", with_views(_EQUAL + """, e AS (SELECT DISTINCT locus, entry AS allele, read FROM ht JOIN sg USING (locus, allele) JOIN nm USING (locus, reads)), ct AS (SELECT locus, allele, count(*) AS reads FROM e GROUP BY ALL),
fi AS (SELECT locus, read, allele FROM (SELECT *, row_number() OVER (PARTITION BY locus, read ORDER BY reads DESC, allele) AS k FROM e JOIN ct USING (locus, allele)) WHERE k = 1), ow AS (SELECT locus, allele, reads, count(*) AS corrected FROM fi JOIN ct USING (locus, allele) GROUP BY ALL),
rk AS (SELECT *, row_number() OVER w AS nth, lead(corrected) OVER w AS next FROM ow WINDOW w AS (PARTITION BY locus ORDER BY corrected DESC, allele)),
dc AS (SELECT locus, max(CASE WHEN nth = 1 THEN corrected > 5 * next END) AS one, arg_max(nth, (corrected::DOUBLE / next, nth)) AS degree FROM rk WHERE nth <= 2 AND next IS NOT NULL GROUP BY locus)
SELECT rk.locus, allele, reads, corrected, nth <= CASE WHEN coalesce(one, true) THEN 1 ELSE degree END AS kept FROM rk LEFT JOIN dc ON dc.locus = rk.locus""", "inserts"))
def g35n(spark, d):
    return a.allele_numbers(read_sets(spark, d))


@query("c21_allele_groups")
def c21(spark, d):
    x = view(spark, d, "taxa").groupBy("otu").agg(F.array_sort(F.collect_set(F.expr("concat('A*', hit % 2, ':0', hit % 4, ':', hit % 8)"))).alias("names"))
    return a.group_allele_names(x)


@query("c21_groups_between")
def c21b(spark, d):
    """Names of one half of each OTU's hits against those of the other half."""
    name = F.expr("concat('A*', hit % 3, ':0', hit % 4, ':', hit % 8)")
    half = lambda k: F.array_sort(F.collect_set(F.when(F.floor(F.col("hit") / 60) % 2 == k, name)))
    x = view(spark, d, "taxa").groupBy("otu").agg(half(0).alias("names"), half(1).alias("others"))
    out = a.group_allele_names_between(x, "names", "others").select("otu", F.explode("groups").alias("g"))
    return out.select("otu", "g.name", F.array_join("g.members", ",").alias("members"))


@query("f14_frequent_alleles", "WITH f AS (SELECT concat('L', p_size % 3) AS locus, p_brand AS allele, p_partkey AS entry, p_size AS coverage FROM part), g AS (SELECT DISTINCT locus, allele FROM f WHERE allele LIKE '%1') SELECT locus, allele, entry, coverage FROM (SELECT f.*, row_number() OVER (PARTITION BY locus, allele ORDER BY coverage DESC, entry) AS n FROM f JOIN g USING (locus, allele)) WHERE n = 1")
def f14(spark, d):
    f = spark.read.parquet(f"{d}/part.parquet").select(F.expr("concat('L', p_size % 3)").alias("locus"), F.col("p_brand").alias("allele"), F.col("p_partkey").alias("entry"), F.col("p_size").alias("coverage"))
    return a.frequent_alleles(f, f.where("allele like '%1'"))


def qc_rows(spark, d):
    refs = view(spark, d, "alleles").where("name like '%-0'").select("marker", F.col("seq").alias("ref"))
    return view(spark, d, "inserts").join(refs, "marker").select("read_id", "sample", "marker", "seq", "ref", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))


@query("g28_error_totals")
def g28(spark, d):
    return p.error_totals(p.read_errors(qc_rows(spark, d)))


def sided_errors(spark, d):
    """Two sides of each read: it on its strand, and a mate with the errors of its first base."""
    x = view(spark, d, "inserts").select("read_id", "marker", F.when(F.col("strand") == "R", "R").otherwise("F").alias("side"), (F.col("tax") % 3).alias("subs"), F.lit(0).alias("ins"), (F.length("seq") == 59).cast("int").alias("dels"))
    mate = x.where("subs < 2").select("read_id", "marker", F.translate("side", "FR", "RF").alias("side"), F.when(F.col("read_id") < "8", 1).otherwise(0).alias("subs"), F.lit(0).alias("ins"), F.lit(0).alias("dels"))
    return x.unionByName(mate)


_SIDES = "x AS (SELECT read_id, marker, CASE WHEN strand = 'R' THEN 'R' ELSE 'F' END AS side, tax % 3 AS subs, CASE WHEN length(seq) = 59 THEN 1 ELSE 0 END AS dels FROM inserts), y AS (SELECT * FROM x UNION ALL SELECT read_id, marker, translate(side, 'FR', 'RF'), CASE WHEN read_id < '8' THEN 1 ELSE 0 END, 0 FROM x WHERE subs < 2), z AS (SELECT marker, read_id, bool_or(side = 'F') AS hf, bool_or(side = 'R') AS hr, bool_or(side = 'F' AND subs + dels > 0) AS bf, bool_or(side = 'R' AND subs + dels > 0) AS br FROM y GROUP BY ALL)"
_CLASSES = "count(*) AS reads, count(*) FILTER (hf AND hr) AS both_primers, count(*) FILTER (bf AND NOT br) AS forward_errors, count(*) FILTER (br AND NOT bf) AS reverse_errors, count(*) FILTER (bf AND br) AS both_errors, count(*) FILTER (NOT bf AND NOT br) AS no_errors FROM z"


@query("g28_error_classes", with_views(_SIDES + f" SELECT {_CLASSES}", "inserts"))
def g28c(spark, d):
    return p.error_classes(sided_errors(spark, d))


@query("g29_errors_by_primer", with_views(_SIDES + f" SELECT marker, {_CLASSES} GROUP BY marker", "inserts"))
def g29p(spark, d):
    return p.error_classes(sided_errors(spark, d), ("marker",))


@query("g29_assignment_matrix", with_views("SELECT sample, marker, count(*) AS reads FROM inserts GROUP BY CUBE (sample, marker)", "inserts"))
def g29(spark, d):
    return p.assignment_matrix(view(spark, d, "inserts"))


@query("g43_basic_statistics", "SELECT round(avg(l_quantity), 6) AS mean, round(median(l_quantity), 6) AS median, round(var_samp(l_quantity), 6) AS variance, round(stddev_samp(l_quantity), 6) AS stdev, round(corr(l_quantity, l_extendedprice), 6) AS correlation, round(covar_samp(l_quantity, l_extendedprice), 3) AS covariance FROM lineitem")
def g43(spark, d):
    out = p.basic_statistics(spark.read.parquet(f"{d}/lineitem.parquet"), "l_quantity", "l_extendedprice")
    return out.select(*[F.round(x, 6).alias(x) for x in out.columns[:-1]], F.round("covariance", 3).alias("covariance"))

"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as s
from .fixtures import view, with_views
from .registry import query

_V = "SELECT DISTINCT md5, seq FROM variants"


def _variants(spark, d):
    return view(spark, d, "variants").select("md5", "seq").distinct()


@query("c01_reverse_complement", with_views("SELECT DISTINCT md5, reverse(translate(seq, 'ACGT', 'TGCA')) AS revcomp, reverse(translate(seq, 'ACGT', 'TGCA')) <> seq AS differs FROM variants", "variants"))
def c01(spark, d):
    rc = s.reverse_complement("seq")
    return _variants(spark, d).select("md5", rc.alias("revcomp"), (rc != F.col("seq")).alias("differs"))


_IUPAC_SQL = "translate(substr(seq, 1, 6), 'ACGT', 'ARNT')"


@query("c02_iupac_regex", with_views(f"SELECT DISTINCT md5, replace(replace({_IUPAC_SQL}, 'N', '[ACGT]'), 'R', '[AG]') AS pattern FROM variants", "variants"))
def c02(spark, d):
    return _variants(spark, d).select("md5", s.iupac_regex(F.expr(_IUPAC_SQL)).alias("pattern"))


@query("c03_expand_ambiguous", with_views("""p AS (SELECT DISTINCT concat(substr(seq, 1, 2), 'R', substr(seq, 3, 1), 'N') AS primer FROM variants)
SELECT primer, concat(substr(primer, 1, 2), a, substr(primer, 4, 1), b) AS plain, 8 AS n FROM p, (SELECT unnest(['A','G']) AS a), (SELECT unnest(['A','C','G','T']) AS b)""", "variants"))
def c03(spark, d):
    p = view(spark, d, "variants").select(F.expr("concat(substr(seq, 1, 2), 'R', substr(seq, 3, 1), 'N')").alias("primer")).distinct()
    return p.select("primer", F.explode(s.plain_sequences("primer")).alias("plain"), s.n_plain_sequences("primer").cast("int").alias("n"))


@query("c04_prosite", "SELECT DISTINCT p_size, concat('[AC].V.{', p_size, '}[^ED]W') AS regex, concat('[AC]-x-V-x(', p_size, ')-{ED}-W') AS prosite FROM part")
def c04(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select("p_size", F.expr("concat('[AC]-x-V-x(', p_size, ')-{ED}-W')").alias("prosite")).distinct()
    p = p.select("p_size", s.prosite_to_regex("prosite").alias("regex"))
    return p.select("p_size", "regex", s.regex_to_prosite("regex").alias("prosite"))


_AA = "(SELECT string_agg(m.aa, '' ORDER BY i) FROM (SELECT unnest(range(0, length(seq) // 3)) AS i) k JOIN code m ON m.codon = substr(seq, k.i * 3 + 1, 3))"
CODE_CTE = "code AS (SELECT unnest([" + ",".join(f"'{c}'" for c in s.CODONS) + "]) AS codon, unnest([" + ",".join(f"'{a}'" for a in s.CODONS.values()) + "]) AS aa)"


def protein_sql(source: str, key: str, seq: str = "seq", frame: int = 1) -> str:
    """CTE body (key, aa): translation of ``seq`` of ``source``."""
    return f"SELECT {key}, coalesce(string_agg(aa, '' ORDER BY i), '') AS aa FROM (SELECT {key}, {seq} AS seq, unnest(range(0, greatest((length({seq}) - {frame - 1}) // 3, 0))) AS i FROM {source}) x JOIN code ON codon = substr(x.seq, i * 3 + {frame}, 3) GROUP BY {key}"


@query("c05_translate", with_views(f"v AS ({_V}), {CODE_CTE} {protein_sql('v', 'md5')}", "variants"))
def c05(spark, d):
    return _variants(spark, d).select("md5", s.translate_dna("seq").alias("aa"))


_FRAMES = ", ".join(f"f{f} AS ({protein_sql('v', 'md5', frame=f)})" for f in (1, 2, 3))
_FRAME_SQL = f"v AS ({_V}), {CODE_CTE}, {_FRAMES}, a AS (SELECT f1.md5, length(f1.aa) - length(replace(f1.aa, '*', '')) AS n1, length(f2.aa) - length(replace(f2.aa, '*', '')) AS n2, length(f3.aa) - length(replace(f3.aa, '*', '')) AS n3 FROM f1 JOIN f2 ON f1.md5 = f2.md5 JOIN f3 ON f1.md5 = f3.md5) "


@query("c06_open_frames", with_views(_FRAME_SQL + "SELECT md5, concat(CASE WHEN n1 = 0 THEN '1' ELSE '' END, CASE WHEN n2 = 0 THEN '2' ELSE '' END, CASE WHEN n3 = 0 THEN '3' ELSE '' END) AS frames FROM a", "variants"))
def c06(spark, d):
    return _variants(spark, d).select("md5", F.array_join(F.transform(s.open_frames("seq"), lambda f: f.cast("string")), "").alias("frames"))


@query("c07_translation_modes", with_views(_FRAME_SQL + "SELECT md5, CASE WHEN n1 <= n2 AND n1 <= n3 THEN 1 WHEN n2 <= n3 THEN 2 ELSE 3 END AS frame FROM a", "variants"))
def c07(spark, d):
    return _variants(spark, d).select("md5", s.best_frame("seq").alias("frame"))


_PAIR = "p AS (SELECT DISTINCT v.md5, v.seq, a.seq AS ref FROM variants v JOIN alleles a ON a.marker = v.marker AND a.name LIKE '%-0')"


def pairs(spark, d):
    a = view(spark, d, "alleles").where("name like '%-0'").select("marker", F.col("seq").alias("ref"))
    return view(spark, d, "variants").join(a, "marker").select("md5", "seq", "ref").distinct()


_HAM = "(SELECT count(*) FROM (SELECT unnest(range(1, length(seq) + 1)) AS i) WHERE substr(seq, i, 1) <> substr(ref, i, 1))"


@query("c08_hamming", with_views(_PAIR + f" SELECT md5, CASE WHEN length(seq) = length(ref) THEN {_HAM} END AS distance FROM p", "variants", "alleles"))
def c08(spark, d):
    return pairs(spark, d).select("md5", s.hamming("seq", "ref").alias("distance"))


@query("c11_single_error", with_views(_PAIR + """, q AS (SELECT *, coalesce((SELECT min(i) FROM (SELECT unnest(range(1, least(length(seq), length(ref)) + 1)) AS i) WHERE substr(seq, i, 1) <> substr(ref, i, 1)), least(length(seq), length(ref)) + 1) AS pos FROM p),
k AS (SELECT md5, pos, CASE WHEN seq = ref THEN 'identical' WHEN length(seq) = length(ref) AND substr(seq, pos + 1) = substr(ref, pos + 1) THEN 'substitution'
WHEN length(seq) = length(ref) + 1 AND substr(seq, pos + 1) = substr(ref, pos) THEN 'insertion' WHEN length(seq) + 1 = length(ref) AND substr(seq, pos) = substr(ref, pos + 1) THEN 'deletion' ELSE 'none' END AS kind FROM q)
SELECT md5, kind, CASE WHEN kind NOT IN ('identical', 'none') THEN pos END AS position FROM k""", "variants", "alleles"))
def c11(spark, d):
    e = s.single_error("seq", "ref")
    return pairs(spark, d).select("md5", e["kind"].alias("kind"), e["position"].alias("position"))


# Variants that lost base 21 have a gap there.
_GAPPED = ", ag AS (SELECT md5, CASE WHEN length(seq) < length(ref) THEN concat(substr(seq, 1, 20), '-', substr(seq, 21)) ELSE seq END AS seq, ref FROM p)"


def aligned(spark, d):
    gapped = F.concat(F.substr("seq", F.lit(1), F.lit(20)), F.lit("-"), F.substr("seq", F.lit(21)))
    return pairs(spark, d).withColumn("seq", F.when(F.length("seq") < F.length("ref"), gapped).otherwise(F.col("seq")))


@query("c12_identity_score", with_views(_PAIR + _GAPPED + f" SELECT md5, length(seq) - {_HAM} AS matches, length(seq) AS total FROM ag", "variants", "alleles"))
def c12(spark, d):
    i = s.identity("seq", "ref")
    return aligned(spark, d).select("md5", i["matches"].alias("matches"), i["total"].alias("total"))


@query("c13_difference_strings", with_views(_PAIR + _GAPPED + """ SELECT md5, (SELECT string_agg(CASE WHEN substr(seq, i, 1) = substr(ref, i, 1) THEN substr(seq, i, 1) ELSE concat('[', substr(seq, i, 1), '|', substr(ref, i, 1), ']') END, '' ORDER BY i) FROM (SELECT unnest(range(1, length(seq) + 1)) AS i)) AS line,
concat(CASE WHEN """ + f"{_HAM} > contains(seq, '-')::INT THEN concat('X', {_HAM} - contains(seq, '-')::INT) ELSE '' END, CASE WHEN contains(seq, '-') THEN 'D1' ELSE '' END) AS label FROM ag", "variants", "alleles"))
def c13(spark, d):
    p = aligned(spark, d)
    zero, gaps = F.lit(0), F.contains("seq", F.lit("-")).cast("int")
    return p.select("md5", s.one_line_alignment("seq", "ref").alias("line"), s.error_label(s.hamming("seq", "ref") - gaps, zero, gaps, zero).alias("label"))


@query("c14_phred", with_views("SELECT read_id, (ascii(substr(qual, 1, 1)) - 33)::DOUBLE AS mean_quality, repeat(chr(ascii(substr(qual, 1, 1)) + 31), length(qual)::INT) AS old_text FROM reads", "reads"))
def c14(spark, d):
    return view(spark, d, "reads").select("read_id", s.mean_phred("qual").alias("mean_quality"), s.phred_text(s.phred_values("qual"), "illumina_old").alias("old_text"))


@query("c15_sequence_key", with_views("SELECT DISTINCT md5, md5(upper(seq)) AS key, substr(md5(upper(seq)), 1, 8) AS short FROM variants", "variants"))
def c15(spark, d):
    return _variants(spark, d).select("md5", s.sequence_key(F.lower("seq")).alias("key"), s.sequence_key("seq", 8).alias("short"))


@query("c16_header_fields", with_views("SELECT marker, sample, md5, concat(marker, '-', sample) AS name, depth::VARCHAR AS depth, length(seq)::VARCHAR AS len FROM variants", "variants"))
def c16(spark, d):
    header = F.concat_ws(" | ", F.concat_ws("-", "marker", "sample"), F.concat(F.lit("depth="), "depth"), F.concat(F.lit("len="), F.length("seq")))
    f = s.header_fields(header)
    return view(spark, d, "variants").select("marker", "sample", "md5", f["name"].alias("name"), f["depth"].alias("depth"), f["len"].alias("len"))


@query("c17_platform", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'illumina' WHEN 1 THEN 'iontorrent' WHEN 2 THEN '454' ELSE 'unknown' END AS platform FROM events")
def c17(spark, d):
    name = F.expr("CASE event_id % 4 WHEN 0 THEN concat('@M0', event_id, ':12:000-AB:1:1101:', user_id, ':99') WHEN 1 THEN concat('AB1C2:', event_id, ':', user_id) WHEN 2 THEN concat('GABCDEFGHIJKLMN', event_id) ELSE concat('read ', event_id) END")
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", s.platform(name).alias("platform"))


@query("c18_taxonomy", with_views("SELECT hit, regexp_extract(taxonomy, 'k:([^,]*)', 1) AS kingdom, regexp_extract(taxonomy, 'g:([^,]*)', 1) AS genus, CASE WHEN regexp_extract(taxonomy, 'g:([^,]*)', 1) LIKE '%x' THEN regexp_extract(taxonomy, 's:(.*)', 1) ELSE regexp_extract(taxonomy, 's:G[0-9]+ (.*)', 1) END AS species FROM taxa", "taxa"))
def c18(spark, d):
    t = view(spark, d, "taxa").select("hit", s.read_taxonomy(s.print_taxonomy(s.read_taxonomy("taxonomy"))).alias("t"))
    return t.select("hit", "t.kingdom", "t.genus", "t.species")


@query("c19_amino_acid_names", with_views(f"v AS ({_V}), {CODE_CTE}, p AS ({protein_sql('v', 'md5')}) SELECT md5, aa, length(aa) * 3 AS n FROM p", "variants"))
def c19(spark, d):
    names = s.aa_names(s.translate_dna("seq"))
    return _variants(spark, d).select("md5", s.aa_letters(names).alias("aa"), F.length(names).alias("n"))


_KIND = "CASE WHEN md5 < '6' THEN seq WHEN md5 < 'b' THEN concat(replace(seq, 'T', 'U'), 'U') ELSE concat('MEFLQ', seq) END"


@query("c20_kind_and_cleaning", with_views(f"SELECT DISTINCT md5, CASE WHEN md5 < '6' THEN 'dna' WHEN md5 < 'b' THEN 'rna' ELSE 'protein' END AS kind, {_KIND} AS cleaned, substr(md5, 1, 9) AS name FROM variants", "variants"))
def c20(spark, d):
    """A third each of DNA, RNA and protein, with blanks, gaps and digits between."""
    x = _variants(spark, d).withColumn("text", F.expr(_KIND))
    dirty = F.concat(F.substring("text", 1, 5), F.lit("-- 12"), F.substring("text", 6, 99))
    name = F.concat(F.substring("md5", 1, 4), F.lit("_-|"), F.substring("md5", 5, 5))
    kind = F.when(s.is_dna("text"), "dna").when(s.is_rna("text"), "rna").when(s.is_protein("text"), "protein")
    return x.select("md5", kind.alias("kind"), s.clean_sequence(dirty).alias("cleaned"), s.clean_name(name).alias("name"))


@query("c27_genotypes", with_views("SELECT order_id, CASE dp % 3 WHEN 0 THEN ref WHEN 1 THEN concat(ref, ',', alt) ELSE alt END AS genotype, '0/0,0/1,1/1' AS all_genotypes FROM calls", "calls"))
def c27(spark, d):
    gt = F.expr("CASE dp % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1|1' END")
    return view(spark, d, "calls").select("order_id", s.genotype_text(gt, "ref", "alt").alias("genotype"), F.array_join(s.genotypes(F.lit(2)), ",").alias("all_genotypes"))


@query("c28_binomial", "SELECT DISTINCT p_size, round(factorial(12)::DOUBLE / factorial(p_size % 13)::DOUBLE / factorial(12 - p_size % 13)::DOUBLE) AS ways, round(log10(p_size), 9) AS log, round(round(factorial(12)::DOUBLE / factorial(p_size % 13)::DOUBLE / factorial(12 - p_size % 13)::DOUBLE) * pow(0.3, p_size % 13) * pow(0.7, 12 - p_size % 13), 12) AS p FROM part")
def c28(spark, d):
    k = F.col("p_size") % 13
    p = spark.read.parquet(f"{d}/part.parquet").select("p_size").distinct()
    return p.select("p_size", s.binomial_coefficient(F.lit(12), k).alias("ways"), F.round(F.log10("p_size"), 9).alias("log"), F.round(s.binomial_probability(F.lit(12), k, F.lit(0.3)), 12).alias("p"))


@query("c29_first_difference", with_views(_PAIR + """ SELECT md5, coalesce((SELECT min(i) - 1 FROM (SELECT unnest(range(1, least(length(seq), length(ref)) + 1)) AS i) WHERE substr(seq, i, 1) <> substr(ref, i, 1)), least(length(seq), length(ref))) AS prefix,
coalesce((SELECT min(i) - 1 FROM (SELECT unnest(range(1, least(length(seq), length(ref)) + 1)) AS i) WHERE substr(reverse(seq), i, 1) <> substr(reverse(ref), i, 1)), least(length(seq), length(ref))) AS suffix FROM p""", "variants", "alleles"))
def c29(spark, d):
    return pairs(spark, d).select("md5", s.first_difference("seq", "ref").alias("prefix"), s.common_suffix("seq", "ref").alias("suffix"))


@query("c30_list_tests", with_views("SELECT otu, max(hit = 7 OR hit = 67) AS has, count(*) FILTER (taxonomy LIKE '%x,s:%') AS n_x FROM taxa GROUP BY otu", "taxa"))
def c30(spark, d):
    t = view(spark, d, "taxa").groupBy("otu").agg(F.collect_list("hit").alias("hits"), F.collect_list("taxonomy").alias("texts"))
    has = F.array_contains("hits", 7) | F.array_contains("hits", 67)
    return t.select("otu", has.alias("has"), F.size(F.filter("texts", lambda x: F.regexp_extract(x, "(x),s:", 1) == "x")).cast("long").alias("n_x"))


_SIX = ", ".join(f"{side}{f} AS ({protein_sql(src, 'md5', frame=f)})" for side, src in (("p", "v"), ("m", "w")) for f in (1, 2, 3))


@query("c07_translations", with_views(f"v AS ({_V}), w AS (SELECT md5, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq FROM v), {CODE_CTE}, {_SIX}, al AS (" + " UNION ALL ".join(f"SELECT md5, {sign}{f} AS frame, aa FROM {side}{f}" for side, sign in (("p", ""), ("m", "-")) for f in (1, 2, 3)) + ") SELECT md5, frame, aa AS protein, 3 * length(aa) AS n FROM al WHERE NOT contains(aa, '*')", "variants"))
def c07t(spark, d):
    """All frames of both strands without a stop."""
    t = _variants(spark, d).select("md5", F.explode(s.translations("seq", True, True)).alias("t"))
    return t.select("md5", "t.frame", "t.protein", F.length("t.dna").alias("n"))


@query("c12_shared_identity", with_views(_PAIR + _GAPPED + " SELECT md5, (SELECT sum(CASE WHEN a = r THEN 1.0 WHEN a = 'R' AND r IN ('A', 'G') THEN 0.5 WHEN a = 'N' THEN 0.25 ELSE 0 END) FROM (SELECT substr(translate(seq, 'AT', 'RN'), i, 1) AS a, substr(ref, i, 1) AS r FROM (SELECT unnest(range(1, length(seq) + 1)) AS i))) AS score FROM ag", "variants", "alleles"))
def c12s(spark, d):
    return aligned(spark, d).select("md5", s.shared_identity(F.translate("seq", "AT", "RN"), "ref")["score"].alias("score"))


@query("c14_quality_by_position", with_views("SELECT i AS pos, round(avg(ascii(substr(qual, i::INT, 1)) - 33), 6) AS mean_quality, count(*) AS reads FROM (SELECT qual, unnest(range(1, length(qual) + 1)) AS i FROM reads) GROUP BY i", "reads"))
def c14p(spark, d):
    out = s.quality_by_position(view(spark, d, "reads"))
    return out.withColumn("mean_quality", F.round("mean_quality", 6))


@query("c16_header_segments", with_views("SELECT event_id, v, concat(j, '+', v) AS j FROM cdr3", "cdr3"))
def c16s(spark, d):
    header = F.concat(F.lit("read | tcrv="), "v", F.lit(" | TRJ="), "j", F.lit(" | tcrj="), "v")
    x = view(spark, d, "cdr3").select("event_id", s.header_segments(header).alias("m"))
    return x.select("event_id", F.array_join(F.col("m")["tcrv"], "+").alias("v"), F.array_join(F.col("m")["tcrj"], "+").alias("j"))


@query("c19_amino_acid_sets", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'J' WHEN 1 THEN 'B' WHEN 2 THEN 'Z' WHEN 3 THEN 'X' ELSE 'W' END AS letter, CASE p_partkey % 5 WHEN 0 THEN 'IL' WHEN 1 THEN 'DN' WHEN 2 THEN 'EQ' WHEN 3 THEN 'ACDEFGHIKLMNPQRSTVWY' ELSE 'W' END AS members FROM part")
def c19s(spark, d):
    text = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'LIL' WHEN 1 THEN 'ND' WHEN 2 THEN 'QE' WHEN 3 THEN 'WCA' ELSE 'WW' END")
    x = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", s.amino_set_of(s.letters(text)).alias("letter"))
    return x.select("p_partkey", "letter", F.array_join(s.amino_acids_of("letter"), "").alias("members"))

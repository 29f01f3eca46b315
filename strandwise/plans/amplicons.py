"""Queries on reads, amplicons and variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq as s
from ..operators import reads as r
from ..operators import variants as v
from ..operators.folders import stored
from .fixtures import PRIMERS, view, with_views
from .registry import query


def sheet(spark, d):
    tags = view(spark, d, "samples").collect()  # twelve rows
    samples = [{"sample": t["sample"], "tag_f": t["tag"]} for t in tags]
    return r.amplicon_patterns([{"marker": m, "primer_f": [p[0]], "primer_rc": [p[1]]} for m, p in PRIMERS.items()], samples)


def both(spark, d):
    x = stored(view(spark, d, "variants"))
    return x, x.groupBy("marker", "sample").agg(F.sum("depth").alias("depth_amplicon"))


@query("f01_trim", with_views("SELECT read_id, substr(seq, 1, 40) AS seq, substr(qual, 1, 40) AS qual FROM reads", "reads"))
def f01(spark, d):
    return r.trim(view(spark, d, "reads").select("read_id", "seq", "qual"), 40)


@query("f02_length_filter", with_views("SELECT read_id FROM reads WHERE length(seq) BETWEEN 86 AND 90", "reads"))
def f02(spark, d):
    return r.length_between(view(spark, d, "reads"), 86, 90).select("read_id")


@query("f03_quality_filter", with_views("SELECT read_id FROM reads WHERE ascii(substr(qual, 1, 1)) - 33 >= 30", "reads"))
def f03(spark, d):
    return r.quality_at_least(view(spark, d, "reads"), 30).select("read_id")


_ONE = "one AS (SELECT read_id FROM inserts GROUP BY read_id)"


@query("f04_amplicon_reads", with_views("SELECT read_id FROM reads WHERE substr(qual, 1, 1) NOT IN ('5', '?')", "reads"))
def f04(spark, d):
    """A fifth of the reads has lost its first eight bases, another has a bad base in each primer; both must go."""
    cut = F.when(F.substring("qual", 1, 1) == "5", F.substr("seq", F.lit(9))).when(F.substring("qual", 1, 1) == "?", F.overlay(F.overlay("seq", F.lit("NN"), 8), F.lit("NN"), F.length("seq") - 3))
    return r.reads_of_amplicons(view(spark, d, "reads").withColumn("seq", F.coalesce(cut, F.col("seq"))), sheet(spark, d)).select("read_id")


@query("f05_primer_prefilter", with_views("SELECT read_id FROM reads WHERE contains(seq, 'ACGTTGCAAC') OR contains(seq, 'GTTGCAACGT')", "reads"))
def f05(spark, d):
    return r.with_primers(view(spark, d, "reads"), [PRIMERS["M0"][0]]).select("read_id")


@query("j01_demultiplex", with_views("SELECT read_id, sample, marker, seq FROM inserts", "inserts"))
def j01(spark, d):
    return r.demultiplex(view(spark, d, "reads"), sheet(spark, d))


def hits(spark, d):
    """Primer hits as an aligner would report them, from the known construction."""
    x = view(spark, d, "inserts")
    n, total = F.length("seq"), F.length("seq") + 26
    strand = F.when(F.col("strand") == "R", "-").otherwise("+")
    plus = strand == "+"
    hit = lambda side, start, stop: F.struct(side.alias("side"), strand.alias("strand"), start.alias("start"), stop.alias("stop"))
    f = hit(F.when(plus, "F").otherwise("R"), F.when(plus, 7).otherwise(total - 15), F.when(plus, 16).otherwise(total - 6))
    b = hit(F.when(plus, "R").otherwise("F"), F.when(plus, 17 + n).otherwise(1), F.when(plus, total).otherwise(10))
    return x.select("read_id", "sample", "marker", F.inline(F.array(f, b)))


@query("j02_inserts_from_hits", with_views("SELECT read_id, sample, marker, seq FROM inserts", "inserts"))
def j02(spark, d):
    return r.inserts_from_hits(hits(spark, d), view(spark, d, "reads"))


# The last letter of each primer stands for any base, so nine letters count; one may be wrong.
_PLACES = " UNION ALL ".join(
    f"SELECT read_id, '{m}' AS primer, '{strand}' AS strand, i AS start, i + 9 AS stop, hamming(substr(seq, i + {skip}, 9), '{part}') AS errors FROM (SELECT read_id, seq, unnest(range(1, length(seq) - 8)) AS i FROM reads)"
    for m, p in PRIMERS.items()
    for strand, skip, part in (("+", 0, p[0][:9]), ("-", 1, p[0][:9][::-1].translate(str.maketrans("ACGT", "TGCA"))))
)


@query("j03_primer_search", with_views(f"pl AS ({_PLACES}) SELECT read_id, primer, strand, start::INTEGER AS start, stop::INTEGER AS stop, errors::INTEGER AS errors FROM pl WHERE errors <= 1", "reads"))
def j03(spark, d):
    return r.primer_hits(view(spark, d, "reads"), [(m, p[0][:9] + "N") for m, p in PRIMERS.items()])


@query("f04_amplicon_pairs", with_views("SELECT read_id FROM reads WHERE substr(qual, 1, 1) NOT IN ('5', '?')", "reads"))
def f04p(spark, d):
    """Mates of which one has lost its first bases, or the other has a bad base in each primer."""
    whole = view(spark, d, "reads").select("read_id", "seq", "qual")
    first = whole.withColumn("seq", F.when(F.substring("qual", 1, 1) == "5", F.substr("seq", F.lit(9))).otherwise(F.col("seq")))
    bad = F.overlay(F.overlay("seq", F.lit("NN"), 8), F.lit("NN"), F.length("seq") - 3)
    second = whole.withColumn("seq", s.reverse_complement(F.when(F.substring("qual", 1, 1) == "?", bad).otherwise(F.col("seq"))))
    return r.pairs_of_amplicons(first, second, sheet(spark, d))[0].select("read_id")


@query("j18_join_mates", with_views("SELECT read_id, concat(seq, reverse(translate(substr(seq, 41), 'ACGT', 'TGCA'))) AS seq, concat(qual, reverse(substr(qual, 41))) AS qual FROM reads", "reads"))
def j18(spark, d):
    x = view(spark, d, "reads").select("read_id", "seq", "qual").repartition("read_id")  # both mates come from one pass
    return r.join_mates(x, x.select("read_id", F.substr("seq", F.lit(41)).alias("seq"), F.substr("qual", F.lit(41)).alias("qual")))


@query("j19_merge_mates", with_views("SELECT read_id, seq, qual FROM reads", "reads"))
def j19(spark, d):
    """Mates that share 29 or 30 bases, by the length of the read."""
    x = view(spark, d, "reads").select("read_id", "seq", "qual").repartition("read_id")  # both mates come from one pass
    left = x.select("read_id", F.substring("seq", 1, 60).alias("seq"), F.substring("qual", 1, 60).alias("qual"))
    right = x.select("read_id", s.reverse_complement(F.substr("seq", F.lit(31))).alias("seq"), F.reverse(F.substr("qual", F.lit(31))).alias("qual"))
    return r.merge_mates(left, right, 25, 40, 0).select("read_id", "seq", "qual")


@query("s04_compressed_amplicons", with_views("SELECT marker, sample, md5, seq, depth FROM variants", "variants"))
def s04(spark, d):
    x = stored(view(spark, d, "variants"))
    forward = x.select("marker", "sample", "seq", F.col("depth").alias("w"))
    twin = x.where("depth > 2").select("marker", "sample", s.reverse_complement("seq").alias("seq"), F.lit(1).cast("long").alias("w"))
    return r.fold_strands(forward.join(twin.select("marker", "sample", s.reverse_complement("seq").alias("seq"), F.col("w").alias("less")), ["marker", "sample", "seq"], "left").select("marker", "sample", "seq", (F.col("w") - F.coalesce("less", F.lit(0))).alias("w")).unionByName(twin), F.col("w"))


@query("g01_dereplicate", with_views("SELECT marker, sample, md5, seq, depth FROM variants", "variants"))
def g01(spark, d):
    return v.dereplicate(view(spark, d, "inserts"))


@query("g02_amplicon_depth", with_views("SELECT marker, sample, depth_amplicon::BIGINT AS depth_amplicon FROM amplicons", "amplicons"))
def g02(spark, d):
    return v.amplicon_depths(v.dereplicate(view(spark, d, "inserts")))


_STAT = "st AS (SELECT marker, md5, any_value(seq) AS seq, sum(depth)::BIGINT AS depth, count(DISTINCT sample) AS samples, round(avg(100.0 * depth / depth_amplicon), 6) AS mean_freq, round(max(100.0 * depth / depth_amplicon), 6) AS max_freq, round(min(100.0 * depth / depth_amplicon), 6) AS min_freq FROM variants JOIN amplicons USING (marker, sample) GROUP BY marker, md5)"


@query("g03_variant_statistics", with_views(_STAT + " SELECT *, length(seq) AS len FROM st", "variants", "amplicons"))
def g03(spark, d):
    out = v.marker_statistics(v.dereplicate(view(spark, d, "inserts")), view(spark, d, "amplicons"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_freq", "max_freq", "min_freq")})


@query("w01_name_variants", with_views(_STAT + " SELECT marker, md5, coalesce('A' || CASE WHEN md5 LIKE '0%' THEN md5 END, concat(marker, '-', lpad(row_number() OVER (ORDER BY marker, depth DESC, md5)::VARCHAR, 7, '0'))) AS name FROM st", "variants", "amplicons"))
def w01(spark, d):
    x, a = both(spark, d)
    known = x.select("md5").distinct().where("md5 like '0%'").withColumn("name", F.concat(F.lit("A"), "md5"))
    return v.name_variants(v.marker_statistics(x, a), known).select("marker", "md5", "name")


@query("f06_gate_amplicons", with_views("SELECT marker, sample, md5, depth FROM variants JOIN amplicons USING (marker, sample) WHERE depth_amplicon >= 1660 AND marker IN ('M0', 'M2')", "variants", "amplicons"))
def f06(spark, d):
    x, a = both(spark, d)
    return v.gate(x, a, 1660, ["M0", "M2"]).select("marker", "sample", "md5", "depth")


@query("f06_low_amplicons", with_views("SELECT m.marker, s.sample, coalesce(depth_amplicon, 0)::BIGINT AS depth_amplicon FROM (SELECT DISTINCT marker FROM alleles) m CROSS JOIN (SELECT sample FROM samples UNION ALL SELECT 'S99') s LEFT JOIN amplicons a ON a.marker = m.marker AND a.sample = s.sample WHERE coalesce(depth_amplicon, 0) < 1660", "amplicons", "alleles", "samples"))
def f06_low(spark, d):
    samples = view(spark, d, "samples").select("sample").unionByName(spark.createDataFrame([("S99",)], "sample string"))
    return v.low_amplicons(view(spark, d, "alleles").select("marker").distinct(), samples, view(spark, d, "amplicons"), 1660)


_KEPT = "fr AS (SELECT *, 100.0 * depth / depth_amplicon AS freq FROM variants JOIN amplicons USING (marker, sample)), kept AS (SELECT * FROM fr WHERE freq >= 1)"


def _kept(spark, d):
    x, a = both(spark, d)
    fr = x.join(a, ["marker", "sample"]).withColumn("freq", 100 * F.col("depth") / F.col("depth_amplicon"))
    return fr, fr.where("freq >= 1")


@query("f08_rescue", with_views(_KEPT + ", often AS (SELECT marker, md5 FROM kept GROUP BY marker, md5 HAVING count(DISTINCT sample) >= 3) SELECT marker, sample, md5, false AS rescued FROM kept UNION ALL SELECT f.marker, f.sample, f.md5, true FROM fr f JOIN often USING (marker, md5) WHERE freq < 1 AND freq >= 0.2 AND EXISTS (SELECT 1 FROM kept k WHERE k.marker = f.marker AND k.sample = f.sample)", "variants", "amplicons"))
def f08(spark, d):
    fr, kept = _kept(spark, d)
    return v.rescue(fr, kept, 3, 0.2).select("marker", "sample", "md5", "rescued")


_W = "WINDOW w AS (PARTITION BY marker, sample ORDER BY depth DESC, md5)"


@query("w02_degree_of_change", with_views(f"t AS (SELECT *, row_number() OVER w AS nth FROM variants {_W}), u AS (SELECT *, depth::DOUBLE / lead(depth) OVER w AS ratio FROM t WHERE nth <= 11 {_W}) SELECT marker, sample, nth, round(100 * ratio / sum(ratio) OVER (PARTITION BY marker, sample), 6) AS doc, last_value(nth) OVER (PARTITION BY marker, sample ORDER BY ratio, nth ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS n_alleles FROM u WHERE ratio IS NOT NULL", "variants"))
def w02(spark, d):
    return v.degree_of_change(view(spark, d, "variants")).select("marker", "sample", "nth", F.round("doc", 6).alias("doc"), "n_alleles")


@query("w03_frequency_to_top", with_views(f"SELECT marker, sample, md5, round(100.0 * depth / first_value(depth) OVER w, 6) AS per_dominant FROM variants {_W}", "variants"))
def w03(spark, d):
    return v.frequency_to_top(view(spark, d, "variants")).select("marker", "sample", "md5", F.round("per_dominant", 6).alias("per_dominant"))


_MAJOR = "mj AS (SELECT * FROM (SELECT *, row_number() OVER w AS nth, coalesce(sum(depth) OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(depth) OVER (PARTITION BY marker, sample) AS total FROM variants WINDOW w AS (PARTITION BY marker, sample ORDER BY depth DESC, md5)) WHERE 100.0 * before / total < 25 AND nth <= 10)"


@query("w04_major_variants", with_views(_MAJOR + " SELECT marker, sample, md5, depth FROM mj", "variants"))
def w04(spark, d):
    return v.major_variants(view(spark, d, "variants")).select("marker", "sample", "md5", "depth")


@query("w05_capped_reads", with_views("SELECT read_id FROM (SELECT read_id, row_number() OVER (PARTITION BY marker, sample ORDER BY read_id) AS n FROM inserts) WHERE n <= 100", "inserts"))
def w05(spark, d):
    return v.capped_reads(view(spark, d, "inserts"), 100).select("read_id")


@query("w12_first_match", with_views("SELECT read_id, sample, marker FROM inserts", "inserts"))
def w12(spark, d):
    twice = hits(spark, d).unionByName(hits(spark, d).withColumn("start", F.col("start") + F.when(F.col("side") == "R", 1).otherwise(0)))
    return r.inserts_from_hits(twice, view(spark, d, "reads")).select("read_id", "sample", "marker")


@query("g15_stage_summary", with_views(_KEPT + " SELECT a.marker, a.sample, a.depth_amplicon, sum(f.depth)::BIGINT AS reads_raw, count(f.md5) AS variants_raw, coalesce(sum(f.depth) FILTER (f.freq >= 1 AND f.sample <> 'S3'), 0)::BIGINT AS reads_filtered, count(f.md5) FILTER (f.freq >= 1 AND f.sample <> 'S3') AS variants_filtered FROM amplicons a LEFT JOIN fr f ON f.marker = a.marker AND f.sample = a.sample GROUP BY ALL", "variants", "amplicons"))
def g15(spark, d):
    fr, kept = _kept(spark, d)
    return v.stage_summary(view(spark, d, "amplicons"), {"raw": fr, "filtered": kept.where("sample <> 'S3'")})


@query("g36_automatic_lengths", with_views(_MAJOR + ", l AS (SELECT DISTINCT marker, length(seq) AS len FROM mj) SELECT v.marker, string_agg(DISTINCT l.len::VARCHAR, ',') AS lengths, 100.0 * sum(v.depth) FILTER (l.len IS NOT NULL) / sum(v.depth) >= 95 AS exact FROM variants v LEFT JOIN l ON l.marker = v.marker AND l.len = length(v.seq) GROUP BY v.marker", "variants"))
def g36(spark, d):
    out = v.automatic_lengths(view(spark, d, "variants"))
    return out.select("marker", F.array_join(F.transform("lengths", lambda x: x.cast("string")), ",").alias("lengths"), "exact")


@query("g37_automatic_min_frequency", with_views(f"t AS (SELECT *, row_number() OVER w AS nth FROM variants {_W}), u AS (SELECT *, depth::DOUBLE / lead(depth) OVER w AS ratio FROM t WHERE nth <= 11 {_W}), x AS (SELECT *, last_value(nth) OVER (PARTITION BY marker, sample ORDER BY ratio, nth ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS n_alleles FROM u WHERE ratio IS NOT NULL), y AS (SELECT x.marker, n_alleles, 100.0 * depth / depth_amplicon AS freq, max(n_alleles) OVER (PARTITION BY x.marker) AS top FROM x JOIN amplicons a ON a.marker = x.marker AND a.sample = x.sample WHERE nth = n_alleles) SELECT marker, round(0.9 * median(freq), 6) AS min_freq FROM y WHERE n_alleles > 1 OR top <= 1 GROUP BY marker", "variants", "amplicons"))
def g37(spark, d):
    x, a = both(spark, d)
    return v.automatic_min_frequency(x, a).select("marker", F.round("min_freq", 6).alias("min_freq"))


@query("g45_tag_primer_sequences", with_views("SELECT concat(sample, '-', marker, '_F001') AS name, concat(tag, p) AS seq FROM samples, (SELECT unnest(['M0','M1','M2']) AS marker, unnest(['ACGTTGCAAC','GGATCAGTCA','TCAGGTACCA']) AS p)", "samples"))
def g45(spark, d):
    markers = spark.createDataFrame([(m, p[0]) for m, p in PRIMERS.items()], "marker string, primer_f string")
    return r.tag_primer_sequences(view(spark, d, "samples").withColumnRenamed("tag", "tag_f"), markers)


@query("u05_add_tags", with_views("SELECT read_id, concat(tag, primer_f, seq, primer_rc) AS seq FROM inserts", "inserts"))
def u05(spark, d):
    markers = spark.createDataFrame([(m, *p) for m, p in PRIMERS.items()], "marker string, primer_f string, primer_rc string")
    samples = view(spark, d, "samples").select("sample", F.col("tag").alias("tag_f"), F.lit(None).cast("string").alias("tag_rc"))
    x = view(spark, d, "inserts").select("read_id", "sample", "marker", "seq", F.repeat(F.lit("I"), F.length("seq")).alias("qual"))
    return r.add_tags(x, samples, markers).select("read_id", "seq")


@query("u03_mix_runs", with_views("t AS (SELECT 'A' AS run, sample, tag FROM samples UNION ALL SELECT 'B', sample, tag FROM samples WHERE sample < 'S3'), c AS (SELECT run, sample, row_number() OVER (PARTITION BY tag ORDER BY run, sample) > 1 AS clash FROM t) SELECT run, sample, CASE WHEN clash THEN concat('NEW', sum(clash::INT) OVER (ORDER BY run, sample)) END AS new_tag FROM c", "samples"))
def u03(spark, d):
    a = view(spark, d, "samples").select(F.lit("A").alias("run"), "sample", F.col("tag").alias("tag_f"))
    out = r.retag_clashes(a.unionByName(a.where("sample < 'S3'").withColumn("run", F.lit("B"))), [f"NEW{i}" for i in range(1, 13)])
    return out.select("run", "sample", "new_tag")


@query("t01_random_reads", with_views("SELECT read_id FROM reads ORDER BY md5(concat('1', read_id)), read_id LIMIT 500", "reads"))
def t01(spark, d):
    return r.sample_reads(view(spark, d, "reads"), 500).select("read_id")


@query("t02_shuffle_reads", with_views("SELECT read_id, seq FROM reads", "reads"))
def t02(spark, d):
    return r.shuffle_reads(view(spark, d, "reads").select("read_id", "seq"))


@query("t03_reads_per_amplicon", with_views("SELECT read_id FROM (SELECT read_id, row_number() OVER (PARTITION BY sample, marker ORDER BY md5(concat('1', read_id)), read_id) AS n FROM inserts) WHERE n <= 20", "inserts"))
def t03(spark, d):
    return r.sample_reads(view(spark, d, "inserts"), 20, keys=("sample", "marker")).select("read_id")


@query("t06_sampling_rounds", with_views(" UNION ALL ".join(f"(SELECT {i} AS round, read_id FROM reads ORDER BY md5(concat('{i}', read_id)), read_id LIMIT 200)" for i in range(3)).replace("(SELECT 0", "SELECT * FROM (SELECT 0", 1), "reads"))
def t06(spark, d):
    return r.sampling_rounds(view(spark, d, "reads"), 3, 200).select("round", "read_id")


@query("t07_natural_order", with_views("SELECT sample, row_number() OVER (ORDER BY substr(sample, 2)::INT) AS nth FROM samples", "samples"))
def t07(spark, d):
    from pyspark.sql.window import Window

    return view(spark, d, "samples").select("sample", F.row_number().over(Window.orderBy(s.natural_key("sample"))).alias("nth"))


@query("t08_read_counts", with_views("SELECT run, count(*) AS reads, count(DISTINCT seq) AS sequences FROM reads GROUP BY run", "reads"))
def t08(spark, d):
    return view(spark, d, "reads").groupBy("run").agg(F.count("*").alias("reads"), F.countDistinct("seq").alias("sequences"))


@query("t08_split_reads", with_views("SELECT read_id, (('0x' || substr(md5(read_id), 1, 8))::BIGINT % 4)::INT AS part FROM reads", "reads"))
def t08s(spark, d):
    return r.split_reads(view(spark, d, "reads"), 4).select("read_id", "part")


@query("u03_rewrite_reads", with_views("SELECT read_id, concat(CASE WHEN sample < 'S3' THEN concat('NN', sample) ELSE tag END, primer_f, seq, primer_rc) AS seq, CASE WHEN sample < 'S3' THEN length(sample) + 2 ELSE 6 END + length(seq) + 20 AS n FROM inserts", "inserts"))
def u03r(spark, d):
    """Samples whose tags clash get new ones, of other lengths, and their reads carry them."""
    new = view(spark, d, "samples").where("sample < 'S3'").select("sample", F.concat(F.lit("NN"), "sample").alias("new_tag"))
    return r.retag(view(spark, d, "reads"), sheet(spark, d), new).select("read_id", "seq", F.length("qual").alias("n"))


_RARE = """rk AS (SELECT *, row_number() OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS nth FROM variants), rr AS (SELECT x.marker, x.sample, x.nth, length(x.seq) <> length(t.seq) AS gap, greatest(length(x.seq), length(t.seq)) AS n FROM rk x JOIN rk t ON t.marker = x.marker AND t.sample = x.sample AND t.nth = 1 AND x.nth > 1 WHERE abs(length(t.seq) - length(x.seq)) <= 0.02 * length(t.seq) AND t.depth - x.depth >= 0.9 * t.depth AND levenshtein(x.seq, t.seq) <= 1),
lr AS (SELECT round(CASE WHEN gap THEN 100.0 / n ELSE 0 END, 2) AS indels, round(CASE WHEN gap THEN 0 ELSE 100.0 / n END, 2) AS subs FROM (SELECT *, row_number() OVER (PARTITION BY marker, sample ORDER BY nth DESC) AS k FROM rr) WHERE k = 1),
er AS (SELECT coalesce(round(avg(indels), 2), 0.001)::DOUBLE AS mean_indels, coalesce(round(avg(subs), 2), 0.001)::DOUBLE AS mean_subs, coalesce(round(1.1 * max(indels), 2), 0.001)::DOUBLE AS limit_indels, coalesce(round(1.1 * max(subs), 2), 0.001)::DOUBLE AS limit_subs FROM lr)"""


@query("g36_automatic_errors", with_views(_RARE + " SELECT *, CASE WHEN mean_indels > mean_subs THEN '454/IonTorrent' WHEN mean_subs > 100 * mean_indels THEN 'Illumina' ELSE 'Unknown' END AS platform FROM er", "variants"))
def g36e(spark, d):
    return v.automatic_errors(stored(view(spark, d, "variants")))


@query("g36_automatic_ratio", with_views("ma AS (SELECT * FROM (SELECT *, 100.0 * coalesce(sum(depth) OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(depth) OVER (PARTITION BY marker, sample) AS before, row_number() OVER (PARTITION BY marker, sample ORDER BY depth DESC, md5) AS nth FROM variants) WHERE before < 80 AND nth <= 10) SELECT x.marker, least(min(round(100.0 * y.depth / x.depth, 2)), 50.0)::DOUBLE AS ratio FROM ma x JOIN ma y ON y.marker = x.marker AND y.sample = x.sample AND y.md5 <> x.md5 WHERE levenshtein(x.seq, y.seq) > 3 GROUP BY x.marker", "variants"))
def g36r(spark, d):
    return v.automatic_ratio(stored(view(spark, d, "variants")), percent=80)


@query("g03_shared_between_markers", with_views("x AS (SELECT CASE WHEN md5 < '8' THEN 'MX' ELSE marker END AS marker, md5, depth FROM variants UNION ALL SELECT marker, md5, depth FROM variants WHERE md5 < '4') SELECT md5, count(DISTINCT marker) AS n_markers, sum(depth)::BIGINT AS depth FROM x GROUP BY md5 HAVING count(DISTINCT marker) > 1", "variants"))
def g03s(spark, d):
    """Sequences that two markers have."""
    x = stored(view(spark, d, "variants"))
    y = x.withColumn("marker", F.when(F.col("md5") < "8", "MX").otherwise(F.col("marker"))).unionByName(x.where("md5 < '4'"))
    return v.shared_between_markers(y)

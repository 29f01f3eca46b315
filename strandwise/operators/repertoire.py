"""T-cell repertoires: CDR3 rows (sample, marker, umi, cdr3, v, j) to clonotypes and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s
from .folders import stored
from .near import near_candidates, settled
from .ranking import first_rows


def extract_cdr3(reads: DataFrame, pattern: str, umi_at: int = 0, umi_length: int = 0, v_pattern: str = "", flank: int = 3, j_length: int = 30) -> DataFrame:
    """Reads whose sequence matches ``pattern`` (a regular expression with one
    group, the CDR3): the CDR3 with ``flank`` bases on each side, the V part to its
    left, up to ``j_length`` bases to its right and the UMI at its place. Letters
    other than A, C, G, T become N first. v_pattern: what the V part must hold."""
    seq = F.regexp_replace(F.upper("seq"), "[^ACGT]", "N")
    whole = F.regexp_substr(seq, F.lit(pattern))
    inner = F.regexp_extract(seq, pattern, 1)
    start = F.instr(seq, whole) + F.instr(whole, inner) - 1
    out = reads.withColumns({"__seq": seq, "__cdr3": inner, "__at": start}).where("__cdr3 <> ''")
    out = out.select(
        "read_id",
        F.substring("__seq", umi_at + 1, umi_length).alias("umi"),
        F.substr("__seq", F.greatest(F.col("__at") - flank, F.lit(1)), F.length("__cdr3") + flank + F.least(F.col("__at") - 1, F.lit(flank))).alias("cdr3"),
        F.substr("__seq", F.lit(1), F.greatest(F.col("__at") - 1 - flank, F.lit(0))).alias("tcrv_seq"),
        F.substr("__seq", F.col("__at") + F.length("__cdr3") + flank, F.lit(j_length)).alias("tcrj_seq"),
    )
    return out.where(F.col("tcrv_seq").rlike(v_pattern)) if v_pattern else out


def best_orientation(pairs: DataFrame, pattern: str) -> DataFrame:
    """Of the four orders of two mates the one with most CDR3s: sense, n. Give it the first reads of a file."""
    orders = {"R1+R2+": F.concat_ws("-----", "seq1", "seq2"), "R1+R2-": F.concat_ws("-----", F.col("seq1"), s.reverse_complement("seq2")), "R1-R2+": F.concat_ws("-----", s.reverse_complement("seq1"), F.col("seq2")), "R1-R2-": F.concat_ws("-----", s.reverse_complement("seq1"), s.reverse_complement("seq2"))}
    tried = pairs.select(F.explode(F.array(*[F.struct(F.lit(k).alias("sense"), v.rlike(pattern).alias("hit")) for k, v in orders.items()])).alias("o"))
    counts = tried.groupBy("o.sense").agg(F.count_if("o.hit").alias("n"))
    return counts.orderBy(F.desc("n"), "sense").limit(1)


def valid_cdr3(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Adds short, long, frameshift, stop and valid; a row may fail several tests."""
    n = F.length("cdr3")
    flags = {"short": n < low, "long": n > high, "frameshift": n % 3 != 0, "stop": s.has_stop("cdr3")}
    return rows.withColumns(flags).withColumn("valid", ~(F.col("short") | F.col("long") | F.col("frameshift") | F.col("stop")))


def validity_counts(rows: DataFrame, low: int, high: int) -> DataFrame:
    flags = ("short", "long", "frameshift", "stop", "valid")
    return valid_cdr3(rows, low, high).groupBy("sample", "marker").agg(F.count("*").alias("reads"), *[F.count_if(f).alias(f) for f in flags])


def plain_umis(rows: DataFrame) -> DataFrame:
    """Rows whose UMI has no other letters than A, C, G, T; others, as NNN.., are hot keys."""
    return rows.where(F.coalesce(F.col("umi").rlike("^[ACGT]+$"), F.lit(False)))


def umi_letters(rows: DataFrame) -> DataFrame:
    """Per sample the reads whose UMI counts, and those that ``plain_umis`` leaves out."""
    plain = F.coalesce(F.col("umi").rlike("^[ACGT]+$"), F.lit(False))
    return rows.groupBy("sample").agg(F.count_if(plain).alias("used"), F.count_if(~plain).alias("left_out"))


def umi_consensus(rows: DataFrame, substitutions: int = 0, keep_singles: bool = False) -> DataFrame:
    """A row per UMI: its most frequent sequence, the reads within ``substitutions``
    of it, all reads, and whether it is correct (more than half of them). Only
    ``plain_umis`` count."""
    key = ["sample", "marker", "umi"]
    counts = plain_umis(rows).groupBy(*key, "cdr3").agg(F.count("*").alias("n"))
    top = counts.groupBy(*key).agg(F.sum("n").alias("reads"), F.min(F.struct((-F.col("n")).alias("n"), "cdr3"))["cdr3"].alias("top"))
    joined = counts.join(top, key)
    near = F.when(F.col("cdr3") == F.col("top"), 0).otherwise(s.hamming("cdr3", "top")) <= substitutions if substitutions else F.col("cdr3") == F.col("top")
    out = joined.groupBy(*key, "reads", "top").agg(F.sum(F.when(near, F.col("n")).otherwise(0)).alias("clustered"))
    if not keep_singles:
        out = out.where("reads > 1")
    return out.withColumn("correct", 2 * F.col("clustered") > F.col("reads"))


def capped_umis(umis: DataFrame, most: int) -> DataFrame:
    """The first ``most`` correct UMIs of each sample and marker: a cap is the feature here."""
    nth = F.row_number().over(Window.partitionBy("sample", "marker").orderBy("umi"))
    return umis.where("correct").withColumn("nth", nth).where(F.col("nth") <= most).drop("nth")


def reads_per_umi(rows: DataFrame) -> DataFrame:
    """Histogram of reads per UMI (``plain_umis``) of each sample, gaps filled with 0."""
    per = plain_umis(rows).groupBy("sample", "umi").agg(F.count("*").alias("reads")).groupBy("sample", "reads").agg(F.count("*").alias("umis"))
    steps = per.groupBy("sample").agg(F.max("reads").alias("most")).select("sample", F.explode(F.sequence(F.lit(1).cast("long"), "most")).alias("reads"))
    return steps.join(per, ["sample", "reads"], "left").select("sample", "reads", F.coalesce("umis", F.lit(0)).cast("long").alias("umis"))


def cluster_equal_length(counts: DataFrame, substitutions: int, keys: list[str], seq: str = "cdr3", depth: str = "depth") -> DataFrame:
    """Greedy by depth within keys and length: a sequence joins the deepest earlier
    head within ``substitutions``. Adds head; an empty sequence has no row. Near
    sequences meet by parts with one base masked, heads settle in rounds."""
    if not substitutions:
        return counts.withColumn("head", F.col(seq))
    known = stored(counts.where(F.length(seq) > 0).select(F.xxhash64(*keys, seq).alias("vid"), *keys, F.col(seq).alias("seq"), F.col(depth).alias("depth")))
    side = lambda k, end: known.select(F.col("vid").alias(end), *[F.col(c).alias(f"{c}_{k}") for c in (*keys, "seq")], F.struct((-F.col("depth")).alias("d"), "seq").alias(f"rank_{k}"))
    pairs = near_candidates(known, substitutions, True, tuple(keys)).join(side(1, "a"), "a").join(side(2, "b"), "b")
    for c in keys:
        pairs = pairs.where(F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2")))
    pairs = pairs.where(s.hamming("seq_1", "seq_2") <= substitutions)
    first = F.col("rank_1") < F.col("rank_2")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    to = settled(pairs.select(pick("a", "b").alias("u"), pick("rank_1", "rank_2").alias("rank"), pick("b", "a").alias("v")))
    heads = to.where("to is not null").join(known.select(F.col("vid").alias("to"), F.col("seq").alias("head")), "to").select(F.col("v").alias("vid"), "head")
    out = counts.where(F.length(seq) > 0).withColumn("vid", F.xxhash64(*keys, seq)).join(heads, "vid", "left")
    return out.withColumn("head", F.coalesce("head", F.col(seq))).drop("vid")


def clonotypes(rows: DataFrame) -> DataFrame:
    """cloneId, cloneCount, cloneFraction, nSeqCDR3, aaSeqCDR3, vHits, jHits per
    sample. Ids number proteins by depth of their best clone; ``.k`` tells several
    nucleotide sequences of a protein apart. V and J: the most frequent, cut at ``*``."""
    mode = lambda c: F.regexp_extract(F.mode(c, True), r"^([^*]*)", 1)
    clones = rows.groupBy("sample", F.col("cdr3").alias("nSeqCDR3")).agg(F.count("*").alias("cloneCount"), mode("v").alias("vHits"), mode("j").alias("jHits"))
    clones = clones.withColumn("aaSeqCDR3", s.translate_dna("nSeqCDR3"))
    sample, protein = Window.partitionBy("sample"), Window.partitionBy("sample", "aaSeqCDR3")
    deep = protein.orderBy(F.desc("cloneCount"), "nSeqCDR3")
    best = clones.withColumns({"top": F.max("cloneCount").over(protein), "lead": F.first("nSeqCDR3").over(deep), "k": F.row_number().over(deep), "n": F.count("*").over(protein), "cloneFraction": F.round(F.col("cloneCount") / F.sum("cloneCount").over(sample), 6)})
    rank = F.dense_rank().over(sample.orderBy(F.desc("top"), "lead")).cast("string")
    clone_id = F.when(F.col("n") > 1, F.concat_ws(".", rank, F.col("k").cast("string"))).otherwise(rank)
    return best.select("sample", clone_id.alias("cloneId"), "cloneCount", "cloneFraction", "nSeqCDR3", "aaSeqCDR3", "vHits", "jHits")


def top_clones(clones: DataFrame, most: int = 10_000) -> DataFrame:
    """The ``most`` clones of each sample by count, then sequence, with their number."""
    return first_rows(clones, ["sample"], [-F.col("cloneCount"), F.substring("nSeqCDR3", 1, 6)], [F.col("nSeqCDR3")], most)


def percentile_group(clones: DataFrame) -> DataFrame:
    """Fifth (1 to 5) of each clone's count in its sample, by the 20, 40, 60 and 80 percentiles."""
    cuts = clones.groupBy("sample").agg(F.percentile("cloneCount", F.array(*[F.lit(x) for x in (0.2, 0.4, 0.6, 0.8)])).alias("cuts"))
    return clones.join(cuts, "sample").withColumn("fifth", F.size(F.filter("cuts", lambda c: c < F.col("cloneCount"))) + 1).drop("cuts")


def stage_counts(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Reads of each sample: all, valid, singletons, clones and proteins."""
    v = valid_cdr3(rows, low, high)
    clones = v.where("valid").groupBy("sample", "cdr3").agg(F.count("*").alias("n"))
    per = clones.groupBy("sample").agg(F.count("*").alias("clones"), F.count_if(F.col("n") == 1).alias("singletons"), F.countDistinct(s.translate_dna("cdr3")).alias("proteins"))
    return v.groupBy("sample").agg(F.count("*").alias("reads"), F.count_if("valid").alias("valid")).join(per, "sample", "left").na.fill(0)


def length_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sample", F.length("cdr3").alias("len")).agg(F.count("*").alias("n"))


def depth_counts(counts: DataFrame, step: str) -> DataFrame:
    """Per sample, marker and ``step`` (a name) how many sequences have each depth."""
    return counts.groupBy("sample", "marker", F.lit(step).alias("step"), "depth").agg(F.count("*").alias("n"))


#: Which columns a row of segment_usage is about, by its grouping id.
USAGE = {0: "sample, v, j", 1: "sample, v", 2: "sample, j", 4: "v, j", 5: "v", 6: "j"}


def segment_usage(rows: DataFrame) -> DataFrame:
    """Counts of V, J and their pairs per sample and over all samples; ``level`` names the
    columns that a row is about, the others are null."""
    sets = [["sample", "v", "j"], ["sample", "v"], ["sample", "j"], ["v", "j"], ["v"], ["j"]]
    counted = rows.groupingSets(sets, "sample", "v", "j").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    names = F.create_map(*[F.lit(x) for kv in USAGE.items() for x in kv])
    return counted.select(F.element_at(names, F.col("g").cast("int")).alias("level"), "sample", "v", "j", "n")


def usage_by_length(rows: DataFrame) -> DataFrame:
    """V and J counts of each CDR3 length over all samples."""
    return rows.groupingSets([["len", "v"], ["len", "j"]], F.length("cdr3").alias("len"), "v", "j").agg(F.count("*").alias("n"))


def shared_pairs(rows: DataFrame) -> DataFrame:
    """Per individual and pair of its samples: sequences u that one of them alone has, c
    that both have, and Chao2 = u + c + u^2 / 2c (null without common ones)."""
    sets = rows.groupBy("marker", "individual", "cdr3").agg(F.array_sort(F.collect_set("sample")).alias("set")).groupBy("marker", "individual", "set").agg(F.count("*").alias("n"))
    samples = sets.select("marker", "individual", F.explode("set").alias("a")).groupBy("marker", "individual").agg(F.array_sort(F.collect_set("a")).alias("all"))
    pairs = samples.select("marker", "individual", "all", F.explode("all").alias("a")).select("marker", "individual", "a", F.explode(F.filter("all", lambda x: x > F.col("a"))).alias("b"))
    met = pairs.join(sets, ["marker", "individual"]).select("marker", "individual", "a", "b", "n", F.array_contains("set", F.col("a")).alias("in_a"), F.array_contains("set", F.col("b")).alias("in_b"))
    per = met.groupBy("marker", "individual", "a", "b").agg(F.sum(F.when(F.col("in_a") != F.col("in_b"), F.col("n")).otherwise(0)).alias("u"), F.sum(F.when(F.col("in_a") & F.col("in_b"), F.col("n")).otherwise(0)).alias("c"))
    return per.withColumn("chao2", F.col("u") + F.col("c") + F.col("u") * F.col("u") / F.nullif(2 * F.col("c"), F.lit(0)))


def shared_by_number(rows: DataFrame) -> DataFrame:
    """Per marker: number of sequences found in exactly k individuals."""
    k = rows.groupBy("marker", "cdr3").agg(F.countDistinct("individual").alias("k"))
    return k.groupBy("marker", "k").agg(F.count("*").alias("n"))


def variants_per_umi(rows: DataFrame) -> DataFrame:
    """Histogram of distinct sequences per UMI (``plain_umis``) of each sample."""
    per = plain_umis(rows).groupBy("sample", "umi").agg(F.countDistinct("cdr3").alias("variants"))
    return per.groupBy("sample", "variants").agg(F.count("*").alias("umis"))


def umi_clonotypes(rows: DataFrame) -> DataFrame:
    """The clonotype table counted by correct UMIs (see ``umi_consensus``), each for its
    most frequent sequence: cloneCount and cloneFraction in UMIs, totalReads and
    readFraction in the reads that agree with it; V and J of those reads."""
    umis = umi_consensus(rows, keep_singles=True).where("correct").select("sample", "marker", "umi", F.col("top").alias("cdr3"))
    counted = rows.join(umis, ["sample", "marker", "umi", "cdr3"])
    reads = counted.groupBy("sample", F.col("cdr3").alias("nSeqCDR3")).agg(F.count("*").alias("totalReads"))
    one = counted.groupBy("sample", "marker", "umi", "cdr3").agg(F.mode("v", True).alias("v"), F.mode("j", True).alias("j"))
    total = F.sum("totalReads").over(Window.partitionBy("sample"))
    return clonotypes(one).join(reads, ["sample", "nSeqCDR3"]).withColumn("readFraction", F.round(F.col("totalReads") / total, 6))


def shared_within(rows: DataFrame) -> DataFrame:
    """Per individual: number of sequences found in exactly k of its samples."""
    k = rows.groupBy("marker", "individual", "cdr3").agg(F.countDistinct("sample").alias("k"))
    return k.groupBy("marker", "individual", "k").agg(F.count("*").alias("n"))


def chao2(rows: DataFrame) -> DataFrame:
    """Per individual with two samples: uniques u, common c and u + c + u^2 / 2c (null without common ones)."""
    k = shared_within(rows)
    per = k.groupBy("marker", "individual").agg(F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("u"), F.sum(F.when(F.col("k") >= 2, F.col("n")).otherwise(0)).alias("c"))
    return per.withColumn("chao2", F.col("u") + F.col("c") + F.col("u") * F.col("u") / F.nullif(2 * F.col("c"), F.lit(0)))


def overlap_matrix(rows: DataFrame, by: str = "sample") -> DataFrame:
    """Shared sequences of each pair of samples (or individuals). Sequences meet by
    their set of samples, so a public one costs a pair for each two samples once per set."""
    sets = rows.groupBy("marker", "cdr3").agg(F.array_sort(F.collect_set(by)).alias("set")).groupBy("marker", "set").agg(F.count("*").alias("n"))
    first = sets.select("marker", "set", "n", F.explode("set").alias("a"))
    pairs = first.select("marker", "a", F.explode(F.filter("set", lambda x: x > F.col("a"))).alias("b"), "n")
    return pairs.groupBy("marker", "a", "b").agg(F.sum("n").alias("shared"))


def shared_near(counts: DataFrame, substitutions: int) -> DataFrame:
    """Per individual and k: sequences found in k samples when ``substitutions`` are allowed."""
    keys = ["marker", "individual"]
    summed = counts.groupBy(*keys, "cdr3").agg(F.count("*").alias("depth"))
    heads = cluster_equal_length(summed, substitutions, keys).select(*keys, "cdr3", "head")
    k = counts.join(heads, [*keys, "cdr3"]).groupBy(*keys, "head").agg(F.countDistinct("sample").alias("k"))
    return k.groupBy(*keys, "k").agg(F.count("*").alias("n"))


def translate_and_collapse(rows: DataFrame) -> DataFrame:
    aa = rows.withColumn("aa", s.translate_dna("cdr3")).where(~F.contains("aa", F.lit("*")))
    return aa.groupBy("sample", "marker", "aa").agg(F.count("*").alias("depth"), F.countDistinct("cdr3").alias("n_sequences"))


def protein_groups(segments: DataFrame) -> DataFrame:
    """segment, aa: summed depth and the joined names of the nucleotide forms."""
    return segments.groupBy("segment", "aa").agg(F.sum("depth").alias("depth"), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


def reference_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("ref").agg(F.sum("depth").alias("depth"), F.count("*").alias("matches"), F.countDistinct("name").alias("distinct_matches"))


def segment_reads(reads: DataFrame, motifs: dict[str, str], d_motif: str | None = None, primers: list[str] | None = None) -> DataFrame:
    """Cuts reads by the motifs of their segments, regular expressions on proteins that
    follow each other (V, CDR3, J and, if wanted, C, in this order, without groups that
    capture): the first of the frames +1, +2, +3, -1, -2, -3 without a stop that matches
    all of them counts. Adds status (valid, no_pattern, no_frame), frame, the nucleotides
    of each segment under its name in lower case, and ``marked``: all of them, those
    beside the CDR3 in lower case. d_motif: adds d, the longest (first) match inside the
    CDR3. primers (IUPAC): adds with_primer, does the read hold one in either strand."""
    pattern = "".join(f"({m})" for m in motifs.values())
    both = F.struct(F.col("seq").alias("forward"), s.reverse_complement("seq").alias("turned"))
    tries = s.let(both, lambda b: F.array(*[F.struct(F.lit(side * f).alias("frame"), F.substr(b[dna], F.lit(f)).alias("dna"), s.translate_dna(b[dna], f).alias("aa")) for side, dna in ((1, "forward"), (-1, "turned")) for f in (1, 2, 3)]))
    opened = F.filter(tries, lambda x: (F.length(x["aa"]) > 0) & ~F.contains(x["aa"], F.lit("*")))
    rows = reads.select("read_id", "seq", opened.alias("open")).withColumn("hit", F.get(F.filter("open", lambda x: F.rlike(x["aa"], F.lit(pattern))), F.lit(0)))
    rows = rows.withColumns({f"aa_{n}": F.regexp_extract("hit.aa", pattern, k) for k, n in enumerate(motifs, 1)}).withColumn("at", F.regexp_instr("hit.aa", F.lit(pattern)) - 1)
    start, columns = F.col("at"), []
    for n in motifs:
        columns.append(F.substr("hit.dna", 3 * start + 1, 3 * F.length(f"aa_{n}")).alias(n.lower()))
        if n == "CDR3":
            cdr3 = start
        start = start + F.length(f"aa_{n}")
    if d_motif:
        found = F.regexp_extract_all("aa_CDR3", F.lit(d_motif), F.lit(0))
        best = s.let(found, lambda x: F.get(F.filter(x, lambda m: F.length(m) == F.array_max(F.transform(x, lambda y: F.length(y)))), F.lit(0)))
        rows = rows.withColumn("aa_D", best)
        columns.append(F.substr("hit.dna", 3 * (cdr3 + F.instr("aa_CDR3", F.col("aa_D"))) - 2, 3 * F.length("aa_D")).alias("d"))
    marked = F.concat(*[F.upper(c) if n == "CDR3" else F.lower(c) for n, c in ((n, F.col(n.lower())) for n in motifs)])
    status = F.when(F.col("hit").isNotNull(), "valid").when(F.size("open") > 0, "no_pattern").otherwise("no_frame")
    extra = []
    if primers:
        plain = "|".join(s.iupac_pattern(p) for p in primers)
        extra.append(F.coalesce(F.rlike(F.upper("seq"), F.lit(plain)) | F.rlike(s.reverse_complement(F.upper("seq")), F.lit(plain)), F.lit(False)).alias("with_primer"))
    cut = rows.select("read_id", status.alias("status"), F.col("hit.frame").alias("frame"), *columns, *extra)
    return cut.withColumn("marked", marked)


def parse_totals(segmented: DataFrame) -> DataFrame:
    """One row: reads, those with a primer (if told) and those of each status."""
    primer = [F.count_if("with_primer").alias("with_primer")] if "with_primer" in segmented.columns else []
    return segmented.agg(F.count("*").alias("reads"), *primer, *[F.count_if(F.col("status") == x).alias(x) for x in ("valid", "no_pattern", "no_frame")])

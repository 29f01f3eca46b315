"""Clustering of amplicon variants, artefact filters and genotyping.

Greedy steps take variants by (depth desc, md5), in rounds over the table of near
pairs, so that an amplicon's work is spread over tasks. Depth is conserved: counted
members, ambiguous ones and leftovers add up."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s
from ..functions.align import compare_pair, error_positions, pair_alignment, star_columns, with_pair_errors
from .chimeras import chimeras
from .folders import stored
from .near import PRIORITY, both_sides, near_candidates, near_pairs, settled, with_vid
from .variants import AMPLICON, by_depth, degree_of_change

MEMBERS = "marker string, sample string, cluster int, role string, md5 string, seq string, depth long, counted boolean, subs int, ins int, dels int, homo int"
_COLUMNS = [c.split()[0] for c in MEMBERS.split(", ")]
_ERRORS = ("subs", "ins", "dels", "homo")


def _guided_pairs(known: DataFrame, max_subs: float, max_indels: float, min_identity: float) -> DataFrame:
    """(h, v, h_rank, v_rank, seqs, depths, errors): what a head h may absorb, earlier or
    later than it. Equal lengths differ by substitutions only; others by at most
    max(indel limit, 3) indels in all, of which the limit counts those outside of runs."""
    longest = known.agg(F.coalesce(F.max(F.length("seq")), F.lit(0))).first()[0]
    subs, indels = round(max_subs * longest / 100), round(max_indels * longest / 100)
    equal = both_sides(near_candidates(known, subs, same_length=True), known).where(F.length("seq_1") == F.length("seq_2"))
    equal = equal.withColumns({"subs": s.hamming("seq_1", "seq_2"), **{c: F.lit(0) for c in ("ins", "dels", "homo")}})
    both = equal.withColumn("ident", F.length("seq_1") - F.col("subs")).withColumn("aligned", F.length("seq_1"))
    if indels >= 1:
        gapped = both_sides(near_candidates(known, subs + max(indels, 3)), known).where(F.length("seq_1") != F.length("seq_2"))
        gapped = with_pair_errors(gapped, "seq_2", "seq_1")
        both = both.unionByName(gapped.select("*", *[F.col(f"e.{c}") for c in (*_ERRORS, "ident", "aligned")]).drop("e"))
    turn = lambda a, b, ins, dels: both.select(*AMPLICON, F.col(f"vid_{a}").alias("h"), F.col(f"vid_{b}").alias("v"), F.col(f"rank_{a}").alias("h_rank"), F.col(f"rank_{b}").alias("v_rank"), F.col(f"seq_{a}").alias("h_seq"), F.col(f"seq_{b}").alias("v_seq"), F.col(f"depth_{a}").alias("h_depth"), F.col(f"depth_{b}").alias("v_depth"), "ident", "aligned", "subs", F.col(ins).alias("ins"), F.col(dels).alias("dels"), "homo")
    pairs = turn(1, 2, "ins", "dels").unionByName(turn(2, 1, "dels", "ins"))
    n, m = F.length("h_seq"), F.length("v_seq")
    limit = lambda percent: F.bround(F.lit(float(percent)) * n / 100)
    gaps = F.col("ins") + F.col("dels")
    fits = (m == n) | ((limit(max_indels) >= 1) & (F.abs(m - n) <= F.greatest(limit(max_indels), F.lit(3))) & (gaps <= F.greatest(limit(max_indels), F.lit(3))) & (gaps - F.col("homo") <= limit(max_indels)))
    return pairs.where(fits & (F.col("subs") <= limit(max_subs)) & (100 * F.col("ident") >= min_identity * F.col("aligned")))


def cluster_guided(variants: DataFrame, max_subs: float = 1, max_indels: float = 1, min_dominant_percent: float = 25, lengths: list[int] | None = None, max_clusters: int = 0, min_amplicon_percent: float = 0, min_identity: float = 0, exact_length: bool = False, stops: int = 0) -> DataFrame:
    """Walks each amplicon by depth: a head absorbs variants within max_subs percent
    substitutions and max_indels percent other indels (and of min_identity percent), but
    not a strong one: with min_dominant_percent of its depth, or min_amplicon_percent of the
    amplicon's, that passes as dominant: in frame with ``lengths`` (or the head's) or of
    such a length (exact_length), without a stop in frame ``stops`` (if not 0), with
    indels against the head in threes or one of each nearby. A variant as near to another
    strong one is listed, not counted. Singletons are no heads; what is left is role "none"
    of cluster 0. Rows of MEMBERS.

    The walk is done in rounds: a head acts as soon as no earlier head can still touch it
    or what it touches, so alleles that are unlike act at once."""
    known = stored(with_vid(variants))
    near = _guided_pairs(known, max_subs, max_indels, min_identity)
    total = known.groupBy(*AMPLICON).agg(F.sum("depth").alias("total"))
    near = near.join(total, list(AMPLICON))
    right = F.array(*[F.lit(x) for x in lengths]) if lengths else F.array(F.length("h_seq"))
    much = 100 * F.col("v_depth") >= min_dominant_percent * F.col("h_depth")
    if min_amplicon_percent:
        much = much | (100 * F.col("v_depth") >= min_amplicon_percent * F.col("total"))
    much = much & (F.col("v_rank") > F.col("h_rank"))
    frame = F.expr("exists(right, x -> abs(length(v_seq) - x) % 3 = 0 and abs(length(v_seq) - x) <= 0.9 * x)")
    fine = F.array_contains("right", F.length("v_seq")) if exact_length else frame
    if stops:
        fine = fine & ~s.has_stop("v_seq", stops)
    near = near.withColumn("right", right).withColumn("strong", much & fine).drop("right")
    # Where the lengths differ the indels have to be in threes, too.
    odd = near.where(F.col("strong") & (F.col("ins") + F.col("dels") > 0)).select("h_seq", "v_seq").distinct()
    odd = odd.withColumn("p", pair_alignment("v_seq", "h_seq")).withColumn("at", error_positions("p.q_aln", "p.s_aln"))
    odd = odd.select("h_seq", "v_seq", indels_in_threes(F.col("at.ins"), F.col("at.dels")).alias("threes"))
    near = near.join(odd, ["h_seq", "v_seq"], "left").withColumn("strong", F.col("strong") & F.coalesce("threes", F.lit(True)))
    near = stored(near.select("h", "h_rank", "v", "v_rank", *_ERRORS, (F.col("subs") + F.col("ins") + F.col("dels") + F.col("homo")).alias("errors"), "strong"))

    later = near.where(F.col("v_rank") > F.col("h_rank"))
    free = stored(known.select("vid", "depth", F.expr(PRIORITY).alias("rank")))
    results = []
    while free.where("depth > 1").head(1):
        heads = free.where("depth > 1").select(F.col("vid").alias("h"), F.col("rank").alias("h_rank"))
        mine = later.drop("h_rank").join(heads, "h").join(free.select(F.col("vid").alias("v")), "v", "left_semi")
        touched = mine.select("h", "h_rank", "v").unionByName(heads.withColumn("v", F.col("h")))
        first = touched.groupBy("v").agg(F.min("h_rank").alias("first"))
        ready = stored(touched.join(first, "v").groupBy("h").agg(F.max(F.col("first") != F.col("h_rank")).alias("waits")).where("not waits").select("h"))
        mine = mine.join(ready, "h", "left_semi")
        rivals = mine.where("strong").select("h", F.col("v").alias("r"))
        others = rivals.join(near.select(F.col("h").alias("r"), "v", "errors"), "r").groupBy("h", "v").agg(F.min("errors").alias("other"))
        won = mine.where("not strong").join(others, ["h", "v"], "left").where(F.col("other").isNull() | (F.col("other") >= F.col("errors")))
        won = won.select("h", "v", F.lit("member").alias("role"), (F.col("other").isNull() | (F.col("other") > F.col("errors"))).alias("counted"), *_ERRORS)
        zero = [F.lit(0).alias(c) for c in _ERRORS]
        done = stored(won.unionByName(ready.select("h", F.col("h").alias("v"), F.lit("head").alias("role"), F.lit(True).alias("counted"), *zero)))
        results.append(done)
        free = stored(free.join(done.select(F.col("v").alias("vid")), "vid", "left_anti"))
    return _members(known, results, max_clusters)


def _members(known: DataFrame, results: list[DataFrame], max_clusters: int = 0, order: DataFrame | None = None) -> DataFrame:
    """Rows of MEMBERS from (h, v, role, counted, errors); clusters are numbered by the
    depth of their heads, or as in ``order``."""
    if not results:
        done = known.select(F.col("vid").alias("h"), F.col("vid").alias("v"), F.lit("none").alias("role"), F.lit(False).alias("counted"), *[F.lit(0).alias(c) for c in _ERRORS]).limit(0)
    else:
        done = results[0]
        for more in results[1:]:
            done = done.unionByName(more)
    heads = order if order is not None else known.join(done.where("role = 'head'").select(F.col("v").alias("vid")), "vid", "left_semi")
    number = F.row_number().over(by_depth(*AMPLICON))
    numbered = heads.select(F.col("vid").alias("h"), number.alias("cluster"))
    numbered = numbered.where(F.col("cluster") <= max_clusters) if max_clusters else numbered
    got = done.join(numbered, "h").drop("h").withColumnRenamed("v", "vid")
    out = known.join(got, "vid", "left")
    return out.select(*AMPLICON, F.coalesce("cluster", F.lit(0)).alias("cluster"), F.coalesce("role", F.lit("none")).alias("role"), "md5", "seq", "depth", F.coalesce("counted", F.lit(False)).alias("counted"), *[F.coalesce(c, F.lit(0)).alias(c) for c in _ERRORS])


def cluster_denovo(variants: DataFrame, substitutions: int = 1, min_percent: float = 25, min_seed: int = 2) -> DataFrame:
    """Round one joins equal lengths within ``substitutions``, smaller depth first
    under min_percent of the head's; round two joins heads whose alignment has as few
    errors, on cluster depths. Rows of MEMBERS."""
    known = stored(with_vid(variants))
    equal = both_sides(near_candidates(known, substitutions, same_length=True), known).where(s.hamming("seq_1", "seq_2") <= substitutions)
    weak = lambda low, high: 100 * F.col(low) < min_percent * F.col(high)
    first = settled(equal.where((F.col("depth_1") >= min_seed) & weak("depth_2", "depth_1")).select(F.col("vid_1").alias("u"), F.col("rank_1").alias("rank"), F.col("vid_2").alias("v")))
    head = F.coalesce("to", F.when(F.col("depth") >= min_seed, F.col("vid")))
    placed = stored(known.join(first.withColumnRenamed("v", "vid"), "vid", "left").withColumn("h", head).drop("to"))
    total = placed.where("h is not null").groupBy("h").agg(F.sum("depth").alias("total"))
    heads = stored(known.drop("depth").join(total, F.col("vid") == F.col("h")).drop("h").withColumnRenamed("total", "depth"))
    gapped = both_sides(near_candidates(heads, substitutions), heads).where(F.length("seq_1") != F.length("seq_2")).where(weak("depth_2", "depth_1"))
    gapped = with_pair_errors(gapped, "seq_2", "seq_1").where(F.col("e.subs") + F.col("e.ins") + F.col("e.dels") <= substitutions)
    second = settled(gapped.select(F.col("vid_1").alias("u"), F.col("rank_1").alias("rank"), F.col("vid_2").alias("v")))
    final = placed.join(second.select(F.col("v").alias("h"), "to"), "h", "left").withColumn("h", F.coalesce("to", "h")).drop("to")
    of = known.select(F.col("vid").alias("h"), F.col("seq").alias("h_seq"))
    rows = with_pair_errors(final.where("h is not null").join(of, "h"), "seq", "h_seq")
    alone = F.col("vid") == F.col("h")
    done = rows.select("h", F.col("vid").alias("v"), F.when(alone, "head").otherwise("member").alias("role"), F.lit(True).alias("counted"), *[F.when(alone, 0).otherwise(F.col(f"e.{c}")).alias(c) for c in _ERRORS])
    # Numbers go by the depth of the clusters before their heads are joined.
    order = heads.join(done.where("role = 'head'").select(F.col("v").alias("vid")), "vid", "left_semi").select("vid", *AMPLICON, "md5", "seq", "depth")
    return _members(known, [stored(done)], 0, order)


def cluster_depths(members: DataFrame) -> DataFrame:
    """marker, sample, cluster, md5 and seq of the head, depth of counted members, size."""
    head = F.max(F.when(F.col("role") == "head", F.struct("md5", "seq")))
    per = members.where("cluster > 0").groupBy(*AMPLICON, "cluster").agg(head.alias("h"), F.sum(F.when(F.col("counted"), F.col("depth")).otherwise(0)).alias("depth"), F.count("*").alias("size"))
    return per.select(*AMPLICON, "cluster", "h.md5", "h.seq", "depth", "size")


def _star_profile(members: DataFrame, heads: DataFrame) -> DataFrame:
    """key, built: the vote by depth in the columns of a star alignment, each distinct
    (member, head) aligned once; a gap is a letter that loses ties."""
    key = [*AMPLICON, "cluster"]
    counted = members.where("cluster > 0 and counted").join(heads.select(*key, "head_seq"), key)
    pairs = counted.select("seq", "head_seq").distinct().withColumn("p", pair_alignment("seq", "head_seq"))
    columns = pairs.select("seq", "head_seq", star_columns("p.q_aln", "p.s_aln").alias("c"))
    votes = counted.join(columns, ["seq", "head_seq"]).select(*key, "depth", F.inline("c")).groupBy(*key, "pos", "slot", "base").agg(F.sum("depth").alias("d"))
    # Members without an insertion vote for none.
    total = counted.groupBy(*key).agg(F.sum("depth").alias("total"))
    gaps = votes.where("slot > 0").groupBy(*key, "pos", "slot").agg(F.sum("d").alias("d")).join(total, key)
    votes = votes.unionByName(gaps.select(*key, "pos", "slot", F.lit("-").alias("base"), (F.col("total") - F.col("d")).alias("d")))
    best = F.min(F.struct((-F.col("d")).alias("d"), (F.col("base") == "-").alias("gap"), "base"))["base"]
    kept = votes.groupBy(*key, "pos", "slot").agg(best.alias("base")).where("base <> '-'")
    built = kept.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "slot", "base"))).alias("b"))
    return built.select(*key, F.array_join(F.transform("b", lambda x: x["base"]), "").alias("built"))


def consensus(members: DataFrame, least: int = 3, lengths: list[int] | None = None, gapped: bool = False) -> DataFrame:
    """Depth-weighted consensus of the members as long as their head, or of all members,
    aligned to their head, if ``gapped``; the smallest base
    wins ties; clusters below ``least`` members, or whose consensus isn't dominant for
    ``lengths``, keep their head. merged_into: the first earlier cluster of the amplicon
    that has the consensus as a member."""
    key = [*AMPLICON, "cluster"]
    heads = cluster_depths(members).select(*key, F.col("seq").alias("head_seq"), "size")
    fit = members.where("cluster > 0 and counted").join(heads, key).where(F.length("seq") == F.length("head_seq"))
    if gapped:
        return _named_consensus(members, _star_profile(members, heads).join(heads, key), least, lengths)
    bases = fit.select(*key, "head_seq", "size", "depth", F.posexplode(s.letters("seq")).alias("pos", "base"))
    best = bases.groupBy(*key, "head_seq", "size", "pos", "base").agg(F.sum("depth").alias("d")).groupBy(*key, "head_seq", "size", "pos").agg(F.min(F.struct((-F.col("d")).alias("d"), "base"))["base"].alias("base"))
    joined = best.groupBy(*key, "head_seq", "size").agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("b")).withColumn("built", F.array_join(F.transform("b", lambda x: x["base"]), ""))
    return _named_consensus(members, joined, least, lengths)


def _named_consensus(members: DataFrame, joined: DataFrame, least: int, lengths: list[int] | None) -> DataFrame:
    """consensus, changed and merged_into from (key, head_seq, size, built)."""
    key = [*AMPLICON, "cluster"]
    right = F.col("size") >= least
    if lengths is not None:
        right = right & is_dominant("built", F.array(*[F.lit(n) for n in lengths]))
    seq = F.when(right, F.col("built")).otherwise(F.col("head_seq"))
    out = joined.select(*key, seq.alias("consensus"), (seq != F.col("head_seq")).alias("changed"))
    earlier = members.where("cluster > 0").select(*AMPLICON, F.col("seq").alias("consensus"), F.col("cluster").alias("of")).groupBy(*AMPLICON, "consensus").agg(F.min("of").alias("of"))
    return out.join(earlier, [*AMPLICON, "consensus"], "left").select(*key, "consensus", "changed", F.when(F.col("of") < F.col("cluster"), F.col("of")).alias("merged_into"))


def prefer_known_heads(members: DataFrame, alleles: DataFrame, errors: bool = False) -> DataFrame:
    """A member that is a known allele becomes its cluster's head (the deepest, if
    several). errors: members of such a cluster get their errors against the new head."""
    known = alleles.select("seq", F.lit(True).alias("known")).distinct()
    m = members.join(known, "seq", "left")
    order = Window.partitionBy(*AMPLICON, "cluster").orderBy((~F.coalesce("known", F.lit(False))).cast("int"), F.when(F.col("role") == "head", 0).otherwise(1), F.desc("depth"), "md5")
    role = F.when(F.col("cluster") == 0, "none").when(F.row_number().over(order) == 1, "head").otherwise("member")
    out = m.withColumn("role", role).drop("known")
    if not errors:
        return out
    key = [*AMPLICON, "cluster"]
    changed = out.where("role = 'head' and cluster > 0").join(members.where("role = 'head'").select(*key, F.col("md5").alias("old")), key).where("md5 <> old").select(*key, F.col("seq").alias("head_seq"))
    new = with_pair_errors(out.join(changed, key).where("role = 'member'"), "seq", "head_seq").select(*key, "md5", "e")
    heads = changed.select(*key, F.lit(True).alias("new_head"))
    told = out.join(new, [*key, "md5"], "left").join(heads, key, "left")
    fresh = lambda c: F.when(F.col("e").isNotNull(), F.col(f"e.{c}")).when(F.col("new_head") & (F.col("role") == "head"), 0).otherwise(F.col(c))
    return told.select(*[fresh(c).alias(c) if c in _ERRORS else F.col(c) for c in out.columns])


def cluster_by_identity(seqs: DataFrame, percent: float, keys: list[str], max_ratio: float = 0.0) -> DataFrame:
    """Greedy, longest then deepest first: a sequence joins the first head with
    ``percent`` identical of the shorter. With max_ratio, single-error copies under that
    share of the head's depth are marked as removed. Adds head and removed."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(n=rows["seq"].str.len()).sort_values(["n", "depth", "md5"], ascending=[False, False, True]).reset_index(drop=True)
        heads: list[int] = []
        head, removed = [], []
        for i, q in enumerate(rows["seq"]):
            found = next((h for h in heads if 100 * compare_pair(q, rows["seq"][h])[0] >= percent * min(len(q), len(rows["seq"][h]))), None)
            if found is None:
                heads.append(i)
                found = i
            e = sum(compare_pair(q, rows["seq"][found])[2:5]) if found != i else 0
            head.append(rows["md5"][found])
            removed.append(bool(max_ratio and e == 1 and rows["depth"][i] < max_ratio * rows["depth"][found]))
        return rows.drop(columns="n").assign(head=head, removed=removed)

    schema = ", ".join(f"{n} {t}" for n, t in seqs.dtypes) + ", head string, removed boolean"
    return seqs.groupBy(*keys).applyInPandas(run, schema)


def cluster_segments(seqs: DataFrame, keys: list[str], min_percent: float = 0.1, identity: float = 90, strong_percent: float = 20) -> DataFrame:
    """Above a frequency floor, deepest first: joins the nearest head with ``identity``
    unless it has strong_percent of that head's depth. Adds head."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[100 * rows["depth"] >= min_percent * rows["depth"].sum()].sort_values(["depth", "md5"], ascending=[False, True]).reset_index(drop=True)
        heads: list[int] = []
        to = []
        for i, q in enumerate(rows["seq"]):
            scored = [(-compare_pair(q, rows["seq"][h])[0], h) for h in heads]
            best = min(scored, default=None)
            if best and -100 * best[0] >= identity * min(len(q), len(rows["seq"][best[1]])) and 100 * rows["depth"][i] < strong_percent * rows["depth"][best[1]]:
                to.append(rows["md5"][best[1]])
            else:
                heads.append(i)
                to.append(rows["md5"][i])
        return rows.assign(head=to)

    schema = ", ".join(f"{n} {t}" for n, t in seqs.dtypes) + ", head string"
    return seqs.groupBy(*keys).applyInPandas(run, schema)


def is_dominant(seq: str | Column, lengths: str | Column, ins: Column | None = None, dels: Column | None = None) -> Column:
    """A right length, or in frame with one (at most 90 % off), and no stop in frame 1.
    With the columns of indels against a reference: one of each within 9 columns, or
    both in threes that lie within 3 columns."""
    n = F.length(seq)
    lengths = F.col(lengths) if isinstance(lengths, str) else lengths
    in_frame = F.exists(lengths, lambda x: (F.abs(n - x) % 3 == 0) & (F.abs(n - x) <= 0.9 * x))
    fine = (F.array_contains(lengths, n) | in_frame) & ~s.has_stop(seq)
    if ins is None or dels is None:
        return fine
    return fine & indels_in_threes(ins, dels)


def indels_in_threes(ins: Column, dels: Column) -> Column:
    """One of each within 9 columns, or both in threes that lie within 3 columns."""
    threes = lambda x: (F.size(x) % 3 == 0) & F.forall(F.transform(x, lambda at, k: F.struct(at.alias("at"), k.alias("k"))), lambda e: (e["k"] % 3 != 2) | (e["at"] - F.get(x, e["k"] - 2) <= 2))
    both = (F.size(ins) == 1) & (F.size(dels) == 1) & (F.abs(F.get(ins, F.lit(0)) - F.get(dels, F.lit(0))) <= 9)
    return both | (threes(ins) & threes(dels))


def filter_artefacts(variants: DataFrame, min_depth: int = 0, min_percent: float = 0, min_dominant_percent: float = 0, lengths: list[int] | None = None, length_error: int | None = None, frameshift: bool = False, stops: bool = False, max_alleles: int = 0, chimera: int | str = 0, degree: bool = False, min_cluster_size: int = 0, min_identical: int = 0) -> DataFrame:
    """Adds reasons (all failed tests) and kept. The plain tests are expressions; the
    number of alleles and chimeras of kept variants settle in rounds.
    ``variants`` has freq (percent of the raw amplicon depth) and, for min_cluster_size,
    cluster_size. degree: what comes after the sharpest fall of depth goes, in place of the
    plain tests. min_identical: identical columns with the top variant. stops: in the first
    frame without one that the deepest variant has, which has such a frame."""
    top = F.first("freq").over(by_depth(*AMPLICON))
    whole = by_depth(*AMPLICON).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.length("seq")
    known = F.array(*[F.lit(x) for x in lengths or []])
    tests = [F.when(F.col("depth") < min_depth, "depth"), F.when(F.col("freq") < min_percent, "frequency"), F.when(100 * F.col("freq") < min_dominant_percent * top, "dominant frequency")]
    if length_error is not None:
        tests.append(F.when(~F.exists(known, lambda x: F.abs(n - x) <= length_error), "length"))
    if frameshift:
        tests.append(F.when(~F.exists(known, lambda x: (n - x) % 3 == 0), "frameshift"))
    if min_cluster_size:
        tests.append(F.when(F.col("cluster_size") < min_cluster_size, "cluster size"))
    given = variants.columns
    if min_identical:
        variants = with_pair_errors(variants.withColumn("__top", F.first("seq").over(by_depth(*AMPLICON))), "seq", "__top")
        tests.append(F.when(F.col("e.ident") < min_identical, "identity"))
    if stops:
        variants = variants.withColumn("__frame", F.first(F.get(s.open_frames("seq"), F.lit(0)), True).over(whole))
        tests.append(F.when(s.has_stop_in("seq", "__frame"), "stop"))
    if degree:
        fall = degree_of_change(variants).groupBy(*AMPLICON).agg(F.max("n_alleles").alias("__alleles"))
        variants = variants.join(fall, list(AMPLICON), "left").withColumn("__nth", F.row_number().over(by_depth(*AMPLICON)))
        tests = [F.when(F.col("__nth") > F.coalesce("__alleles", F.lit(1)), "degree of change")]
    out = variants.withColumn("reasons", F.array_compact(F.array(*tests))).select(*given, "reasons")
    if max_alleles or chimera:
        out = _ordered_filters(out, max_alleles, chimera)
    return out.withColumn("kept", F.size("reasons") == 0)


def _ordered_filters(tested: DataFrame, max_alleles: int, chimera: int | str) -> DataFrame:
    """Adds the reasons that depend on what is kept before: chimeras of two kept
    variants, and the number of alleles. What is kept settles by depth, so rounds
    that start from the kept ones of the round before come to an end."""
    tested = stored(tested)
    fine = tested.where(F.size("reasons") == 0).select(*AMPLICON, "md5", "seq", "depth")

    def first(rows: DataFrame) -> DataFrame:
        return rows.withColumn("nth", F.row_number().over(by_depth(*AMPLICON))).where(F.col("nth") <= max_alleles).drop("nth") if max_alleles else rows

    key, kept = [*AMPLICON, "md5"], stored(first(fine))
    odd = tested.select(*key).limit(0)
    while chimera:
        odd = stored(chimeras(tested, chimera, parents=kept).select(*key))
        again = stored(first(fine.join(odd, key, "left_anti")))
        same = not again.select(*key).exceptAll(kept.select(*key)).head(1) and not kept.select(*key).exceptAll(again.select(*key)).head(1)
        kept = again
        if same:
            break
    more = [F.when(F.col("odd"), "chimera"), F.when((F.size("reasons") == 0) & F.col("odd").isNull() & F.col("in").isNull(), "allele number")]
    out = tested.join(odd.withColumn("odd", F.lit(True)), key, "left").join(kept.select(*key, F.lit(True).alias("in")), key, "left")
    return out.withColumn("reasons", F.concat("reasons", F.array_compact(F.array(*more)))).drop("odd", "in")


def genotype_threshold_zones(variants: DataFrame, low: float = 1, high: float = 5, errors: int = 1, chimera: int = 10) -> DataFrame:
    """Under ``low`` percent artefact, over ``high`` allele; between them an artefact if
    a chimera or within ``errors`` of a deeper variant. Adds verdict."""
    near = near_pairs(variants, errors).select(*AMPLICON, F.col("md5_2").alias("md5"), F.lit(True).alias("copy")).distinct()
    chim = chimeras(variants, chimera).select(*AMPLICON, "md5", F.lit(True).alias("chimera"))
    out = variants.join(near, [*AMPLICON, "md5"], "left").join(chim, [*AMPLICON, "md5"], "left")
    odd = F.coalesce("copy", F.lit(False)) | F.coalesce("chimera", F.lit(False))
    return out.withColumn("verdict", F.when(F.col("freq") < low, "artefact").when((F.col("freq") > high) | ~odd, "allele").otherwise("artefact"))


def genotype_folding(variants: DataFrame, errors: int = 3, percent: float = 2, max_alleles: int = 10) -> DataFrame:
    """Folds variants under ``percent`` of a parent and within ``errors`` onto it; the
    degree of change of folded depths tells alleles from artefacts."""
    known = stored(with_vid(variants))
    pairs = both_sides(near_candidates(known, errors), known).where(100 * F.col("depth_2") < percent * F.col("depth_1"))
    pairs = with_pair_errors(pairs, "seq_2", "seq_1").where(F.col("e.subs") + F.col("e.ins") + F.col("e.dels") <= errors)
    to = settled(pairs.select(F.col("vid_1").alias("u"), F.col("rank_1").alias("rank"), F.col("vid_2").alias("v"))).where("to is not null").withColumnRenamed("v", "vid")
    placed = stored(known.join(to, "vid", "left").select("vid", *AMPLICON, "md5", "depth", F.coalesce("to", "vid").alias("parent")))
    folded = placed.groupBy(F.col("parent").alias("vid")).agg(F.sum("depth").alias("folded"))
    parents = stored(placed.select("vid", *AMPLICON, "md5").join(folded, "vid").withColumnRenamed("folded", "depth"))
    nth = F.row_number().over(by_depth(*AMPLICON))
    top = parents.withColumn("nth", nth).where(F.col("nth") <= max_alleles + 1)
    # One parent has no change: it is the allele.
    falls = degree_of_change(parents, max_alleles).groupBy(*AMPLICON).agg(F.max("n_alleles").alias("n_alleles"))
    alleles = top.join(falls, list(AMPLICON), "left").where(F.col("nth") <= F.coalesce("n_alleles", F.lit(1))).select("vid", F.lit("allele").alias("verdict"))
    out = placed.join(folded, "vid", "left").join(alleles, "vid", "left")
    return out.select(*AMPLICON, "md5", "depth", F.coalesce("folded", F.lit(0)).cast("long").alias("folded"), F.coalesce("verdict", F.lit("artefact")).alias("verdict"))


def repaired_indels(variants: DataFrame, max_freq: float) -> DataFrame:
    """Variants below max_freq (percent, ``freq``) that are one inserted or deleted base
    away from a deeper variant of the amplicon give it their depth and freq; the
    deepest such variant takes them. Substitutions may be alleles and stay."""
    key = [*AMPLICON, "md5"]
    known = stored(with_vid(variants))
    pairs = near_pairs(variants, 1).where((F.col("subs") == 0) & (F.col("ins") + F.col("dels") == 1))
    to = pairs.groupBy(*AMPLICON, F.col("md5_2").alias("md5")).agg(F.min(F.struct((-F.col("depth_1")).alias("d"), F.col("md5_1").alias("to")))["to"].alias("to"))
    moved = variants.join(to, key, "left").withColumn("md5", F.when(F.col("freq") < max_freq, F.coalesce("to", "md5")).otherwise(F.col("md5")))
    sums = moved.groupBy(*key).agg(F.sum("depth").alias("depth"), F.sum("freq").alias("freq"))
    return sums.join(known.select(*key, "seq"), key)


def genotype_replicates(first: DataFrame, second: DataFrame, errors: int = 2, chimera: int = 10, top: int = 0) -> DataFrame:
    """Three steps over two runs: label variants (chimera, copy, distinct), ask for the
    replicate or another sample, then compare with the deepest artefact. top: only
    the deepest ``top`` of an amplicon."""
    top_rows = first.withColumn("nth", F.row_number().over(by_depth(*AMPLICON))).where(F.col("nth") <= top).drop("nth") if top else first
    near = near_pairs(top_rows, errors).select(*AMPLICON, F.col("md5_2").alias("md5"), F.lit("copy").alias("c")).distinct()
    chim = chimeras(top_rows, chimera).select(*AMPLICON, "md5", F.lit("chimera").alias("h"))
    key = [*AMPLICON, "md5"]
    twin = second.select(*key, F.lit(True).alias("twin")).distinct()
    other = first.groupBy("marker", "md5").agg(F.countDistinct("sample").alias("n"))
    labelled = top_rows.join(near, key, "left").join(chim, key, "left").join(twin, key, "left").join(other, ["marker", "md5"]).withColumn("label", F.coalesce("h", "c", F.lit("distinct")))
    found = F.coalesce("twin", F.lit(False)) | (F.col("n") > 1)
    step = F.when(~found, "artefact").when(F.col("label") == "distinct", "candidate").otherwise("doubtful")
    worst = F.max(F.when(F.col("step") == "artefact", F.col("freq"))).over(Window.partitionBy(*AMPLICON))
    verdict = F.when(F.col("step") == "artefact", "artefact").when((F.col("step") == "candidate") & (F.col("freq") > F.coalesce(worst, F.lit(0.0))), "allele").when(F.col("step") == "doubtful", "artefact").otherwise("unclassified")
    return labelled.withColumn("step", step).withColumn("verdict", verdict).select(*key, "depth", "freq", "label", "verdict")


def genotype_by_rank(variants: DataFrame, min_freq: float = 1, stop_mean: float = 1, repair_below: float = 0) -> DataFrame:
    """Variants of a marker by their highest frequency; the list ends before the first
    rank whose followers' mean is under stop_mean. repair_below: single indels of
    variants with less frequency are repaired first."""
    variants = stored(repaired_indels(variants, repair_below)) if repair_below else variants
    best = variants.where(F.col("freq") >= min_freq).groupBy("marker", "md5").agg(F.max("freq").alias("best"))
    down = Window.partitionBy("marker").orderBy(F.desc("best"), "md5")
    ranked = best.withColumns({"rank": F.row_number().over(down), "above": F.avg("best").over(down.rowsBetween(Window.unboundedPreceding, 0)), "below": F.avg("best").over(down.rowsBetween(1, Window.unboundedFollowing))})
    end = F.min(F.when(F.coalesce("below", F.lit(0.0)) < stop_mean, F.col("rank"))).over(Window.partitionBy("marker"))
    return ranked.withColumn("allele", F.col("rank") <= F.coalesce(end, F.col("rank")))


def check_verdicts(variants: DataFrame, pairs: DataFrame, chimera_rows: DataFrame, errors: int = 1, percent: float = 25) -> DataFrame:
    """Per variant of a marker: cells that are bad (chimera, or a copy of a deeper one
    under ``percent`` of its depth), suspicious (copy, deeper) or good, and the verdict."""
    copies = pairs.where(F.col("subs") + F.col("ins") + F.col("dels") <= errors).groupBy(*AMPLICON, F.col("md5_2").alias("md5")).agg(F.min(100 * F.col("depth_2") / F.col("depth_1")).alias("ratio"))
    cells = variants.join(copies, [*AMPLICON, "md5"], "left").join(chimera_rows.select(*AMPLICON, "md5", F.lit(True).alias("ch")), [*AMPLICON, "md5"], "left")
    state = F.when(F.col("ch") | (F.col("ratio") < percent), "bad").when(F.col("ratio").isNotNull(), "suspicious").otherwise("good")
    per = cells.withColumn("state", state).groupBy("marker", "md5").agg(*[F.count_if(F.col("state") == x).alias(x) for x in ("good", "suspicious", "bad")])
    verdict = F.when(F.col("good") > 5 * (F.col("bad") + F.col("suspicious")), "good").when(F.col("good") + F.col("suspicious") > F.col("bad"), "suspicious").otherwise("bad")
    return per.withColumn("verdict", verdict)

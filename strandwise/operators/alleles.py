"""Reference alleles: matching, naming, typing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import seq as s
from ..functions.align import with_pair_errors
from .folders import stored


def exact_matches(variants: DataFrame, alleles: DataFrame, least: int, both_strands: bool = False, word: int = 16) -> DataFrame:
    """md5, name where one sequence holds the other and the shorter has ``least``
    bases. Pairs come from an equi-join on the shorter one's first word in the longer."""
    refs = alleles.select("name", F.upper("seq").alias("ref"))
    if both_strands:
        refs = refs.unionByName(refs.withColumn("ref", s.reverse_complement("ref")))
    words = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - word + 1), lambda i: F.substr(c, i, F.lit(word))))
    first = lambda c: F.substring(c, 1, word)
    q = stored(variants.select("md5", F.upper("seq").alias("q")).distinct().where(F.length("q") >= max(word, least)))
    r = refs.where(F.length("ref") >= max(word, least))
    inside = q.withColumn("w", first("q")).join(r.withColumn("w", F.explode(words(F.col("ref")))), "w").where(F.contains("ref", "q"))
    outside = q.withColumn("w", F.explode(words(F.col("q")))).join(r.withColumn("w", first("ref")), "w").where(F.contains("q", "ref"))
    return inside.select("md5", "name").unionByName(outside.select("md5", "name")).distinct()


def _words(df: DataFrame, key: str, name: str, word: int) -> DataFrame:
    """(name, at, w): the words of each sequence."""
    long = df.select(F.col(key).alias(name), "seq").distinct().where(F.length("seq") >= word)
    return long.select(name, F.posexplode(F.transform(F.sequence(F.lit(1), F.length("seq") - word + 1), lambda i: F.substr("seq", i, F.lit(word)))).alias("at", "w"))


def word_hits(variants: DataFrame, references: DataFrame, word: int = 8) -> DataFrame:
    """query, subject, ident, aligned of the global alignments of all pairs that share a
    word. Sequences of n bases with k differing columns share one of n // (k + 1) bases."""
    pairs = _words(variants, "md5", "query", word).select("query", "w").distinct().join(_words(references, "name", "subject", word).select("subject", "w").distinct(), "w").select("query", "subject").distinct()
    whole = pairs.join(variants.select(F.col("md5").alias("query"), F.col("seq").alias("qs")).distinct(), "query").join(references.select(F.col("name").alias("subject"), F.col("seq").alias("ss")), "subject")
    return with_pair_errors(whole, "qs", "ss").select("query", "subject", "e.ident", "e.aligned")


def seed_hits(variants: DataFrame, references: DataFrame, word: int = 10) -> DataFrame:
    """query, subject, ident, aligned of ungapped matches on a shared diagonal. Pairs
    come from an equi-join on words and meet by diagonal; each is then scored whole."""
    q, r = _words(variants, "md5", "query", word), _words(references, "name", "subject", word)
    diagonals = q.withColumnRenamed("at", "qa").join(r, "w").select("query", "subject", (F.col("qa") - F.col("at")).alias("diagonal")).groupBy("query", "subject", "diagonal").agg(F.count("*").alias("seeds"))
    whole = diagonals.join(variants.select(F.col("md5").alias("query"), F.col("seq").alias("qs")).distinct(), "query").join(references.select(F.col("name").alias("subject"), F.col("seq").alias("ss")), "subject")
    a = F.substr("qs", F.greatest(F.col("diagonal"), F.lit(0)) + 1, F.length("qs"))
    b = F.substr("ss", F.greatest(-F.col("diagonal"), F.lit(0)) + 1, F.length("ss"))
    n = F.least(F.length(a), F.length(b))
    differ = s.hamming(F.substr(a, F.lit(1), n), F.substr(b, F.lit(1), n))
    return whole.select("query", "subject", (n - differ).alias("ident"), n.alias("aligned"))


def local_hits(variants: DataFrame, references: DataFrame, word: int = 10, penalty: int = 3, least: int | None = None, both_strands: bool = False) -> DataFrame:
    """query, subject, strand, q_start, s_start (from 1, on the forward subject), aligned,
    ident, score: on each diagonal that shares a word the ungapped segment of the highest
    score, 1 for a match and -penalty for a mismatch, of ``least`` (a word) or more. The
    running sum starts anew where it falls to zero, so a pair with an indel has a segment
    on either side of it, on two diagonals."""
    refs = references.select("name", F.upper("seq").alias("seq"), F.lit("+").alias("strand"))
    if both_strands:
        refs = refs.unionByName(references.select("name", s.reverse_complement(F.upper("seq")).alias("seq"), F.lit("-").alias("strand")))
    refs = refs.withColumn("subject", F.concat("strand", "name"))
    q, r = _words(variants, "md5", "query", word), _words(refs, "subject", "subject", word)
    diagonals = q.withColumnRenamed("at", "qa").join(r, "w").select("query", "subject", (F.col("qa") - F.col("at")).alias("diagonal")).distinct()
    whole = diagonals.join(variants.select(F.col("md5").alias("query"), F.col("seq").alias("qs")).distinct(), "query").join(refs.select("subject", "name", "strand", F.col("seq").alias("ss")), "subject")
    a0, b0 = F.greatest(F.col("diagonal"), F.lit(0)), F.greatest(-F.col("diagonal"), F.lit(0))
    n = F.least(F.length("qs") - a0, F.length("ss") - b0)
    same = F.zip_with(s.letters(F.substr("qs", a0 + 1, n)), s.letters(F.substr("ss", b0 + 1, n)), lambda x, y: x == y)
    number = lambda x: F.lit(x).cast("int")
    state = F.struct(*[number(0).alias(c) for c in ("at", "sum", "start", "best", "first", "last")])

    def step(t: Column, match: Column) -> Column:
        anew = t["sum"] <= 0
        start = F.when(anew, t["at"]).otherwise(t["start"])
        value = F.when(anew, 0).otherwise(t["sum"]) + F.when(match, 1).otherwise(-penalty)
        better = value > t["best"]
        pick = lambda new, old: F.when(better, new).otherwise(t[old])
        fields = {"at": t["at"] + 1, "sum": value, "start": start, "best": pick(value, "best"), "first": pick(start, "first"), "last": pick(t["at"] + 1, "last")}
        return F.struct(*[v.cast("int").alias(k) for k, v in fields.items()])

    scored = whole.withColumn("t", F.aggregate(same, state, step)).where(F.col("t.best") >= (word if least is None else least))
    aligned = F.col("t.last") - F.col("t.first")
    ident = (F.col("t.best") + penalty * aligned) / (1 + penalty)
    forward = b0 + F.col("t.first") + 1
    s_start = F.when(F.col("strand") == "+", forward).otherwise(F.length("ss") - (forward + aligned - 1) + 1)
    return scored.select("query", F.col("name").alias("subject"), "strand", (a0 + F.col("t.first") + 1).cast("int").alias("q_start"), s_start.cast("int").alias("s_start"), aligned.alias("aligned"), ident.cast("int").alias("ident"), F.col("t.best").alias("score"))


def best_names(hits: DataFrame, lengths: DataFrame, min_aligned: float = 0.9, min_ident: float = 0.9) -> DataFrame:
    """query and the joined names of its subjects with most identical bases. Hits of
    a pair add up; lengths: (id, len) of queries and subjects."""
    per = hits.groupBy("query", "subject").agg(F.sum("ident").alias("ident"), F.sum("aligned").alias("aligned"))
    per = per.join(lengths.select(F.col("id").alias("query"), F.col("len").alias("q_len")), "query").join(lengths.select(F.col("id").alias("subject"), F.col("len").alias("s_len")), "subject")
    fit = per.where((F.col("aligned") >= min_aligned * F.least("q_len", "s_len")) & (F.col("ident") >= min_ident * F.col("aligned")))
    top = fit.withColumn("r", F.rank().over(Window.partitionBy("query").orderBy(F.desc("ident")))).where("r = 1")
    return top.groupBy("query").agg(F.array_join(F.array_sort(F.collect_set("subject")), " | ").alias("name"), F.max("ident").alias("ident"))


def name_segments(clones: DataFrame, references: DataFrame, min_ident: float = 0.9) -> DataFrame:
    """Most frequent segment read of each clonotype named by its best references;
    names are cut at ``*`` and distinct ones joined by commas."""
    mode = clones.groupBy("clone").agg(F.mode("segment", True).alias("seq")).withColumn("md5", s.sequence_key("seq"))
    lengths = mode.select(F.col("md5").alias("id"), F.length("seq").alias("len")).distinct().unionByName(references.select(F.col("name").alias("id"), F.length("seq").alias("len")))
    names = best_names(seed_hits(mode, references), lengths, 0.5, min_ident)
    cut = F.array_join(F.array_distinct(F.transform(F.split("name", r" \| "), lambda x: F.regexp_extract(x, r"^([^*]*)", 1))), ",")
    return mode.join(names.withColumnRenamed("query", "md5"), "md5", "left").select("clone", cut.alias("segment"))


def locus_of_markers(named: DataFrame) -> DataFrame:
    """Locus that most allele names of a marker's top variants carry: (marker, name list joined by " | ")."""
    loci = named.select("marker", F.explode(F.split("name", r" \| ")).alias("a")).select("marker", F.regexp_extract("a", r"^([^*-]*)", 1).alias("locus"))
    return loci.groupBy("marker", "locus").agg(F.count("*").alias("n")).groupBy("marker").agg(F.max_by("locus", F.struct("n", "locus")).alias("locus"))


def allele_groups(names: list[str]) -> list[str]:
    """Longest common leading fields of names like A*02:01:01, by first field."""
    groups: dict[str, list[list[str]]] = {}
    for name in sorted(names):
        groups.setdefault(name.split(":")[0], []).append(name.split(":"))
    out = []
    for fields in groups.values():
        same = 0
        while all(len(f) > same for f in fields) and len({f[same] for f in fields}) == 1:
            same += 1
        out.append(":".join(fields[0][:same]))
    return out


def allele_groups_between(names: list[str], others: list[str]) -> dict[str, list[str]]:
    """Each of ``names`` with those of ``others`` that share leading fields with it, under
    the fields that all share; one of ``others`` goes with the first name that takes it."""
    left, out = [x.split(":") for x in others], {}

    def shared(a: list[str], b: list[str]) -> int:
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    for fields in (x.split(":") for x in names):
        taken = [x for x in left if x != fields and shared(x, fields)]
        left = [x for x in left if x not in taken]
        common = ":".join(fields[: min((shared(x, fields) for x in taken), default=len(fields))])
        out.setdefault(common, []).extend(":".join(x) for x in [fields, *taken])
    return out


def group_allele_names_between(rows: DataFrame, column: str, other: str) -> DataFrame:
    """Adds groups (name, members) of two columns of allele names."""

    @F.pandas_udf("array<struct<name: string, members: array<string>>>")
    def grouped(names: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([[{"name": k, "members": v} for k, v in allele_groups_between(list(a), list(b)).items()] for a, b in zip(names, others, strict=True)])

    return rows.withColumn("groups", grouped(column, other))


def group_allele_names(rows: DataFrame, column: str = "names") -> DataFrame:
    @F.pandas_udf("array<string>")
    def grouped(names: pd.Series) -> pd.Series:
        return names.map(lambda x: allele_groups(list(x)))

    return rows.withColumn("groups", grouped(column))


def alleles_over_exons(candidates: DataFrame) -> DataFrame:
    """(locus, sample, marker, md5, freq, alleles): allele sets of one variant per marker
    intersected over the markers, the most frequent variants first; used ones go."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["freq", "md5"], ascending=[False, True])
        left = {m: list(g.itertuples(index=False)) for m, g in rows.groupby("marker")}
        out = []
        while all(left.values()):
            first = min(left, key=lambda m: (-left[m][0].freq, m))
            head = left[first].pop(0)
            common, freqs = set(head.alleles), [head.freq]
            for m in sorted(left):
                if m == first:
                    continue
                pick = max(left[m], key=lambda r: (len(common & set(r.alleles)) > 0, r.freq))
                if common & set(pick.alleles):
                    common &= set(pick.alleles)
                    freqs.append(pick.freq)
                    left[m].remove(pick)
            out.append((head.locus, head.sample, " | ".join(sorted(common)), sum(freqs) / len(freqs), len(freqs)))
        return pd.DataFrame(out, columns=["locus", "sample", "alleles", "freq", "markers"])

    return candidates.groupBy("locus", "sample").applyInPandas(run, "locus string, sample string, alleles string, freq double, markers int")


def allele_sets(reads: DataFrame) -> DataFrame:
    """(locus, allele, read) to (locus, alleles, reads): each set of alleles that reads
    support, and how many do. A read is shuffled once; all counts of alleles over reads,
    and which alleles the same reads support, follow from these sets alone."""
    per = reads.repartition("locus", "read").groupBy("locus", "read").agg(F.array_sort(F.collect_set("allele")).alias("alleles"))
    return stored(per.groupBy("locus", "alleles").agg(F.count("*").alias("reads")))


def _corrected(sets: DataFrame) -> DataFrame:
    """locus, allele, reads, corrected of sets of alleles."""
    rows = sets.withColumn("allele", F.explode("alleles"))
    counts = rows.groupBy("locus", "allele").agg(F.sum("reads").alias("reads"))
    better = F.struct((-F.col("total")).alias("r"), "allele")
    first = rows.join(counts.withColumnRenamed("reads", "total"), ["locus", "allele"]).groupBy("locus", "alleles").agg(F.min(better)["allele"].alias("allele"), F.first("reads").alias("reads"))
    own = first.groupBy("locus", "allele").agg(F.sum("reads").alias("corrected"))
    return counts.join(own, ["locus", "allele"])


def corrected_coverage(reads: DataFrame, most: int = 2, ratio: float = 5) -> DataFrame:
    """(locus, allele, read): alleles by reads, reads of better alleles taken off; an
    allele stays while the one before has under ``ratio`` times its reads, ``most`` at most.
    A read counts for the best allele that has it; of a locus only its alleles meet."""

    def keep(rows: pd.DataFrame) -> pd.DataFrame:
        rows, kept, before = rows.sort_values(["reads", "allele"], ascending=[False, True]), [], None
        for n in rows["corrected"]:
            kept.append(sum(kept) < most and (before is None or before < ratio * n))
            before = n
        return rows.assign(kept=kept)

    return _corrected(allele_sets(reads)).groupBy("locus").applyInPandas(keep, "locus string, allele string, reads long, corrected long, kept boolean")


def equal_alleles(reads: DataFrame) -> DataFrame:
    """(locus, allele, read) to (locus, allele, entry): alleles of a locus that the same
    reads support get one entry, the names joined."""
    return _equal(allele_sets(reads))


def _equal(sets: DataFrame) -> DataFrame:
    """Alleles that are in the same sets meet by the number and a sum of hashes of these,
    which needs no order and no list; an anti-join of the sets with those of the first
    allele confirms each."""
    rows = sets.select("locus", F.explode("alleles").alias("allele"), "alleles")
    hashed = F.xxhash64("alleles").cast("decimal(38,0)")
    keys = rows.groupBy("locus", "allele").agg(F.count("*").alias("n"), F.sum(hashed).alias("sum"), F.bit_xor(F.xxhash64("alleles", F.lit(1))).alias("xor"))
    lead = keys.withColumn("lead", F.min("allele").over(Window.partitionBy("locus", "n", "sum", "xor"))).select("locus", "allele", "lead")
    others = rows.join(lead.where("allele <> lead"), ["locus", "allele"])
    of_lead = rows.select("locus", F.col("allele").alias("lead"), "alleles")
    wrong = others.join(of_lead, ["locus", "lead", "alleles"], "left_anti").select("locus", "allele", F.lit(True).alias("wrong")).distinct()
    checked = lead.join(wrong, ["locus", "allele"], "left").withColumn("lead", F.when(F.col("wrong"), F.col("allele")).otherwise(F.col("lead")))
    names = checked.groupBy("locus", "lead").agg(F.array_join(F.array_sort(F.collect_set("allele")), " | ").alias("entry"))
    return checked.join(names, ["locus", "lead"]).select("locus", "allele", "entry")


def allele_numbers(reads: DataFrame, ratio: float = 5, most: int = 2) -> DataFrame:
    """locus, allele (entries of ``equal_alleles``), reads, corrected, kept: one allele
    where the best has more than ``ratio`` times the corrected reads of the next, else
    as many as the degree of change of the first most + 1 says."""
    sets = allele_sets(reads)
    named = sets.withColumn("allele", F.explode("alleles")).join(_equal(sets), ["locus", "allele"])
    entries = named.groupBy("locus", "alleles", "reads").agg(F.array_sort(F.collect_set("entry")).alias("entries"))
    corrected = _corrected(entries.groupBy("locus", F.col("entries").alias("alleles")).agg(F.sum("reads").alias("reads")))
    order = Window.partitionBy("locus").orderBy(F.desc("corrected"), "allele")
    ranked = corrected.withColumns({"nth": F.row_number().over(order), "next": F.lead("corrected").over(order), "first": F.first("corrected").over(order)})
    top = ranked.where(F.col("nth") <= most + 1)
    ratios = top.where("next is not null").where(F.col("nth") <= most).groupBy("locus").agg(F.max(F.struct((F.col("corrected") / F.col("next")).alias("ratio"), "nth"))["nth"].alias("degree"), F.max(F.when(F.col("nth") == 1, F.col("corrected") > ratio * F.col("next"))).alias("one"))
    number = F.when(F.coalesce("one", F.lit(True)), 1).otherwise(F.col("degree"))
    return ranked.join(ratios, "locus", "left").select("locus", "allele", "reads", "corrected", (F.col("nth") <= number).alias("kept"))


def frequent_alleles(found: DataFrame, frequent: DataFrame) -> DataFrame:
    """Alleles of a (locus, allele) list; of entries with one name the best covered."""
    listed = found.join(frequent.select("locus", "allele").distinct(), ["locus", "allele"], "left_semi")
    best = Window.partitionBy("locus", "allele").orderBy(F.desc("coverage"), "entry")
    return listed.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")

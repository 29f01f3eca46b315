"""Steps that large tables need: what is computed, how often, and that results stay."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise import plans
from strandwise.functions import search
from strandwise.functions import seq as s
from strandwise.operators import alleles, reads, repertoire


def test_allele_sets_need_reads_once(spark):
    """Counts by set of alleles, whatever the number of reads; all else follows from them."""
    rows = [("L", a, f"r{i}") for i in range(40) for a in (("A1", "A2") if i < 30 else ("A3",))]
    df = spark.createDataFrame(rows + rows[:5], "locus string, allele string, read string")
    passes = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            passes.add(len(b))
            yield b

    seen = df.mapInPandas(counted, df.schema)
    assert sorted((x.alleles, x.reads) for x in alleles.allele_sets(seen).collect()) == [(["A1", "A2"], 30), (["A3"], 10)]
    passes.value = 0
    assert sorted((x.allele, x.reads, x.corrected, x.kept) for x in alleles.allele_numbers(seen).collect()) == [("A1 | A2", 30, 30, True), ("A3", 10, 10, False)]
    assert passes.value == len(rows) + 5


def _times(frame, call: str) -> int:
    return frame._jdf.queryExecution().analyzed().toString().count(call)


def test_inputs_of_sequence_functions_are_computed_once(spark):
    x = spark.createDataFrame([("ACGTTGNATG",)], "x string")
    text = F.reverse("x")
    for column in (s.translate_dna(text), s.mean_phred(text), s.print_taxonomy(s.read_taxonomy(text))):
        assert _times(x.select(column.alias("y")), "reverse(x") == 1
    given = spark.createDataFrame([("r", "ATGGCTTGTTGGAAATTT")], "read_id string, seq string")
    cut = repertoire.segment_reads(given, {"V": "..", "CDR3": "[A-Z]{2,}", "J": "[A-Z]$"})
    assert _times(cut, "reverse(translate(seq") == 1 and cut.first()["status"] == "valid"


def test_quality_texts(spark):
    x = spark.createDataFrame([("5:?DI",), ("",), (None,), ("Ié",)], "q string")
    got = x.select(s.mean_phred("q").alias("m"), s.phred_values("q").alias("v"), s.phred_text(s.phred_values("q"), "illumina_old").alias("t")).collect()
    assert [r.m for r in got] == [sum(map(ord, "5:?DI")) / 5 - 33, None, None, (73 + 233) / 2 - 33]
    assert [r.v for r in got] == [[20, 25, 30, 35, 40], [], None, [40, 200]]
    assert [r.t for r in got] == ["TY^ch", "", None, "h\x08"]


def _counted(spark, df):
    """``df``, and an accumulator of the rows that are computed of it."""
    passes = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            passes.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema), passes


def test_hits_and_variants_are_computed_once(spark):
    rows = [("r", "S", "M", "F", "+", 1, 3), ("r", "S", "M", "F", "+", 2, 4), ("r", "S", "M", "R", "+", 7, 9), ("r", "S", "M", "R", "-", 6, 8)]
    hits, passes = _counted(spark, spark.createDataFrame(rows, "read_id string, sample string, marker string, side string, strand string, start int, stop int"))
    read = spark.createDataFrame([("r", "ACGTACGTA")], "read_id string, seq string")
    assert [x.seq for x in reads.inserts_from_hits(hits, read).collect()] == ["TAC"] and passes.value == 4
    variants, passes = _counted(spark, spark.createDataFrame([("v", "ACGTTGCAACGGATCAGTCA")], "md5 string, seq string"))
    alleles_ = spark.createDataFrame([("a", "ACGTTGCAACGGATCAGTCAT")], "name string, seq string")
    assert [x.name for x in alleles.exact_matches(variants, alleles_, 16).collect()] == ["a"] and passes.value == 1


def test_first_places_of_all_patterns_at_once():
    text = np.frombuffer(b"ACGTTGCAACNGGATCAGTCAACGTTGCAAC", np.uint8).reshape(1, -1)
    patterns = [search.pattern_masks(p) for p in ("ACGTTGCAAC", "GGATCARTCA", "ACG", *["TTGCAAC"] * 9)]
    found = search.first_places(search.word_codes(text), patterns)
    assert found[2] is None
    for p, f in zip(patterns, found, strict=True):
        assert [x.tolist() for x in search.places(text, p, first=f)] == [x.tolist() for x in search.places(text, p)]


@pytest.mark.parametrize("name", ["j18_join_mates", "j19_merge_mates"])
def test_both_mates_come_from_one_pass(spark, name):
    found = plans.QUERIES[name](spark, "/root/testdata/sf0.001")
    rows = found.collect()
    assert len(rows) > 5000 and "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def _merged(a, qa, b, qb, shortest, longest, most):
    """Mates (the second turned to the first's strand) as one read, overlap by overlap."""
    best = None
    for n in range(min(longest, len(a), len(b)), shortest - 1, -1):
        share = sum(x != y for x, y in zip(a[-n:], b[:n], strict=True)) / n
        if share <= most and (best is None or share < best[0]):
            best = share, n
    if best:
        n = best[1]
        pairs = list(zip(a[-n:], qa[-n:], b[:n], qb[:n], strict=True))
        return a[:-n] + "".join(x if p >= q else y for x, p, y, q in pairs) + b[n:], qa[:-n] + "".join(max(p, q) for _, p, _, q in pairs) + qb[n:], n


def test_merged_mates_equal_a_plain_search(spark):
    r, turn = random.Random(3), str.maketrans("ACGTRYacgtryN", "TGCAYRtgcayrN")
    left, right, want = [], [], {most: [] for most in (0, 0.25)}
    for i in range(300):
        whole = "".join(r.choice("ACGTacgtRYN" if i % 3 else "ACé") for _ in range(r.randint(20, 40)))
        a, b = whole[: r.randint(10, 20)], list(whole[-r.randint(10, 22) :])
        for _ in range(r.randint(0, 2)):
            b[r.randrange(len(b))] = r.choice("ACGT")
        b = "".join(b)
        qa, qb = ("".join(r.choice("5?DI") for _ in x) for x in (a, b))
        left.append((f"r{i}", a, qa))
        right.append((f"r{i}", b[::-1].translate(turn), qb[::-1]))
        for most, rows in want.items():
            if got := _merged(a, qa, b, qb, 3, 15, most):
                rows.append((f"r{i}", *got))
    left += [("none", None, None), ("one", "ACGT", "IIII"), ("empty", "", "")]
    right += [("none", "ACGT", "IIII"), ("one", None, None), ("empty", "", "")]
    one, other = (spark.createDataFrame(x, "read_id string, seq string, qual string") for x in (left, right))
    for most, rows in want.items():
        assert len(rows) > 50
        assert sorted(tuple(x) for x in reads.merge_mates(one, other, 3, 15, most).collect()) == sorted(rows)
    with pytest.raises(Exception, match="differ in length"):
        reads.merge_mates(one.withColumn("qual", F.lit("I")), other).collect()

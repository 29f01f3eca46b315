"""Planted-truth cases of the sequence operators."""

import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandwise.functions import align
from strandwise.functions import seq as s
from strandwise.operators import alleles, chimeras, clustering, compare, mutations, reads, repertoire, taxonomy, variants
from strandwise.sources import readers, writers

A = "ACGTTGCAACGGATCCTTAGCATGCATTGGCCAATTCGCGATATCGGATCA"
B = "TTGACCATGGCATACGATTACAGGCCTTAAGCGCTATGGCTAACCGTTAGC"


def error(seq, at):
    return seq[:at] + {"A": "C", "C": "A", "G": "T", "T": "G"}[seq[at]] + seq[at + 1 :]


def amplicon(spark, rows):
    df = spark.createDataFrame([("M", "S", q, n) for q, n in rows], "marker string, sample string, seq string, depth long")
    return df.withColumn("md5", F.md5("seq"))


def test_clustering_returns_the_alleles(spark):
    rows = [(A, 500), (B, 400)] + [(error(x, k), 5) for x in (A, B) for k in (7, 20, 33)]
    for members in (clustering.cluster_guided(amplicon(spark, rows), 2, 2), clustering.cluster_denovo(amplicon(spark, rows))):
        got = {r.seq: r.depth for r in clustering.cluster_depths(members).collect()}
        assert got == {A: 515, B: 415}
        assert members.agg(F.sum("depth")).first()[0] == sum(n for _, n in rows)


def test_a_strong_copy_stays_apart_and_a_tie_is_not_counted(spark):
    twin = error(error(A, 10), 12)
    between = error(A, 10)
    members = clustering.cluster_guided(amplicon(spark, [(A, 500), (twin, 400), (between, 20)]), 4, 4).collect()
    assert {r.seq for r in members if r.role == "head"} == {A, twin}
    assert [r.counted for r in members if r.seq == between] == [False]


def test_chimera_names_both_parents(spark):
    rows = chimeras.chimeras(amplicon(spark, [(A, 500), (B, 400), (A[:25] + B[25:], 20), (error(A, 5), 9)])).collect()
    import hashlib

    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert [(r.md5, r.left_parent, r.right_parent) for r in rows] == [(md5(A[:25] + B[25:]), md5(A), md5(B))]


def test_degree_of_change_of_two_alleles(spark):
    rows = [(A, 100), (B, 90), (error(A, 3), 5), (error(B, 3), 4)]
    assert {r.n_alleles for r in variants.degree_of_change(amplicon(spark, rows)).collect()} == {2}


def test_umi_consensus(spark):
    rows = [("S", "M", "ACGT", "AAAAACCCCC")] * 3 + [("S", "M", "ACGT", "AAAAACCCCG"), ("S", "M", "GGGG", "AAAAACCCCC"), ("S", "M", "GGGG", "TTTTTCCCCC"), ("S", "M", "NNNN", "AAAAA")]
    got = {r.umi: (r.reads, r.clustered, r.correct) for r in repertoire.umi_consensus(spark.createDataFrame(rows, "sample string, marker string, umi string, cdr3 string"), 1).collect()}
    assert got == {"ACGT": (4, 4, True), "GGGG": (2, 1, False)}


def test_consensus_taxonomy_stops_at_the_family(spark):
    rows = [("O", "k:B,p:P,c:C,o:O,f:F,g:G1,s:G1 x"), ("O", "k:B,p:P,c:C,o:O,f:F,g:G2,s:G2 y")]
    r = taxonomy.consensus(spark.createDataFrame(rows, "otu string, taxonomy string")).first().taxonomy
    assert (r.family, r.genus, r.species) == ("F", None, None)


def test_adjacent_deletions_are_one_event(spark):
    df = spark.createDataFrame([("r", p, b) for p, b in ((5, "A"), (6, "C"), (7, "G"), (9, "T"))], "ref string, pos int, base string")
    assert sorted((r["first"], r["length"], r.bases) for r in mutations.merge_adjacent(df, ["ref"]).collect()) == [(5, 3, "ACG"), (9, 1, "T")]


def test_demultiplexing_inverts_tagging(spark):
    samples = [("S1", "AACCGG", None), ("S2", "TTGGCC", None)]
    markers = [("M1", "ACGTRCAAC", "CTAAGGATCC")]
    rows = [(f"r{i}", samples[i % 2][0], "M1", A[i : i + 30], "I" * 30) for i in range(10)]
    tagged = reads.add_tags(spark.createDataFrame(rows, "read_id string, sample string, marker string, seq string, qual string"), spark.createDataFrame(samples, "sample string, tag_f string, tag_rc string"), spark.createDataFrame([("M1", "ACGTGCAAC", "CTAAGGATCC")], "marker string, primer_f string, primer_rc string"))
    turned = tagged.withColumn("seq", F.when(F.substring("read_id", 2, 1).cast("int") % 3 == 0, s.reverse_complement("seq")).otherwise(F.col("seq")))
    patterns = reads.amplicon_patterns([{"marker": m, "primer_f": [f], "primer_rc": [r]} for m, f, r in markers], [{"sample": n, "tag_f": t} for n, t, _ in samples])
    got = {(r.read_id, r["sample"], r.seq) for r in reads.demultiplex(turned, patterns).collect()}
    assert got == {(i, smp, q) for i, smp, _, q, _ in rows}


def test_primer_places_equal_a_plain_search(spark):
    """Ambiguous primers, both strands, all places within a tenth and within a third."""
    import random

    r = random.Random(7)
    primers = [("p", "ACGTRCAANC"), ("q", "TTGGC"), ("s", "GATTACAGATTACAGATTACN")]
    flip = str.maketrans(s.IUPAC, s.COMPLEMENT)
    texts = ["".join(r.choice("ACGTacgtN" if i % 5 == 0 else "ACGT") for _ in range(r.choice([0, 4, 30, 31, 90]))) for i in range(120)] + ["GATTACAGATTACAGATTACG" * 2, "ACGTACAATCACGTGCAACC", None]
    for k in range(20):
        texts.append(texts[k] + "GATTACAGATTTCAGATTACA"[: 21 - k % 3])
    df = spark.createDataFrame(list(enumerate(texts)), "read_id int, seq string").repartition(3)
    for percent in (10, 34):
        want = Counter()
        for i, text in enumerate(texts):
            for name, primer in primers:
                for strand, p in (("+", primer), ("-", primer[::-1].translate(flip))):
                    for at in range(len(text or "") - len(p) + 1):
                        wrong = sum(x not in s.AMBIGUOUS[y] for x, y in zip(text.upper()[at : at + len(p)], p))
                        if wrong <= int(percent * len(p) / 100):
                            want[i, name, strand, at + 1, at + len(p), wrong] += 1
        assert Counter(tuple(x) for x in reads.primer_hits(df, primers, percent).collect()) == want


def test_both_mates_must_match(spark):
    patterns = reads.amplicon_patterns([{"marker": "M", "primer_f": ["ACGT"], "primer_rc": ["GGCC"]}], [{"sample": "S", "tag_f": "AAC"}])
    good, bad = "AACACGTTTTGGCC", "AACACGTTTTGGC"
    left = spark.createDataFrame([(1, good), (2, good), (3, bad), (4, None)], "read_id int, seq string")
    right = spark.createDataFrame([(1, good[::-1].translate(str.maketrans("ACGT", "TGCA"))), (2, bad), (3, good), (4, good)], "read_id int, seq string")
    assert [[x.read_id for x in df.collect()] for df in reads.pairs_of_amplicons(left, right, patterns)] == [[1], [1]]


def test_pairs_with_unequal_counts_are_told(spark):
    files = readers.paired_files(spark, ["a_R1.fastq", "a_R2.fastq", "b_R1.fastq", "b_R2.fastq", "c_1.fq.gz", "d_R1.fastq", "d_R2.fastq"])
    counts = spark.createDataFrame([("a_R1.fastq", 5), ("a_R2.fastq", 5), ("b_R1.fastq", 5), ("b_R2.fastq", 4), ("c_1.fq.gz", 3), ("d_R1.fastq", 2)], "path string, reads long")
    assert sorted(tuple(x) for x in readers.unequal_pairs(files, counts).collect()) == [("b", 5, 4), ("c", 3, None), ("d", 2, None)]


def test_more_clashing_tags_than_new_ones(spark):
    runs = spark.createDataFrame([("A", "S1", "AAC"), ("B", "S2", "AAC"), ("C", "S3", "AAC")], "run string, sample string, tag_f string")
    assert sorted((r["sample"], r.new_tag) for r in reads.retag_clashes(runs, ["X", "Y"]).collect()) == [("S1", None), ("S2", "X"), ("S3", "Y")]
    with pytest.raises(Exception, match="tags clash"):
        reads.retag_clashes(runs, ["X"]).collect()


def test_alignment_and_its_errors():
    a, b = align.global_alignment(A[:20] + A[23:], A)
    assert a.replace("-", "") == A[:20] + A[23:] and b == A and a.count("-") == 3
    assert align.compare_pair(error(A, 9), A)[2:] == (1, 0, 0, 0)
    assert align.errors_of("AC-AAAT", "ACAAAAT") == ([], [], [3], [3])


def test_reverse_complement_is_an_involution(spark):
    df = spark.createDataFrame([("ACGTMRWSYKVHDBN",), ("acgtN",), ("",)], "seq string")
    assert df.where(s.reverse_complement(s.reverse_complement("seq")) != F.col("seq")).count() == 0
    assert [r.x for r in spark.createDataFrame([("RN",)], "seq string").select(F.size(s.plain_sequences("seq")).alias("x")).collect()] == [8]


def test_quality_lines_may_start_with_at(spark, tmp_path):
    (tmp_path / "x.fastq").write_text("@r1 a\nACGT\n+\n@@II\n@r2 b\nGGTT\n+\nII@@\n@r3\nAC\n+r3\n@I\n")
    got = sorted((r.read_id, r.header, r.seq, r.qual) for r in readers.read_fastq(spark, str(tmp_path / "x.fastq")).collect())
    assert got == [("r1", "r1 a", "ACGT", "@@II"), ("r2", "r2 b", "GGTT", "II@@"), ("r3", "r3", "AC", "@I")]


def test_sheet_round_trip(spark, tmp_path):
    text = ">marker,length,primer_f,primer_r,gene\nM1,60-62 70,ACGT RRTT,GGCC,g\n>sample,tag_f,tag_r\nS1,AAC,GGT\n>param,marker,value\nmin,,5\nmin,M1,7\n>allele,sequence\nA1,ACGT\n"
    (tmp_path / "sheet.csv").write_text(text)
    sheet = readers.read_sheet(spark, str(tmp_path / "sheet.csv"))
    m = sheet["markers"].first()
    assert (m.primer_f, m.primer_rc, m.lengths, m.attrs) == (["ACGT", "RRTT"], ["GGCC"], [60, 61, 62, 70], {"gene": "g"})
    writers.write_sheet(sheet["markers"], sheet["samples"], sheet["params"], sheet["alleles"], str(tmp_path / "out"))
    again = readers.read_sheet(spark, str(tmp_path / "out"))
    assert again["markers"].select("marker", "lengths").collect() == sheet["markers"].select("marker", "lengths").collect()
    assert sorted(map(tuple, again["samples"].select("sample", "tag_f", "tag_r").collect())) == [("S1", "AAC", "GGT")]
    with pytest.raises(ValueError):
        readers.parse_sheet(">sample,tag_f\nS1,A\nS1,C\n")


def test_results_do_not_depend_on_partitions(spark):
    rows = [(A, 50), (B, 40), (error(A, 3), 5), (error(B, 3), 5)]
    df = amplicon(spark, rows)
    one, many = (sorted(map(tuple, clustering.cluster_denovo(d).collect())) for d in (df.coalesce(1), df.repartition(5)))
    assert one == many


def test_overlap_matrix_counts_each_pair_once(spark):
    rows = [("M", smp, q) for smp, qs in (("a", "xyz"), ("b", "xy"), ("c", "x")) for q in qs]
    got = {(r.a, r.b): r.shared for r in repertoire.overlap_matrix(spark.createDataFrame(rows, "marker string, sample string, cdr3 string")).collect()}
    assert got == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}


def test_compare_states(spark):
    a, b = amplicon(spark, [(A, 5), (B, 4)]), amplicon(spark, [(B, 9), (error(A, 1), 2)])
    assert sorted(r.state for r in compare.compare(a, b).collect()) == ["common", "only_1", "only_2"]


def test_error_totals_count_reads_of_all_lengths(spark):
    from strandwise.plans import genotypes
    from strandwise.plans.fixtures import view

    d = "/root/testdata/sf0.001"
    got = genotypes.g28(spark, d).first()
    assert got.reads == view(spark, d, "inserts").count() and got.dels > 0


def test_fastq_records_that_splits_cut(spark, tmp_path):
    """Splits of a few bytes, which end in headers, bases and qualities that start with @."""
    rows = [(f"r{i}", f"r{i} x{i}", "ACGT" * (1 + i % 4), ("@@II" if i % 3 == 0 else "@III" if i % 3 == 1 else "II@I") * (1 + i % 4)) for i in range(60)]
    (tmp_path / "x.fastq").write_text("".join(f"@{h}\n{seq}\n+\n{qual}\n" for _, h, seq, qual in rows))
    (tmp_path / "y.fastq").write_text("@one\nA\n+\n@\n@two\nC\n+\nI")
    keys = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    try:
        for size in (7, 16, 33, 64, 1000):
            for k, v in keys.items():
                spark.conf.set(k, v or str(size))
            got = sorted((r.read_id, r.header, r.seq, r.qual) for r in readers.read_fastq(spark, str(tmp_path / "x.fastq")).collect())
            assert got == sorted(rows), size
            got = sorted((r.read_id, r.seq, r.qual) for r in readers.read_fastq(spark, str(tmp_path / "y.fastq")).collect())
            assert got == [("one", "A", "@"), ("two", "C", "I")]
    finally:
        for k in keys:
            spark.conf.unset(k)
    (tmp_path / "z.fastq").write_text("@one\nA\n+\n")
    with pytest.raises(Exception, match="cut short"):
        readers.read_fastq(spark, str(tmp_path / "z.fastq")).collect()


def test_a_sheet_with_ambiguous_tags_and_several_primers(spark):
    """Reads that match several amplicons, none, or only on the other strand."""
    markers = [{"marker": "M1", "primer_f": ["ACGTR", "ACGTA"], "primer_rc": ["GGCC"]}, {"marker": "M2", "primer_f": ["TTTTC"], "primer_rc": ["GGCC", "CCGG"]}]
    samples = [{"sample": "S1", "tag_f": "AAN"}, {"sample": "S2", "tag_f": "CCC", "tag_rc": "TT"}, {"sample": "S3"}]
    patterns = reads.amplicon_patterns(markers, samples)
    texts = ["AAGACGTATTTGGCC", "ggccaaatacgtctt", "CCCTTTTCAAGGCCTT", "CCCTTTTCAAGGCC", "GGGG", None, "AATACGTGCAGGCCAAGTTTTCGACCGG", "AAGACGTAGGCC"]
    got = sorted((r.read_id, r["sample"], r.marker, r.seq) for r in reads.demultiplex(spark.createDataFrame(list(enumerate(texts)), "read_id int, seq string"), patterns).collect())
    want = []
    flip = str.maketrans("ACGT", "TGCA")
    for i, text in enumerate(texts):
        seen = set()
        for strand in ((text or "").upper(), (text or "").upper()[::-1].translate(flip)):
            for sample, marker, tag, primer, reverse, end in patterns:
                if (hit := re.search(f"{tag}{s.iupac_pattern(primer)}(.+){s.iupac_pattern(reverse + end)}", strand)) and (sample, marker) not in seen:
                    seen.add((sample, marker))
                    want.append((i, sample, marker, hit[1]))
    assert got == sorted(want) and len({g[0] for g in got}) == 5


def test_pile_up_of_hard_cigars(spark):
    """Insertions, deletions, clips and gaps at the edges, against a walk base by base."""
    ref = "ACGTACGGGTACCATGCATTTGCA"
    rows = [("a", 3, "4M2I5M", "GTACTTGGGTA"), ("a", 3, "4M2I5M", "GTACTAGGGTA"), ("a", 1, "5M1D4M", "ACGTAGGGT"), ("a", 11, "2S3M1I2M1D4M", "NNACCGATCATT"), ("a", 3, "4M2I5M", "GTACTTGGGTA"), ("a", 12, "2I4M", "GGCCAT"), ("a", 1, "24M", ref[:10] + "T" + ref[11:])]
    sam = spark.createDataFrame([(f"q{i}", *r) for i, r in enumerate(rows)], "qname string, rname string, pos int, cigar string, seq string")
    refs = spark.createDataFrame([("a", ref)], "name string, seq string")
    want = Counter()
    for _, pos, cigar, seq in rows:
        columns, i, j = [], 0, pos - 1
        for n, op in re.findall(r"(\d+)([MIDS])", cigar):
            for _ in range(int(n)):
                if op != "S":
                    columns.append((seq[i] if op != "D" else "-", ref[j] if op != "I" else "-", j))
                i += op != "D"
                j += op not in "IS"
        k = 0
        while k < len(columns):
            q, r, j = columns[k]
            stop = k + 1
            if "-" in (q, r):
                while stop < len(columns) and (columns[stop][0] == "-", columns[stop][1] == "-") == (q == "-", r == "-"):
                    stop += 1
                if not re.search(r"(.)\1\1", ref[max(0, j - 3) : j + 3]):
                    text = "".join(c[1 if q == "-" else 0] for c in columns[k:stop])
                    want[j + (q == "-"), ("del" if q == "-" else "ins") + text] += 1
            elif q != r:
                want[j + 1, f"{r}->{q}"] += 1
            k = stop
    got = {(r.pos, r.change): r.var_depth for r in mutations.pile_up(sam, refs).collect()}
    assert got == dict(want)
    deep = Counter(p for _, pos, cigar, _ in rows for p in range(pos, pos + sum(int(n) for n in re.findall(r"(\d+)[MD]", cigar))))
    assert {r.pos: r.coverage for r in mutations.coverage(sam).collect()} == deep


def test_coverage_runs_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(mutations, "STRETCH", 16)
    rows = [("a", 3, "70M"), ("a", 10, "5M"), ("a", 15, "1M"), ("a", 120, "9M"), ("b", 16, "16M")]
    deep = Counter((ref, p) for ref, pos, cigar in rows for p in range(pos, pos + int(cigar[:-1])))
    got = mutations.coverage(spark.createDataFrame(rows, "rname string, pos int, cigar string")).collect()
    assert {(r.ref, r.pos): r.coverage for r in got} == deep and len(got) == len(deep)


def test_corrected_coverage_counts_a_read_once(spark):
    rows = [("L", a, f"r{k}") for a, n, m in (("A1", 0, 50), ("A2", 40, 60), ("A3", 0, 40), ("A4", 55, 58)) for k in range(n, m)]
    got = {r.allele: (r.reads, r.corrected, r.kept) for r in alleles.corrected_coverage(spark.createDataFrame(rows, "locus string, allele string, read string")).collect()}
    assert got == {"A1": (50, 50, True), "A2": (20, 10, False)}


def test_biom_object(spark):
    rows = [("O2", "S1", 3), ("O1", "S1", 1), ("O1", "S2", 5)]
    table = json.loads(taxonomy.biom_json(spark.createDataFrame(rows, "otu string, sample string, depth long")).first().value)
    assert [r["id"] for r in table["rows"]] == ["O1", "O2"] and [c["id"] for c in table["columns"]] == ["S1", "S2"]
    assert table["shape"] == [2, 2] and sorted(map(tuple, table["data"])) == [(0, 0, 1), (0, 1, 5), (1, 0, 3)]


def test_allele_groups_between_two_lists(spark):
    names, others = ["A*02:01:01", "A*02:05", "B*07:02"], ["A*02:01:03", "A*02:06", "B*07:02", "C*01:02"]
    want = {"A*02": ["A*02:01:01", "A*02:01:03", "A*02:06"], "A*02:05": ["A*02:05"], "B*07:02": ["B*07:02"]}
    assert alleles.allele_groups_between(names, others) == want
    df = spark.createDataFrame([(names, others)], "x array<string>, y array<string>")
    assert {g.name: g.members for g in alleles.group_allele_names_between(df, "x", "y").first().groups} == want


def test_identity_clusters_segments_and_folding(spark):
    """A rare copy of one allele and a strong copy of another."""
    thin, strong = error(A, 3), error(B, 7)
    df = amplicon(spark, [(A, 1000), (thin, 5), (B, 400), (strong, 300)])
    name = {r.md5: r.seq for r in df.collect()}
    keys = ["marker", "sample"]
    same = {r.seq: (name[r["head"]], r.removed) for r in clustering.cluster_by_identity(df, 95, keys, 0.2).collect()}
    assert same == {A: (A, False), thin: (A, True), B: (B, False), strong: (B, False)}
    assert {r.seq: name[r["head"]] for r in clustering.cluster_segments(df, keys).collect()} == {A: A, thin: A, B: B, strong: strong}
    folded = {name[r.md5]: r.folded for r in clustering.genotype_folding(df).collect()}
    assert folded == {A: 1005, thin: 0, B: 400, strong: 300}


def test_filter_reasons(spark):
    """Stops in the frame of the deepest open variant, columns shared with it, small clusters, the sharpest fall."""
    open_ = "ACG" * 17
    stop = open_[:30] + "TAA" + open_[33:]
    far = B  # with a stop in frame 1
    rows = amplicon(spark, [(open_, 100), (stop, 90), (far, 6)]).withColumns({"freq": F.col("depth") / 2, "cluster_size": F.when(F.col("depth") == 90, 1).otherwise(3)})
    got = {r.seq: r.reasons for r in clustering.filter_artefacts(rows, stops=True, min_cluster_size=2, min_identical=45).collect()}
    assert got == {open_: [], stop: ["cluster size", "stop"], far: ["identity", "stop"]}
    kept = {r.seq: r.kept for r in clustering.filter_artefacts(rows, degree=True).collect()}
    assert kept == {open_: True, stop: True, far: False}

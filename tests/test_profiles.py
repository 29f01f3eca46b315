"""Top rows, local hits, equal alleles, rarefaction and sparse tables."""

import json
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strandwise.operators import alleles, mutations, ranking, reads, repertoire, taxonomy

A = "ACGTTGCAACGGATCCTTAGCATGCATTGGCCAATTCGCGATATCGGATCA"


def test_first_rows_equal_a_sort(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.randint(0, 5), r.choice("xyz") + str(r.randint(0, 50))) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, n int, name string").repartition(4)
    for most in (1, 40, 5000):
        got = [(x.k, x.n, x["name"], x.nth) for x in ranking.first_rows(df, ["k"], [-F.col("n"), F.substring("name", 1, 1)], [F.col("name")], most).collect()]
        want = Counter()
        for k in ("a", "b", None):
            mine = sorted((x for x in rows if x[0] == k), key=lambda x: (-x[1], x[2]))[:most]
            assert sorted(n for kk, _, _, n in got if kk == k) == list(range(1, len(mine) + 1))
            want.update(mine)
        assert Counter(x[:3] for x in got) == want


def test_samples_of_groups_are_the_first_by_hash(spark):
    import hashlib

    df = spark.createDataFrame([(f"r{i}", "g" if i % 3 else "h") for i in range(300)], "read_id string, g string")
    got = {x.read_id for x in reads.sample_reads(df, 20, keys=("g",)).collect()}
    want = set()
    for g in "gh":
        mine = [f"r{i}" for i in range(300) if ("g" if i % 3 else "h") == g]
        want |= set(sorted(mine, key=lambda x: (hashlib.md5(("1" + x).encode()).hexdigest(), x))[:20])
    assert got == want
    rounds = reads.sampling_rounds(df, 3, 50).groupBy("round").count().collect()
    assert {(x.round, x["count"]) for x in rounds} == {(k, 50) for k in range(3)}


def test_top_clones_by_count(spark):
    rows = [("S", n % 7, f"TGT{n:04d}") for n in range(200)] + [("T", 1, "X")]
    df = spark.createDataFrame(rows, "sample string, cloneCount long, nSeqCDR3 string")
    got = sorted((x["sample"], x.nth, x.nSeqCDR3) for x in repertoire.top_clones(df, 30).collect())
    want = [("S", k, x[2]) for k, x in enumerate(sorted((x for x in rows if x[0] == "S"), key=lambda x: (-x[1], x[2]))[:30], 1)]
    assert got == [*want, ("T", 1, "X")]


def test_segments_beside_a_deletion_add_up(spark):
    lost = A[:24] + A[27:]
    flip = str.maketrans("ACGT", "TGCA")
    v = spark.createDataFrame([("q", lost), ("w", A[:5] + "T" + A[6:]), ("t", A[::-1].translate(flip))], "md5 string, seq string")
    refs = spark.createDataFrame([("ref", A)], "name string, seq string")
    hits = alleles.local_hits(v, refs, least=12, both_strands=True)  # words of 10 that are their own complement score less
    got = {(x["query"], x.strand, x.q_start, x.s_start, x.aligned, x.ident) for x in hits.collect()}
    assert got == {("q", "+", 1, 1, 24, 24), ("q", "+", 25, 28, len(A) - 27, len(A) - 27), ("w", "+", 1, 1, len(A), len(A) - 1), ("t", "-", 1, 1, len(A), len(A))}
    lengths = spark.createDataFrame([("q", len(lost)), ("w", len(A)), ("t", len(A)), ("ref", len(A))], "id string, len int")
    names = {x["query"]: (x["name"], x.ident) for x in alleles.best_names(hits.select("query", "subject", "ident", "aligned"), lengths).collect()}
    assert names == {"q": ("ref", len(lost)), "w": ("ref", len(A) - 1), "t": ("ref", len(A))}


def test_alleles_with_the_same_reads_are_one_entry(spark):
    sets = {"A1": range(20), "A2": range(20), "A3": range(1, 21), "B1": range(3)}
    rows = [("L", a, f"r{i}") for a, reads_of in sets.items() for i in reads_of] + [("K", "A1", f"r{i}") for i in range(20)]
    df = spark.createDataFrame([*rows, *rows[:5]], "locus string, allele string, read string").repartition(3)
    got = {(x.locus, x.allele): x.entry for x in alleles.equal_alleles(df).collect()}
    assert got == {("L", "A1"): "A1 | A2", ("L", "A2"): "A1 | A2", ("L", "A3"): "A3", ("L", "B1"): "B1", ("K", "A1"): "A1"}
    kept = {(x.locus, x.allele): (x.corrected, x.kept) for x in alleles.allele_numbers(df).collect()}
    assert kept == {("L", "A1 | A2"): (20, True), ("L", "A3"): (1, False), ("K", "A1"): (20, True)}
    two = spark.createDataFrame([("L", f"A{k}", f"r{k}-{i}") for k, n in ((1, 30), (2, 25), (3, 2)) for i in range(n)], "locus string, allele string, read string")
    assert {x.allele for x in alleles.allele_numbers(two).where("kept").collect()} == {"A1", "A2"}


def test_rarefied_counts_have_the_depths_and_means_asked_for(spark, monkeypatch):
    monkeypatch.setattr(taxonomy, "BUCKET_OTUS", 4)  # so that a sample fills several tasks
    depths = {f"o{k}": 5 + 37 * k for k in range(30)}
    df = spark.createDataFrame([("S", o, n) for o, n in depths.items()] + [("T", "o1", 9)], "sample string, otu string, depth long")
    rows = taxonomy.rarefied_counts(df, [50, 400], 40).collect()
    sums, mean = Counter(), defaultdict(float)
    for x in rows:
        sums[x["sample"], x.step, x.replicate] += x.n
        if x["sample"] == "S" and x.step == 400:
            mean[x.otu] += x.n / 40
    assert sums == {(s, n, k): n for s in "ST" for n in (50, 400) for k in range(40)}
    total = sum(depths.values())
    for o, n in depths.items():
        want = 400 * n / total
        assert abs(mean[o] - want) <= 5 * (want / 40) ** 0.5 + 0.05
    again = taxonomy.rarefied_counts(df.repartition(5), [50, 400], 40).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert taxonomy.rarefaction_depths(df) == (800, 800)


def test_sparse_table_is_one_json_text(spark, tmp_path):
    rows = [(f"o{i % 37}", f"S{i % 5}", i + 1) for i in range(120)]
    df = spark.createDataFrame(rows, "otu string, sample string, depth long").repartition(4)
    want = Counter()
    for o, s, n in rows:
        want[o, s] += n
    taxonomy.write_biom(df, str(tmp_path / "table"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "table").glob("part-*")))
    table = json.loads(text)
    cells = {(table["rows"][r]["id"], table["columns"][c]["id"]): n for r, c, n in table["data"]}
    assert table["shape"] == [37, 5] and cells == dict(want)
    assert all(x["metadata"]["row"] == k for k, x in enumerate(table["rows"]))
    assert {(x.otu, x["sample"]): x.depth for x in taxonomy.read_biom(spark, str(tmp_path / "table")).collect()} == dict(want)
    taxonomy.write_biom(df.limit(0), str(tmp_path / "none"))
    assert json.loads("\n".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*"))))["data"] == []


def plain_heads(rows, substitutions):
    """The walk by depth within each group and length."""
    out = {}
    for g in {x[0] for x in rows}:
        heads = []
        for _, q, _ in sorted((x for x in rows if x[0] == g), key=lambda x: (-x[2], x[1])):
            near = [h for h in heads if len(h) == len(q) and sum(a != b for a, b in zip(h, q)) <= substitutions]
            if not near:
                heads.append(q)
            out[g, q] = near[0] if near else q
    return out


def test_equal_length_clusters_equal_the_walk(spark):
    r, rows = random.Random(5), {}
    for g in ("a", "b"):
        pool = ["".join(r.choice("ACGT") for _ in range(r.choice([12, 15]))) for _ in range(6)]
        for _ in range(80):
            q = r.choice(pool)
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(q))
                q = q[:k] + r.choice("ACGT") + q[k + 1 :]
            pool.append(q)
            rows[g, q] = rows.get((g, q), 0) + r.randint(1, 9)
    rows = [(g, q, n) for (g, q), n in rows.items()]
    df = spark.createDataFrame([*rows, ("a", "", 3)], "sample string, cdr3 string, depth long").repartition(3)
    for substitutions in (0, 1, 2):
        got = {(x["sample"], x.cdr3): x["head"] for x in repertoire.cluster_equal_length(df, substitutions, ["sample"]).collect() if x.cdr3}
        assert got == plain_heads(rows, substitutions)


def test_points_in_ranges_of_all_lengths(spark):
    r = random.Random(8)
    ranges = []
    for k in range(120):
        start = r.randint(1, 5_000_000)
        ranges.append((f"G{k}", f"chr{k % 2}", start, start + r.choice([0, 3, 60, 64, 900, 70_000, 2_000_000])))
    ranges.append(("OR1", "chr0", 1, 5_000_000))
    points = [(f"chr{k % 2}", r.randint(1, 6_000_000)) for k in range(300)] + [(c, s) for _, c, s, _ in ranges[:9]] + [(c, e) for _, c, _, e in ranges[:9]]
    got = Counter((x.gene, x.chrom, x.pos) for x in mutations.in_ranges(spark.createDataFrame(points, "chrom string, pos int"), spark.createDataFrame(ranges, "gene string, chrom string, start int, stop int")).collect())
    assert got == Counter((g, c, p) for c, p in points for g, gc, s, e in ranges[:-1] if c == gc and s <= p <= e)

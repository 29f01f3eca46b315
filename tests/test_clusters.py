"""Near pairs, greedy clusters and chimeras against plain walks over whole amplicons."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandwise.functions.align import compare_pair, errors_of, global_alignment
from strandwise.operators import chimeras, clustering, near


def md5(seq):
    return hashlib.md5(seq.encode()).hexdigest()


def changed(r, seq, n):
    for _ in range(n):
        k = r.randrange(len(seq))
        seq = {"s": seq[:k] + r.choice("ACGT") + seq[k + 1 :], "i": seq[:k] + r.choice("ACGT") + seq[k:], "d": seq[:k] + seq[k + 1 :], "r": seq[:k] + seq[k] * 2 + seq[k:]}[r.choice("sssid r".replace(" ", ""))]
    return seq


def amplicons(seed, number=60, length=45):
    """Two amplicons of alleles, their copies with errors, copies of these, and chimeras."""
    r, rows = random.Random(seed), {}
    for sample in ("S1", "S2"):
        alleles = ["".join(r.choice("ACGT") for _ in range(length)) for _ in range(3)]
        alleles.append(changed(r, alleles[0], 1))
        pool = list(alleles)
        for a in alleles:
            rows[sample, a] = r.randint(200, 900)
        for _ in range(number):
            q = changed(r, r.choice(pool), r.randint(1, 3))
            if r.random() < 0.15:
                k = r.randint(8, length - 8)
                x, y = r.sample(alleles[:3], 2)
                q = x[:k] + y[k:]
            pool.append(q)
            rows.setdefault((sample, q), r.choice([1, 1, 2, 3, 5, 8, 20, 60]))
    return [("M", s, md5(q), q, n) for (s, q), n in rows.items()]


VARIANTS = "marker string, sample string, md5 string, seq string, depth long"


def by_amplicon(rows):
    out = {}
    for m, s, k, q, n in sorted(rows, key=lambda x: (x[0], x[1], -x[4], x[2])):
        out.setdefault((m, s), []).append((q, n))
    return out


@pytest.mark.parametrize("errors", [0, 1, 2, 3, 4])
def test_near_pairs_are_all_pairs_that_are_near(spark, errors):
    rows = amplicons(errors, 40)
    want = set()
    for (m, s), vs in by_amplicon(rows).items():
        for i, (a, _) in enumerate(vs):
            for b, _ in vs[i + 1 :]:
                e = compare_pair(b, a)
                if sum(e[2:5]) <= errors:
                    want.add((s, md5(a), md5(b), *e))
    got = near.near_pairs(spark.createDataFrame(rows, VARIANTS).repartition(3), errors).collect()
    assert {(r["sample"], r.md5_1, r.md5_2, r.ident, r.aligned, r.subs, r.ins, r.dels, r.homo) for r in got} == want
    assert len(got) == len(want) and (errors == 0 or want)


def test_pairs_within_limits_in_both_directions(spark):
    rows = amplicons(11, 30)
    df = spark.createDataFrame(rows, VARIANTS)
    length = {md5(q): len(q) for _, _, _, q, _ in rows}
    got = near.compare_within(df, 4, 5, 2.5, 90).collect()
    pairs = {(r["sample"], r.md5, r.of): r for r in got}
    assert len(got) == len(pairs) > 20
    for (s, a, b), r in pairs.items():
        assert r.subs <= 0.05 * length[a] and r.ins + r.dels - r.homo <= 0.025 * length[a] and r.identity >= 90
        assert r.label == "".join(f"{c}{n}" for c, n in (("X", r.subs), ("I", r.ins), ("D", r.dels), ("H", r.homo)) if n)
        if (s, b, a) in pairs:
            back = pairs[s, b, a]
            assert (back.ins, back.dels, back.subs, back.homo) == (r.dels, r.ins, r.subs, r.homo)


def plain_guided(vs, max_subs, max_indels, min_dominant, lengths=None, max_clusters=0, min_amplicon=0):
    """The walk by depth; errors of a pair as the deeper one sees the other, and turned round."""
    total = sum(n for _, n in vs)

    def errors(v, h):
        if len(vs[v][0]) == len(vs[h][0]):
            return sum(x != y for x, y in zip(vs[v][0], vs[h][0])), 0, 0, 0
        e = compare_pair(vs[max(v, h)][0], vs[min(v, h)][0])[2:]
        return e if v > h else (e[0], e[2], e[1], e[3])

    def near_of(h):
        n, out = len(vs[h][0]), {}
        subs, indels = round(max_subs * n / 100), round(max_indels * n / 100)
        for v in range(len(vs)):
            if v == h or (len(vs[v][0]) != n and (indels < 1 or abs(len(vs[v][0]) - n) > max(indels, 3))):
                continue
            e = errors(v, h)
            if e[0] <= subs and e[1] + e[2] - e[3] <= indels and e[1] + e[2] <= max(indels, 3):
                out[v] = e
        return out

    def strong(v, h, e):
        n = len(vs[v][0])
        much = 100 * vs[v][1] >= min_dominant * vs[h][1] or (min_amplicon and 100 * vs[v][1] >= min_amplicon * total)
        frame = any(abs(n - x) % 3 == 0 and abs(n - x) <= 0.9 * x for x in lengths or [len(vs[h][0])])
        if not much or not frame or not (e[1] or e[2]):
            return much and frame
        _, ins, dels, _ = errors_of(*global_alignment(vs[v][0], vs[h][0]))
        whole = all(len(x) % 3 == 0 and all(x[k + 2] - x[k] <= 2 for k in range(0, len(x), 3)) for x in (ins, dels))
        return whole or (len(ins) == len(dels) == 1 and abs(ins[0] - dels[0]) <= 9)

    near_to = {h: near_of(h) for h in range(len(vs))}
    free, out, heads = set(range(len(vs))), [], 0
    for top in range(len(vs)):
        if top not in free or vs[top][1] < 2 or (max_clusters and heads >= max_clusters):
            continue
        heads += 1
        free.discard(top)
        out.append((heads, "head", top, True))
        mine = {v: e for v, e in near_to[top].items() if v in free and v > top}
        rivals = [v for v, e in mine.items() if strong(v, top, e)]
        for v, e in mine.items():
            if v in rivals:
                continue
            others = [sum(near_to[r][v]) for r in rivals if v in near_to[r]]
            if others and min(others) < sum(e):
                continue
            free.discard(v)
            out.append((heads, "member", v, not (others and min(others) == sum(e))))
    return Counter((k, role, md5(vs[v][0]), counted) for k, role, v, counted in [*out, *((0, "none", v, False) for v in free)])


@pytest.mark.parametrize("limits", [(4.5, 2.5, 25, None, 0, 0), (2, 0, 10, [45], 3, 0), (7, 2.5, 40, [45, 46], 0, 4)])
def test_guided_rounds_equal_the_walk(spark, limits):
    rows = amplicons(21 + int(limits[0]))
    got = clustering.cluster_guided(spark.createDataFrame(rows, VARIANTS).repartition(4), *limits).collect()
    assert len(got) == len(rows) and sum(r.depth for r in got) == sum(r[4] for r in rows)
    for (m, s), vs in by_amplicon(rows).items():
        mine = Counter((r.cluster, r.role, r.md5, r.counted) for r in got if r["sample"] == s)
        assert mine == plain_guided(vs, *limits)


def plain_denovo(vs, substitutions, min_percent, min_seed):
    def gap(i, j):
        return sum(x != y for x, y in zip(vs[i][0], vs[j][0])) if len(vs[i][0]) == len(vs[j][0]) else 99

    head = {}
    for i in range(len(vs)):
        if i in head or vs[i][1] < min_seed:
            continue
        head[i] = i
        for j in range(i + 1, len(vs)):
            if j not in head and gap(i, j) <= substitutions and 100 * vs[j][1] < min_percent * vs[i][1]:
                head[j] = i
    total = Counter()
    for j, i in head.items():
        total[i] += vs[j][1]
    heads, to = sorted(total, key=lambda i: (-total[i], md5(vs[i][0]))), {}
    for n, i in enumerate(heads):
        for j in heads[:n]:
            if j not in to and len(vs[i][0]) != len(vs[j][0]) and sum(compare_pair(vs[i][0], vs[j][0])[2:5]) <= substitutions and 100 * total[i] < min_percent * total[j]:
                to[i] = j
                break
    number = {h: k for k, h in enumerate([h for h in heads if h not in to], 1)}
    final = {j: to.get(i, i) for j, i in head.items()}
    return Counter((number[final[j]] if j in final else 0, "none" if j not in final else "head" if final[j] == j else "member", md5(vs[j][0])) for j in range(len(vs)))


@pytest.mark.parametrize("limits", [(1, 25, 2), (2, 60, 1)])
def test_denovo_rounds_equal_the_walk(spark, limits):
    rows = amplicons(31 + limits[0])
    got = clustering.cluster_denovo(spark.createDataFrame(rows, VARIANTS).repartition(4), *limits).collect()
    for (m, s), vs in by_amplicon(rows).items():
        assert Counter((r.cluster, r.role, r.md5) for r in got if r["sample"] == s) == plain_denovo(vs, *limits)


def test_a_chain_settles_from_its_deep_end(spark):
    edges = [(k, k, k + 1) for k in range(6)] + [(0, 0, 3), (2, 2, 5), (10, 10, 12), (11, 11, 12)]
    got = {r.v: r.to for r in near.settled(spark.createDataFrame(edges, "u long, rank long, v long")).collect()}
    assert got == {1: 0, 2: None, 3: 0, 4: None, 5: 2, 6: None, 12: 10}
    assert near.settled(spark.createDataFrame([], "u long, rank long, v long")).count() == 0


def shared(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def plain_chimeras(vs, least, similar=None, parents=None):
    out = {}
    for i, (q, _) in enumerate(vs):
        n = int(len(q) * float(least[:-1]) / 100) if isinstance(least, str) else least
        of = [j for j in range(i) if (parents is None or j in parents) and (similar is None or sum(compare_pair(q, vs[j][0])[2:5]) > similar)]
        ends = [(j, shared(q, vs[j][0]), shared(q[::-1], vs[j][0][::-1])) for j in of]
        pairs = [(-a, j, -b, k) for j, a, _ in ends for k, _, b in ends if j != k and n <= a < len(q) and n <= b < len(q) and a + b >= len(q)]
        if pairs:
            _, j, _, k = min(pairs)
            out[md5(q)] = (md5(vs[j][0]), md5(vs[k][0]))
    return out


@pytest.mark.parametrize("least,similar", [(10, None), ("15%", None), (6, 2), (1, None)])
def test_chimeras_are_those_of_all_pairs(spark, least, similar):
    rows = amplicons(41)
    got = chimeras.chimeras(spark.createDataFrame(rows, VARIANTS).repartition(3), least, similar).collect()
    for (m, s), vs in by_amplicon(rows).items():
        mine = {r.md5: (r.left_parent, r.right_parent) for r in got if r["sample"] == s}
        assert mine == plain_chimeras(vs, least, similar) and mine


def test_ordered_filters_settle_as_the_walk_does(spark):
    rows = amplicons(51)
    df = spark.createDataFrame(rows, VARIANTS).withColumn("freq", F.col("depth") / 10)
    for most, chimera in ((0, 8), (5, 8), (3, 0)):
        got = {(r["sample"], r.md5): (r.kept, list(r.reasons)) for r in clustering.filter_artefacts(df, min_depth=2, max_alleles=most, chimera=chimera).collect()}
        for (m, s), vs in by_amplicon(rows).items():
            kept = set()
            for i, (q, n) in enumerate(vs):
                why = ["depth"] if n < 2 else []
                if chimera and md5(q) in plain_chimeras(vs[: i + 1], chimera, parents=kept):
                    why.append("chimera")
                if most and not why and len(kept) >= most:
                    why.append("allele number")
                if not why:
                    kept.add(i)
                assert got[s, md5(q)] == (not why, why)


def test_deletions_are_outvoted_and_insertions_voted_in(spark):
    """Members of all lengths vote; the head lacks a base that most have, and has one that few have."""
    a = "ACGTTGCAACGGATCCTTAGCATGCATTGG"
    lost, more = a[:9] + a[10:], a[:20] + "T" + a[20:]
    rows = [("M", "S", 1, "head", lost, 50), ("M", "S", 1, "member", a, 40), ("M", "S", 1, "member", a[:3] + "C" + a[4:], 30), ("M", "S", 1, "member", more, 5), ("M", "S", 2, "head", a, 9), ("M", "S", 2, "member", lost, 8)]
    df = spark.createDataFrame(rows, "marker string, sample string, cluster int, role string, seq string, depth long").withColumns({"md5": F.md5("seq"), "counted": F.lit(True)})
    got = {r.cluster: (r.consensus, r.changed) for r in clustering.consensus(df, 3, gapped=True).collect()}
    assert got == {1: (a, True), 2: (a, False)}
    plain = {r.cluster: r.consensus for r in clustering.consensus(df, 3).collect()}
    assert plain[1] == lost  # only members as long as the head vote


def test_a_known_head_gets_the_errors_of_its_members(spark):
    a = "ACGTTGCAACGGATCCTTAGCATGCATTGG"
    b, c = a[:4] + "A" + a[5:], a[:4] + "A" + a[5:12] + "G" + a[13:]
    rows = [("M", "S", 1, "head", a, 50, 0), ("M", "S", 1, "member", b, 30, 1), ("M", "S", 1, "member", c, 4, 2), ("M", "S", 2, "head", c[1:], 9, 0)]
    df = spark.createDataFrame(rows, "marker string, sample string, cluster int, role string, seq string, depth long, subs int").withColumns({"md5": F.md5("seq"), "counted": F.lit(True), **{x: F.lit(0) for x in ("ins", "dels", "homo")}})
    known = spark.createDataFrame([("K", b)], "name string, seq string")
    got = {(r.cluster, r.seq): (r.role, r.subs) for r in clustering.prefer_known_heads(df, known, errors=True).collect()}
    assert got == {(1, a): ("member", 1), (1, b): ("head", 0), (1, c): ("member", 1), (2, c[1:]): ("head", 0)}


def test_single_indels_are_repaired_before_ranking(spark):
    a = "ACGTTGCAACGGATCCTTAGCATGCATTGG"
    rows = [("M", "S", q, n, f) for q, n, f in ((a, 90, 90.0), (a[:9] + a[10:], 5, 5.0), (a[:5] + "A" + a[6:], 3, 3.0), (a[:12] + "T" + a[12:], 2, 2.0))]
    df = spark.createDataFrame(rows, "marker string, sample string, seq string, depth long, freq double").withColumn("md5", F.md5("seq"))
    got = {r.seq: (r.depth, r.freq) for r in clustering.repaired_indels(df, 4.0).collect()}
    assert got == {a: (92, 92.0), a[:9] + a[10:]: (5, 5.0), a[:5] + "A" + a[6:]: (3, 3.0)}
    ranked = {r.md5: r.best for r in clustering.genotype_by_rank(df, 1, 1, repair_below=10.0).collect()}
    assert ranked == {md5(a): 97.0, md5(a[:5] + "A" + a[6:]): 3.0}

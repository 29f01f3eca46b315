"""Near-dedup, packing, neighbours, mixing, sharding and chat against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strandwise.llm import chat, components, mixing, near_dedup, neighbours, packing, sharding

from .conftest import document_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows):
    out = {}
    for doc_id, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def plain_components(rows):
    sets = sets_of(rows)
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_dedup_edge_cases(docs, no_docs):
    got = near_dedup.components(docs).collect()
    want = plain_components([r[:2] for r in document_rows() if r[0] is not None])
    assert len(got) == len(document_rows())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = [r.doc_id for r in near_dedup.keep_one(docs).collect()]
    assert Counter(kept) == Counter(r[0] for r in document_rows() if r[0] is None or want[r[0]][1] == r[0])
    assert near_dedup.components(no_docs).count() == 0


def test_unlike_texts_of_one_doc_id(spark):
    """The doc_id links its rows in ``components``; ``keep_one`` loses no text for it."""
    x, y, z = (" ".join(words(60, seed)) for seed in (91, 92, 93))
    near = x.replace(" ", " changed ", 1)
    rows = [(3, x), (5, x), (5, y), (7, z), (8, z.upper()), (9, near), (5, y), (11, None), (11, "few words"), (None, x)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dedup.components(df).collect())
    assert got == Counter({(3, 56, 3): 1, (5, 56, 3): 3, (7, 56, 7): 1, (8, 56, 7): 1, (9, 57, 3): 1, (11, 0, 11): 1, (11, 1, 11): 1, (None, 56, None): 1})
    kept = Counter((r.doc_id, r.text) for r in near_dedup.keep_one(df).collect())
    assert kept == Counter({(3, x): 1, (5, y): 2, (7, z): 1, (11, None): 1, (11, "few words"): 1, (None, x): 1})


def test_near_copies_of_a_base_that_are_far_from_each_other(spark):
    """Links only through the base, which is not the smallest id."""
    base = words(150, 9)
    rows = []
    for i in range(60):
        r = random.Random(i)
        w = list(base)
        for k in r.sample(range(150), 4):
            w[k] = f"edit{i}x{k}"
        rows.append((i, " ".join(w)))
    rows.append((100, " ".join(base)))
    rows += [(200 + i, " ".join(words(80, 300 + i))) for i in range(20)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_components(rows)


def exact_components(rows):
    """As ``plain_components``, with all intersections from one matrix."""
    sets = sets_of(rows)
    ids = sorted(sets)
    number = {g: k for k, g in enumerate({g for d in ids for g in sets[d]})}
    both = np.zeros((len(ids), len(ids)), np.float32)
    for lo in range(0, len(number), 4096):
        part = np.zeros((len(ids), 4096), np.float32)
        for i, d in enumerate(ids):
            part[i, [number[g] - lo for g in sets[d] if lo <= number[g] < lo + 4096]] = 1
        both += part @ part.T
    size = np.array([len(sets[d]) for d in ids])
    near = 100 * both >= 75 * (size[:, None] + size[None, :] - both)
    label = np.arange(len(ids))
    while (low := np.array([label[near[i]].min() if size[i] else label[i] for i in range(len(ids))])).tolist() != label.tolist():
        label = low
    return {d: (len(sets[d]), ids[label[i]]) for i, d in enumerate(ids)}


def test_unlike_documents_with_a_common_passage(spark):
    """Two thousand documents that share two thirds to six sevenths of their words, and near copies of some."""
    passage, rows = words(72, 11), []
    for i in range(2000):
        own = [f"{w}{i}" for w in words(12 + i % 25, 5000 + i)]
        rows.append((i, " ".join(own + passage)))
        if i % 100 == 0:
            own[0] = "changed"
            rows.append((10_000 + i, " ".join(own + passage)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == exact_components(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(30)}}


def plain_best_fit(sizes, sources, clusters, capacity, most):
    bins, out = [], []
    for s, src, c in zip(sizes, sources, clusters):
        fits = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= s and b["src"][src] < most and (c < 0 or c not in b["clu"])]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": capacity, "src": Counter(), "clu": set()})
        out.append((i, capacity - bins[i]["left"]))
        bins[i]["left"] -= s
        bins[i]["src"][src] += 1
        bins[i]["clu"].add(c)
    return out


def test_best_fit_equals_a_full_search():
    r = random.Random(3)
    for most in (1, 2, 3):
        sizes = sorted((r.randint(1, 100) for _ in range(400)), reverse=True)
        sources, clusters = [r.choice([0, 0, 1, 2, 3]) for _ in sizes], [r.choice([-1, -1, 0, 1, 2]) for _ in sizes]
        assert packing.best_fit(sizes, sources, clusters, 100, most) == plain_best_fit(sizes, sources, clusters, 100, most)


def test_packing_keeps_its_rules(docs, no_docs):
    items = packing.documents_as_items(docs).cache()
    rows = packing.pack(items, capacity=256).collect()
    bins, total = defaultdict(list), Counter()
    for r in rows:
        total[r.doc_id] += r.n_words
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    want = Counter()
    for doc_id, text, *_ in document_rows():
        want[doc_id] += len(WORD.findall(text or ""))
    assert total == want and set(total) == set(want)
    cluster = {r[0]: hash(r[1]) for r in document_rows()}
    for b in bins.values():
        b.sort(key=lambda r: r.bin_offset)
        assert all(x.bin_offset + x.n_words <= y.bin_offset for x, y in zip(b, b[1:])) and b[-1].bin_offset + b[-1].n_words <= 256
        assert max(Counter(r.source for r in b).values()) <= packing.MOST_OF_SOURCE
        assert len({cluster[r.doc_id] for r in b}) == len(b)
    assert packing.pack(packing.documents_as_items(no_docs)).count() == 0


def exact_nearest(vectors, queries, k):
    out = {}
    for q in queries:
        d = sorted((math.dist(vectors[q], v), i) for i, v in vectors.items() if i != q)
        out[q] = d[:k]
    return out


def test_neighbours_recall_and_edge_cases(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = {i: [float(np.float32(c)) for c in v] for i, v in enumerate(x)}
    for i in range(1000, 1400):  # a common vector
        vectors[i] = vectors[1000]
    rows = [*vectors.items(), (9000, None), (9100, [0.0] * 24), (9200, [float("nan")] * 24), (9300, [None] + [1.0] * 23), (9400, [float("inf")] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    want = exact_nearest(vectors, [i for i in vectors if i % 100 == 0], 10)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    found = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want) / (10 * len(want))
    assert found >= 0.95
    assert [i for _, i in got[1000]] == [*range(1001, 1011)] and [i for _, i in got[1100]] == [*range(1000, 1010)]
    assert all(abs(s - math.dist(vectors[q], vectors[i])) < 1e-12 for q in got for s, i in got[q])
    few = neighbours.nearest(spark.createDataFrame(rows[:5], "vec_id long, embedding array<float>"), F.col("vec_id") % 2 == 0)
    assert Counter(r.query_id for r in few.collect()) == {0: 4, 2: 4, 4: 4}
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 2 == 0).count() == 0


def test_neighbours_of_vectors_of_unlike_length(spark):
    """Directions choose the buckets, lengths decide the nearest; repeated rows and clashing names change nothing."""
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(30, 16))
    x = (centres[draw.integers(0, 30, 1500)] + 0.3 * draw.normal(size=(1500, 16))) * np.exp(0.5 * draw.normal(size=(1500, 1)))
    rows = [(i, v.tolist(), "a", 1) for i, v in enumerate(x)]
    df = spark.createDataFrame([*rows, *rows[:50]], "vec_id long, embedding array<double>, lead string, block int")
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    found = 0
    for q in range(0, 1500, 100):
        gap = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        gap[q] = np.inf
        found += len(set(np.argsort(gap, kind="stable")[:10].tolist()) & set(got[q]))
        assert len(got[q]) == 10
    assert found >= 0.9 * 150


def test_neighbours_probe_further_until_the_sampled_recall_holds(spark):
    vectors = {i: v for i, v in enumerate(np.random.default_rng(3).standard_normal((2000, 16)).astype(np.float32))}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>").repartition(3)
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, tables=2, probes=1).collect()}
    want = exact_nearest(vectors, [i for i in vectors if i % 50 == 0], 10)
    pairs = {(q, v) for q, near in want.items() for _, v in near}
    assert len(got & pairs) / len(pairs) >= 0.95
    assert [neighbours.probes_for(n) for n in (100, 12_500)] == [neighbours.PROBES] * 2
    assert neighbours.probes_for(2_000_000) > neighbours.probes_for(500_000) > neighbours.probes_for(51_282) > neighbours.PROBES


def test_targets_stop_at_three_times_the_source(spark):
    rows = [(s, "s" + s, n) for s, n in (("a", 10), ("b", 1000), ("c", 500), ("d", 5))]
    got = {r.source_key: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, source_key string, size long")).collect()}
    weight, size, total = {"sa": 5, "sb": 2, "sc": 1, "sd": 5}, {"sa": 10, "sb": 1000, "sc": 500, "sd": 5}, 1515
    capped = set()
    while True:
        free = {k for k in size if k not in capped}
        level = (total - sum(3 * size[k] for k in capped)) / sum(weight[k] for k in free)
        over = {k for k in free if level * weight[k] > 3 * size[k]}
        if not over:
            break
        capped |= over
    for k in size:
        assert abs(got[k] - (3 * size[k] if k in capped else level * weight[k])) < 1e-6


def test_mixing_meets_targets(spark, docs, no_docs, monkeypatch):
    rows = [(i, " ".join(words(30 + i % 90, i)), f"s{i % 4 if i % 3 else 0}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    numbered = mixing.numbered(df)
    sources, segments = mixing.mix(numbered, 16)
    segments = segments.cache()
    size = {r.rid: r["size"] for r in numbered.collect()}
    taken = Counter()
    for r in segments.collect():
        taken[r.rid] += r.n_words
        assert 0 <= r.first_word and r.first_word + r.n_words <= size[r.rid]
    assert all(taken[k] <= 3 * size[k] for k in taken)
    by_source = {r.source_key: r.n for r in segments.groupBy("source_key").agg(F.sum("n_words").alias("n")).collect()}
    for r in sources.collect():
        assert abs(by_source[r.source_key] - r.target) <= max(32, 0.02 * r.target)
    again = mixing.mix(mixing.numbered(df.repartition(5)), 16)[1].groupBy("source_key").agg(F.sum("n_words").alias("n")).collect()
    assert {r.source_key: r.n for r in again} == by_source
    # Slots draw their shards: even counts for each source, up to what a multinomial draw strays.
    slots = segments.select("source_key", "slot", "shard").distinct().groupBy("source_key", "shard").agg(F.count("*").alias("n")).collect()
    shards = 1 + max(r.shard for r in slots)
    of_source = Counter()
    for r in slots:
        of_source[r.source_key] += r.n
    for r in slots:
        mean = of_source[r.source_key] / shards
        assert abs(r.n - mean) <= 6 * math.sqrt(mean) + 1
    text = {i: t for i, t, _ in rows}
    for r in mixing.mixed_documents(df.withColumn("n_chars", F.lit(1).cast("long")), 16).limit(200).collect():
        assert " ".join(r.text.split()) in text[r.doc_id]
    assert {r.doc_id for r in mixing.mixed_documents(docs, 16).collect()} <= {r[0] for r in document_rows()}
    assert mixing.mixed_documents(no_docs).count() == 0


def test_sharding_keeps_rows_even_and_copies_together(spark, docs, no_docs):
    rows = [(i, f"text {i % 100 if i % 2 else 0 if i < 400 else i}") for i in range(1000)]
    out = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    counts = Counter(r.shard for r in out)
    assert len(out) == 1000 and set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    groups = defaultdict(set)
    text = dict(rows)
    for r in out:
        groups[text[r.doc_id]].add(r.shard)
    odd = [len(groups[f"text {k}"]) for k in range(1, 100, 2)]
    assert sum(odd) / len(odd) < 2  # ten copies each; dealt blindly they would lie in nine shards
    assert len(groups["text 0"]) < 20
    some = sharding.shard_documents(docs).collect()
    assert Counter(r.doc_id for r in some) == Counter(r[0] for r in document_rows())
    assert {r["size"] for r in some if r.doc_id in (5, 6)} == {16}
    assert sharding.shard_documents(no_docs).count() == 0


def test_places_of_more_rows_than_64_bit_products_hold(spark):
    big = 10**12
    ranks = [0, 1, 123_456_789_012, big - 7, big - 1]
    df = spark.createDataFrame([(k,) for k in ranks], "rank long")
    got = {r["rank"]: r.at for r in df.select("rank", sharding._spread("rank", big - 3, big).alias("at")).collect()}
    assert got == {k: k * (big - 3) // big for k in ranks}


def test_sharding_cuts_no_more_groups_than_a_search_of_all_placements(spark):
    """Small tables whose least number of cut groups is found by trying all ways
    to lay whole groups into quotas; propagation may cut one group a shard more."""

    def least_cut(sizes, quota):
        import itertools

        best = len(sizes)
        for places in itertools.product(range(len(quota) + 1), repeat=len(sizes)):  # the last place: cut
            if sum(p == len(quota) for p in places) < best and all(sum(n for n, p in zip(sizes, places, strict=True) if p == s) <= q for s, q in enumerate(quota)):
                best = sum(p == len(quota) for p in places)
        return best

    for seed, singles in ((1, 0), (2, 0), (3, 3), (4, 6)):
        r = random.Random(seed)
        sizes = [r.randint(2, 5) for _ in range(6)]
        texts = [f"group {k}" for k, n in enumerate(sizes) for _ in range(n)] + [f"single {k}" for k in range(singles)]
        r.shuffle(texts)
        out = sharding.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3).collect()
        counts, shards = Counter(x.shard for x in out), defaultdict(set)
        for x in out:
            shards[texts[x.doc_id]].add(x.shard)
        assert max(counts.values()) - min(counts[s] for s in range(3)) <= 1
        cut = sum(len(v) > 1 for v in shards.values())
        assert cut <= least_cut(sizes, sorted(counts.values(), reverse=True)) + 2


def test_sharding_gathers_tables_of_copies_only(spark):
    def pieces(texts):
        out = sharding.shard_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
        counts, shards = Counter(r.shard for r in out), defaultdict(set)
        assert len(out) == len(texts) and len(counts) == 40 and max(counts.values()) - min(counts.values()) <= 1
        for r in out:
            shards[texts[r.doc_id]].add(r.shard)
        return [len(v) for v in shards.values()]

    cut = pieces([f"text {i % 400}" for i in range(4000)])  # every text ten times: there is no room but by exchange
    assert sum(n > 1 for n in cut) < 40
    # Seven tenths of a quota fit one shard.
    assert pieces([f"large {i % 40}" if i < 2800 else f"single {i}" for i in range(4000)]).count(1) == 1240


TURNS = [
    (1, 0, "system", "be # good"), (1, 1, "user", chat.HARD), (1, 2, "assistant", "\\\\ a\\"), (2, 0, "user", None), (2, 1, "assistant", ""),
    (3, None, None, None), (3, 0, "assistant", "x:y é 😀 </turn>\n### user: hi"), (3, 0, "odd: role<#", "tie"), (None, 0, "assistant", "no id"),
    (4, 0, "assistant", "same"), (4, 0, "assistant", "same"),
]


def plain_chat(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t, role or "", text or "") for c, t, role, text in rows if c == conv), key=lambda x: (x[0], x[1] or 0, x[2], x[3]))
        all_turns, loss = "".join(f"{r}\n{t}\n" for _, _, r, t in turns), "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark, monkeypatch):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    digest = lambda d: {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(d).collect()}
    formatted = chat.format_chat(df.withColumn("part", F.lit("clash")))
    assert digest(formatted) == plain_chat(TURNS)
    assert digest(chat.format_chat(df.limit(0))) == {}


def test_long_conversations_go_on_in_parts(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"<{t}> " * 40_000) for c in (1, 2) for t in range(90)] + [(3, 0, "user", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        formatted = chat.format_chat(df).cache()
        assert max(r.part for r in formatted.select("part").collect()) > 0
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain_chat(rows)

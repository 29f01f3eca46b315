"""Phrases, centroids and languages against plain versions."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strandwise.llm import centroids, collocations, languages

from .conftest import document_rows, words


def plain_collocations(rows, least, top):
    f, out = defaultdict(Counter), []
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            ws = re.findall("[^ \t]+", piece)
            for n in range(1, 5):
                for i in range(len(ws) - n + 1):
                    f["und" if lang is None else lang][tuple(ws[i : i + n])] += 1
    for lang, counts in f.items():
        total = sum(c for w, c in counts.items() if len(w) == 1)
        found = {w: c for w, c in counts.items() if len(w) > 1 and c >= least}
        kept = []
        for w, a in found.items():
            score, _, l, r = min((2_000_000 * a // (counts[w[:k]] + counts[w[k:]]), k, counts[w[:k]], counts[w[k:]]) for k in range(1, len(w)))
            inside = lambda long: any(long[i : i + len(w)] == w for i in range(len(long) - len(w) + 1))  # noqa: B023, E731
            if not any(len(long) > len(w) and 100 * b >= 80 * a and inside(long) for long, b in found.items()):
                kept.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, total, -s) for k, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def phrase_rows(seed, n):
    r, vocabulary = random.Random(seed), [f"w{k}é" if k % 5 == 0 else f"w{k}" for k in range(40)]
    fixed = [["Once", "upon", "a", "time"], ["by", "the", "way"], ["w1", "w2"], ["as", "well", "as"], ["a", "a", "a", "a"]]
    out = []
    for i in range(n):
        text = []
        for _ in range(r.randint(0, 30)):
            text += r.choice(fixed) if r.random() < 0.3 else [r.choice(vocabulary)]
            text[-1] += r.choice(["", "", "", ",", ".", "!", "\n", "\r\n", "\t", "  "])
        out.append((" ".join(text), ("en", "fr", None, "und")[i % 4]))
    return out


def test_phrases_equal_a_plain_count(spark, docs, no_docs, monkeypatch):
    rows = [*phrase_rows(4, 400), (None, "en"), ("", "fr"), (" .,; ", "de"), ("long " * 3000 + "word.", "de")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, word string, s1 int").repartition(3)
    want = plain_collocations(rows, 5, 60)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert len(want) > 60
    assert sorted(tuple(r) for r in collocations.collocations(df, least=5, top=60).select(*names).collect()) == want
    # A bitmap that is nearly full, tries of a few phrases, short rows and early sums change nothing.
    for name, value in (("FILTER_BITS", 9), ("TRIE_PHRASES", 40), ("ROW_SYMBOLS", 50), ("HELD_KEYS", 64), ("ROWS", 3), ("PARTS", 2)):
        monkeypatch.setattr(collocations, name, value)
    assert sorted(tuple(r) for r in collocations.collocations(df, least=5, top=60).select(*names).collect()) == want
    assert collocations.collocations(no_docs).count() == 0
    both = sorted((tuple(r) for r in collocations.collocations(docs, least=2).select(*names).collect()))
    assert both == plain_collocations([(r[1], r[2]) for r in document_rows()], 2, 2000)


def test_tries_count_as_a_search_does():
    r = np.random.default_rng(6)
    symbols = r.integers(1, 1 << 63, 300, np.uint64)
    x = symbols[np.minimum(r.zipf(1.3, 20_000), 300) - 1]
    x[r.random(len(x)) < 0.1] = 0
    grams = {tuple(x[i : i + n].tolist()) for i in range(0, 4000) for n in (2, 3, 4) if (x[i : i + n] != 0).all()}
    phrases = np.array([[*g, *[0] * (4 - len(g))] for g in sorted(grams)], np.uint64)
    trie = collocations.Trie(r.permutation(phrases))
    count = Counter(tuple(x[i : i + n].tolist()) for n in (2, 3, 4) for i in range(len(x) - n + 1))
    got = {tuple(s for s in p if s): c for p, c in zip(trie.phrases.tolist(), trie.count(x).tolist(), strict=True)}
    assert got == {g: count[g] for g in grams}
    assert collocations.Trie(phrases[:1]).count(np.zeros(0, np.uint64)).tolist() == [0]


def test_candidates_are_written_where_they_are_owned(spark):
    df = spark.createDataFrame(phrase_rows(4, 400), "text string, lang string").repartition(8)
    ids, words_of = collocations._encoded(df, "lang", "text")
    assert ids.count() >= 8
    keys, phrases, _ = collocations.candidates(ids, words_of, 5)
    # Most phrases lie in all eight files; each is written once all the same.
    assert phrases.count() == phrases.distinct().count() == keys.count() > 60


def test_hashes_are_summed_where_they_were_dealt_to(spark):
    # A sum ahead of the exchange holds all keys of a split in the executor's memory.
    df = spark.createDataFrame(phrase_rows(4, 400), "text string, lang string").repartition(8)
    ids, words_of = collocations._encoded(df, "lang", "text")
    every = spark.sparkContext.broadcast(np.full(1 << (collocations.FILTER_BITS - 6), np.uint64((1 << 64) - 1)))
    hashed = ids.mapInArrow(collocations._counter([every], 0), "key long, n long, owner int")
    summed = collocations.summed_hashes(hashed)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange", 1)
    assert "HashAggregate" in above and "HashAggregate" not in below and "MapInArrow" in below
    want = {}
    for r in hashed.collect():
        n, owner = want.get(r.key, (0, r.owner))
        want[r.key] = (n + r.n, min(owner, r.owner))
    assert {r.key: (r.n, r.owner) for r in summed.collect()} == want


def test_workers_hand_on_in_slices():
    """What a worker needs beside the keys that it holds is a part of them."""

    class Every:
        value = np.full(1 << (collocations.FILTER_BITS - 6), np.uint64((1 << 64) - 1))

    def batches():
        r = np.random.default_rng(8)
        for _ in range(4):
            x = r.integers(1, 1 << 63, 1 << 17, np.uint64)
            x[-1] = 0
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["ids"])

    keys, before = 0, np.uint64(0)
    tracemalloc.start()
    for batch in collocations._counter([Every], 0)(batches()):
        k = batch.column(0).to_numpy().view(np.uint64)
        assert k[0] > before and (k[1:] > k[:-1]).all()
        keys, before = keys + len(k), k[-1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert keys == 4 * ((1 << 17) - 2)
    assert peak < 60 * keys, peak / keys  # a key with count and owner takes 18 bytes


def test_phrases_of_one_hash_are_told_apart(spark):
    a, b, c = np.random.default_rng(7).integers(1 << 40, 1 << 63, 3, np.uint64)
    with np.errstate(over="ignore"):
        d = c + (a - b) * collocations._STEP
    one, other = (np.array([*p, 0] * 6, np.uint64) for p in ((a, c), (b, d)))
    assert collocations.gram_hashes(one, np.array([0]), 2) == collocations.gram_hashes(other, np.array([0]), 2)
    ids = spark.createDataFrame([(bytearray(x.tobytes()),) for x in (one, other)], "ids binary").repartition(2)
    signed = np.array([a, c, b, d], np.uint64).view(np.int64).tolist()
    words_of = spark.createDataFrame([(s, "en", f"w{s}", 6) for s in signed], "symbol long, lang string, word string, n long")
    got = collocations.counted_phrases(ids, words_of, 5).collect()
    assert sorted((r.s1, r.s2, r.s3, r.s4, r.a) for r in got) == sorted([(signed[0], signed[1], 0, 0, 6), (signed[2], signed[3], 0, 0, 6)])


def test_scores_beyond_64_bits(spark):
    a = 10**13
    words_of = spark.createDataFrame([(1, "en", "x", 3 * a), (2, "en", "y", 2 * a + 1)], "symbol long, lang string, word string, n long")
    phrase = spark.createDataFrame([(1, 2, 0, 0, a)], "s1 long, s2 long, s3 long, s4 long, a long")
    got = collocations.scored(phrase, words_of, 30).collect()
    assert [(r.l, r.r, r.score) for r in got] == [(3 * a, 2 * a + 1, 2_000_000 * a // (5 * a + 1))]


def plain_clusters(rows, k, rounds, dimensions):
    kept = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) if i is not None else ("z", v) for i, v in kept))[:k]
    at = [v for _, v in first]
    gap = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((gap(v, c), n) for n, c in enumerate(at))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        at = [tuple(sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)) if n in groups else c for n, c in enumerate(at)]
    final = [(i, *near(v)) for i, v in kept]
    of = Counter()
    for _, d, n in final:
        of[n] += d
    return Counter((i, n, d, of[n], sum(of.values()), hashlib.sha256(",".join(map(str, at[n])).encode()).hexdigest()) for i, d, n in final)


def test_clusters_equal_a_plain_run(spark):
    r = random.Random(9)
    rows = [(i, [float(np.float32(r.gauss((i % 5) - 2, 0.6))) for _ in range(6)]) for i in range(300)]
    rows += rows[:7]  # repeated rows
    rows += [(1000 + i, rows[3][1]) for i in range(20)]  # one vector many times
    rows += [(2000, None), (2001, [1.0] * 5), (2002, [1.0] * 7), (2003, [1.0] * 5 + [None]), (2004, [float("nan")] * 6), (2005, [float("inf")] + [0.0] * 5), (2006, []), (None, [0.5] * 6), (2007, [0.0] * 6), (2008, [-0.0001] * 6)]
    df = spark.createDataFrame([(*x, "a", 2) for x in rows], "vec_id long, embedding array<float>, x string, cluster int").repartition(3)
    for k, rounds in ((8, 10), (3, 1), (500, 2)):
        out, at = centroids.cluster(df, centroids=k, rounds=rounds, dimensions=6)
        assert Counter(tuple(x) for x in out.collect()) == plain_clusters(rows, k, rounds, 6)
    empty, at = centroids.cluster(df.limit(0), dimensions=6)
    assert empty.count() == 0 and at == [] and empty.columns == out.columns


STEMS = {"aa": ("th", "er", "on", "an", "ing", "ed"), "bb": ("sch", "ung", "ver", "ein", "ich", "ü"), "cc": ("ción", "os", "que", "ar", "la", "ñ")}


def spoken(n):
    rows = []
    for i in range(n):
        lang = sorted(STEMS)[i % 3]
        text = " ".join(words(8 + i % 60, i, STEMS[lang]))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang, f"src{i % 4}"))
    return rows


def test_languages_of_texts_that_were_not_learned_from(spark, no_docs, tmp_path):
    rows = spoken(600)
    odd = [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "123 !? 456", "bb", "s"), (None, rows[1][1], None, None), (1003, rows[2][1], None, None)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([*rows, *rows[:3], *odd], "doc_id long, text string, lang string, source string").write.parquet(path)
    out = languages.op13_languages(spark, str(tmp_path)).collect()
    assert len(out) == 608 and all(0 <= r.score <= 1 for r in out)
    held = {r.doc_id: r for r in out if r.held_out}
    assert set(held) == {r[0] for r in [*rows, *odd] if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1}
    truth = {r[0]: r[2] for r in rows}
    right = [r.lang_pred == truth[d] for d, r in held.items() if d in truth]
    assert sum(right) >= 0.98 * len(right)
    assert all(r.lang_pred == truth[d] for d, r in held.items() if d in truth and r.accepted)
    assert {r.doc_id: (r.lang_pred, r.score, r.accepted) for r in out if r.doc_id in (1000, 1001, 1002)} == {k: ("und", 0.0, False) for k in (1000, 1001, 1002)}
    assert {r.lang_pred for r in out} == {"aa", "bb", "cc", "und"}


def test_a_prediction_reads_the_text_only(spark, docs, no_docs):
    df = spark.createDataFrame(spoken(300), "doc_id long, text string, lang string, source string")
    known = languages.learned(df)
    again = languages.learned(df.withColumns({"doc_id": -F.col("doc_id"), "source": F.lit("s"), "TEXT2": F.lit(1)}).repartition(5))
    assert known == again and list(known) == ["aa", "bb", "cc"]
    wrong = df.withColumns({"lang": F.lit("cc"), "source": F.lit(None).cast("string")})
    got = [{(r.text, r.p.lang_pred, r.p.score) for r in x.select("text", languages.identify(F.col("text"), known, spark).alias("p")).collect()} for x in (df, wrong)]
    assert got[0] == got[1]
    assert languages.learned(no_docs) == {} and {r.p.lang_pred for r in docs.select(languages.identify(F.col("text"), {}, spark).alias("p")).collect()} == {"und"}
    one = languages.learned(docs)
    assert list(one) == ["en"]
    assert {(r.p.lang_pred, r.p.score) for r in docs.where("doc_id = 1").select(languages.identify(F.col("text"), one, spark).alias("p")).collect()} == {("en", 0.0)}


def test_copies_and_long_texts_in_the_sample(spark, monkeypatch):
    """A text that a third of all rows hold counts once; more languages than may be broadcast are an error."""
    rows = [*spoken(90), *[(5000 + i, "the very same text", "aa", "s") for i in range(60)], (9000, "verein " * 20_000, "bb", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    known = languages.learned(df)
    assert known["aa"].count(b"the very same text") == 1 and all(len(v) <= languages.DICTIONARY_BYTES for v in known.values())
    assert list(known)[0] == "aa"
    monkeypatch.setattr(languages, "MOST_LANGUAGES", 2)
    try:
        languages.learned(df)
    except ValueError:
        return
    raise AssertionError("no error")

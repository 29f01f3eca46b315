"""Quality rules, token counts, binary output and line dedup."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandwise.llm import binary_output, common, line_dedup, near_dedup, pretokens, quality, token_counts
from strandwise.llm.common import shared_dir

from .conftest import document_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(text):
    ws = WORD.findall(text or "")
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_quality_equals_a_plain_count(docs, no_docs):
    got = docs.select("doc_id", "text", quality.quality("text").alias("q")).collect()
    assert len(got) == len(document_rows())
    for r in got:
        q = r.q
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == plain_quality(r.text)
        assert not (q.base_failed and q.kept)
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert {1, 3, 4, 18, 19, 20} <= kept and not kept & {5, 6, 7, 8, 14, 15, 17}
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(no_docs).count() == 0


def test_token_counts_equal_the_library(docs, no_docs):
    path = public_tokenizers.path(token_counts.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    want = Counter((r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in document_rows())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, path).collect()) == want
    assert token_counts.count_tokens(no_docs, path).count() == 0


def hard_words():
    """A word of two letters and its complement, alike to any polynomial modulo 2**64."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_are_hard_to_tell_apart(spark):
    one, other = hard_words()
    own = " ".join(words(60, 77))
    texts = [f"{one}\n{other}\n{own}", one, other, f"{one} {other} x y {one} {other} z", f"{other}\n{one}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("text", quality.quality("text").alias("q")).collect():
        q = r.q
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == plain_quality(r.text)
    assert {r.doc_id: r.component_id for r in near_dedup.components(df).collect()} == {i: i for i in range(len(texts))}
    path = public_tokenizers.path(token_counts.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df, path).collect()} == {i: len(tokenizer.encode(t).ids) for i, t in enumerate(texts)}
    path = public_tokenizers.path(binary_output.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    at = binary_output.write_records(df, path, shared_dir(spark))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in binary_output.read_records(spark, at, with_ids=True).collect()}
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_equal_hashes_of_unequal_strings_are_seen(monkeypatch):
    path = public_tokenizers.path(token_counts.TOKENIZER)
    data = np.frombuffer(b"some words and some other words", np.uint8)
    want = pretokens.Block(data, np.array([0, len(data)]), path)
    real = pretokens.byte_hashes
    monkeypatch.setattr(pretokens, "byte_hashes", lambda d, s, e, seed=0: real(d, s, e, seed) if seed else np.zeros(len(s), np.uint64))
    got = pretokens.Block(data, np.array([0, len(data)]), path)
    assert [got.strings(got.first)[i] for i in got.which] == [want.strings(want.first)[i] for i in want.which]


def test_offsets_in_levels(spark, monkeypatch):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("n"))
    flat = sorted(common.distributed_offsets(df, ["k"], ["id"], "n", "at", 200).collect())
    monkeypatch.setattr(common, "FAN", 4)
    assert sorted(common.distributed_offsets(df, ["k"], ["id"], "n", "at", 200).collect()) == flat
    for k in range(3):
        at = 0
        for r in sorted((r for r in flat if r.k == k), key=lambda r: r["at"]):
            assert at <= r["at"] or r.n == 0
        assert max(r["at"] + r.n for r in flat if r.k == k) == sum(r.n for r in flat if r.k == k)


def test_far_apart_ids_and_high_counts(spark):
    path = public_tokenizers.path(token_counts.TOKENIZER)
    rows = [(-(1 << 62), "x " * 1000), (1 << 62, "y"), (5, "x y")]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    tokenizer = Tokenizer.from_file(path)
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(tokenizer.encode(t).ids) for i, t in rows}


def test_records_round_trip(spark, docs, no_docs):
    path = public_tokenizers.path(binary_output.TOKENIZER)
    tokenizer = Tokenizer.from_file(path)
    at = binary_output.write_records(docs, path, shared_dir(spark))
    index = {(r.file_no, r.offset): r.start for r in spark.read.parquet(f"{at}/index").collect()}
    got = sorted(((index[r.file_no, r.offset], r) for r in binary_output.read_records(spark, at, with_ids=True).collect()), key=lambda x: x[0])
    rows = sorted(document_rows(), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    assert [r.doc_id for _, r in got] == [r[0] for r in rows]
    start = 0
    for (s, r), (_, text, *_) in zip(got, rows, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        raw = np.array(ids, "<u4").tobytes()
        assert (s, r.n_tokens, bytes(r.ids), r.ids_crc32) == (start, len(ids), raw, zlib.crc32(raw))
        start += len(ids)
    empty = binary_output.write_records(no_docs, path, shared_dir(spark))
    assert binary_output.read_records(spark, empty).count() == 0


def test_damage_is_found():
    good = binary_output.frame(7, 2, b"\1\0\n\0") + b"\n" + binary_output.frame(None, 2, b"") + b"\n"
    assert [(d, bytes(ids)) for _, _, d, _, ids in binary_output.frames(good)] == [(7, b"\1\0\n\0"), (None, b"")]
    for k in range(len(good)):
        bad = bytearray(good)
        bad[k] ^= 4
        with pytest.raises(ValueError):
            list(binary_output.frames(bytes(bad)))


def plain_line_dedup(rows, single_lines=False):
    import hashlib

    number = lambda line: int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
    size = lambda line: len(WORD.findall(line))
    split = {}
    for doc_id, text in rows:  # lines with a word, each with the blank ones after it
        units = [[]]
        for line in text.split("\n"):
            if size(line):
                units.append([])
            units[-1].append(line)
        split[doc_id] = units[0], units[1:]
    often = Counter(u[0] for _, units in split.values() for u in units)
    chunks = []
    for doc_id, _ in rows:
        lines, i = [u[0] for u in split[doc_id][1]], 0
        while i < len(lines):
            start = i
            while i < len(lines) and often[lines[i]] > 1 and often[lines[i]] == often[lines[start]]:
                i += 1
            cuts = [start]
            for k in range(start + 1, i):
                rolling = 0
                for back in range(line_dedup.WINDOW, 0, -1):
                    rolling = (rolling * line_dedup.MULTIPLIER + number(lines[k - back])) % line_dedup.PRIME if k - back >= start else 1
                long = max(size(lines[k]), size(lines[k - 1])) >= line_dedup.LONG_WORDS
                if long or (k - start >= line_dedup.WINDOW and rolling % line_dedup.DIVISOR == 0):
                    cuts.append(k)
            chunks += [(doc_id, a, b, "\n".join(lines[a:b])) for a, b in zip(cuts, [*cuts[1:], i], strict=True) if a < b]
            i = max(i, start + 1)
    seen, later = set(), defaultdict(list)
    for doc_id, a, b, body in sorted(chunks):
        if body in seen:
            later[doc_id].append((a, b))
        seen.add(body)
    left = {}
    for doc_id, _ in rows:
        before, units = split[doc_id]
        lines, islands, units = [u[0] for u in units], [], units.copy()
        for a, b in later[doc_id]:
            if islands and islands[-1][-1][1] == a:
                islands[-1].append((a, b))
            else:
                islands.append([(a, b)])
        for island in islands:
            words = sum(size(x) for x in lines[island[0][0] : island[-1][1]])
            whole = island[-1][1] - island[0][0] >= 2 and words >= line_dedup.LONG_WORDS
            for a, b in island:
                if b - a >= 2 or whole or (single_lines and size(lines[a]) >= line_dedup.LONG_WORDS):
                    units[a:b] = [[]] * (b - a)
        left[doc_id] = "\n".join([*before, *(x for u in units for x in u)])
    return left


def test_line_dedup_equals_a_plain_pass(docs, no_docs):
    rows = {r[0]: r[1] for r in document_rows() if r[0] is not None and r[1] is not None}
    want = plain_line_dedup(sorted(rows.items()))
    out = line_dedup.dedup_lines(docs)
    got = {r.doc_id: r.text for r in out.collect()}
    assert {k: got[k] for k in want} == want
    assert got[6] is None and got[None] == "no id here" and got[4] == got[1] and out.count() == docs.count()
    single = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, single_lines=True).collect()}
    assert {k: single[k] for k in want} == plain_line_dedup(sorted(rows.items()), True) and single[4] == ""
    assert out.columns == docs.columns
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_a_shared_passage_leaves_later_documents(spark):
    passage = "\n".join(f"line {i} of the passage that many documents share {i * i}" for i in range(30))
    rows = [(i, f"own {i} start\nmore {i}\n{passage}\nend {i}") for i in range(20)]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1]
    for i in range(1, 20):
        assert f"own {i} start" in out[i] and f"end {i}" in out[i] and len(out[i].split("\n")) < 14


def test_short_passages_between_own_lines_go(spark):
    """Passages of two to five lines with 50 words together, each in three documents."""
    rows, passages = [], []
    for k in range(24):
        n = 2 + k % 4
        passages.append("\n".join(" ".join(words(60 // n, 1000 * k + i)) for i in range(n)))
        rows += [(3 * k + c, f"own {k} {c} first\nown {k} {c} second\n{passages[-1]}\nown {k} {c} last") for c in range(3)]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        own = "\n".join(x for x in text.split("\n") if x.startswith("own"))
        assert out[i] == (text if i % 3 == 0 else own)
    assert out == plain_line_dedup(rows)


def test_passages_beside_blank_and_common_lines_go(spark):
    """One copy of each passage stands beside a blank line, or beside a line that
    twenty documents have; the other between own lines."""
    rows = [(1000 + i, f"a line that many have\nonly {i}") for i in range(20)]
    passages = ["\n".join(" ".join(words(13, 7000 * k + i)) for i in range(4)) for k in range(60)]
    for k, passage in enumerate(passages):
        beside = ("", "   ", "a line that many have")[k % 3]
        rows += [(2 * k, f"own {k} first\n{passage}\nown {k} last"), (2 * k + 1, f"own {k} other\n{beside}\n{passage}\n{beside}\nown {k} end")]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == plain_line_dedup(sorted(rows))
    for k, passage in enumerate(passages):
        assert passage in out[2 * k] and not set(passage.split("\n")) & set(out[2 * k + 1].split("\n"))
        assert {f"own {k} other", f"own {k} end"} <= set(out[2 * k + 1].split("\n"))

"""Quality rules by repetition coverage.

Words, lines and n-grams of whole texts are hashed with one rolling hash in
numpy; repeated hashes inside a document are found by sorting. A repeated
(n+1)-gram starts with a repeated n-gram, so longer windows are only looked
for where the shorter one repeats.

Defined results: a null or empty text has no words, symbols or lines and fails
the base rules; repeated rows give equal rows; a table without rows gives
none; other columns, whatever their names, are neither read nor changed.
Lines are the parts between newlines; lines without a word don't count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, by_position, byte_hashes, mix, rolling_hashes, table, utf8_rows, word_spans

#: Percent of a document's word characters that repeated n-grams may cover, by n.
NGRAM_LIMITS = {5: 30, 6: 28, 7: 26, 8: 24, 9: 22, 10: 20}
#: Percent of lines, and of word characters in lines, that may repeat an earlier line.
LINE_LIMIT, LINE_CHAR_LIMIT = 50, 30
#: Symbols for a hundred words that a kept text may have.
SYMBOL_LIMIT = 10
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_N = 50, 50, 3
SYMBOLS = b"#*$%&|<>"

FIELDS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words", *[f"dup_chars_{n}" for n in NGRAM_LIMITS]]
SCHEMA = T.StructType([*[T.StructField(f, T.LongType()) for f in FIELDS], T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more; is it not the first."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def measure(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The FIELDS of each row of a block of UTF-8 texts."""
    rows = len(bounds) - 1
    per_row = lambda row, weight=None: np.bincount(row, weight, rows).astype(np.int64)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    symbol = np.zeros(len(data) + 1, np.int64)
    np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), out=symbol[1:])
    s, e, row = word_spans(data, bounds)
    chars = lead[e] - lead[s]
    out = {"n_words": per_row(row), "word_chars": per_row(row, chars), "n_symbols": symbol[bounds[1:]] - symbol[bounds[:-1]]}

    first = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(data == 10) + 1]))
    first = first[first < len(data)]
    last = np.append(first[1:], len(data))[: len(first)]
    last = last - (data[last - 1] == 10) if len(first) else last
    from_word, to_word = np.searchsorted(s, first), np.searchsorted(s, last)
    full = to_word > from_word
    first, last, from_word, to_word = first[full], last[full], from_word[full], to_word[full]
    line_row = row[from_word] if len(first) else np.zeros(0, np.int64)
    _, later = _repeated(mix(byte_hashes(data, first, last) ^ mix(line_row.astype(np.uint64))))
    word_sum = np.append(0, np.cumsum(chars))
    out |= {"n_lines": per_row(line_row), "n_dup_lines": per_row(line_row[later]), "dup_line_chars": per_row(line_row[later], (word_sum[to_word] - word_sum[from_word])[later])}

    words = byte_hashes(data, s, e)
    at = np.arange(len(s))
    for n in [REPEAT_N, *NGRAM_LIMITS]:
        at = at[at + n <= len(s)]
        at = at[row[at] == row[at + n - 1]]
        twice, _ = _repeated(mix(rolling_hashes(words, at, at + n) ^ mix(row[at].astype(np.uint64))))
        at = at[twice]
        edge = np.bincount(at, minlength=len(s) + 1) - np.bincount(at + n, minlength=len(s) + 1)[: len(s) + 1]
        covered = np.cumsum(edge)[: len(s)] > 0
        if n == REPEAT_N:
            out["n_repeat_words"] = per_row(row[covered])
        else:
            out[f"dup_chars_{n}"] = per_row(row[covered], chars[covered])
    return out


def judge(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    repetitive = (100 * m["n_dup_lines"] > LINE_LIMIT * m["n_lines"]) | (100 * m["dup_line_chars"] > LINE_CHAR_LIMIT * m["word_chars"]) | (100 * m["n_symbols"] > SYMBOL_LIMIT * m["n_words"])
    for n, limit in NGRAM_LIMITS.items():
        repetitive |= 100 * m[f"dup_chars_{n}"] > limit * m["word_chars"]
    return {"base_failed": failed, "kept": ~failed & ~repetitive}


@F.arrow_udf(SCHEMA)
def _quality(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        data, bounds = utf8_rows(column)
        parts = []
        for i, j in blocks(np.diff(bounds)):
            at = bounds[i : j + 1]
            parts.append(measure(data[at[0] : at[-1]], at - at[0]))
        m = {f: np.concatenate([p[f] for p in parts]) if parts else np.zeros(0, np.int64) for f in FIELDS}
        v = judge(m)
        names = [*FIELDS, "base_failed", "kept"]
        yield pa.StructArray.from_arrays([pa.array((m | v)[f]) for f in names], names)


def quality(text: str | Column) -> Column:
    """Struct of the FIELDS, base_failed and kept for a text column."""
    return _quality(text)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text the rules keep."""
    plain, (at,) = by_position(docs, text)
    return plain.where(quality(F.col(at)).getField("kept")).toDF(*docs.columns)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", quality("text").alias("q"))
    return docs.select("doc_id", *[f"q.{f}" for f in [*FIELDS, "base_failed", "kept"]])


def op9_sql() -> str:
    grams = ",\n".join(
        f"""d{n} AS (SELECT doc_id, sum(length(w)) AS c FROM (
  SELECT w.doc_id, w.i, any_value(w.w) AS w FROM words w JOIN (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
      SELECT doc_id, i, list_slice(ws, i, i + {n - 1}) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM t WHERE len(ws) >= {n})))
    WHERE c > 1) r ON w.doc_id = r.doc_id AND w.i BETWEEN r.i AND r.i + {n - 1} GROUP BY w.doc_id, w.i) GROUP BY doc_id)"""
        for n in NGRAM_LIMITS
    )
    cols = ", ".join(f"coalesce(d{n}.c, 0)::BIGINT AS dup_chars_{n}" for n in NGRAM_LIMITS)
    joins = " ".join(f"LEFT JOIN d{n} ON d{n}.doc_id = t.doc_id" for n in NGRAM_LIMITS)
    bad = " OR ".join(f"100 * dup_chars_{n} > {limit} * word_chars" for n, limit in NGRAM_LIMITS.items())
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM t),
rep AS (SELECT doc_id, count(*) AS n FROM (
  SELECT DISTINCT w.doc_id, w.i FROM words w JOIN (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
      SELECT doc_id, i, list_slice(ws, i, i + 2) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t WHERE len(ws) >= 3)))
    WHERE c > 1) r ON w.doc_id = r.doc_id AND w.i BETWEEN r.i AND r.i + 2) GROUP BY doc_id),
lines AS (SELECT doc_id, l, k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS k FROM t) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (rn > 1) AS n_dup, sum(length(regexp_replace(l, '[\\x20\\x09-\\x0D]', '', 'g'))) FILTER (rn > 1) AS c
  FROM (SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id, l ORDER BY k) AS rn FROM lines) GROUP BY doc_id),
{grams},
m AS (SELECT t.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
  coalesce(ln.c, 0)::BIGINT AS dup_line_chars, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, {cols}
  FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id LEFT JOIN ln ON ln.doc_id = t.doc_id {joins}),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT (100 * n_dup_lines > {LINE_LIMIT} * n_lines OR 100 * dup_line_chars > {LINE_CHAR_LIMIT} * word_chars OR 100 * n_symbols > {SYMBOL_LIMIT} * n_words OR {bad}) AS kept FROM b"""

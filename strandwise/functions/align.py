"""Small vectorised helpers for pairs of sequences: Hamming rows, global
alignment of a pair, and the errors of an aligned pair."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MATCH, MISMATCH, GAP = 1, -1, -2


def rows_of(seqs: list[str]) -> np.ndarray:
    """Byte matrix of equal-length sequences."""
    return np.frombuffer("".join(seqs).encode("latin-1"), np.uint8).reshape(len(seqs), -1)


def texts_of(rows: np.ndarray) -> list[str]:
    """The sequences of a byte matrix."""
    width = rows.shape[1]
    text = np.ascontiguousarray(rows).tobytes().decode("latin-1")
    return [text[k : k + width] for k in range(0, len(text), width)] if width else [""] * len(rows)


def global_alignment(a: str, b: str) -> tuple[str, str]:
    """Needleman-Wunsch with linear gaps; equal lengths with few differences stay ungapped."""
    if len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= max(2, len(a) // 10):
        return a, b
    n, m = len(a), len(b)
    x, y = np.frombuffer(a.encode("latin-1"), np.uint8), np.frombuffer(b.encode("latin-1"), np.uint8)
    score = np.zeros((n + 1, m + 1), np.int32)
    score[:, 0], score[0] = np.arange(n + 1) * GAP, np.arange(m + 1) * GAP
    ramp = np.arange(m + 1) * GAP
    for i in range(1, n + 1):
        best = np.empty(m + 1, np.int32)
        best[0] = score[i, 0]
        best[1:] = np.maximum(score[i - 1, :-1] + np.where(y == x[i - 1], MATCH, MISMATCH), score[i - 1, 1:] + GAP)
        score[i] = np.maximum.accumulate(best - ramp) + ramp  # gaps along the row
    p, q, i, j = [], [], n, m
    while i or j:
        if i and j and score[i, j] == score[i - 1, j - 1] + (MATCH if x[i - 1] == y[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
            p.append(a[i])
            q.append(b[j])
        elif i and score[i, j] == score[i - 1, j] + GAP:
            i -= 1
            p.append(a[i])
            q.append("-")
        else:
            j -= 1
            p.append("-")
            q.append(b[j])
    return "".join(reversed(p)), "".join(reversed(q))


def errors_of(aligned: str, ref: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """1-based columns of substitutions, insertions and deletions against an aligned
    reference, and of those indels that lie in a run of three equal bases or more."""
    subs, ins, dels, homo = [], [], [], []
    plain = {i for text in (aligned, ref) for m in re.finditer(r"([ACGT])\1{2,}", text.replace("-", "")) for i in range(*m.span())}
    at_q = at_r = 0
    for k, (x, y) in enumerate(zip(aligned, ref, strict=True), 1):
        if x == "-" or y == "-":
            (dels if x == "-" else ins).append(k)
            if (at_r if x == "-" else at_q) in plain:
                homo.append(k)
        elif x != y:
            subs.append(k)
        at_q += x != "-"
        at_r += y != "-"
    return subs, ins, dels, homo


@lru_cache(1 << 16)
def compare_pair(seq: str, ref: str) -> tuple[int, int, int, int, int, int]:
    """Identical columns, all columns, substitutions, insertions, deletions, homopolymer indels."""
    a, b = global_alignment(seq, ref)
    subs, ins, dels, homo = errors_of(a, b)
    return len(a) - len(subs) - len(ins) - len(dels), len(a), len(subs), len(ins), len(dels), len(homo)


_ERRORS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("ident", "aligned", "subs", "ins", "dels", "homo")])
_ALIGNED = T.StructType([T.StructField(n, T.StringType()) for n in ("q_aln", "s_aln")])


@F.pandas_udf(_ERRORS)
def pair_errors(seq: pd.Series, ref: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([compare_pair(a, b) for a, b in zip(seq, ref, strict=True)], columns=_ERRORS.names)


_POSITIONS = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("subs", "ins", "dels", "homo")])


@F.pandas_udf(_POSITIONS)
def error_positions(aligned: pd.Series, ref: pd.Series) -> pd.DataFrame:
    """1-based columns of the errors of an aligned pair, by kind."""
    return pd.DataFrame([errors_of(a, b) for a, b in zip(aligned, ref, strict=True)], columns=_POSITIONS.names)


@F.pandas_udf(_ALIGNED)
def pair_alignment(seq: pd.Series, ref: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([global_alignment(a, b) for a, b in zip(seq, ref, strict=True)], columns=_ALIGNED.names)


_STAR = T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("slot", T.IntegerType()), T.StructField("base", T.StringType())]))


@F.pandas_udf(_STAR)
def star_columns(aligned: pd.Series, ref: pd.Series) -> pd.Series:
    """The letters of an aligned pair by place: pos is the base of the reference (from
    1) with slot 0, or the base before an insertion with its number in it."""

    def one(a: str, b: str) -> list[dict]:
        out, pos, slot = [], 0, 0
        for x, y in zip(a, b, strict=True):
            pos, slot = (pos, slot + 1) if y == "-" else (pos + 1, 0)
            out.append({"pos": pos, "slot": slot, "base": x})
        return out

    return pd.Series([one(a, b) for a, b in zip(aligned, ref, strict=True)])


def with_pair_errors(rows: DataFrame, seq: str, ref: str) -> DataFrame:
    """Adds ``e``, the errors of ``seq`` against ``ref``. Each distinct pair is aligned once."""
    once = rows.select(seq, ref).distinct().withColumn("e", pair_errors(seq, ref))
    return rows.join(once, [seq, ref])

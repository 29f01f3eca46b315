r"""Chat formatting by columnar byte assembly.

A turn becomes ``### role: text</turn>`` and a newline. Inside role and text
every ``\``, ``#`` and ``<`` (in the role ``:`` too) gets a ``\`` before it, so
neither control string can occur in them and removing each escaping ``\``
gives the text back. For a batch of turns the lengths of all segments,
their offsets and the place of every byte are computed in numpy, and headers
and contents are copied into one buffer that becomes the Arrow column.

A conversation is one row; beyond PART_BYTES it goes on in further rows
(``part``), so a task holds a bounded piece of however long a conversation.

Defined results: turns go by (turn, role, text), nulls first; a null text or
role counts as empty; repeated rows are turns of their own; rows with a null
conv_id make one conversation; an empty table gives none; other columns aren't
read. The loss mask covers the texts of ``assistant`` turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, utf8_rows

HEAD, BETWEEN, END = b"### ", b": ", b"</turn>\n"
ESCAPED, ESCAPED_IN_ROLE = b"\\#<", b"\\#<:"
LEARNED = "assistant"
PART_BYTES = 8 << 20
FORMATTED = "conv_id long, part int, n_turns long, formatted string, loss_starts array<long>, loss_lengths array<long>"


def _place(out: np.ndarray, at: np.ndarray, data: np.ndarray, bounds: np.ndarray, special: np.ndarray) -> None:
    """Copies each row of ``data`` to out[at[row]:], a backslash before each special byte."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    before = np.append(0, np.cumsum(special))
    to = np.arange(len(data)) + (at - bounds[:-1] - before[bounds[:-1]])[row] + before[1:]
    out[to] = data
    out[to[special] - 1] = ord("\\")


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all turns, where each turn begins (and the last ends),
    and start and length of each escaped text."""
    sides = []
    for column, marks in ((roles, ESCAPED_IN_ROLE), (texts, ESCAPED)):
        data, bounds = utf8_rows(column)
        special = np.isin(data, np.frombuffer(marks, np.uint8))
        added = np.append(0, np.cumsum(special))
        sides.append((data, bounds, special, np.diff(bounds) + np.diff(added[bounds])))
    (role, role_bounds, role_special, role_length), (text, text_bounds, text_special, text_length) = sides
    length = len(HEAD) + role_length + len(BETWEEN) + text_length + len(END)
    begin = np.append(0, np.cumsum(length))
    out = np.empty(begin[-1], np.uint8)
    at = begin[:-1]
    out[at[:, None] + np.arange(len(HEAD))] = np.frombuffer(HEAD, np.uint8)
    _place(out, at + len(HEAD), role, role_bounds, role_special)
    at = at + len(HEAD) + role_length
    out[at[:, None] + np.arange(len(BETWEEN))] = np.frombuffer(BETWEEN, np.uint8)
    start = at + len(BETWEEN)
    _place(out, start, text, text_bounds, text_special)
    out[(start + text_length)[:, None] + np.arange(len(END))] = np.frombuffer(END, np.uint8)
    return out, begin, start, text_length


def _rows(turns: pa.Table, firsts: np.ndarray, parts: list[int]) -> pa.RecordBatch:
    """A formatted row for the turns from each of ``firsts`` to the next."""
    roles, texts = turns.column("role").combine_chunks(), turns.column("text").combine_chunks()
    out, begin, start, length = assemble(roles, texts)
    cuts = np.append(firsts, len(turns))
    learned = np.flatnonzero(pc.fill_null(pc.equal(roles, LEARNED), False).to_numpy(zero_copy_only=False))
    conv = np.searchsorted(firsts, learned, side="right") - 1
    spans = np.searchsorted(conv, np.arange(len(firsts) + 1)).astype(np.int32)
    formatted = pa.Array.from_buffers(pa.large_string(), len(firsts), [None, pa.py_buffer(begin[cuts].astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
    starts = pa.ListArray.from_arrays(pa.array(spans), pa.array(start[learned] - begin[firsts][conv]))
    lengths = pa.ListArray.from_arrays(pa.array(spans), pa.array(length[learned]))
    ids = turns.column("conv_id").combine_chunks().take(pa.array(firsts))
    return pa.RecordBatch.from_arrays([ids, pa.array(parts, pa.int32()), pa.array(np.diff(cuts)), formatted, starts, lengths], ["conv_id", "part", "n_turns", "formatted", "loss_starts", "loss_lengths"])


def _begins(ids: pa.ChunkedArray) -> np.ndarray:
    null = ids.is_null().to_numpy()
    value = pc.fill_null(ids, 0).to_numpy()
    return np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (null[1:] != null[:-1])))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None  # turns of the last conversation, which may go on
    last, part = None, 0  # the conversation that was handed out in parts, and its next part
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = pa.Table.from_batches([batch])
        turns = turns if held is None else pa.concat_tables([held, turns])
        begins = _begins(turns.column("conv_id"))
        first = part if part and turns.column("conv_id")[0].as_py() == last else 0
        if len(begins) > 1:
            yield _rows(turns.slice(0, begins[-1]), begins[:-1], [first, *[0] * (len(begins) - 2)])
            first = 0
        held, part = turns.slice(begins[-1]), first
        last = held.column("conv_id")[0].as_py()
        if held.nbytes > PART_BYTES:
            yield _rows(held, np.array([0]), [part])
            held, part = None, part + 1
    if held is not None:
        yield _rows(held, np.array([0]), [part])


def format_chat(conversations: DataFrame) -> DataFrame:
    """Rows of FORMATTED; loss spans are bytes of ``formatted``."""
    spark = conversations.sparkSession
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = turns.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format, FORMATTED)


_TURN = re.compile(rb"### ((?:[^\\#<:]+|\\.)*): ((?:[^\\#<]+|\\.)*)</turn>\n", re.DOTALL)
_ESCAPE = re.compile(rb"\\(.)", re.DOTALL)


def unescaped(data: bytes) -> bytes:
    return _ESCAPE.sub(rb"\1", data)


def parse(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(role, text) of each turn; a ValueError names bytes that are no turn."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at byte {at}")
        yield unescaped(m[1]), unescaped(m[2])
        at = m.end()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose parts follow each other; state is one conversation's hashes."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    current: list | None = None
    done: list[tuple] = []

    def close() -> None:
        conv_id, n, turns, chars, loss, formatted = current
        done.append((conv_id, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

    def flush() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for conv_id, part, formatted, starts, lengths in zip(*(batch.column(c) for c in ("conv_id", "part", "formatted", "loss_starts", "loss_lengths")), strict=True):
            if part.as_py() == 0:
                if current:
                    close()
                current = [conv_id.as_py(), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            data = formatted.as_buffer().to_pybytes()
            for role, text in parse(data):
                current[1] += 1
                current[2].update(b"%b\n%b\n" % (role, text))
            for s, n in zip(starts.as_py(), lengths.as_py(), strict=True):
                text = unescaped(data[s : s + n])
                current[3] += len(text.decode())
                current[4].update(text)
            current[5] += len(data.decode())
        if done:
            yield flush()
            done.clear()
    if current:
        close()
        yield flush()


def digests(formatted: DataFrame) -> DataFrame:
    spark = formatted.sparkSession
    dealt = formatted.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


HARD = "\\### Assistant: </turn> ok"


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.createDataFrame([(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return digests(materialise(format_chat(rows)))


def op8_sql() -> str:
    def more(column: str, marks: str) -> str:
        return f"(length({column}) - length(translate({column}, '{marks}', '')))"

    fixed = len(HEAD) + len(BETWEEN) + len(END)
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{HARD}' UNION ALL SELECT -7, 1, 'assistant', '{HARD}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
  sum({fixed} + length(role) + {more("role", ESCAPED_IN_ROLE.decode())} + length(text) + {more("text", ESCAPED.decode())})::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""

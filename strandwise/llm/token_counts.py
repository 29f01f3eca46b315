"""Token counts without token ids.

Each block of documents gives its distinct pre-tokens with postings (row,
frequency). Pieces are counted once per distinct pre-token; a join on the
pre-token brings the counts to the postings, whose products are summed per
row. A pre-token that every document holds meets as one row per block. The
rows' ids and sizes travel with the postings, so that texts are read once.

Defined results: a null text counts as empty (0 bytes, 0 tokens); each row of
the documents has a row of the result, also where doc_ids repeat or are null;
an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, mix, table, utf8_rows
from .pretokens import Block, as_byte_letters, load

TOKENIZER = "byte_bpe_50k.json"
MOST_TOKENS = 1024
#: Characters of text whose postings share rows; a bound of a task's memory.
POSTING_CHARS = 24 << 20
#: Sums that a task keeps before it hands them on.
MOST_SUMS = 4_000_000

_FREQ = T.StructType([T.StructField("pretoken", T.StringType(), False), T.StructField("base", T.LongType(), False), T.StructField("posting", T.BinaryType(), False)])

_SUMS = ["doc_group", "docs", "tokens", "about"]


def _postings(names: dict[str, int], numbers: list, docs: list, counts: list) -> pa.RecordBatch:
    """A row for each pre-token. Its posting: the rows as unsigned
    differences from base (2, 4 or 8 bytes each), their counts (a byte each)
    and a byte with the width; larger counts are told in further entries."""
    h, d, c = np.concatenate(numbers), np.concatenate(docs), np.concatenate(counts)
    while (big := c > 255).any():
        h, d = np.append(h, h[big]), np.append(d, d[big])
        c = np.append(np.where(big, 255, c), c[big] - 255)
    order = np.lexsort((d, h))
    h, d, c = h[order], d[order], c[order].astype(np.uint8)
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    base = d.min()
    away = d.astype(np.uint64) - base.astype(np.uint64)  # modulo 2**64
    width = next(w for w in (2, 4, 8) if w == 8 or int(away.max()) < 1 << 8 * w)
    number = np.diff(np.append(first, len(h)))
    size = number * (width + 1) + 1
    start = np.append(0, np.cumsum(size))
    out = np.empty(start[-1], np.uint8)
    nth = np.arange(len(h)) - np.repeat(first, number)
    at = np.repeat(start[:-1], number) + nth * width
    for k, byte in enumerate(away.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]):
        out[at + k] = byte
    out[np.repeat(start[:-1] + number * width, number) + nth] = c
    out[start[1:] - 1] = width
    posting = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(start.astype(np.int64)), pa.py_buffer(out)]).cast(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(names), pa.string()), pa.array(np.full(len(first), base)), posting], [f.name for f in _FREQ])


def _about(rows: list) -> pa.RecordBatch:
    """A row with the number, doc_id, size and null mark of each of ``rows``, and 0 for a width."""
    number, doc_id, size, null = (np.concatenate(x) for x in zip(*rows, strict=True))
    told = b"".join([number.tobytes(), doc_id.tobytes(), size.tobytes(), null.tobytes(), b"\0"])
    return pa.RecordBatch.from_arrays([pa.array([f"\0{number[0]}"]), pa.array(number[:1]), pa.array([told], pa.binary())], [f.name for f in _FREQ])


def _told(text: memoryview) -> tuple[np.ndarray, ...]:
    n = (len(text) - 1) // 25
    number, doc_id, size = np.frombuffer(text, np.int64, 3 * n).reshape(3, n)
    return number, doc_id, size, np.frombuffer(text, np.bool_, n, 24 * n)


def _frequencies(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        numbers, rows, counts, size, about = [], [], [], 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, bounds = utf8_rows(batch.column(2))
            about.append((ids, pc.fill_null(batch.column(1), 0).to_numpy(zero_copy_only=False), np.diff(bounds), pc.is_null(batch.column(1)).to_numpy(zero_copy_only=False)))
            for i, j in blocks(np.diff(bounds), 1 << 19):
                at = bounds[i : j + 1]
                if at[-1] == at[0]:
                    continue
                block = Block(data[at[0] : at[-1]], at - at[0], path)
                pair, n = np.unique(block.which.astype(np.int64) * (j - i) + block.row, return_counts=True)
                number = np.array([names.setdefault(w, len(names)) for w in block.strings(block.first)], np.int64)
                numbers.append(number[pair // (j - i)])
                rows.append(ids[i:j][pair % (j - i)])
                counts.append(n)
                size += int(at[-1] - at[0])
                if size >= POSTING_CHARS and names:
                    yield _postings(names, numbers, rows, counts)
                    names, numbers, rows, counts, size = {}, [], [], [], 0
        if names:
            yield _postings(names, numbers, rows, counts)
        if about:
            yield _about(about)

    return run


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, _, special = load(path)
        for batch in batches:
            words = batch.column(0)
            n = [1 if w in special else len(tokenizer.model.tokenize(as_byte_letters(w))) for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["pretoken", "n_pieces"])

    return run


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list]:
    """Rows of the postings of a batch, their tokens in these pre-tokens, and what is told of rows."""
    base, n_pieces, column = batch.column("base").to_numpy(), batch.column("n_pieces").to_numpy(), batch.column("posting")
    cuts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(column.buffers()[2], np.uint8)
    widths, docs, tokens = flat[cuts[1:] - 1], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    about = [_told(column[int(k)].as_buffer()) for k in np.flatnonzero(widths == 0)]
    for w in np.unique(widths[widths > 0]).tolist():
        mine = widths == w
        start, number = cuts[:-1][mine], (np.diff(cuts)[mine] - 1) // (w + 1)
        nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        at, away = np.repeat(start, number) + nth * w, np.zeros(len(nth), np.uint64)
        for k in range(w):
            away |= flat[at + k].astype(np.uint64) << np.uint64(8 * k)
        docs.append((away + np.repeat(base[mine], number).astype(np.uint64)).astype(np.int64))
        tokens.append(flat[np.repeat(start + number * w, number) + nth] * np.repeat(n_pieces[mine], number))
    return np.concatenate(docs), np.concatenate(tokens), about


def _added(docs: list, tokens: list) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(np.concatenate(docs), return_inverse=True)
    total = np.zeros(len(u), np.int64)
    np.add.at(total, inverse, np.concatenate(tokens))
    return u, total


def _partial_sums(groups: int):
    """A row for each group of documents that the task has met: their numbers
    and sums, or (``about``) their numbers with what is told of them."""

    def split(number: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
        group = (mix(number.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
        for at in np.split(order, first[1:]):
            yield int(group[at[0]]), number[at].tobytes(), *[c[at].tobytes() for c in columns]

    def flush(docs: list, tokens: list) -> pa.RecordBatch:
        group, number, total = zip(*split(*_added(docs, tokens)), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(group), pa.array(number, pa.binary()), pa.array(total, pa.binary()), pa.nulls(len(group), pa.binary())], _SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, tokens, size = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            d, t, about = _unpacked(batch)
            for told in about:
                group, number, *rest = zip(*split(*told), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(number, pa.binary()), pa.nulls(len(group), pa.binary()), pa.array([b"".join(x) for x in zip(*rest, strict=True)], pa.binary())], _SUMS)
            docs.append(d)
            tokens.append(t)
            size += len(d)
            if size > MOST_SUMS:
                d, t = _added(docs, tokens)
                docs, tokens, size = [d], [t], len(d)
                if size > MOST_SUMS // 2:
                    yield flush(docs, tokens)
                    docs, tokens, size = [], [], 0
        if size:
            yield flush(docs, tokens)

    return run


def _total_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a group of documents; a task holds some 40 bytes for each."""
    docs, tokens, about, size, most = [], [], [], 0, MOST_SUMS
    for batch in batches:
        for d, t, a in zip(*(batch.column(c) for c in _SUMS[1:]), strict=True):
            if a.is_valid:
                about.append(_told(d.as_buffer().to_pybytes() + a.as_buffer().to_pybytes() + b"\0"))
                continue
            docs.append(np.frombuffer(d.as_buffer(), np.int64))
            tokens.append(np.frombuffer(t.as_buffer(), np.int64))
            size += len(docs[-1])
        if size > most:
            d, t = _added(docs, tokens)
            docs, tokens, size = [d], [t], len(d)
            most = max(MOST_SUMS, 2 * size)
    if about:
        number, doc_id, n_bytes, null = (np.concatenate(x) for x in zip(*about, strict=True))
        d, t = _added(docs, tokens) if docs else (np.zeros(1, np.int64), np.zeros(1, np.int64))
        at = np.minimum(np.searchsorted(d, number), len(d) - 1)
        total = np.where(d[at] == number, t[at], 0)  # an empty text has no sums
        for i in range(0, len(number), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(doc_id[part], mask=null[part]), pa.array(n_bytes[part]), pa.array(total[part])], ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of each row; the file at ``tokenizer_path`` must be where the tasks run."""
    spark = docs.sparkSession
    slim = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    freq = slim.mapInArrow(_frequencies(tokenizer_path), _FREQ).repartition(partitions, "pretoken")
    # It reads every column, so that this and the join below share one exchange.
    distinct = freq.groupBy("pretoken").agg(F.max(F.col("base") + F.length("posting")).alias("widest"))
    counted = distinct.mapInArrow(_pieces(tokenizer_path), T.StructType([T.StructField("pretoken", T.StringType(), False), T.StructField("n_pieces", T.LongType(), False)]))
    sums = freq.join(counted, "pretoken").select("base", "posting", "n_pieces").mapInArrow(_partial_sums(partitions), "doc_group long, docs binary, tokens binary, about binary")
    return sums.repartition(partitions, "doc_group").mapInArrow(_total_sums, "doc_id long, n_bytes long, n_tokens long")


def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path).withColumn("over_limit", F.col("n_tokens") > MOST_TOKENS)

r"""Token ids as length-delimited binary records with a separate offset index.

A file is a run of frames, one per document, in ascending doc_id order:

    length   u64   bytes of the payload
    check    u32   masked CRC-32 of the length bytes
    payload        doc_id i64, flags u8 (1: doc_id is null), width u8 (2 or 4),
                   then the ids, unsigned little-endian of that width
    check    u32   masked CRC-32 of the payload
    end      u8    newline

Spark's text sink writes the frames (its row separator is ``end``), so commits,
retried tasks and every Hadoop file system work as for any Spark output. The
index is a Parquet table of its own (file_no, offset, frame_bytes, doc_id,
n_tokens, start) for shuffled reads.

Defined results: a null text counts as empty and gives only the end id; null
doc_ids come first; repeated rows are one record each; an empty table gives no
records; other columns aren't read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import FAN, blocks, materialise, shared_dir, table, utf8_rows
from .pretokens import Block, as_byte_letters, load

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Bytes of text for a file; a longer document is a file of its own size.
FILE_BYTES = 8 << 20
#: Words whose ids a worker keeps.
MOST_WORDS = 400_000
HEAD, RECORD = struct.Struct("<QI"), struct.Struct("<qBB")


def masked(crc: int) -> int:
    """Rotated and shifted, so that a checksum of data holding checksums stays sound."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, width: int, ids: bytes) -> bytes:
    """A frame without its ``end``, which the sink writes."""
    payload = RECORD.pack(doc_id or 0, doc_id is None, width) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((HEAD.pack(len(payload), masked(zlib.crc32(length))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def frames(content: bytes, at: int = 0) -> Iterator[tuple[int, int, int | None, int, memoryview]]:
    """(offset, frame bytes, doc_id, width, ids) of each frame from offset ``at``; a ValueError names a damaged one."""
    view = memoryview(content)
    while at < len(view):
        length, check = HEAD.unpack_from(view, at)
        end = at + HEAD.size + length
        if masked(zlib.crc32(view[at : at + 8])) != check or end + 5 > len(view):
            raise ValueError(f"damaged length at byte {at}")
        payload = view[at + HEAD.size : end]
        if masked(zlib.crc32(payload)) != struct.unpack_from("<I", view, end)[0] or view[end + 4] != 10:
            raise ValueError(f"damaged record at byte {at}")
        doc_id, null, width = RECORD.unpack_from(payload)
        yield at, end + 5 - at, None if null else doc_id, width, payload[RECORD.size :]
        at = end + 5


_words: dict[tuple[str, str], bytes] = {}


def _ids(block: Block, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows of a block, and where each row's begin."""
    rows = len(block.bounds) - 1
    if len(_words) > MOST_WORDS:
        _words.clear()
    model, parts = block.tokenizer.model, []
    for word in block.strings(block.first):
        if (part := _words.get((path, word))) is None:
            ids = [t.id for t in model.tokenize(as_byte_letters(word))]
            part = _words[path, word] = struct.pack(f"<{len(ids)}I", *ids)
        parts.append(part)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat = np.frombuffer(b"".join(parts), np.uint32)
    each = lengths[block.which]
    shift = (np.cumsum(lengths) - lengths)[block.which] - (np.cumsum(each) - each)
    ids = flat[np.repeat(shift, each) + np.arange(each.sum())]
    number = np.bincount(block.row, each, rows).astype(np.int64)
    if not block.whole.any():
        return ids, np.append(0, np.cumsum(number))
    cuts = np.append(0, np.cumsum(number))
    each_row = [
        np.array(block.tokenizer.encode(block.row_text(r), add_special_tokens=False).ids, np.uint32) if block.whole[r] else ids[cuts[r] : cuts[r + 1]] for r in range(rows)
    ]
    return np.concatenate(each_row), np.append(0, np.cumsum([len(x) for x in each_row]))


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, *_ = load(path)
        kind = np.uint16 if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32
        width = np.dtype(kind).itemsize
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            data, bounds = utf8_rows(batch.column(1))
            for i, j in blocks(np.diff(bounds)):
                at = bounds[i : j + 1]
                ids, cuts = _ids(Block(data[at[0] : at[-1]], at - at[0], path), path)
                raw, cuts = ids.astype(kind).tobytes(), (cuts * width).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([frame(d, width, raw[a:b] + end) for d, a, b in zip(doc_ids[i:j], cuts, cuts[1:], strict=False)], pa.binary())], ["frame"])

    return run


def write_records(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> str:
    """Encodes whole texts and writes records in doc_id order below ``path``
    (``records`` and ``index``); returns ``path``."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    dealt = slim.repartitionByRange(max(1, -(-size // FILE_BYTES)), "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_encode(tokenizer_path, end_id), "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(f"{path}/records", lineSep="\n")
    heads = materialise(read_records(docs.sparkSession, path).select("file_no", "offset", "frame_bytes", "doc_id", "n_tokens", "before"))
    # A row for each file, then one for each FAN files.
    totals = heads.groupBy("file_no").agg(F.sum("n_tokens").alias("total")).withColumn("fan", F.floor(F.col("file_no") / FAN))
    earlier = lambda w: F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fans = totals.groupBy("fan").agg(F.sum("total").alias("total")).select("fan", earlier(Window.orderBy("fan")).alias("fan_start"))
    starts = totals.withColumn("in_fan", earlier(Window.partitionBy("fan").orderBy("file_no"))).join(fans, "fan").select("file_no", (F.col("fan_start") + F.col("in_fan")).alias("file_start"))
    index = heads.join(starts, "file_no").withColumn("start", F.col("file_start") + F.col("before")).drop("file_start", "before")
    index.write.parquet(f"{path}/index")
    return path


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_no, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[tuple] = []
                before = size = 0
                for offset, length, doc_id, width, ids in frames(content.as_buffer().to_pybytes()):
                    wide = np.frombuffer(ids, np.uint16 if width == 2 else np.uint32).astype("<u4")
                    rows.append((file_no, offset, length, doc_id, len(wide), before, zlib.crc32(wide), wide.tobytes() if with_ids else None))
                    before += len(wide)
                    size += len(wide)
                    if size > 4 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    return run


_COLUMNS = {"file_no": pa.int64(), "offset": pa.int64(), "frame_bytes": pa.int64(), "doc_id": pa.int64(), "n_tokens": pa.int64(), "before": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _COLUMNS.values(), strict=True)], list(_COLUMNS))


def read_records(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Records of ``path``, checked: file_no, offset, frame_bytes, doc_id,
    n_tokens, before (ids of earlier records in the file), ids_crc32 and, if
    asked for, the ids as little-endian unsigned 32-bit integers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    numbered = files.select(F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long").alias("file_no"), "content")
    return numbered.mapInArrow(_read(with_ids), "file_no long, offset long, frame_bytes long, doc_id long, n_tokens long, before long, ids_crc32 long, ids binary")


def op7_token_id_output(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    path = write_records(table(spark, sf_dir, "documents"), tokenizer_path, shared_dir(spark))
    index = spark.read.parquet(f"{path}/index").select("file_no", "offset", "start")
    return read_records(spark, path).join(index, ["file_no", "offset"]).select("doc_id", "start", "n_tokens", "ids_crc32")

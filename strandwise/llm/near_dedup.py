"""MinHash near-dedup.

A document's set is its distinct SHINGLE-word windows of lower-cased (A-Z)
words. HASHES universal hash minima make its signature; BANDS bands of them
nominate pairs, signatures drop pairs far below the threshold, and every link
is confirmed on the full sets of both texts. Documents with equal sets stand
as one. Components come from alternating large-star and small-star.

A band's bucket is never paired out. Each member meets the bucket's pivot, the
member that meets most others in all bands; a group of copies costs as many
comparisons as it has members. A bucket whose other members lie in several
components after that is open. The documents of open buckets meet again by
their rarest shingles: two sets that are PERCENT similar have their first common
shingle, in order of rarity, so early in both that enough may follow. Only
documents of different components are compared there, and at least one of them
outside the shingle's largest component, so neither a group of copies nor a
passage in unlike documents makes pairs. This second way loses nothing.

What may be lost: two sets at exactly PERCENT similarity meet in no band with
probability (1 - 0.75**4)**32 = 5e-6, less above it, and fall below LEAST_EQUAL
equal minima with 3e-7; a document linked to others is lost only with all its links.

Defined results: no words or a null text gives an empty set, linked with
nothing and kept; fewer than SHINGLE words are one shingle; each row has a row
of the result. Rows with equal doc_id have one component_id, even if their
texts are unlike, as the doc_id links them; but ``keep_one`` looks at texts
only: of each group of similar texts the row of the smallest (doc_id, text hash)
stays, with the rows that equal it. A null doc_id has a null component and is
kept; an empty table gives no rows; other columns aren't read, so their names
are free.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_batches, blocks, byte_hashes, by_position, materialise, mix, rolling_hashes, table, utf8_rows, word_spans
from .components import connected_components

SHINGLE, PERCENT = 5, 75
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
#: Equal minima of a pair below which its similarity can't be 0.75 (5 deviations).
LEAST_EQUAL = 71
#: Pairs whose two texts a task holds at once.
PAIR_ROWS = 256
SEED = 20_240_229

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each row, sorted by both."""
    data = _LOWER[data]
    s, e, row = word_spans(data, bounds)
    words = byte_hashes(data, s, e)
    at = np.arange(max(0, len(s) - SHINGLE + 1))
    at = at[row[at] == row[at + SHINGLE - 1]]
    number = np.bincount(row, minlength=len(bounds) - 1)
    first = np.cumsum(number) - number
    short = np.flatnonzero((number > 0) & (number < SHINGLE))
    begin, end = np.append(at, first[short]), np.append(at + SHINGLE, (first + number)[short])
    h, r = rolling_hashes(words, begin, end), row[begin] if len(begin) else np.zeros(0, np.int64)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))[: len(h)]
    return r[new], h[new]


def signatures(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HASHES minima (32 bits) of a*h+b modulo 2**64 over each run of ``h``."""
    draw = np.random.default_rng(SEED)
    a = draw.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    b = draw.integers(0, 1 << 63, HASHES, np.uint64)
    out = np.empty((len(starts), HASHES), np.uint32)
    ends = np.append(starts[1:], len(h))
    for i, j in blocks(ends - starts, 1 << 14):
        part = h[starts[i] : ends[j - 1]]
        at, t = starts[i:j] - starts[i], np.empty_like(part)
        for k in range(HASHES):
            np.multiply(part, a[k], out=t)
            np.add(t, b[k], out=t)
            out[i:j, k] = np.minimum.reduceat(t, at) >> np.uint64(32)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "part", "n_shingles", "set_hash", "bands", "signature"]
    nth = np.arange(BANDS, dtype=np.uint64) << np.uint64(32)
    for batch in batches:
        data, bounds = utf8_rows(batch.column(2))
        for i, j in blocks(np.diff(bounds)):
            at = bounds[i : j + 1]
            row, h = shingles(data[at[0] : at[-1]], at - at[0])
            number = np.bincount(row, minlength=j - i)
            rows = np.flatnonzero(number)
            starts = np.cumsum(number[rows]) - number[rows]
            set_hash, signature = [None] * (j - i), [None] * (j - i)
            minima = signatures(h, starts) if len(rows) else np.zeros((0, HASHES), np.uint32)
            key = np.broadcast_to(nth, (len(rows), BANDS))
            for k in range(BAND_ROWS):
                key = mix(key + minima[:, k::BAND_ROWS])
            bands = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.where(number > 0, BANDS, 0))), pa.int32()), pa.array(key.reshape(-1).view(np.int64)))
            for k, (r, s, n) in enumerate(zip(rows.tolist(), starts.tolist(), number[rows].tolist(), strict=True)):
                set_hash[r] = hashlib.blake2b(h[s : s + n], digest_size=16).digest()
                signature[r] = minima[k].tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(number), pa.array(set_hash, pa.binary()), bands, pa.array(signature, pa.binary())], names)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures may belong to similar sets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("signature_a", "signature_b"))
        keep = pa.array((a == b).sum(axis=1) >= LEAST_EQUAL)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are PERCENT similar."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        data, bounds = utf8_rows(pa.concat_arrays([batch.column("text_a"), batch.column("text_b")]))
        size, both = np.zeros((2, n), np.int64), np.zeros(n, np.int64)
        sides = [(data[bounds[k * n] : bounds[k * n + n]], bounds[k * n : k * n + n + 1] - bounds[k * n]) for k in (0, 1)]
        for i, j in blocks(np.diff(sides[0][1]) + np.diff(sides[1][1])):
            keys = []
            for k, (bytes_of, at) in enumerate(sides):
                row, h = shingles(bytes_of[at[i] : at[j]], at[i : j + 1] - at[i])
                size[k, i:j] = np.bincount(row, minlength=j - i)
                keys.append((row, h))
            row, h = np.concatenate([keys[0][0], keys[1][0]]), np.concatenate([keys[0][1], keys[1][1]])
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
            both[i:j] = np.bincount(row[1:][same], minlength=j - i)
        keep = pa.array(100 * both >= PERCENT * (size[0] + size[1] - both))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["u", "v"])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a node's text."""
    for batch in batches:
        data, bounds = utf8_rows(batch.column(1))
        for i, j in blocks(np.diff(bounds)):
            at = bounds[i : j + 1]
            row, h = shingles(data[at[0] : at[-1]], at - at[0])
            number = np.bincount(row, minlength=j - i)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(number[row]), pa.array(h.view(np.int64))], ["node", "size", "shingle"])


def _rare_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components of members (node, component) that share
    a shingle behind which, in order of rarity, as many may follow as a link needs."""
    held = materialise(texts.join(members, "node", "left_semi").select("node", "text").mapInArrow(_shingle_rows, "node long, size long, shingle long"))
    often = held.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    own = Window.partitionBy("node")
    repeated = held.join(often, "shingle")
    # Shingles that nobody else has come first and meet nothing.
    nth = F.row_number().over(own.orderBy("often", "shingle")) - F.count("*").over(own) + F.col("size")
    early = repeated.withColumn("left", F.col("size") - nth + 1).where(100 * F.col("left") >= PERCENT * F.col("size"))
    early = materialise(early.join(members, "node").select("shingle", "node", "component", "size", "left"))
    heads = early.groupBy("shingle", "component").agg(F.count("*").alias("rows")).groupBy("shingle").agg(F.max(F.struct("rows", "component")).alias("most"), F.count("*").alias("number"))
    heads = materialise(heads.where("number > 1").select("shingle", F.col("most.component").alias("main")))
    near = materialise(early.join(heads, "shingle"))
    other = near.where("component != main").select("shingle", *[F.col(c).alias(f"other_{c}") for c in ("node", "component", "size", "left")])
    differ = (F.col("component") != F.col("other_component")) & ((F.col("component") == F.col("main")) | (F.col("node") < F.col("other_node")))
    length = 100 * F.least("size", "other_size") >= PERCENT * F.greatest("size", "other_size")
    enough = (100 + PERCENT) * F.least("left", "other_left") >= PERCENT * (F.col("size") + F.col("other_size"))
    return near.join(other, "shingle").where(differ & length & enough).select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()


def _links(pairs: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v): the pairs (a, b) that pass by signature, then by full sets."""
    side = lambda df, value, end: df.select(F.col("node").alias(end), F.col(value).alias(f"{value}_{end}"))
    near = pairs.join(side(signed, "signature", "a"), "a").join(side(signed, "signature", "b"), "b").mapInArrow(_alike, "a long, b long")
    whole = near.join(side(texts, "text", "a"), "a").join(side(texts, "text", "b"), "b")
    with arrow_batches(pairs.sparkSession, PAIR_ROWS):
        return materialise(whole.select("a", "b", "text_a", "text_b").mapInArrow(_confirmed, "u long, v long"))


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc_id, part, text): all with their n_shingles and set_hash, and
    the sets of words with their class: set_hash, node, component (the least node
    of the class), top (the least (doc_id, part) of the class)."""
    signed = rows.mapInArrow(_sign, "doc_id long, part long, n_shingles long, set_hash binary, bands array<long>, signature binary")
    signed = materialise(signed.withColumn("rid", F.monotonically_increasing_id()))
    filled = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # A set is a node, numbered by its first row, whose text stands for it.
    sets = filled.groupBy("set_hash").agg(F.min(F.struct("doc_id", "part", "rid")).alias("first"))
    sets = sets.select("set_hash", F.struct("first.doc_id", "first.part").alias("lead"), F.col("first.rid").alias("node"))
    sets = materialise(sets)
    one = materialise(filled.join(sets.select("node"), F.col("rid") == F.col("node")).select("node", "doc_id", "part", "bands", "signature"))
    bands = one.select(F.explode("bands").alias("key"), "node")
    counts = bands.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = materialise(bands.join(counts, "key"))
    # How often a node meets others: the middle of a group of near copies is the pivot.
    weights = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    pivots = materialise(shared.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top")).select("key", F.col("top.node").alias("pivot")))
    others = materialise(shared.select("key", "node").join(pivots, "key").where("node != pivot"))
    needed = materialise(one.join(weights, "node", "left_semi").select("node", "doc_id", "part", "signature"))
    texts = materialise(rows.join(needed.select("node", "doc_id", "part"), ["doc_id", "part"]).dropDuplicates(["doc_id", "part"]).select("node", "text"))
    signatures_of = needed.select("node", "signature")
    found = _links(others.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), signatures_of, texts)
    of = connected_components(found)

    component = F.coalesce("component", "node").alias("component")
    open_keys = others.join(of, "node", "left").select("key", component).groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
    met = others.join(materialise(open_keys), "key", "left_semi")
    members = materialise(met.select("node").unionByName(met.select(F.col("pivot").alias("node"))).distinct().join(of, "node", "left").select("node", component))
    if members.head(1):
        more = _links(_rare_pairs(members, texts), signatures_of, texts)
        if more.head(1):
            of = connected_components(more.unionByName(of.select(F.col("node").alias("u"), F.col("component").alias("v"))))

    named = materialise(sets.join(of, "node", "left").select("set_hash", "node", component, "lead"))
    tops = named.join(of.select("node"), "node", "left_semi").groupBy("component").agg(F.min("lead").alias("top"))
    return signed, materialise(named.join(tops, "component", "left").select("set_hash", "node", "component", F.coalesce("top", "lead").alias("top")))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, part (tells texts of one doc_id apart), text."""
    plain, (of, at) = by_position(docs, doc_id, text)
    return plain.select(F.col(of).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(at), F.lit(0)).alias("part"), F.col(at).alias("text"))


def _one_class_a_doc_id(linked: DataFrame, named: DataFrame) -> DataFrame:
    """``linked`` (doc_id, n_shingles, component, top) with classes that a doc_id
    joins made one, and the least doc_id of each as component_id."""
    spread = materialise(linked.groupBy("doc_id").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("doc_id", "low"))
    plain = linked.select("doc_id", "n_shingles", F.col("top.doc_id").alias("component_id"), "component")
    if not spread.head(1):
        return plain.drop("component")
    joined = connected_components(linked.join(spread, "doc_id").select(F.col("component").alias("u"), F.col("low").alias("v")).distinct())
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("root"))
    least = named.join(joined, "component").groupBy("root").agg(F.min("top.doc_id").alias("least"))
    moved = materialise(joined.join(least, "root").select("component", "least"))
    return plain.join(moved, "component", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of each row."""
    signed, named = _classes(_rows(docs, doc_id, text))
    filled = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    # A row for each set, so that the rows of a group of copies meet one row.
    linked = signed.where(filled).join(named, "set_hash").select("doc_id", "n_shingles", "component", "top")
    alone = signed.where(~filled).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return _one_class_a_doc_id(linked, named).unionByName(alone)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` but for those that another row of a similar text stands for."""
    signed, named = _classes(_rows(docs, doc_id, text))
    other = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).join(named, "set_hash").where(F.struct("doc_id", "part") != F.col("top"))
    gone = other.select(F.col("doc_id").alias("gone_id"), F.col("part").alias("gone_part")).distinct()
    plain, (of, at) = by_position(docs, doc_id, text)
    same = (F.col(of).cast("long") == F.col("gone_id")) & (F.coalesce(F.xxhash64(at), F.lit(0)) == F.col("gone_part"))
    return plain.join(gone, same, "left_anti").toDF(*docs.columns)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = components(table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op2_sql() -> str:
    """Exact links of all pairs that share a shingle, and their components."""
    return f"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, to_id) AS (SELECT a, b FROM u UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.to_id = u.a),
m AS (SELECT doc_id, min(to_id) AS low FROM r GROUP BY doc_id)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(t.doc_id, coalesce(m.low, t.doc_id)) AS component_id, t.doc_id = least(t.doc_id, coalesce(m.low, t.doc_id)) AS kept
FROM t LEFT JOIN n ON n.doc_id = t.doc_id LEFT JOIN m ON m.doc_id = t.doc_id"""

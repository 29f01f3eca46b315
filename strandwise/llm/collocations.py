"""Phrase collocation mining with tries of candidates.

Texts become arrays of symbols, a 64-bit hash of language and word, with a zero
between pieces; that no two words share a symbol is checked, else the next seed is
taken. Candidates are found level by level: phrases are counted under a hash, which
bounds each count from above, and only where their shorter phrases pass. What
passes goes into a bitmap of FILTER_BITS bits, of that size whatever the table:
false hits add candidates and lose none. Each hash keeps the least of its rows'
owners, so that a candidate is written out where it is owned, not by each task that
holds it; if two phrases share a hash, the exact counts don't add up to the hashed
ones, and the next seed is taken. The candidates are dealt by a hash into
shards of some TRIE_PHRASES; a task lays each shard out as a double-array trie
over its own alphabet, which is then broadcast. Every text position is a state;
all states advance together, level by level, and the accepting ones are counted.
The sums over all tasks are the exact counts; parts, cuts and ranks come from joins.

Defined results: a null text is empty, a null language ``und``; empty pieces have
no words; repeated rows count again; a null doc_id matters nowhere, as only text
and language are read; ties by score and count go by phrase, in byte order; an
empty table gives no rows; other columns aren't read, so their names are free.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks, by_position, byte_hashes, materialise, mix, settings, table, utf8_rows, word_spans

LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate goes if a longer one that holds it has this percent of its count.
HELD_PERCENT = 80
SCALE = 2_000_000
FILTER_BITS = 26
TRIE_PHRASES = 1 << 18
#: Keys that a task holds before it hands them on: most tasks hand on once.
HELD_KEYS = 1 << 21
#: Symbols of a row of the encoded table. Parquet buffers a hundred rows before it looks at their size.
ROW_SYMBOLS = 1 << 13
#: Such rows that a task takes at once.
ROWS = 32
#: Bytes of files that a task counts a trie in: it holds one number for each phrase.
COUNT_SPLIT = "128m"
#: Documents that a task takes at once, and bytes of a file that a task reads: the distinct
#: keys of a task are held in the executor's memory, too.
DOCUMENTS, SPLIT = 1000, "16m"
#: Characters of text that are encoded at once, and rows of a batch that a task hands on.
ENCODED_CHARS, OUT_ROWS = 1 << 18, 1 << 16
#: Parts that a language's candidates are ranked in before the last ranking.
PARTS = 64

_S = [f"s{k}" for k in range(1, LONGEST + 1)]
_BREAKS = np.zeros(256, bool)
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_PLAIN = np.arange(256, dtype=np.uint8)  # lower case, one blank for whatever ends a word
_PLAIN[65:91] += 32
_PLAIN[_BREAKS] = 32
_PLAIN[9] = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def encode(data: np.ndarray, bounds: np.ndarray, languages: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all rows with a zero after each piece; and each word's symbol, row, start and end."""
    plain = _PLAIN[data]
    s, e, row = word_spans(plain, bounds)
    symbol = mix(byte_hashes(plain, s, e, seed) ^ languages[row]) if len(s) else np.zeros(0, np.uint64)
    pieces = np.append(0, np.cumsum(_BREAKS[data]))[s]
    ends = np.append((row[1:] != row[:-1]) | (pieces[1:] != pieces[:-1]), True)[: len(s)]
    out = np.zeros(len(s) + int(ends.sum()), np.uint64)
    out[np.arange(len(s)) + np.cumsum(ends) - ends] = symbol
    return out, symbol, row, s, e


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    flat = data[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(flat))


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each is first, and the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
    return k[new], order[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


def _slices(parts: list) -> Iterator[list]:
    """The parts, whose keys come first and ascend, cut by the keys' top bits: what is
    put together at once is a sixteenth of all that is held."""
    edges = np.arange(1, 16, dtype=np.uint64) << np.uint64(60)
    cuts = [[0, *np.searchsorted(p[0], edges).tolist(), len(p[0])] for p in parts]
    for k in range(16):
        own = [[column[at[k] : at[k + 1]] for column in p] for p, at in zip(parts, cuts, strict=True) if at[k] < at[k + 1]]
        if own:
            yield own


_ENCODED = pa.schema([("ids", pa.binary()), ("symbol", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _encoder(seed: int):
    """(text, lang) to rows of symbols (ids) and rows of words with their counts."""

    def words(parts: list) -> Iterator[pa.RecordBatch]:
        for own in _slices(parts):
            symbol, first, n = _merged(np.concatenate([p[0] for p in own]), np.concatenate([p[1] for p in own]))
            langs, names = (pa.concat_arrays([p[k] for p in own]) for k in (2, 3))
            for i in range(0, len(symbol), OUT_ROWS):
                at = pa.array(first[i : i + OUT_ROWS])
                lang, word = langs.take(at), names.take(at)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), pa.array(symbol[i : i + OUT_ROWS].view(np.int64)), lang, word, pa.array(n[i : i + OUT_ROWS])], schema=_ENCODED)

    def rows_of(x: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows that end with a piece, so that no phrase is cut."""
        cuts = np.flatnonzero(x == 0) + 1
        stops = np.unique(cuts[np.searchsorted(cuts, np.append(np.arange(ROW_SYMBOLS, len(x), ROW_SYMBOLS), len(x)))]) if len(x) else cuts
        for i in range(0, len(stops), ROWS):
            begin, own = stops[i - 1] if i else 0, stops[i : i + ROWS]
            offsets = np.append(0, own - begin).astype(np.int32) * 8
            ids = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(x[begin : own[-1]])])
            yield pa.RecordBatch.from_arrays([ids, *(pa.nulls(len(own), t) for t in (pa.int64(), pa.string(), pa.string(), pa.int64()))], schema=_ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            data, bounds = utf8_rows(batch.column(0))
            lang_data, lang_bounds = utf8_rows(batch.column(1))
            languages = byte_hashes(lang_data, lang_bounds[:-1], lang_bounds[1:], seed + 1)
            for i, j in blocks(np.diff(bounds), ENCODED_CHARS):
                at = bounds[i : j + 1]
                own = data[at[0] : at[-1]]
                x, symbol, row, s, e = encode(own, at - at[0], languages[i:j], seed)
                yield from rows_of(x)
                if len(symbol):
                    one, first, n = _merged(symbol, np.ones(len(symbol), np.int64))
                    parts.append((one, n, batch.column(1).take(pa.array(row[first] + i)), _strings(_PLAIN[own], s[first], e[first])))
                    held += len(one)
                if held > HELD_KEYS:
                    yield from words(parts)
                    parts, held = [], 0
        if parts:
            yield from words(parts)

    return run


def _rows(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all rows of a batch, one row behind the other, and the rows' bounds."""
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    _, offsets, values = ids.buffers()
    bounds = np.frombuffer(offsets, np.int32)[ids.offset : ids.offset + len(ids) + 1]
    return np.frombuffer(values, np.uint8)[bounds[0] : bounds[-1]].view(np.uint64), (bounds - bounds[0]) >> 3


def _owned_rows(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a batch and the owner of each: 16 bits from what its row holds, so
    they are the same wherever the row is read."""
    x, bounds = _rows(ids)
    if not len(x):
        return x, np.zeros(0, np.uint16)
    owner = (mix(np.add.reduceat(x, bounds[:-1])) >> np.uint64(48)).astype(np.uint16)
    return x, np.repeat(owner, np.diff(bounds))


# ---- candidates ------------------------------------------------------------


def gram_hashes(x: np.ndarray, at: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A hash of the ``n`` symbols from each place on."""
    h, step = x[at], _STEP + np.uint64(2 * seed)
    with np.errstate(over="ignore"):
        for k in range(1, n):
            h = mix(h * step + x[at + k] + np.uint64(k))
    return h


def _owned(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    return keys ^ (owners.astype(np.uint64) << np.uint64(48))


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(65 - (64 * len(bits)).bit_length())
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The bits at the top FILTER_BITS of each key; at most 2**FILTER_BITS / 64 rows come to the driver."""
    slots = keys.select(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    rows = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def levels(x: np.ndarray, filters: list, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, hashes) of the phrases of 2, 3, ... words, all of whose shorter phrases
    pass; filters: the bitmaps of words, pairs, ..."""
    at = np.flatnonzero(x)
    h = x[at]
    for n, bits in enumerate(filters, 2):
        at = at[_passes(bits.value, h)]
        good = np.zeros(len(x) + 1, bool)
        good[at] = True
        at = at[good[at + 1]]
        h = gram_hashes(x, at, n, seed)
        yield n, at, h


def _summed(keys: np.ndarray, counts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their counts and the least of their owners."""
    if not len(keys):
        return keys, counts, owners
    order = np.argsort(keys)
    k = keys[order]
    new = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[new], np.add.reduceat(counts[order], new), np.minimum.reduceat(owners[order], new)


def _counter(filters: list, seed: int):
    """Sums and owners of the hashes of the longest phrases that the filters tell of: (key, n, owner)."""

    def emit(parts: list) -> Iterator[pa.RecordBatch]:
        for part in _slices(parts):
            k, n, owner = _summed(*(np.concatenate([p[i] for p in part]) for i in range(3)))
            for i in range(0, len(k), OUT_ROWS):
                own = slice(i, i + OUT_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(k[own].view(np.int64)), pa.array(n[own]), pa.array(owner[own].astype(np.int32))], ["key", "n", "owner"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            x, owners = _owned_rows(batch.column(0))
            *_, (_, at, keys) = levels(x, filters, seed)
            parts.append(_summed(keys, np.ones(len(keys), np.int64), owners[at]))
            held += len(parts[-1][0])
            if held > HELD_KEYS:
                yield from emit(parts)
                parts, held = [], 0
        if held:
            yield from emit(parts)

    return run


def _phrases(filters: list, owned, seed: int):
    """Distinct (key, symbols) of the phrases that pass, from the rows that own them."""

    def distinct(key: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if (symbols[first][inverse] != symbols).any():  # unlike phrases of one hash
            return key, symbols
        return key[first], symbols[first]

    def emit(parts: list) -> Iterator[pa.RecordBatch]:
        key, symbols = distinct(*(np.concatenate([p[k] for p in parts]) for k in range(2)))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(pa.array(np.ascontiguousarray(symbols[:, k]).view(np.int64)) for k in range(LONGEST))], ["key", *_S])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            x, owners = _owned_rows(batch.column(0))
            for n, at, h in levels(x, filters, seed):
                keep = _passes(owned.value, _owned(h, owners[at]))
                at, h = at[keep], h[keep]
                symbols = np.zeros((len(at), LONGEST), np.uint64)
                for k in range(n):
                    symbols[:, k] = x[at + k]
                parts.append(distinct(h, symbols))
                held += len(parts[-1][0])
            if held > HELD_KEYS >> 3:
                yield from emit(parts)
                parts, held = [], 0
        if held:
            yield from emit(parts)

    return run


# ---- tries -----------------------------------------------------------------


class Trie:
    """A double-array trie of phrases (rows of symbols, zero for none): the child
    of state t by code c is base[t] + c, if check holds t there. accept: the row
    that ends in a state, or -1. Symbols that end most edges have the smallest codes,
    so the children of a state lie close together."""

    def __init__(self, phrases: np.ndarray):
        self.alphabet, at = np.unique(phrases, return_inverse=True)
        at = at.reshape(phrases.shape)
        if self.alphabet[0] == 0:
            self.alphabet, at = self.alphabet[1:], at - 1
        later = at[:, 1:][at[:, 1:] >= 0]
        self.code_of = np.empty(len(self.alphabet), np.int64)
        self.code_of[np.argsort(-np.bincount(later, minlength=len(self.alphabet)), kind="stable")] = np.arange(1, len(self.alphabet) + 1)
        codes = np.where(at >= 0, self.code_of[at], 0)
        order = np.lexsort(codes.T[::-1])
        self.phrases, codes = phrases[order], codes[order]
        width = len(self.alphabet) + 1
        self._room(4 * width + 2 * len(codes))
        self.check[0] = 0
        self._from = width
        state = np.zeros(len(codes), np.int64)
        for level in range(codes.shape[1]):
            rows = np.flatnonzero(codes[:, level])
            if not len(rows):
                break
            new = np.append(True, (state[rows][1:] != state[rows][:-1]) | (codes[rows, level][1:] != codes[rows, level][:-1]))
            parent, code = state[rows[new]], codes[rows[new], level]  # of each edge
            begin = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            number = np.diff(np.append(begin, len(parent)))
            base = np.empty(len(begin), np.int64)
            for k in np.argsort(-number, kind="stable")[: np.count_nonzero(number > 1)]:
                base[k] = self._place(parent[begin[k]], code[begin[k] : begin[k] + number[k]], width)
            single = begin[number == 1]
            base[number == 1] = self._fill(parent[single], code[single], width)
            self.base[parent[begin]] = base
            state[rows] = (np.repeat(base, number) + code)[np.cumsum(new) - 1]
        self.accept = np.full(len(self.base), -1, np.int32)
        self.accept[state] = np.arange(len(codes))

    def _room(self, size: int) -> None:
        old = getattr(self, "check", np.zeros(0, np.int32))
        self.check = np.append(old, np.full(size - len(old), -1, np.int32))
        self.base = np.append(getattr(self, "base", old), np.zeros(size - len(old), np.int32))

    def _place(self, parent: int, edge: np.ndarray, width: int) -> int:
        """A base that brings all edges (ascending codes) to free places: whole windows of
        places are tried at once, and the search goes on where the last one ended.
        Places below ``width`` stay free, so no base is negative."""
        window = max(8, (1 << 14) // len(edge))
        while True:
            if self._from + window + 2 * width >= len(self.check):
                self._room(2 * len(self.check) + window)
            bases = np.flatnonzero(self.check[self._from : self._from + window] < 0) + self._from - edge[0]
            fits = np.flatnonzero((self.check[bases[:, None] + edge] < 0).all(axis=1))
            if len(fits):
                base = int(bases[fits[0]])
                self.check[base + edge] = parent
                return base
            self._from += window

    def _fill(self, parents: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
        """Bases of states with one child each: the first free places."""
        while (free := np.flatnonzero(self.check[width : len(self.check) - 2 * width] < 0) + width).size < len(edges):
            self._room(2 * len(self.check))
        self.check[free[: len(edges)]] = parents
        return free[: len(edges)] - edges

    def count(self, x: np.ndarray) -> np.ndarray:
        """How often each phrase occurs in the symbols: all places advance at once."""
        at = np.minimum(np.searchsorted(self.alphabet, x), len(self.alphabet) - 1)
        codes = np.append(np.where(self.alphabet[at] == x, self.code_of[at], 0), np.zeros(self.phrases.shape[1], np.int64))
        place, state, total = np.flatnonzero(codes), np.zeros(np.count_nonzero(codes), np.int64), np.zeros(len(self.phrases), np.int64)
        for level in range(self.phrases.shape[1]):
            code = codes[place + level]
            to = self.base[state] + code
            alive = (code > 0) & (self.check[to] == state)
            place, state = place[alive], to[alive]
            ends = self.accept[state]
            total += np.bincount(ends[ends >= 0], minlength=len(total))
        return total


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    import pickle

    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "trie": [pickle.dumps(Trie(rows[_S].to_numpy(np.int64).view(np.uint64)))]})


def _trie_counter(trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        own = pickle.loads(trie.value)
        total = np.zeros(len(own.phrases), np.int64)
        for batch in batches:
            total += own.count(_rows(batch.column(0))[0])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(own.phrases[some, k]).view(np.int64)) for k in range(LONGEST)), pa.array(total[some])], [*_S, "n"])

    return run


_PHRASE = ", ".join(f"{s} long" for s in _S)


def _encoded(docs: DataFrame, lang: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows of symbols (ids), and words (symbol, lang, word, n)."""
    plain, (by, at) = by_position(docs, lang, text)
    given = plain.select(F.coalesce(F.col(at), F.lit("")).alias("text"), F.coalesce(F.col(by), F.lit("und")).alias("lang"))
    seed = 0
    while True:
        held = materialise(given.mapInArrow(_encoder(seed), "ids binary, symbol long, lang string, word string, n long"))
        words = materialise(held.where("symbol is not null").groupBy("symbol", "lang", "word").agg(F.sum("n").alias("n")))
        if not words.groupBy("symbol").agg(F.count("*").alias("k")).where("k > 1 or symbol = 0").head(1):
            return held.where("ids is not null").select("ids"), words
        seed += 2


def summed_hashes(hashed: DataFrame) -> DataFrame:
    """``hashed`` (key, n, owner) with one row for each key. Tasks have summed what they hold, and few
    keys come from one task twice: rows are dealt by key before they are summed, as a sum
    ahead of that would hold all keys of a split in the executor's memory."""
    parts = 2 * int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return hashed.repartition(parts, "key").groupBy("key").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))


def candidates(ids: DataFrame, words: DataFrame, least: int, seed: int = 0) -> tuple[DataFrame, DataFrame, list]:
    """The hashes of the phrases that occur ``least`` times (key, n, owner), the phrases
    of such hashes (key, s1, s2, ...) from their owners, with false hits, and the bitmaps in use."""
    context = ids.sparkSession.sparkContext
    filters, counts = [context.broadcast(_bitmap(words.where(F.col("n") >= least).select(F.col("symbol").alias("key"))))], []
    for n in range(2, LONGEST + 1):
        hashed = ids.mapInArrow(_counter(list(filters), seed), "key long, n long, owner int")
        counts.append(materialise(summed_hashes(hashed).where(F.col("n") >= least)))
        if n < LONGEST:
            filters.append(context.broadcast(_bitmap(counts[-1].select("key"))))
    keys = functools.reduce(DataFrame.unionByName, counts)
    owned = context.broadcast(_bitmap(keys.select(F.col("key").bitwiseXOR(F.shiftleft(F.col("owner").cast("long"), 48)).alias("key"))))
    return keys, ids.mapInArrow(_phrases(filters, owned, seed), f"key long, {_PHRASE}"), [*filters, owned]


def counted_phrases(ids: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """s1, s2, ... (zero for none), a: the exact counts of all phrases of two words or more that occur ``least`` times."""
    spark, seed = ids.sparkSession, 0
    while True:
        keys, phrases, bitmaps = candidates(ids, words, least, seed)
        phrases = materialise(phrases.join(keys.select("key"), "key", "left_semi").select(*_S).distinct())
        for b in bitmaps:
            b.unpersist()
        shards = max(1, -(-phrases.count() // TRIE_PHRASES))
        tries = materialise(phrases.withColumn("shard", F.pmod(F.xxhash64(*_S), F.lit(shards))).groupBy("shard").applyInPandas(_built, "shard long, trie binary"))
        out = phrases.limit(0).withColumn("a", F.lit(0).cast("long"))
        for shard in range(shards):  # one bounded trie after the other
            one = tries.where(F.col("shard") == shard).select("trie").head()
            if one is None:
                continue
            trie = spark.sparkContext.broadcast(bytes(one["trie"]))
            with settings(spark, {"spark.sql.files.maxPartitionBytes": COUNT_SPLIT}):
                out = out.unionByName(materialise(ids.mapInArrow(_trie_counter(trie), f"{_PHRASE}, n long").groupBy(*_S).agg(F.sum("n").alias("a")).where(F.col("a") >= least)))
            trie.unpersist()
        # Each hashed count is the sum of its phrases' counts: equal totals tell that none is missing.
        if keys.agg(F.sum("n")).head()[0] == out.agg(F.sum("a")).head()[0]:
            return out
        seed += 1


# ---- scores ----------------------------------------------------------------


def _part(first: int, n: int) -> list[Column]:
    """n symbols from number ``first`` on, then zeros."""
    return [F.col(_S[first + k]) if k < n and first + k < LONGEST else F.lit(0).cast("long") for k in range(LONGEST)]


def _named(columns: list[Column]) -> Column:
    return F.struct(*[c.alias(s) for c, s in zip(columns, _S, strict=True)])


def scored(phrases: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``phrases`` (s1, ..., a) with n_words, l, r and score of the lowest-scoring cut,
    without those that a longer one holds."""
    ones = words.where(F.col("n") >= least).select(F.col("symbol").alias("s1"), *[F.lit(0).cast("long").alias(s) for s in _S[1:]], F.col("n").alias("a"))
    counts = phrases.unionByName(ones)
    size = sum((F.col(s) != 0).cast("int") for s in _S)
    phrases = phrases.withColumn("n_words", size)
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), _named(_part(0, k)).alias("left"), _named(_part(k, LONGEST)).alias("right")) for k in range(1, LONGEST)])
    cut = phrases.withColumn("cut", F.explode(F.filter(cuts, lambda c: c["k"] < F.col("n_words"))))
    for side, name in (("left", "l"), ("right", "r")):
        part = counts.select(*[F.col(s).alias(f"{side}_{s}") for s in _S], F.col("a").alias(name))
        cut = cut.withColumns({f"{side}_{s}": F.col(f"cut.{side}.{s}") for s in _S}).join(part, [f"{side}_{s}" for s in _S])
    # Decimals, as the product may pass 64 bits.
    cut = cut.withColumn("score", F.expr(f"cast(a as decimal(20, 0)) * {SCALE} div (cast(l as decimal(20, 0)) + r)"))
    best = cut.groupBy(*_S, "a", "n_words").agg(F.min(F.struct("score", "cut.k", "l", "r")).alias("best"))

    inner = [F.struct(F.lit(first + n).alias("end"), F.lit(n).alias("n"), _named(_part(first, n)).alias("part")) for n in range(2, LONGEST) for first in range(LONGEST - n + 1)]
    parts = phrases.select("a", "n_words", F.explode(F.filter(F.array(*inner), lambda p: (p["end"] <= F.col("n_words")) & (p["n"] < F.col("n_words")))).alias("p"))
    holder = parts.groupBy(*[F.col(f"p.part.{s}").alias(s) for s in _S]).agg(F.max("a").alias("most"))
    held = F.expr(f"cast(most as decimal(20, 0)) * 100 >= cast(a as decimal(20, 0)) * {HELD_PERCENT}")
    return best.join(holder, _S, "left").where(~F.coalesce(held, F.lit(False))).select(*_S, "n_words", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language."""
    spark, batch = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    with settings(spark, {batch: str(DOCUMENTS), "spark.sql.files.maxPartitionBytes": SPLIT}):
        ids, words = _encoded(docs, lang, text)
    with settings(spark, {batch: str(ROWS), "spark.sql.files.maxPartitionBytes": SPLIT}):
        phrases = counted_phrases(ids, words, least)
    found = materialise(scored(phrases, words, least))
    often = words.where(F.col("n") >= least)
    for k, s in enumerate(_S):
        name = often.select(F.col("symbol").alias(s), F.col("word").alias(f"w{k}"), *([F.col("lang")] if k == 0 else []))
        found = found.join(name, s, "left")
    found = found.select("lang", F.concat_ws(" ", *[f"w{k}" for k in range(LONGEST)]).alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part of a language first, so that no task ranks a whole one.
    part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    first = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("nth", part).where(F.col("nth") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op11_sql() -> str:
    parts = ", ".join(f"array_to_string(list_slice(w, {first + 1}, {first + n}), ' ')" for n in range(2, LONGEST) for first in range(LONGEST - n + 1))
    ends = ", ".join(str((first + n) * 10 + n) for n in range(2, LONGEST) for first in range(LONGEST - n + 1))
    return f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
m AS (SELECT lang, ws, i, unnest(range(1, {LONGEST + 1})) AS m FROM i),
g AS (SELECT lang, m, list_slice(ws, i, i + m - 1) AS w, count(*) AS f FROM m WHERE i + m - 1 <= len(ws) GROUP BY ALL),
s AS (SELECT *, array_to_string(w, ' ') AS phrase FROM g),
c AS (SELECT * FROM s WHERE m >= 2 AND f >= {LEAST}),
k AS (SELECT lang, phrase, m, w, f, unnest(range(1, m)) AS k FROM c),
x AS (SELECT k.lang, k.phrase, k.f AS a, k, l.f AS l, r.f AS r, ({SCALE}::HUGEINT * k.f) // (l.f + r.f) AS score FROM k
  JOIN s l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(k.w, 1, k), ' ') JOIN s r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(k.w, k + 1, k.m), ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM x) WHERE nth = 1),
h AS (SELECT lang, f, m, unnest([{parts}]) AS part, unnest([{ends}]) AS code FROM c WHERE m > 2),
d AS (SELECT lang, part, max(f) AS most FROM h WHERE code // 10 <= m AND code % 10 < m GROUP BY ALL),
o AS (SELECT b.* FROM b LEFT JOIN d ON d.lang = b.lang AND d.part = b.phrase WHERE coalesce(100::HUGEINT * most < {HELD_PERCENT}::HUGEINT * a, true)),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM s WHERE m = 1 GROUP BY lang)
SELECT t.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM t JOIN n ON n.lang = t.lang WHERE rank <= {TOP}"""

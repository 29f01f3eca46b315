"""Reads: trimming, filters, mates, assignment to amplicons by tags and primers."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import search
from ..functions import seq as s
from ..functions.align import texts_of
from .ranking import first_rows


def trim(reads: DataFrame, n: int, columns: tuple[str, ...] = ("seq", "qual")) -> DataFrame:
    return reads.withColumns({c: F.substring(c, 1, n) for c in columns})


def length_between(reads: DataFrame, low: int, high: int, columns: tuple[str, ...] = ("seq",)) -> DataFrame:
    """All mates must pass."""
    for c in columns:
        reads = reads.where(F.length(c).between(low, high))
    return reads


def quality_at_least(reads: DataFrame, low: float, columns: tuple[str, ...] = ("qual",)) -> DataFrame:
    for c in columns:
        reads = reads.where(s.mean_phred(c) >= low)
    return reads


def with_primers(reads: DataFrame, primers: list[str]) -> DataFrame:
    """Reads that hold any of the primers (IUPAC), in either strand."""
    both = [s.iupac_pattern(p) for p in primers] + [s.iupac_pattern(p[::-1].translate(str.maketrans(s.IUPAC, s.COMPLEMENT))) for p in primers]
    return reads.where(F.upper("seq").rlike("|".join(both)))


#: A line of a sheet: sample, marker, tag (plain), primer, reverse primer and its tag (all as they stand on the forward strand).
Line = tuple[str, str, str, str, str, str]


def amplicon_patterns(markers: list[dict], samples: list[dict]) -> list[Line]:
    """The lines of a sheet: every tag pair with every primer pair; a tag with
    ambiguous letters stands for each plain one."""
    out = []
    for m in markers:
        for smp in samples:
            for tag in map("".join, itertools.product(*[s.AMBIGUOUS.get(c, c) for c in (smp.get("tag_f") or "").upper()])):
                for f in m.get("primer_f") or [""]:
                    for r in m.get("primer_rc") or [""]:
                        out.append((smp["sample"], m["marker"], tag, f.upper(), r.upper(), (smp.get("tag_rc") or "").upper()))
    return out


#: Bytes of a sheet up to which it is sent to all executors.
SHEET_BYTES = 8 << 20

_TAIL = "array<struct<kind: int, start: int>>"
_ENDS = f"heads array<struct<kind: int, tag: string, forward: int, turned: int>>, forward {_TAIL}, turned {_TAIL}"


def _ends(heads: list[tuple[str, int]], tails: list[str]):
    """Column function: of each sequence the tags before primers (kind, tag, where it
    starts first on the forward strand and on the turned one, or null), and where
    reverse primers start on each strand. heads: primer and length of the tag."""
    before = [(search.pattern_masks(p), len(p), n) for p, n in heads]
    behind = [search.pattern_masks(p) for p in tails]

    def text_array(tags: np.ndarray, n: int) -> pa.Array:
        return pa.StringArray.from_buffers(len(tags), pa.py_buffer((np.arange(len(tags) + 1) * n).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(tags)))

    def lists(rows: int, row: np.ndarray, fields: dict) -> pa.Array:
        order = np.argsort(row, kind="stable")
        offsets = np.append(0, np.cumsum(np.bincount(row, minlength=rows))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([v.take(pa.array(order)) for v in fields.values()], list(fields)))

    @F.arrow_udf(_ENDS)
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            head, tail = [], ([], [])
            given = column.is_valid().to_numpy(zero_copy_only=False)
            for rows, letters in search.letters_by_length(column):
                rows, letters = rows[given[rows]], letters[given[rows]]
                strands = (letters, search.turned(letters))
                codes = [search.word_codes(x) for x in strands]
                firsts = [search.first_places(c, [p for p, _, _ in before]) for c in codes]
                any_head = np.zeros((2, len(rows)), bool)
                for kind, (pattern, _, n) in enumerate(before):
                    parts = []
                    for side, x in enumerate(strands):
                        row, start, _ = search.places(x, pattern, codes=codes[side], first=firsts[side][kind])
                        row, start = row[start >= n], start[start >= n]
                        any_head[side, row] = True
                        tag = np.ascontiguousarray(x[row[:, None], start[:, None] - n + np.arange(n)]).view(f"S{n}").ravel() if n else np.zeros(len(row), "S1")
                        parts.append((row, tag, np.full(len(row), side), start - n))
                    row, tag, side, at = (np.concatenate(v) for v in zip(*parts, strict=True))
                    order = np.lexsort((at, side, tag, row))
                    row, tag, side, at = row[order], tag[order], side[order], at[order]
                    new = np.append(True, (row[1:] != row[:-1]) | (tag[1:] != tag[:-1]))[: len(row)]
                    one = np.cumsum(new) - 1
                    first = np.full((2, int(new.sum())), -1)
                    for k in (1, 0):  # the first of each strand, written last
                        mine = np.flatnonzero(side == k)[::-1]
                        first[k, one[mine]] = at[mine]
                    head.append((rows[row[new]], np.full(int(new.sum()), kind), tag[new], first[0], first[1]))
                for side, x in enumerate(strands):
                    some = np.flatnonzero(any_head[side])
                    texts, numbers = x[some], codes[side][some]
                    firsts = search.first_places(numbers, behind)
                    for kind, pattern in enumerate(behind):
                        row, start, _ = search.places(texts, pattern, codes=numbers, first=firsts[kind])
                        if not len(pattern):  # no reverse primer: the insert goes on to the end
                            row, start = np.arange(len(some)), np.full(len(some), x.shape[1])
                        tail[side].append((rows[some[row]], np.full(len(row), kind), start))
            join = lambda parts, k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
            none = lambda v: pa.array(v, pa.int32(), mask=v < 0)
            tags = pa.concat_arrays([text_array(p[2], heads[k][1]) for p in head for k in p[1][:1]] or [pa.array([], pa.string())])
            fields = {"kind": pa.array(join(head, 1), pa.int32()), "tag": tags, "forward": none(join(head, 3)), "turned": none(join(head, 4))}
            ends = [lists(len(column), join(tail[k], 0), {"kind": pa.array(join(tail[k], 1), pa.int32()), "start": pa.array(join(tail[k], 2), pa.int32())}) for k in (0, 1)]
            yield pa.StructArray.from_arrays([lists(len(column), join(head, 0), fields), *ends], ["heads", "forward", "turned"])

    return found


def _matches(reads: DataFrame, patterns: list[Line]) -> DataFrame:
    """Adds sample, marker, tag, strand (the read on the strand that matches, the forward
    one first), turned, at (where the tag starts, from 1), start and length of the insert.
    Tags before primers are looked up in the sheet by an equi-join; of the lines
    found those count whose reverse primer and tag come later, the last place of them."""
    spark = reads.sparkSession
    plain = lambda text: set(text) <= set("ACGT")
    # A reverse tag with ambiguous letters is searched for with its primer.
    patterns = [(*p[:4], p[4], p[5]) if plain(p[5]) else (*p[:4], p[4] + p[5], "") for p in patterns]
    heads, tails = sorted({(p[3], len(p[2])) for p in patterns}), sorted({p[4] for p in patterns})
    lines = [(heads.index((f, len(tag))), tag, smp, m, i, len(tag) + len(f), tails.index(r), len(r), end) for i, (smp, m, tag, f, r, end) in enumerate(patterns)]
    sheet = spark.createDataFrame(lines, "kind int, tag string, sample string, marker string, line int, head int, tail int, tail_length int, tag_rc string")
    sheet = F.broadcast(sheet) if sum(64 + sum(len(x) for x in p) for p in patterns) <= SHEET_BYTES else sheet
    given = reads.columns
    found = reads.withColumn("__ends", _ends(heads, tails)(F.col("seq"))).withColumn("__h", F.explode("__ends.heads"))
    found = found.select(*given, "__ends", "__h", F.col("__h.kind").alias("kind"), F.col("__h.tag").alias("tag")).join(sheet, ["kind", "tag"])
    turned = s.reverse_complement(F.upper("seq"))

    def stop(side: str, text: Column) -> Column:
        fits = lambda t: (t["kind"] == F.col("tail")) & (t["start"] > F.col(f"__h.{side}") + F.col("head")) & ((F.col("tag_rc") == "") | (F.substr(text, t["start"] + F.col("tail_length") + 1, F.length("tag_rc")) == F.col("tag_rc")))
        return F.when(F.col(f"__h.{side}").isNotNull(), F.array_max(F.transform(F.filter(f"__ends.{side}", fits), lambda t: t["start"])))

    # An explode, not a filter, takes the first strand that matches: a filter would be
    # pushed down and all that it needs be computed twice.
    ends = F.array(*[F.struct(F.lit(side == "turned").alias("turned"), F.col(f"__h.{side}").alias("head"), stop(side, text).alias("stop")) for side, text in (("forward", F.upper("seq")), ("turned", turned))])
    hits = found.withColumn("__m", F.explode(F.slice(F.filter(ends, lambda x: x["stop"].isNotNull()), 1, 1)))
    back, head, begin = F.col("__m.turned"), F.col("__m.head"), F.col("__m.head") + F.col("head")
    hits = hits.select(*given, "sample", "marker", "tag", "line", F.when(back, turned).otherwise(F.upper("seq")).alias("strand"), back.alias("turned"), (head + 1).alias("at"), (begin + 1).alias("start"), (F.col("__m.stop") - begin).alias("length"))
    if len({p[:2] for p in patterns}) < len(patterns):  # an amplicon has several lines: its first counts
        first = Window.partitionBy("read_id", "sample", "marker").orderBy("line")
        hits = hits.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    return hits.drop("line")


def demultiplex(reads: DataFrame, patterns: list[Line]) -> DataFrame:
    """read_id, sample, marker, seq (the greedy insert, on the forward strand). A read
    counts once for an amplicon and may match several."""
    hits = _matches(reads.select("read_id", "seq"), patterns)
    return hits.select("read_id", "sample", "marker", F.substr("strand", F.col("start"), F.col("length")).alias("seq"))


def retag(reads: DataFrame, patterns: list[Line], new_tags: DataFrame) -> DataFrame:
    """read_id, sample, marker, seq, qual of the reads that match, on the forward strand;
    those of samples in new_tags (sample, new_tag) carry the new tag in place of theirs, its
    bases with the quality of the tag's first."""
    hits = _matches(reads.select("read_id", "seq", "qual"), patterns).join(new_tags.select("sample", "new_tag"), "sample", "left")
    hits = hits.withColumn("quals", F.when(F.col("turned"), F.reverse("qual")).otherwise(F.col("qual")))
    new = F.col("new_tag").isNotNull()
    swap = lambda text, tag: F.when(new, F.concat(F.substr(text, F.lit(1), F.col("at") - 1), tag, F.substr(text, F.col("at") + F.length("tag"), F.length(text)))).otherwise(F.col(text))
    first = F.substr("quals", F.col("at"), F.lit(1))
    return hits.select("read_id", "sample", "marker", swap("strand", F.col("new_tag")).alias("seq"), swap("quals", F.repeat(first, F.length("new_tag"))).alias("qual"))


def reads_of_amplicons(reads: DataFrame, patterns: list[Line]) -> DataFrame:
    """Reads (of one read_id each) that match some amplicon in either strand."""
    whole = reads.select("read_id", "seq", F.struct(*reads.columns).alias("__read"))
    return _matches(whole, patterns).dropDuplicates(["read_id"]).select("__read.*")


def pairs_of_amplicons(left: DataFrame, right: DataFrame, patterns: list[Line]) -> tuple[DataFrame, DataFrame]:
    """Both mates of the pairs of which each mate matches some amplicon in either strand."""
    both = [_matches(mates.select("read_id", "seq"), patterns).select("read_id").distinct() for mates in (left, right)]
    ids = both[0].join(both[1], "read_id")
    return left.join(ids, "read_id", "left_semi"), right.join(ids, "read_id", "left_semi")


def inserts_from_hits(hits: DataFrame, reads: DataFrame) -> DataFrame:
    """From primer hits (read_id, sample, marker, side F or R, strand, start, stop):
    the insert between a forward and a reverse hit of one amplicon on one strand;
    the first such pair of a read counts."""
    side = lambda x: F.filter("hits", lambda h: h["side"] == x)
    pairs = F.flatten(F.transform(side("F"), lambda f: F.transform(F.filter("back", lambda b: (b["strand"] == f["strand"]) & (b["start"] > f["stop"])), lambda b: F.struct(f["stop"].alias("left"), b["start"].alias("right"), f["strand"].alias("strand")))))
    # Dealt by read at once, so that the reads meet them where they are.
    each = hits.repartition("read_id").groupBy("read_id", "sample", "marker").agg(F.collect_list(F.struct("side", "strand", "start", "stop")).alias("hits"))
    first = each.withColumn("back", side("R")).select("read_id", "sample", "marker", F.explode(F.slice(F.array_sort(pairs), 1, 1)).alias("p")).select("read_id", "sample", "marker", "p.*")
    seq = F.substr("seq", F.col("left") + 1, F.col("right") - F.col("left") - 1)
    return first.join(reads.select("read_id", "seq"), "read_id").select("read_id", "sample", "marker", F.when(F.col("strand") == "-", s.reverse_complement(seq)).otherwise(seq).alias("seq"))


def primer_hits(reads: DataFrame, primers: list[tuple[str, str]], max_percent: float = 10) -> DataFrame:
    """read_id, primer, strand, start, stop (from 1, on the read as it is), errors: all
    places of the primers (name, IUPAC sequence), as they are (+) and as reverse
    complements (-), with at most ``max_percent`` of their letters wrong."""
    turn = str.maketrans(s.IUPAC, s.COMPLEMENT)
    wanted = [(name, strand, search.pattern_masks(p), int(max_percent * len(p) / 100)) for name, seq in primers for strand, p in (("+", seq.upper()), ("-", seq.upper()[::-1].translate(turn)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, letters in search.letters_by_length(batch.column(1)):
                for name, strand, pattern, most in wanted:
                    row, start, errors = search.places(letters, pattern, most)
                    if len(row):
                        ids = batch.column(0).take(pa.array(rows[row]))
                        same = [pa.array([x] * len(row)) for x in (name, strand)]
                        numbers = [pa.array(v, pa.int32()) for v in (start + 1, start + len(pattern), errors)]
                        yield pa.RecordBatch.from_arrays([ids, *same, *numbers], ["read_id", "primer", "strand", "start", "stop", "errors"])

    key = reads.schema["read_id"].dataType.simpleString()
    return reads.select("read_id", "seq").where("seq is not null").mapInArrow(run, f"read_id {key}, primer string, strand string, start int, stop int, errors int")


def join_mates(left: DataFrame, right: DataFrame, reverse: bool = True) -> DataFrame:
    """R1 followed by R2, reverse-complemented with its own qualities reversed unless told otherwise."""
    r = right.select("read_id", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    seq2, qual2 = (s.reverse_complement("seq2"), F.reverse("qual2")) if reverse else (F.col("seq2"), F.col("qual2"))
    return left.join(r, "read_id").select("read_id", F.concat("seq", seq2).alias("seq"), F.concat("qual", qual2).alias("qual"))


#: Complements of letters in either case.
_TURNED = np.arange(256, dtype=np.uint8)
_TURNED[list((s.IUPAC + s.IUPAC.lower()).encode())] = list((s.COMPLEMENT + s.COMPLEMENT.lower()).encode())


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts, a byte each, and the texts' bounds."""
    if not pc.all(pc.string_is_ascii(column), min_count=0).as_py():
        column = pa.array([x.encode("latin-1") for x in column.to_pylist()], pa.large_binary())
    _, offsets, values = column.cast(pa.large_binary()).buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8), bounds


def _texts(columns: np.ndarray) -> pa.Array:
    """The texts whose letters stand below each other."""
    rows = np.ascontiguousarray(columns.T)
    if rows.size and rows.max() > 127:
        return pa.array(texts_of(rows))
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.StringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(rows))


def merge_mates(left: DataFrame, right: DataFrame, shortest: int = 10, longest: int = 200, max_mismatch: float = 0.25) -> DataFrame:
    """One read from overlapping mates: the overlap with the lowest share of
    mismatches (the longest, if equal); in it the base of higher quality."""
    names = ["read_id", "seq", "qual", "overlap"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.column(1).null_count or batch.column(3).null_count:  # not before: a filter would be pushed down
                batch = batch.filter(pc.and_(batch.column(1).is_valid(), batch.column(3).is_valid()))
            texts = [_letters(c) for c in batch.columns[1:]]
            (la, qla, lb, qlb), out = (np.diff(bounds) for _, bounds in texts), []
            if (la != qla).any() or (lb != qlb).any():
                raise ValueError("a read and its qualities differ in length")
            for pair in np.unique(la << 32 | lb).tolist():
                na, nb = pair >> 32, pair & 0xFFFFFFFF
                rows = np.flatnonzero((la == na) & (lb == nb))
                # A column for each pair of mates: sums go over whole rows of numbers.
                a, qa, b, qb = (data[bounds[rows] + np.arange(n)[:, None]] for (data, bounds), n in zip(texts, (na, na, nb, nb), strict=True))
                b, qb = _TURNED[b[::-1]], qb[::-1]
                share, best = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64)
                for n in range(min(longest, na, nb), shortest - 1, -1):
                    wrong = (a[na - n :] != b[:n]).view(np.uint8).sum(axis=0, dtype=np.uint8 if n < 256 else np.int64) / n
                    better = (wrong <= max_mismatch) & (wrong < share)
                    share[better], best[better] = wrong[better], n
                    if not share.any():  # no shorter overlap is better than none wrong
                        break
                for n in np.unique(best[best > 0]).tolist():
                    at = np.flatnonzero(best == n)
                    ours, theirs, q, p = a[na - n :, at], b[:n, at], qa[na - n :, at], qb[:n, at]
                    seq = np.concatenate([a[: na - n, at], np.where(q >= p, ours, theirs), b[n:, at]])
                    qual = np.concatenate([qa[: na - n, at], np.maximum(q, p), qb[n:, at]])
                    out.append(pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[at])), _texts(seq), _texts(qual), pa.array(np.full(len(at), n, np.int32))], names))
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    key = left.schema["read_id"].dataType.simpleString()
    r = right.select("read_id", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return left.select("read_id", "seq", "qual").join(r, "read_id").mapInArrow(run, f"read_id {key}, seq string, qual string, overlap int")


def fold_strands(inserts: DataFrame, weight: Column) -> DataFrame:
    """Depths with reads that are the reverse complement of a deeper-or-equal known
    variant of the amplicon folded onto it."""
    counted = inserts.groupBy("marker", "sample", F.md5(F.upper("seq")).alias("md5")).agg(F.first(F.upper("seq")).alias("seq"), F.sum(weight).alias("depth"))
    other = counted.select("marker", "sample", F.col("md5").alias("rc_md5"), F.col("depth").alias("rc_depth"))
    joined = counted.withColumn("rc_md5", F.md5(s.reverse_complement("seq"))).join(other, ["marker", "sample", "rc_md5"], "left")
    flip = (F.col("rc_depth") > F.col("depth")) | ((F.col("rc_depth") == F.col("depth")) & (F.col("rc_md5") < F.col("md5")))
    folded = joined.select("marker", "sample", F.when(flip, s.reverse_complement("seq")).otherwise(F.col("seq")).alias("seq"), "depth")
    return folded.groupBy("marker", "sample", F.md5("seq").alias("md5")).agg(F.first("seq").alias("seq"), F.sum("depth").alias("depth"))


def tag_primer_sequences(samples: DataFrame, markers: DataFrame) -> DataFrame:
    """Plain sequences of tag + primer of every amplicon (small sheets): name, seq."""
    seqs = samples.crossJoin(markers).select("sample", "marker", F.posexplode(s.plain_sequences(F.concat(F.coalesce("tag_f", F.lit("")), "primer_f"))).alias("n", "seq"))
    return seqs.select(F.concat("sample", F.lit("-"), "marker", F.lit("_F"), F.lpad((F.col("n") + 1).cast("string"), 3, "0")).alias("name"), "seq")


def add_tags(reads: DataFrame, samples: DataFrame, markers: DataFrame, quality: str = "?") -> DataFrame:
    """The inverse of demultiplex: tag, primer, read, reverse primer; quality padded."""
    head, tail = F.concat("tag_f", "primer_f"), F.concat(F.col("primer_rc"), F.coalesce("tag_rc", F.lit("")))
    joined = reads.join(samples, "sample").join(markers, "marker")
    padded = F.concat(F.repeat(F.lit(quality), F.length(head)), "qual", F.repeat(F.lit(quality), F.length(tail)))
    return joined.select("read_id", "sample", "marker", F.concat(head, "seq", tail).alias("seq"), padded.alias("qual"))


def retag_clashes(runs: DataFrame, new_tags: list[str]) -> DataFrame:
    """Samples (run, sample, tag_f) of several runs: a tag that an earlier run has is
    replaced by the next of ``new_tags``; new_tag is null where nothing changes. Too
    few of them raise an error when the rows are read."""
    nth = F.row_number().over(Window.partitionBy("tag_f").orderBy("run", "sample"))
    clash = runs.withColumn("nth", nth).withColumn("clash", (F.col("nth") > 1).cast("int"))
    order = F.sum("clash").over(Window.orderBy("run", "sample", "tag_f"))  # a row for each sample of the sheets
    more = F.raise_error(F.lit(f"more than {len(new_tags)} tags clash")).cast("string")
    tag = F.coalesce(F.get(F.array(*[F.lit(t) for t in new_tags]).cast("array<string>"), (order - 1).cast("int")), more)
    return clash.withColumn("new_tag", F.when(F.col("clash") == 1, tag)).drop("nth", "clash")


def sample_reads(reads: DataFrame, n: int, seed: str = "1", keys: tuple[str, ...] = (), order: str = "read_id") -> DataFrame:
    """``n`` reads (of each of ``keys``) by the order of a hash: the same on every run."""
    if not keys:
        return reads.orderBy(F.md5(F.concat(F.lit(seed), order)), order).limit(n)
    drawn = F.md5(F.concat(F.lit(seed), order))
    return first_rows(reads, list(keys), [F.substring(drawn, 1, 4)], [drawn, F.col(order)], n).drop("nth")


def shuffle_reads(reads: DataFrame, seed: str = "1", order: str = "read_id") -> DataFrame:
    return reads.orderBy(F.md5(F.concat(F.lit(seed), order)), order)


def split_reads(reads: DataFrame, parts: int, order: str = "read_id") -> DataFrame:
    """Adds ``part`` (from 0), near even and the same on every run, by a hash of ``order``."""
    return reads.withColumn("part", (F.conv(F.substring(F.md5(F.col(order).cast("string")), 1, 8), 16, 10).cast("long") % parts).cast("int"))


def sampling_rounds(reads: DataFrame, rounds: int, n: int, order: str = "read_id") -> DataFrame:
    """``rounds`` samples of ``n`` reads each, with their ``round``; drawn anew in each, in one pass."""
    every = reads.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    drawn = F.md5(F.concat(F.col("round").cast("string"), order))
    return first_rows(every, ["round"], [F.substring(drawn, 1, 4)], [drawn, F.col(order)], n).drop("nth")

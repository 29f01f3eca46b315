"""Line dedup by content-defined chunks of lines, with DataFrame functions only.

A line here is a line with a word, and the lines without one that follow it
belong to it: they are no part of what is compared, and go where it goes. Lines
that occur once anywhere belong to no chunk. A run is lines one behind the other
that occur equally often. Runs are cut into chunks: before a line where the
rolling hash of the WINDOW lines above it, all of the run, is 0 modulo DIVISOR,
and on both sides of a line of LONG_WORDS words or more. So a
passage has the same boundaries between a document's own lines, beside blank
lines and beside lines that are more common, and they come back after an
insertion. A chunk that occurs again anywhere counts but for its first occurrence
(smallest doc_id, then position) and is removed if it has two lines or more, or if
it and its counted neighbours make two lines or more of LONG_WORDS words. With
``single_lines`` a line of LONG_WORDS words is removed on its own, too; that is
off in op1, where chunks have more lines than one, and on in the pipeline, where
passages may be a line. Hashes only nominate lines; the grouping that decides
compares bytes.

Defined results: a null text stays null and has no lines; a text without words
has no line to remove; a document that loses all lines keeps what stands before
the first, as a rule an empty text; rows with equal doc_id and text count as one
document and get the same result, rows with equal doc_id and other texts are
documents of their own; a null doc_id sorts first. Other columns pass unchanged,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, by_position, let, materialise, md5_number, table

WINDOW, DIVISOR, LONG_WORDS = 2, 3, 50
MULTIPLIER, PRIME = 31_337, 2_147_483_647
_ID, _HASH = "__line_id", "__line_hash"


#: A line end that a line with a word follows.
_BREAK = r"\n(?=[\x20\x09\x0B-\x0D]*+[^\x20\x09-\x0D])"


def _units(text: Column) -> Column:
    """The lines with a word, each with the blank lines after it; what has no
    word before the first is a unit, too."""
    return F.split(text, _BREAK, -1)


def _line(unit: Column) -> Column:
    return F.substring_index(unit, "\n", 1)


def _chunks(text: Column, at: Column, times: Column) -> Column:
    """Array of (first, n_lines, n_words, body) of the chunks of the lines ``at``
    (sorted), which occur ``times``."""

    def starts(hashes: Column, words: Column) -> Column:
        def opens(k: Column) -> Column:
            rolling = F.lit(0).cast("long")
            for back in range(WINDOW, 0, -1):
                rolling = (rolling * MULTIPLIER + F.get(hashes, k - back)) % PRIME
            of_run = F.get(at, k - WINDOW) == F.get(at, k) - WINDOW
            for back in range(1, WINDOW + 1):
                of_run = of_run & (F.get(times, k - back) == F.get(times, k))
            long = (F.get(words, k) >= LONG_WORDS) | (F.get(words, k - 1) >= LONG_WORDS)
            rarer = F.get(times, k - 1) != F.get(times, k)
            return (k == 0) | (F.get(at, k - 1) != F.get(at, k) - 1) | long | rarer | ((k >= WINDOW) & of_run & (rolling % DIVISOR == 0))

        return F.filter(F.sequence(F.lit(0), F.size(at) - 1), opens)

    def of(lines: Column) -> Column:
        def built(words: Column) -> Column:
            def cut(begins: Column) -> Column:
                def one(k: Column, j: Column) -> Column:
                    n = F.coalesce(F.get(begins, j + 1), F.size(at)) - k
                    body = F.array_join(F.slice(lines, k + 1, n), "\n")
                    return F.struct(F.get(at, k).alias("first"), n.alias("n_lines"), F.aggregate(F.slice(words, k + 1, n), F.lit(0), lambda a, x: a + x).alias("n_words"), body.alias("body"))

                return F.transform(begins, one)

            return let(let(F.transform(lines, md5_number), lambda hashes: starts(hashes, words)), cut)

        return let(F.transform(lines, lambda line: F.regexp_count(line, F.lit(WORD))), built)

    return let(let(_units(text), lambda units: F.transform(at, lambda i: _line(F.get(units, i)))), of)


def _without(text: Column, removed: Column) -> Column:
    """``text`` without the ranges of lines ``removed`` (first, n_lines, sorted)."""

    def of(lines: Column) -> Column:
        def part(k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(removed, k - 1)["first"] + F.get(removed, k - 1)["n_lines"])
            stop = F.when(k == F.size(removed), F.size(lines)).otherwise(F.get(removed, k)["first"])
            return F.slice(lines, start + 1, stop - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(removed)), part)), "\n")

    return let(_units(text), of)


def _deduped(docs: DataFrame, doc_id: str, text: str, single_lines: bool) -> tuple[DataFrame, list[str]]:
    """``docs`` by position with the text shortened, plus ``removed``: the removed
    chunks (first line, number of lines), null where nothing was removed; and the
    names of doc_id and text."""
    plain, (of, at) = by_position(docs, doc_id, text)
    keyed = plain.withColumns({_ID: F.coalesce(F.col(of).cast("long"), F.lit(-(1 << 63))), _HASH: F.coalesce(F.xxhash64(at), F.lit(0))})
    slim = keyed.select(_ID, _HASH, F.col(at).alias("whole"))
    worded = F.when(F.regexp_like("unit", F.lit(r"[^\x20\x09-\x0D]")), F.xxhash64(_line(F.col("unit"))))
    units = slim.select(_ID, _HASH, F.posexplode(_units(F.col("whole"))).alias("at", "unit"))
    lines = materialise(units.select(_ID, _HASH, "at", worded.alias("line")).where("line is not null"))
    repeated = materialise(lines.groupBy("line").agg(F.count("*").alias("times")).where("times > 1"))
    nominated = lines.join(repeated, "line").groupBy(_ID, _HASH).agg(F.array_sort(F.collect_set(F.struct("at", "times"))).alias("rows"))
    cut = slim.join(nominated, [_ID, _HASH]).select(_ID, _HASH, F.explode(_chunks(F.col("whole"), F.col("rows.at"), F.col("rows.times"))).alias("c"))
    chunks = materialise(cut.select(_ID, _HASH, "c.*", F.xxhash64("c.body").alias("key")))
    owners = chunks.groupBy("key", "body").agg(F.min(F.struct(_ID, "first", _HASH)).alias("owner"), F.count("*").alias("times")).where("times > 1")
    later = chunks.join(materialise(owners.drop("times")), ["key", "body"]).where(F.struct(_ID, "first", _HASH) != F.col("owner"))
    later = later.select(_ID, _HASH, "first", "n_lines", "n_words").distinct()
    before = Window.partitionBy(_ID, _HASH).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    island = Window.partitionBy(_ID, _HASH, "island")
    later = later.withColumn("island", F.col("first") - F.coalesce(F.sum("n_lines").over(before), F.lit(0)))
    goes = (F.col("n_lines") >= 2) | ((F.sum("n_lines").over(island) >= 2) & (F.sum("n_words").over(island) >= LONG_WORDS))
    if single_lines:
        goes = goes | (F.col("n_words") >= LONG_WORDS)
    gone = later.withColumn("goes", goes).where("goes")
    removed = gone.groupBy(_ID, _HASH).agg(F.array_sort(F.collect_list(F.struct("first", "n_lines"))).alias("removed"))
    out = keyed.join(removed, [_ID, _HASH], "left").drop(_ID, _HASH)
    return out.withColumn(at, F.when(F.col("removed").isNull(), F.col(at)).otherwise(_without(F.col(at), F.col("removed")))), [of, at]


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", single_lines: bool = False) -> DataFrame:
    """``docs`` with the texts shortened."""
    out, _ = _deduped(docs, doc_id, text, single_lines)
    return out.drop("removed").toDF(*docs.columns)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the texts shortened, by single lines too, and their lengths in
    ``n_chars`` with them; a document that loses all its words goes."""
    out, (_, at) = _deduped(docs, doc_id, text, True)
    _, (_, number) = by_position(docs, text, n_chars)
    changed = F.col("removed").isNotNull()
    out = out.where(~changed | F.regexp_like(at, F.lit(r"[^\x20\x09-\x0D]")))
    return out.withColumn(number, F.when(changed, F.length(at).cast("long")).otherwise(F.col(number))).drop("removed").toDF(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_lines: all lines of the text; n_lines_removed: those with a word that went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"))
    out, (of, at) = _deduped(docs, "doc_id", "text", False)
    gone = F.coalesce(F.aggregate("removed", F.lit(0), lambda a, r: a + r["n_lines"]), F.lit(0)).cast("long")
    return out.select(F.col(of).alias("doc_id"), F.col("c2").alias("n_lines"), gone.alias("n_lines_removed"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_chunks_removed"), F.col(at).alias("text"))


def op1_sql() -> str:
    rolling = "0"
    for k in range(WINDOW, 0, -1):
        rolling = f"(({rolling}) * {MULTIPLIER} + lag(h, {k}) OVER w) % {PRIME}"
    return f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS raw FROM documents WHERE text IS NOT NULL),
all_lines AS (SELECT *, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS words FROM lines),
units AS (SELECT *, sum(CASE WHEN words > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY raw) AS i FROM all_lines),
g AS (SELECT *, ('0x' || substr(md5(l), 1, 8))::BIGINT AS h FROM (SELECT *, count(*) OVER (PARTITION BY l) AS times FROM units WHERE words > 0) WHERE times > 1),
u AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, times ORDER BY i) AS run FROM g),
o AS (SELECT *, lag(i) OVER w IS NULL OR words >= {LONG_WORDS} OR lag(words) OVER w >= {LONG_WORDS} OR (lag(i, {WINDOW}) OVER w IS NOT NULL AND ({rolling}) % {DIVISOR} = 0) AS opens FROM u WINDOW w AS (PARTITION BY doc_id, times, run ORDER BY i)),
n AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM o),
c AS (SELECT doc_id, min(i) AS first, count(*) AS n, sum(words) AS words, string_agg(l, chr(10) ORDER BY i) AS body FROM n GROUP BY doc_id, chunk),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS nth FROM c) WHERE nth > 1),
s AS (SELECT *, first - coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM k),
r AS (SELECT doc_id, first, n FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id, island) AS all_n, sum(words) OVER (PARTITION BY doc_id, island) AS all_words FROM s) WHERE n >= 2 OR (all_n >= 2 AND all_words >= {LONG_WORDS})),
x AS (SELECT units.doc_id, units.l, units.raw, words > 0 AS worded, r.first IS NOT NULL AS gone, r.first = units.i AND words > 0 AS heads FROM units LEFT JOIN r ON r.doc_id = units.doc_id AND units.i >= r.first AND units.i < r.first + r.n)
SELECT d.doc_id, count(x.raw)::BIGINT AS n_lines, count(*) FILTER (gone AND worded)::BIGINT AS n_lines_removed, count(*) FILTER (heads)::BIGINT AS n_chunks_removed,
  CASE WHEN any_value(d.text) IS NOT NULL THEN coalesce(string_agg(x.l, chr(10) ORDER BY x.raw) FILTER (NOT gone), '') END AS text
FROM documents d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY d.doc_id"""

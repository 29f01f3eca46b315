"""Language identification by compression.

A language's dictionary is raw text: a sample of its labelled documents, of
SAMPLE_TEXTS distinct texts of SAMPLE_CHARS characters each at most, of which the
last DICTIONARY_BYTES are kept. A text is compressed once with each dictionary,
whole, and belongs to the language that makes it smallest; ties go to the language
with most learning documents, then by name. The score is the margin to the second
language, as a share of its size; with a margin below NARROW a prediction isn't
``accepted``. Compressed is the text in lower case with blanks for all of ASCII but
letters. The sample is drawn by a hash of the text; neither doc_id nor source has
a part in it, and the labels only name the dictionaries.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and
isn't accepted, nor learned from; a null language isn't learned from; copies of a
text count once in the sample; with one language learned every other text is of
it, with score 0; with none all are ``und``; a null doc_id hashes as an empty
text; repeated rows each have a row; an empty table gives no rows; other columns
aren't read, so their names are free.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import first_rows
from .common import by_position, materialise, table

SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 1 << 14, 1 << 18
LEVEL, NARROW = 6, 0.01
#: Dictionaries are broadcast; more languages than these are an error.
MOST_LANGUAGES = 256
UNKNOWN = "und"

_LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def _plain(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS)


def _has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def learned(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """The dictionary of each language, those with most documents first."""
    plain, (at, by) = by_position(docs, text, lang)
    rows = plain.where(F.col(by).isNotNull() & _has_letter(F.col(at))).select(F.col(by).alias("lang"), F.md5(at).alias("drawn"), F.left(at, F.lit(SAMPLE_CHARS)).alias("text"))
    often = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(often) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # Distinct hashes, so no copies; of each language only the cells with the least are sorted.
    hashes = materialise(rows.select("lang", "drawn").distinct())
    chosen = first_rows(hashes, ["lang"], [F.substring("drawn", 1, 3)], [F.col("drawn")], SAMPLE_TEXTS)
    sample = rows.join(F.broadcast(chosen), ["lang", "drawn"]).groupBy("lang", "nth").agg(F.max("text").alias("text"))
    texts: dict[str, list] = {k: [] for k in sorted(often, key=lambda k: (-often[k], k))}
    for r in sample.collect():  # at most SAMPLE_TEXTS of SAMPLE_CHARS for each language
        texts[r["lang"]].append((r["nth"], r["text"]))
    return {k: b" ".join(_plain(t) for _, t in sorted(v))[-DICTIONARY_BYTES:] for k, v in texts.items()}


def _sizes(dictionaries: dict[str, bytes], level: int):
    """The compressed sizes of a text, one for each dictionary."""
    import zstandard

    packers = []
    for raw in dictionaries.values():
        own = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=level)
        packers.append(zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False))
    return lambda text: [len(p.compress(text)) for p in packers]


PREDICTION = "lang_pred string, score double, accepted boolean"


def identify(text: Column, dictionaries: dict[str, bytes], spark: SparkSession, narrow: float = NARROW) -> Column:
    """Struct of lang_pred, score and accepted for a text column."""
    held = spark.sparkContext.broadcast(dictionaries)

    @F.arrow_udf(PREDICTION)
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, sizes = list(held.value), None
        for column in columns:
            langs, scores = [], []
            for value in column:
                value = value.as_py()
                if value is None or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                sizes = sizes or _sizes(held.value, LEVEL)
                of = sizes(_plain(value))
                best = min(range(len(of)), key=of.__getitem__)  # the first of equal sizes
                second = min((x for k, x in enumerate(of) if k != best), default=of[best])
                langs.append(names[best])
                scores.append((second - of[best]) / second)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array([x >= narrow for x in scores], pa.bool_())], ["lang_pred", "score", "accepted"])

    return predicted(F.when(_has_letter(text), text))


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    known = learned(docs.where(~held_out))
    out = docs.select("doc_id", held_out.alias("held_out"), identify(F.col("text"), known, spark).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")

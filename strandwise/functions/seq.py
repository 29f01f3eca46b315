"""Column functions on sequences, qualities, headers, taxonomy strings and names.

All but the means and forms of qualities, which read whole batches in numpy, are
built-in expressions and stay in the JVM. Positions are 1-based and closed. Null in
gives null out unless stated."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: IUPAC letters and their complements, in order.
IUPAC, COMPLEMENT = "ACGTUMRWSYKVHDBXN", "TGCAAKYWSRMBDHVXN"
#: The bases that an IUPAC letter stands for.
AMBIGUOUS = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT", "X": "ACGT"}
#: The standard genetic code, by first, second and third base in the order TCAG.
GENETIC_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Letters that stand for several amino acids.
AMINO_SETS = {"J": "IL", "B": "DN", "Z": "EQ", "X": "ACDEFGHIKLMNPQRSTVWY"}
#: Amino acids by letter.
AMINO_ACIDS = {"A": "Ala", "R": "Arg", "N": "Asn", "D": "Asp", "C": "Cys", "Q": "Gln", "E": "Glu", "G": "Gly", "H": "His", "I": "Ile", "L": "Leu", "K": "Lys", "M": "Met", "F": "Phe", "P": "Pro", "S": "Ser", "T": "Thr", "W": "Trp", "Y": "Tyr", "V": "Val", "*": "Ter"}
LEVELS = ("kingdom", "domain", "phylum", "class", "order", "family", "genus", "species")
#: Offsets of Phred text by kind.
PHRED_OFFSET = {"sanger": 33, "illumina": 33, "solexa": 64, "illumina_old": 64}
CODONS = {a + b + c: GENETIC_CODE[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def letters(seq: str | Column) -> Column:
    """The letters as an array; none for an empty text."""
    return F.filter(F.split(_c(seq), ""), lambda x: x != "")


def reverse_complement(seq: str | Column) -> Column:
    return F.reverse(F.translate(_c(seq), IUPAC + IUPAC.lower(), COMPLEMENT + COMPLEMENT.lower()))


def sequence_key(seq: str | Column, length: int = 32) -> Column:
    return F.substring(F.md5(F.upper(_c(seq))), 1, length)


def iupac_regex(seq: str | Column) -> Column:
    """Regular expression that the plain sequences of an IUPAC sequence match."""
    classes = _map({k: v if len(v) == 1 else f"[{v}]" for k, v in AMBIGUOUS.items()})
    return F.array_join(F.transform(letters(F.upper(_c(seq))), lambda x: F.coalesce(classes[x], x)), "")


def iupac_pattern(seq: str) -> str:
    return "".join(b if len(b) == 1 else f"[{b}]" for b in (AMBIGUOUS.get(x, x) for x in seq.upper()))


def complement_pattern(pattern: str) -> str:
    """The ``iupac_pattern`` of the reverse complement of what ``pattern`` was made of."""
    turned = [x.translate(str.maketrans(IUPAC, COMPLEMENT)) for x in re.findall(r"\[[A-Z]+\]|[A-Z]", pattern)]
    return "".join(reversed(turned))


def plain_sequences(seq: str | Column) -> Column:
    """Array of all unambiguous sequences of an IUPAC sequence."""
    bases = _map(AMBIGUOUS)
    return F.aggregate(letters(F.upper(_c(seq))), F.array(F.lit("")), lambda acc, x: F.flatten(F.transform(acc, lambda a: F.transform(letters(bases[x]), lambda b: F.concat(a, b)))))


def n_plain_sequences(seq: str | Column) -> Column:
    bases = _map(AMBIGUOUS)
    return F.aggregate(letters(F.upper(_c(seq))), F.lit(1).cast("long"), lambda acc, x: acc * F.length(bases[x]))


def prosite_to_regex(pattern: str | Column) -> Column:
    out = F.regexp_replace(_c(pattern), r"\{([A-Z]+)\}", "[^$1]")
    out = F.regexp_replace(out, r"\((\d+(?:,\d+)?)\)", "{$1}")
    out = F.regexp_replace(F.regexp_replace(out, "^<", "^"), r">\.?$", "\\$")
    return F.regexp_replace(F.regexp_replace(out, r"[-. ]", ""), "x", ".")


def regex_to_prosite(pattern: str | Column) -> Column:
    out = F.regexp_replace(_c(pattern), r"\{(\d+(?:,\d+)?)\}", "($1)")
    out = F.regexp_replace(out, r"\[\^([A-Z]+)\]", "{$1}")
    out = F.regexp_replace(out, r"\.", "x")
    # A dash between elements, but not inside brackets.
    return F.regexp_replace(out, r"(\]|\}|\)|[A-Zx])(?=[A-Zx\[{])(?![^\[{]*[\]}])", "$1-")


def translate_dna(seq: str | Column, frame: int | Column = 1) -> Column:
    """Protein from ``frame`` (1 to 3); an unknown codon is X, a partial one is left out."""
    code, frame = _map(CODONS), F.lit(frame) if isinstance(frame, int) else frame

    def protein(dna: Column) -> Column:
        last = F.length(dna) - 2
        at = F.when(last >= frame, F.sequence(frame, F.greatest(last, frame), F.lit(3))).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(at, lambda i: F.coalesce(F.try_element_at(code, F.substr(dna, i, F.lit(3))), F.lit("X"))), "")

    return let(F.translate(F.upper(_c(seq)), "U", "T"), protein)


def has_stop(seq: str | Column, frame: int = 1) -> Column:
    return F.contains(translate_dna(seq, frame), F.lit("*"))


def open_frames(seq: str | Column) -> Column:
    """Frames 1 to 3 without a stop."""
    return F.array_compact(F.array(*[F.when(~has_stop(seq, f), F.lit(f)) for f in (1, 2, 3)]))


def best_frame(seq: str | Column) -> Column:
    """The frame with fewest stops, the smallest if several."""
    stops = [F.struct(F.length(p) - F.length(F.replace(p, F.lit("*"), F.lit(""))), F.lit(f).alias("frame")) for f in (1, 2, 3) for p in [translate_dna(seq, f)]]
    return F.array_min(F.array(*[s.cast("struct<stops:int,frame:int>") for s in stops]))["frame"]


def translations(seq: str | Column, both_strands: bool = False, drop_stops: bool = False) -> Column:
    """Array of frame (1 to 3, negative on the other strand), dna (whole codons) and protein."""
    strands = [(1, _c(seq)), (-1, reverse_complement(seq))][: 1 + both_strands]
    whole = lambda dna, f: F.substr(dna, F.lit(f), F.floor((F.length(dna) - f + 1) / 3).cast("int") * 3)
    every = F.array(*[F.struct(F.lit(side * f).alias("frame"), whole(dna, f).alias("dna"), translate_dna(dna, f).alias("protein")) for side, dna in strands for f in (1, 2, 3)])
    return F.filter(every, lambda t: ~F.contains(t["protein"], F.lit("*"))) if drop_stops else every


def has_stop_in(seq: str | Column, frame: str | Column) -> Column:
    """Is there a stop in the frame that a column names? True where it names none."""
    return F.coalesce(F.get(F.array(*[has_stop(seq, f) for f in (1, 2, 3)]), _c(frame) - 1), F.lit(True))


def hamming(a: str | Column, b: str | Column) -> Column:
    """Differing positions; null if lengths differ."""
    differ = F.aggregate(F.zip_with(letters(a), letters(b), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(F.length(_c(a)) == F.length(_c(b)), differ)


def first_difference(a: str | Column, b: str | Column) -> Column:
    """Length of the longest common prefix."""
    n = F.least(F.length(_c(a)), F.length(_c(b)))
    same = F.zip_with(letters(a), letters(b), lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False)
    return F.when(at > 0, (at - 1).cast("int")).otherwise(n)


def common_suffix(a: str | Column, b: str | Column) -> Column:
    return first_difference(F.reverse(_c(a)), F.reverse(_c(b)))


def single_error(seq: str | Column, ref: str | Column) -> Column:
    """Struct kind (identical, substitution, insertion, deletion, none) and 1-based position."""
    s, r = _c(seq), _c(ref)
    at = first_difference(s, r) + 1
    tail = lambda x, k: F.substr(x, at + k, F.length(x) + 1)
    kind = (
        F.when(s == r, "identical")
        .when((F.length(s) == F.length(r)) & (tail(s, 1) == tail(r, 1)), "substitution")
        .when((F.length(s) == F.length(r) + 1) & (tail(s, 1) == tail(r, 0)), "insertion")
        .when((F.length(s) + 1 == F.length(r)) & (tail(s, 0) == tail(r, 1)), "deletion")
        .otherwise("none")
    )
    return F.struct(kind.alias("kind"), F.when(~kind.isin("identical", "none"), at).alias("position"))


def identity(a: str | Column, b: str | Column) -> Column:
    """Struct matches, total over columns of an aligned pair with a base in either."""
    pairs = F.filter(F.zip_with(letters(a), letters(b), lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: (p["x"] != "-") | (p["y"] != "-"))
    return F.struct(F.size(F.filter(pairs, lambda p: p["x"] == p["y"])).alias("matches"), F.size(pairs).alias("total"))


def shared_identity(a: str | Column, b: str | Column) -> Column:
    """As ``identity``, but a column scores the share of its bases, as IUPAC sets, that both have."""
    sets = _map(AMBIGUOUS)
    of = lambda x: letters(F.coalesce(F.try_element_at(sets, F.upper(x)), F.lit("")))
    pairs = F.filter(F.zip_with(letters(a), letters(b), lambda x, y: F.struct(of(x).alias("x"), of(y).alias("y"))), lambda p: (F.size(p["x"]) > 0) | (F.size(p["y"]) > 0))
    score = F.aggregate(pairs, F.lit(0.0), lambda t, p: t + F.size(F.array_intersect(p["x"], p["y"])) / F.greatest(F.size(p["x"]), F.size(p["y"])))
    return F.struct(score.alias("score"), F.size(pairs).alias("total"))


def error_label(subs: Column, ins: Column, dels: Column, homo: Column) -> Column:
    part = lambda name, n: F.when(n > 0, F.concat(F.lit(name), n.cast("string"))).otherwise("")
    return F.concat(part("X", subs), part("I", ins), part("D", dels), part("H", homo))


def one_line_alignment(a: str | Column, b: str | Column) -> Column:
    return F.array_join(F.zip_with(letters(a), letters(b), lambda x, y: F.when(x == y, x).otherwise(F.concat(F.lit("["), x, F.lit("|"), y, F.lit("]")))), "")


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each text starts and the last ends; null: none."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None else np.zeros(0, np.uint8)
    if (data < 128).all():
        return data, at - at[0]
    return np.frombuffer("".join(column.to_pylist()).encode("utf-32-le"), np.uint32), np.append(0, np.cumsum(pc.utf8_length(column).to_numpy()))


def phred_values(qual: str | Column, kind: str = "sanger") -> Column:
    low = PHRED_OFFSET[kind]

    @F.arrow_udf("array<int>")
    def values(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            codes, at = _codes(column)
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(codes.astype(np.int32) - low), mask=column.is_null())

    return values(_c(qual))


def phred_text(values: str | Column, kind: str = "sanger") -> Column:
    low = PHRED_OFFSET[kind]

    @F.arrow_udf("string")
    def text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            codes = column.flatten()
            plain = codes.to_numpy(zero_copy_only=False) + low if not codes.null_count else np.array([-1])
            if ((plain > 0) & (plain < 128)).all():
                at = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy()))
                out = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(plain.astype(np.uint8)))
                yield pc.if_else(column.is_valid(), out, pa.scalar(None, pa.large_string())).cast(pa.string())
            else:  # as char() has it: modulo 256, and nothing for a negative number or null
                letter = lambda v: "" if v is None or v + low < 0 else chr((v + low) % 256)
                yield pa.array([None if x is None else "".join(map(letter, x)) for x in column.to_pylist()], pa.string())

    return text(_c(values))


def mean_phred(qual: str | Column, kind: str = "sanger") -> Column:
    """Null for an empty text."""
    low = PHRED_OFFSET[kind]

    @F.arrow_udf("double")
    def mean(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            codes, at = _codes(column)
            total, n = np.append(0, np.cumsum(codes, dtype=np.int64)), np.diff(at)
            yield pa.array((total[at[1:]] - total[at[:-1]]) / np.maximum(n, 1) - low, mask=n == 0)

    return mean(_c(qual))


def quality_by_position(reads: DataFrame, qual: str = "qual", kind: str = "sanger") -> DataFrame:
    """pos (from 1), mean_quality and reads of all qualities at each position."""
    each = reads.select(F.posexplode(phred_values(qual, kind)).alias("pos", "value"))
    return each.groupBy((F.col("pos") + 1).alias("pos")).agg(F.avg("value").alias("mean_quality"), F.count("*").alias("reads"))


def header_fields(header: str | Column) -> Column:
    """Map of the ``key=value`` parts of ``name | key=value | ...``; ``name`` has the first part."""
    parts = F.split(_c(header), r"\s*\|\s*")
    pairs = F.filter(F.slice(parts, 2, F.size(parts)), lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(pairs, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.trim(F.substr(p, F.instr(p, "=") + 1, F.length(p))).alias("value")))
    return F.map_from_entries(F.concat(F.array(F.struct(F.lit("name").alias("key"), F.trim(parts[0]).alias("value"))), entries))


def header_segments(header: str | Column) -> Column:
    """Map of the segments that ``tcrv=..`` or ``trv=..`` marks of a header name (tcrv, tcrj, ...) to their values."""
    every = lambda k: F.regexp_extract_all(_c(header), F.lit(r"(?i)tc?r(\S?)=(\S+)"), F.lit(k))
    names = F.transform(every(1), lambda x: F.concat(F.lit("tcr"), F.lower(x)))
    pairs = F.arrays_zip(names.alias("name"), every(2).alias("value"))
    return F.map_from_entries(F.transform(F.array_distinct(names), lambda n: F.struct(n, F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]))))


def platform(read_name: str | Column) -> Column:
    name = F.regexp_replace(_c(read_name), "^[@>]", "")
    return (
        F.when(name.rlike(r"^[A-Z0-9-]+:\d+:[A-Z0-9-]+:\d+:\d+:\d+:\d+"), "illumina")
        .when(name.rlike(r"^[A-Z0-9]{5}:\d+:\d+"), "iontorrent")
        .when(name.rlike(r"^[A-Z0-9]{14}"), "454")
        .otherwise("unknown")
    )


def let(value: Column, body) -> Column:
    """body(value) with ``value`` computed once a row."""
    return F.transform(F.array(value), body)[0]


def read_taxonomy(text: str | Column) -> Column:
    """Struct of LEVELS from ``k:..,d:..,p:..``; nothing below an "unidentified" level;
    a genus repeated at the start of the species goes."""

    def of(parts: Column) -> Column:
        found = lambda k: F.get(F.filter(parts, lambda p: F.substring(p, 1, 2) == F.concat(k, F.lit(":"))), F.lit(0))
        return F.transform(F.array(*[F.lit(x[0]) for x in LEVELS]), lambda k: F.nullif(F.substring(found(k), 3, 1 << 30), F.lit("")))

    def levels(values: Column) -> Column:
        value = lambda i: F.get(values, F.lit(i))
        species, genus = value(len(LEVELS) - 1), value(len(LEVELS) - 2)
        short = F.when(species.startswith(F.concat(genus, F.lit(" "))), F.substr(species, F.length(genus) + 2, F.length(species))).otherwise(species)
        unknown = F.array_position(F.transform(values, lambda v: F.coalesce(F.lower(v).startswith("unidentified"), F.lit(False))), F.lit(True))
        known = lambda u, i: (u == 0) | (u > i + 1)
        return let(unknown, lambda u: F.struct(*[F.when(known(u, i), short if level == "species" else value(i)).alias(level) for i, level in enumerate(LEVELS)]))

    return let(let(F.transform(F.split(_c(text), "[,;]"), lambda p: F.trim(p)), of), levels)


def print_taxonomy(taxonomy: str | Column) -> Column:
    return let(_c(taxonomy), lambda t: F.array_join(F.array_compact(F.array(*[F.concat(F.lit(x[0] + ":"), t[x]) for x in LEVELS])), ","))


def aa_names(protein: str | Column) -> Column:
    names = _map(AMINO_ACIDS)
    return F.array_join(F.transform(letters(protein), lambda a: F.coalesce(F.try_element_at(names, a), F.lit("Xaa"))), "")


def aa_letters(names: str | Column) -> Column:
    codes = _map({v: k for k, v in AMINO_ACIDS.items()})
    n = F.length(_c(names))
    at = F.when(n >= 3, F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1)), F.lit(3))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(at, lambda i: F.coalesce(F.try_element_at(codes, F.substr(_c(names), i, F.lit(3))), F.lit("X"))), "")


def iupac_of(bases: str | Column) -> Column:
    """IUPAC letter of an array of bases."""
    codes = _map({v: k for k, v in AMBIGUOUS.items() if k not in "UX"})
    return F.try_element_at(codes, F.array_join(F.array_sort(F.array_distinct(_c(bases))), ""))


def amino_set_of(letters_: str | Column) -> Column:
    """Letter of an array of amino acids; X for sets without a letter of their own."""
    codes = _map({v: k for k, v in AMINO_SETS.items()})
    key = F.array_join(F.array_sort(F.array_distinct(_c(letters_))), "")
    return F.when(F.length(key) == 1, key).when(F.length(key) > 1, F.coalesce(F.try_element_at(codes, key), F.lit("X")))


def amino_acids_of(letter: str | Column) -> Column:
    """Array of the amino acids that a letter stands for."""
    return letters(F.coalesce(F.try_element_at(_map(AMINO_SETS), F.upper(_c(letter))), F.upper(_c(letter))))


def is_dna(seq: str | Column) -> Column:
    return F.upper(_c(seq)).rlike(f"^[{IUPAC.replace('U', '')}-]+$")


def is_rna(seq: str | Column) -> Column:
    return F.upper(_c(seq)).rlike(f"^[{IUPAC.replace('T', '')}-]+$")


def is_protein(seq: str | Column) -> Column:
    return F.upper(_c(seq)).rlike(r"^[ACDEFGHIKLMNPQRSTVWXY*-]+$") & ~is_dna(seq) & ~is_rna(seq)


def clean_sequence(seq: str | Column) -> Column:
    return F.regexp_replace(_c(seq), r"[\s.\-_0-9]", "")


def clean_name(name: str | Column) -> Column:
    return F.regexp_replace(_c(name), "[^A-Za-z0-9]", "")


def binomial_coefficient(n: str | Column, k: str | Column) -> Column:
    steps = F.when(_c(k) >= 1, F.sequence(F.lit(1), F.greatest(_c(k).cast("int"), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.when((_c(k) >= 0) & (_c(k) <= _c(n)), F.round(F.aggregate(steps, F.lit(1.0), lambda acc, i: acc * (_c(n) - _c(k) + i) / i))).otherwise(0.0)


def binomial_probability(n: str | Column, k: str | Column, p: str | Column) -> Column:
    return binomial_coefficient(n, k) * F.pow(_c(p), _c(k)) * F.pow(1 - _c(p), _c(n) - _c(k))


def genotypes(n_alleles: str | Column) -> Column:
    """Genotypes ``i/j`` of alleles 0..n-1 in the order of variant call files."""
    top = F.sequence(F.lit(0), _c(n_alleles) - 1)
    return F.flatten(F.transform(top, lambda j: F.transform(F.sequence(F.lit(0), j), lambda i: F.concat_ws("/", i.cast("string"), j.cast("string")))))


def genotype_text(gt: str | Column, ref: str | Column, alt: str | Column) -> Column:
    """``0/0`` -> REF, ``0/1`` -> REF,ALT, ``1/1`` -> ALT; null for a missing call."""
    alleles = F.concat(F.array(_c(ref)), F.split(_c(alt), ","))
    called = F.array_sort(F.array_distinct(F.filter(F.split(_c(gt), "[/|]"), lambda x: x.rlike(r"^\d+$"))))
    return F.nullif(F.array_join(F.transform(called, lambda i: F.get(alleles, i.cast("int"))), ","), F.lit(""))


def natural_key(name: str | Column) -> Column:
    """Sorts S2 before S10: struct of the text before the first number, the number, the whole."""
    return F.struct(F.regexp_extract(_c(name), r"^(\D*)", 1).alias("text"), F.nullif(F.regexp_extract(_c(name), r"(\d+)", 1), F.lit("")).cast("long").alias("number"), _c(name).alias("whole"))

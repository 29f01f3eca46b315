"""Near variants of an amplicon without comparing all its pairs, and greedy
choices among them in rounds.

Two sequences with at most k errors agree, but for one error, in some of k // 2 + 1
parts. So distinct parts meet by an equi-join on their deletion neighbourhood (the
text, and the text without one base), whole variants meet by their parts, and each
candidate is aligned once. A part at an end keeps its place; an inner one is looked
for k bases around. Sequences of one length that may only have substitutions meet
by parts with one base masked. Keys are hashes of amplicon and part, so a hot
amplicon is spread over all tasks; what two equal hashes bring together falls at
the comparison.

Greedy clustering takes variants by depth, and each choice depends on earlier ones.
``settled`` makes these choices in rounds: whatever waits for nobody settles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seq as s
from ..functions.align import with_pair_errors
from .folders import stored
from .variants import AMPLICON

#: Earlier (deeper, then by md5) in the order in which variants are taken.
PRIORITY = "struct(-depth AS minus_depth, md5)"


def _without_one(text: Column) -> Column:
    """The text and its texts with one base less."""
    n = F.length(text)
    shorter = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, n)))
    return F.array_distinct(F.when(n == 0, F.array(text)).otherwise(F.array_append(shorter, text)))


def _masked(text: Column) -> Column:
    """The texts with one base masked."""
    n = F.length(text)
    return F.when(n == 0, F.array(text)).otherwise(F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.lit("."), F.substr(text, i + 1, n))))


def _cut(part: int, n: Column, parts: int) -> Column:
    return F.floor(n * part / parts).cast("int")


def _own_parts(seq: Column, parts: int) -> Column:
    n = F.length(seq)
    return F.array(*[F.struct(F.lit(i).alias("part"), F.substr(seq, _cut(i, n, parts) + 1, _cut(i + 1, n, parts) - _cut(i, n, parts)).alias("text")) for i in range(parts)])


def _places(seq: Column, parts: int, errors: int) -> Column:
    """Where the parts of a sequence within ``errors`` may lie in this one."""
    n = F.length(seq)
    least, most = F.greatest(F.floor((n - errors) / parts), F.lit(0)).cast("int"), F.ceil((n + errors) / parts).cast("int")
    sizes = F.sequence(F.greatest(least - 1, F.lit(0)), most + 1)

    def of(i: int) -> Column:
        if i == 0:
            texts = F.transform(sizes, lambda k: F.substr(seq, F.lit(1), k))
        elif i == parts - 1:
            texts = F.transform(sizes, lambda k: F.substr(seq, F.greatest(n - k, F.lit(0)) + 1, n))
        else:
            first = F.greatest(_cut(i, n - errors, parts) - errors, F.lit(0))
            starts = F.sequence(first, F.greatest(first, F.least(n, _cut(i, n + errors, parts) + errors)))
            texts = F.flatten(F.transform(starts, lambda a: F.transform(sizes, lambda k: F.substr(seq, a + 1, k))))
        return F.transform(F.array_distinct(texts), lambda t: F.struct(F.lit(i).alias("part"), t.alias("text")))

    return F.concat(*[of(i) for i in range(parts)])


def near_candidates(variants: DataFrame, errors: int, same_length: bool = False, within: tuple[str, ...] = AMPLICON) -> DataFrame:
    """Pairs (a, b), a < b, of variant ids (``vid``) of an amplicon (or equal in ``within``): all with at most
    ``errors`` errors, or with at most as many substitutions, and some others."""
    parts = errors // 2 + 1
    seq = F.col("seq")

    def texts(places: Column, *more: str) -> DataFrame:
        rows = variants.select("vid", *within, *([F.length(seq).alias("n")] if same_length else []), F.explode(places).alias("p"))
        key = [*within, *(["n"] if same_length else []), "part", "text"]
        rows = rows.select("vid", *[c for c in key if c not in ("part", "text")], "p.part", "p.text")
        return rows.withColumn("tid", F.xxhash64(*key))

    def keys(rows: DataFrame, tid: str) -> DataFrame:
        scope = [*within, *(["n"] if same_length else []), "part"]
        once = rows.dropDuplicates(["tid"])
        around = _masked(F.col("text")) if same_length else _without_one(F.col("text"))
        return once.select(F.col("tid").alias(tid), F.explode(F.transform(around, lambda t: F.xxhash64(*scope, t))).alias("key"))

    own = texts(_own_parts(seq, parts))
    other = own if same_length or parts == 1 else texts(_places(seq, parts, errors))
    near = keys(own, "tid_x").join(keys(other, "tid_y"), "key").select("tid_x", "tid_y").distinct()
    x = own.select(F.col("tid").alias("tid_x"), F.col("vid").alias("x"))
    y = other.select(F.col("tid").alias("tid_y"), F.col("vid").alias("y"))
    return x.join(near, "tid_x").join(y, "tid_y").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def with_vid(variants: DataFrame) -> DataFrame:
    return variants.select(F.xxhash64(*AMPLICON, "md5").alias("vid"), *AMPLICON, "md5", "seq", "depth")


def both_sides(candidates: DataFrame, variants: DataFrame) -> DataFrame:
    """The pairs with the columns of both (suffixes _1 and _2), the earlier first."""
    side = lambda k, end: variants.select(F.col("vid").alias(end), *[F.col(c).alias(f"{c}_{k}") for c in (*AMPLICON, "md5", "seq", "depth")], F.expr(PRIORITY).alias(f"rank_{k}"))
    both = candidates.join(side(1, "a"), "a").join(side(2, "b"), "b")
    same = F.lit(True)
    for c in AMPLICON:
        same = same & F.col(f"{c}_1").eqNullSafe(F.col(f"{c}_2"))
    both = both.where(same)
    swap = F.col("rank_2") < F.col("rank_1")
    pick = lambda c, k: F.when(swap, F.col(f"{c}_{3 - k}")).otherwise(F.col(f"{c}_{k}")).alias(f"{c}_{k}")
    ids = [F.when(swap, F.col("b")).otherwise(F.col("a")).alias("vid_1"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("vid_2")]
    return both.select(*[F.col(f"{c}_1").alias(c) for c in AMPLICON], *ids, *[pick(c, k) for c in ("md5", "seq", "depth", "rank") for k in (1, 2)])


def near_pairs(variants: DataFrame, errors: int) -> DataFrame:
    """All pairs of an amplicon's variants within ``errors`` errors, the deeper first:
    md5 and depth of both, ident, aligned, subs, ins, dels, homo of the second
    against the first."""
    known = with_vid(variants)
    pairs = both_sides(near_candidates(known, errors), known)
    pairs = with_pair_errors(pairs, "seq_2", "seq_1").where(F.col("e.subs") + F.col("e.ins") + F.col("e.dels") <= errors)
    return pairs.select(*AMPLICON, "md5_1", "md5_2", "depth_1", "depth_2", F.length("seq_1").alias("len_1"), F.length("seq_2").alias("len_2"), "e.*")


def compare_within(variants: DataFrame, errors: int, max_subs: float | None = None, max_indels: float | None = None, min_identity: float | None = None) -> DataFrame:
    """Each variant of an amplicon (md5) with those near it (of), in both directions:
    depth, depth_of, identity (percent of the length of md5), subs, ins, dels, homo
    and the error label of ``of`` against md5; the reversed pair has insertions and
    deletions swapped. Limits in percent of the length of the variant, not rounded;
    max_indels is about indels outside of runs of bases, ``errors`` about all errors."""
    pairs = near_pairs(variants, errors)
    turn = lambda a, b, ins, dels: pairs.select(*AMPLICON, F.col(f"md5_{a}").alias("md5"), F.col(f"md5_{b}").alias("of"), F.col(f"depth_{a}").alias("depth"), F.col(f"depth_{b}").alias("depth_of"), F.col(f"len_{a}").alias("len"), F.round(100 * F.col("ident") / F.col("len_1"), 2).alias("identity"), "subs", F.col(ins).alias("ins"), F.col(dels).alias("dels"), "homo")
    out = turn(1, 2, "ins", "dels").unionByName(turn(2, 1, "dels", "ins"))
    if max_subs is not None:
        out = out.where(F.col("subs") <= max_subs * F.col("len") / 100)
    if max_indels is not None:
        out = out.where(F.col("ins") + F.col("dels") - F.col("homo") <= max_indels * F.col("len") / 100)
    if min_identity is not None:
        out = out.where(F.col("identity") >= min_identity)
    return out.drop("len").withColumn("label", s.error_label(F.col("subs"), F.col("ins"), F.col("dels"), F.col("homo")))


def settled(edges: DataFrame) -> DataFrame:
    """(v, to): the greedy choice over edges (u, rank, v), u earlier than v: v goes to
    the earliest of its u that itself goes to nobody, else to nobody (null). In each
    round all v settle whose u have settled; as many rounds as the longest chain."""
    edges = stored(edges.select("u", "rank", "v"))
    waiting = stored(edges.select("v").distinct())
    done = None
    while waiting.head(1):
        state = edges.join(waiting, "v", "left_semi").join(waiting.select(F.col("v").alias("u"), F.lit(True).alias("waits")), "u", "left")
        if done is not None:
            state = state.join(done.select(F.col("v").alias("u"), F.col("to").isNotNull().alias("gone")), "u", "left")
        else:
            state = state.withColumn("gone", F.lit(False))
        free = ~F.coalesce("gone", F.lit(False))
        best = F.min(F.when(free, F.struct("rank", "u")))["u"]
        now = stored(state.groupBy("v").agg(F.max(F.coalesce("waits", F.lit(False))).alias("waits"), best.alias("to")).where("not waits").select("v", "to"))
        done = now if done is None else done.unionByName(now)
        waiting = stored(waiting.join(now, "v", "left_anti"))
    return done if done is not None else edges.select("v", F.col("u").alias("to")).limit(0)

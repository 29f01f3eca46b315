"""Mixing sources to target weights, with DataFrame functions only.

The words of a source form one stream (documents in the order of an MD5
bucket, then doc_id), cut into blocks of BLOCK_WORDS. A source gets as many
slots as bring its blocks to its target; each slot draws its output shard, so
a source's counts per shard are a multinomial draw, conditioned on the total
that the target fixes. Slot j takes block p(j mod blocks) of its source, where
p is a pseudorandom permutation (swap-or-not rounds keyed by source and pass);
slots and blocks are joined by (source, block). A pass over all blocks ends
before the next begins and there are three passes at most, so no document is
taken more than MOST_TIMES times.

Defined results: sources weigh WEIGHTS, repeating, by code point, a null source
last and as a source of its own; a null or empty text has no words, is in no
block and is not taken; repeated rows are rows of their own; an empty table
gives no rows; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bucket_count, by_position, distributed_offsets, let, materialise, md5_number, table, word_count

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
ROUNDS = 8
SEED = "mix-1"
CHUNK = 16_384
#: Rows of a source that one task sorts.
BUCKET_ROWS = 2_000


def source_targets(sizes: DataFrame) -> DataFrame:
    """source_key, source_size, weight, target from (source, source_key, size) rows.

    The share of all sizes by weight is capped at MOST_TIMES the source's size
    and the excess reshared: a water level over sources by cap for a unit of weight."""
    per = sizes.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # a row for each source
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * MOST_TIMES)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    below, every = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    per = per.withColumns(
        {
            "total": F.sum("source_size").over(every),
            "cap_below": F.coalesce(F.sum("cap").over(below), F.lit(0)),
            "weight_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0)),
        }
    ).withColumn("capped", F.col("cap_below") * F.col("weight") + F.col("cap") * F.col("weight_left") <= F.col("total") * F.col("weight"))
    free = ~F.col("capped")
    level = (F.max("total").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))).cast("double") / F.sum(F.when(free, F.col("weight"))).over(every)
    return per.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))).select("source_key", "source_size", "weight", "target")


def _permuted(slot: Column, n: Column, keys: Column, name: Column) -> Column:
    """Swap-or-not: a bijection of 0..n-1 for any n, for each pass of its own."""
    lap = (slot / n).cast("long")

    def swap(r: int):
        def of(x: Column) -> Column:
            other = (F.get(F.get(keys, lap.cast("int")), F.lit(r)) + n - x) % n
            larger = F.greatest(x, other)
            bit = F.substring(F.md5(F.concat_ws("/", F.lit(f"{SEED}/{r}"), name, lap.cast("string"), larger.cast("string"))), 1, 1) < "8"
            return F.when(bit, other).otherwise(x)

        return of

    x = slot % n
    for r in range(ROUNDS):
        x = let(x, swap(r))
    return x


def mix(rows: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """From rows (rid, doc_id, source, size): the sources with their targets,
    and the mixture's segments (shard, source_key, slot, block, rid,
    first_word, n_words): words of a document, in the order they are taken."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    rows = rows.withColumn("source_key", key)
    sources = source_targets(rows)
    n_blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    n_slots = F.least(MOST_TIMES * F.col("n_blocks"), F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long"))
    laps = F.transform(
        F.sequence(F.lit(0), F.lit(MOST_TIMES - 1)),
        lambda lap: F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), lambda r: md5_number(F.concat_ws("/", F.lit(SEED), "source_key", lap.cast("string"), r.cast("string"))) % F.col("n_blocks")),
    )
    plan = sources.where("source_size > 0").withColumn("n_blocks", n_blocks).withColumn("n_slots", n_slots).withColumn("keys", laps)
    plan = plan.withColumn("n_shards", F.ceil(F.sum("n_slots").over(Window.partitionBy(F.lit(1))) / SHARD_SLOTS).cast("long")).where("n_slots > 0")
    chunks = plan.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_slots") - 1, F.lit(CHUNK).cast("long"))))
    chunks = chunks.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_key", "lo")
    slots = chunks.withColumn("slot", F.explode(F.sequence("lo", F.least(F.col("lo") + CHUNK, F.col("n_slots")) - 1)))
    slots = slots.select(
        "source_key",
        "slot",
        (md5_number(F.concat_ws("/", F.lit(SEED + "/shard"), "source_key", F.col("slot").cast("string"))) % F.col("n_shards")).alias("shard"),
        _permuted(F.col("slot"), F.col("n_blocks"), F.col("keys"), F.col("source_key")).alias("block"),
    )
    worded = rows.where("size > 0")
    placed = distributed_offsets(worded, ["source_key"], ["doc_id", "rid"], "size", "at", bucket_count(rows.count(), BUCKET_ROWS))
    first, last = (F.col("at") / block_words).cast("long"), ((F.col("at") + F.col("size") - 1) / block_words).cast("long")
    pieces = placed.select("source_key", "rid", "size", "at", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("at"), F.col("block") * block_words)
    end = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("source_key", "block", "rid", (begin - F.col("at")).alias("first_word"), (end - begin).alias("n_words"))
    # Slots come from a few rows by explode, which size estimates miss; they must not be broadcast.
    return sources, slots.hint("merge").join(pieces, ["source_key", "block"])


def numbered(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """(rid, doc_id, source, size) of each row, kept in the shared folder so that rid stays."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` as the mixture takes them, with the same columns: a row for each
    segment, its words (and the white space before them) as text, n_chars its
    length; a document that isn't taken has no row."""
    plain, (doc_id, text, source, n_chars) = by_position(docs, "doc_id", "text", "source", "n_chars")
    held = materialise(plain.withColumn("rid", F.monotonically_increasing_id()))
    rows = materialise(held.select("rid", F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    _, segments = mix(rows, block_words)
    # At most MOST_TIMES segments for each block that a document is in.
    of = segments.groupBy("rid").agg(F.collect_list(F.struct("first_word", "n_words")).alias("segments"))
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    texts = let(words, lambda w: F.transform("segments", lambda s: F.array_join(F.slice(w, (s["first_word"] + 1).cast("int"), s["n_words"].cast("int")), "")))
    out = held.join(of, "rid").withColumn(text, F.explode(texts)).withColumn(n_chars, F.length(text).cast("long"))
    return out.select(*plain.columns).toDF(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered(table(spark, sf_dir, "documents"))
    sources, segments = mix(rows)
    # As many segments a document as it has blocks, MOST_TIMES over.
    taken = segments.groupBy("rid").agg(F.sum("n_words").alias("taken"), F.size(F.collect_set("shard")).cast("long").alias("n_shards"))
    keyed = rows.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    out = keyed.join(taken, "rid", "left").join(sources, "source_key")
    return out.select("doc_id", "size", "source_size", "target", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("taken", "n_shards")])


def op6_sql() -> str:
    x = "slot % n_blocks"
    rounds, previous = [], "s0"
    for r in range(ROUNDS):
        key = f"('0x' || substr(md5(concat_ws('/', '{SEED}', source_key, lap::VARCHAR, '{r}')), 1, 8))::BIGINT % n_blocks"
        other = f"(({key}) + n_blocks - x) % n_blocks"
        rounds.append(f"s{r + 1} AS (SELECT * EXCLUDE (x), CASE WHEN substr(md5(concat_ws('/', '{SEED}/{r}', source_key, lap::VARCHAR, greatest(x, {other})::VARCHAR)), 1, 1) < '8' THEN {other} ELSE x END AS x FROM {previous})")
        previous = f"s{r + 1}"
    weights = ", ".join(map(str, WEIGHTS))
    return f"""WITH t AS (SELECT doc_id, source, coalesce('s' || source, 'n') AS source_key, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
p AS (SELECT source_key, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM t GROUP BY source_key),
w AS (SELECT *, ([{weights}])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::BIGINT] AS weight, source_size * {MOST_TIMES} AS cap FROM p),
l AS (SELECT *, sum(source_size) OVER () AS total, coalesce(sum(cap) OVER b, 0) AS cap_below, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left FROM w
  WINDOW b AS (ORDER BY cap / weight, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap_below * weight + cap * weight_left <= total * weight AS capped FROM l),
s AS (SELECT source_key, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (total - coalesce(sum(cap) FILTER (capped) OVER (), 0))::DOUBLE / (sum(weight) FILTER (NOT capped) OVER ())::DOUBLE * weight END AS target FROM c),
q AS (SELECT *, ceil(source_size / {BLOCK_WORDS})::BIGINT AS n_blocks FROM s WHERE source_size > 0),
q2 AS (SELECT *, least({MOST_TIMES} * n_blocks, round(target * n_blocks / source_size)::BIGINT) AS n_slots FROM q),
s0 AS (SELECT source_key, slot, n_blocks, slot // n_blocks AS lap, {x} AS x FROM (SELECT *, unnest(range(n_slots)) AS slot FROM q2)),
{", ".join(rounds)},
k AS (SELECT source_key, x AS block, ('0x' || substr(md5(concat_ws('/', '{SEED}/shard', source_key, slot::VARCHAR)), 1, 8))::BIGINT % (SELECT ceil(sum(n_slots) / {SHARD_SLOTS})::BIGINT FROM q2) AS shard FROM {previous}),
o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source_key ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, ceil(count(*) / {BUCKET_ROWS}))::BIGINT FROM t), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM t WHERE size > 0),
e AS (SELECT source_key, doc_id, size, pos, unnest(range(pos // {BLOCK_WORDS}, (pos + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM o),
g AS (SELECT e.doc_id, count(DISTINCT shard) AS n_shards, sum((least(pos + size, (e.block + 1) * {BLOCK_WORDS}) - greatest(pos, e.block * {BLOCK_WORDS}))) AS taken FROM e JOIN k ON k.source_key = e.source_key AND k.block = e.block GROUP BY e.doc_id)
SELECT t.doc_id, t.size, s.source_size, s.target, coalesce(g.taken, 0)::BIGINT AS taken, coalesce(g.n_shards, 0)::BIGINT AS n_shards FROM t JOIN s ON s.source_key = t.source_key LEFT JOIN g ON g.doc_id = t.doc_id"""

"""Sharding by balanced label propagation, with DataFrame functions only.

Documents with equal texts are linked. A group larger than a quota is split
beforehand; groups larger than half a quota get a shard each, as long as there
are shards, for no two of them fit one. The other linked documents start in a
shard by the rank of an MD5 bucket and their number. In each round the members
of a group move to the shard that holds most of them, as far as movers the other
way round (or round a cycle of shards) or room make place; room is what linked
documents don't fill, as single documents have no edges to cut. Rounds go on
while fewer groups stay cut. Groups that are cut then are laid one behind the
other into the room left, which cuts fewer than ``shards`` of them. Then the
single documents fill every shard to its quota. The law is ``rows``: counts at
most one apart.

Defined results: a null text counts as empty for the checksum and the group,
with size 16; repeated rows are rows of their own with slots of their own; a
null doc_id is a value like others; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bucket_count, distributed_offsets, materialise, table

SHARDS, HEAD_BYTES = 40, 16


def _quota(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _at(values: list[int], index: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]), index)


def _into(room: list[int], rank: Column) -> Column:
    """The shard of the place ``rank`` where the shards' room lies in one line."""
    ends = list(itertools.accumulate(room))
    return F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= rank)).cast("int")


def _spread(rank: str, rooms: int, rows: int) -> Column:
    """rank * rooms div rows; the product passes 64 bits where rows pass 3 billion."""
    wide = "cast({} as decimal(19, 0))"
    return F.expr(f"{wide.format(rank)} * {wide.format(rooms)} div {wide.format(rows)}")


def admitted(wanted: list[list[int]], room: list[int]) -> list[list[int]]:
    """How many of the movers wanted[s][t] may go so that no shard gains more
    than its room: first those that make place for each other round a cycle,
    then along paths that end in room."""
    n = len(room)
    left, room = [row.copy() for row in wanted], room.copy()

    def path(start: int, ends) -> list[int] | None:
        before, todo = {start: start}, [start]
        for s in todo:
            for t in range(n):
                if left[s][t] > 0 and ends(t):
                    way = [t, s]
                    while way[-1] != start:
                        way.append(before[way[-1]])
                    return way[::-1]
                if left[s][t] > 0 and t not in before:
                    before[t] = s
                    todo.append(t)
        return None

    for start in range(n):
        while way := path(start, lambda t: t == start):
            edges = list(itertools.pairwise(way))
            many = min(left[s][t] for s, t in edges)
            for s, t in edges:
                left[s][t] -= many
    for start in range(n):
        while way := path(start, lambda t: room[t] > 0 and t != start):
            edges = list(itertools.pairwise(way))
            many = min(room[way[-1]], *(left[s][t] for s, t in edges))
            room[start], room[way[-1]] = room[start] + many, room[way[-1]] - many
            for s, t in edges:
                left[s][t] -= many
    return [[w - x for w, x in zip(*rows, strict=True)] for rows in zip(wanted, left, strict=True)]


def _gathered(linked: DataFrame, free: list[int], buckets: int) -> DataFrame:
    """``linked`` (rid, grp, shard, one) after the rounds of label propagation."""
    shards, turn, cut_before = len(free), 0, None
    while True:
        cells = linked.groupBy("grp", "shard").agg(F.count("*").alias("here"))
        # Near equal goals are told apart by chance, so that not all groups want one shard.
        best = F.max(F.struct(F.floor(F.log2("here")).alias("many"), F.xxhash64("grp", "shard", F.lit(turn)).alias("tie"), "shard"))
        goals = cells.groupBy("grp").agg(best.alias("best"), F.count("*").alias("shards")).where("shards > 1").select("grp", F.col("best.shard").alias("goal"))
        goals = materialise(goals)
        cut = goals.count()
        if not cut or (cut_before is not None and cut >= cut_before):
            return linked
        moves = materialise(cells.join(goals, "grp").where("shard != goal"))
        wanted = [[0] * shards for _ in free]
        for r in moves.groupBy("shard", "goal").agg(F.sum("here").alias("n")).collect():
            wanted[r["shard"]][r["goal"]] = r["n"]
        filled = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        allowed = admitted(wanted, [f - filled.get(s, 0) for s, f in enumerate(free)])
        moves = distributed_offsets(moves.withColumn("tie", F.xxhash64("grp")), ["shard", "goal"], ["tie", "grp"], "here", "ahead", buckets)
        may = _at([x for row in allowed for x in row], F.col("shard") * shards + F.col("goal")) - F.col("ahead")
        moves = moves.withColumn("allowed", F.least("here", may)).where("allowed > 0").select("grp", "shard", "goal", "allowed")
        moving = distributed_offsets(linked.join(moves, ["grp", "shard"]), ["grp", "shard"], ["rid"], "one", "nth", buckets).where("nth < allowed").select("rid", "goal")
        linked = materialise(linked.join(moving, "rid", "left").select("rid", "grp", F.coalesce("goal", "shard").alias("shard"), "one"))
        turn, cut_before = turn + 1, cut


def _laid_out(linked: DataFrame, free: list[int], buckets: int) -> DataFrame:
    """rid, shard of ``linked``, with the groups that are cut laid one behind
    the other into the room that whole groups leave."""
    groups = materialise(linked.groupBy("grp").agg(F.count("*").alias("size"), F.min("shard").alias("shard"), (F.min("shard") != F.max("shard")).alias("cut")))
    filled = {r["shard"]: r["n"] for r in groups.where("not cut").groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    cut = groups.where("cut").select("grp", "size", F.xxhash64("grp").alias("tie"), F.lit(1).alias("all"))
    cut = distributed_offsets(cut, ["all"], ["tie", "grp"], "size", "ahead", buckets).select("grp", "ahead")
    rows = distributed_offsets(linked.select("rid", "grp", "one").join(cut, "grp"), ["grp"], ["rid"], "one", "nth", buckets)
    rows = rows.select("rid", _into([f - filled.get(s, 0) for s, f in enumerate(free)], F.col("ahead") + F.col("nth")).alias("shard"))
    return linked.join(cut, "grp", "left_anti").select("rid", "shard").unionByName(rows)


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds ``shard`` to rows (rid, unique; grp: linked where equal). Numbers per
    shard and pair of shards come to the driver, nothing that grows with the rows."""
    n = rows.count()
    quota, buckets = _quota(n, shards), bucket_count(n)
    rows = rows.withColumn("one", F.lit(1).cast("long"))
    # The counts are a table of their own, so that the join can split a large group.
    rows = materialise(rows.join(materialise(rows.groupBy("grp").agg(F.count("*").alias("members"))), "grp"))
    most = max(1, quota[-1])
    linked = distributed_offsets(rows.where("members > 1").select("rid", "grp", "one"), ["grp"], ["rid"], "one", "nth", buckets)
    linked = materialise(linked.select("rid", "one", F.struct("grp", (F.col("nth") / most).cast("int").alias("part")).alias("grp")))
    # Fewer than two for each shard are larger than half a quota.
    large = linked.groupBy("grp").agg(F.count("*").alias("size")).where(F.col("size") * 2 > most).orderBy(F.desc("size"), F.xxhash64("grp"), "grp").limit(min(n, shards))
    large = materialise(large.select("grp", "size", (F.row_number().over(Window.orderBy(F.desc("size"), F.xxhash64("grp"), "grp")) - 1).alias("shard")))
    taken = {r["shard"]: r["size"] for r in large.select("shard", "size").collect()}
    free = [q - taken.get(s, 0) for s, q in enumerate(quota)]
    settled = linked.join(large, "grp").select("rid", "shard")
    linked = distributed_offsets(linked.join(large, "grp", "left_anti"), ["one"], ["rid"], "one", "rank", buckets)
    m = n - sum(taken.values()) - rows.where("members = 1").count()
    linked = materialise(linked.select("rid", "grp", _into(free, _spread("rank", sum(free), max(1, m))).alias("shard"), "one"))
    settled = materialise(settled.unionByName(_laid_out(_gathered(linked, free, buckets), free, buckets)))
    filled = {r["shard"]: r["n"] for r in settled.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    single = distributed_offsets(rows.where("members = 1").select("rid", "one"), ["one"], ["rid"], "one", "rank", buckets)
    return settled.unionByName(single.select("rid", _into([q - filled.get(s, 0) for s, q in enumerate(quota)], F.col("rank")).alias("shard")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(whole) + HEAD_BYTES).cast("long").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            F.unhex(F.md5(whole)).alias("grp"),
        )
    )
    placed = rows.drop("grp").join(assign(rows.select("rid", "grp"), shards), "rid").withColumn("one", F.lit(1).cast("long"))
    placed = distributed_offsets(placed, ["shard"], ["rid"], "one", "slot", bucket_count(rows.count(), 200_000))
    return placed.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

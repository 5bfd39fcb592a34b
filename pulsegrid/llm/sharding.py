"""Sharding by balanced label propagation, on DataFrame functions alone.

Documents with equal texts are linked.  All documents start in the shard their
hash names.  In every round the linked documents of a shard turn to the shard
where most of their group lives, as far as that shard's byte quota goes: per
target the bytes that want to come are added up, and if they exceed what is free,
only the share that fits moves, chosen by a hash.  A group larger than a shard
fills one shard after another.  Documents without links, which cut no edge
anywhere, are then dealt so that all shards come to nearly equal bytes.

Links are never listed: a group's members in a shard are one row with a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import unit
from pulsegrid.runtime import pin

SHARDS = 24
ROUNDS = 24
# Buckets in which documents are dealt to equalise shards, and rows per numbering bucket.
DEAL = 512
SLOT_ROWS = 50_000


def sized(docs: DataFrame, text: str = "text", overhead: int = 8) -> DataFrame:
    """doc_id, size (UTF-8 bytes and `overhead`), text_crc32 and the group of each text; a null text counts as empty."""
    raw = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(raw) + overhead).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"),
        F.md5(raw.cast("binary")).alias("_group"), unit(F.col("doc_id"), raw, seed=9).alias("_u"),
    )


def _loads(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, load) of all shards, empty ones too: one row per shard."""
    every = rows.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    return every.join(F.broadcast(rows.groupBy("shard").agg(F.sum("size").alias("_b"))), "shard", "left").select(
        "shard", F.coalesce("_b", F.lit(0)).cast("long").alias("load")
    )


def _round(state: DataFrame, quota: int, shards: int, turn: int) -> tuple[DataFrame, int]:
    """One round over (doc columns, _group, shard); returns the new state and the bytes moved."""
    parts = state.groupBy("_group", "shard").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    free = F.broadcast(_loads(state, shards).select("shard", F.greatest(F.lit(quota) - F.col("load"), F.lit(0)).alias("free")))
    # The favourite is where most live among shards that can still take bytes; ties by a hash of group and shard.
    parts = parts.join(free, "shard").withColumn("_luck", F.xxhash64("_group", "shard"))
    of_group = Window.partitionBy("_group")  # at most one row per shard
    smallest = F.least(F.greatest(F.min("b").over(of_group), F.lit(quota // 64)), F.lit(quota // 8))
    parts = parts.withColumn("_can", F.col("free") >= smallest)
    wish = parts.withColumn("_best", F.max(F.when(F.col("_can"), F.struct("n", "_luck", "shard"))).over(of_group))
    # A part moves to a favourite that holds more of the group, or as many but with better luck.
    better = F.col("_best") > F.struct("n", "_luck", "shard")
    wish = wish.withColumn("_to", F.col("_best.shard")).where(better & (F.col("_to") != F.col("shard")))
    demand = F.broadcast(wish.groupBy("_to").agg(F.sum("b").alias("_demand")))
    room = free.select(F.col("shard").alias("_to"), F.col("free").alias("_room"))
    moves = wish.join(demand, "_to").join(F.broadcast(room), "_to")
    moves = pin(moves.select(F.col("_group").alias("_g"), F.col("shard").alias("_from"), "_to", "b", "_demand", "_room"))
    share = F.col("_room") / F.col("_demand")
    # Small parts move whole or not at all; parts that alone would take much of the room move document by document.
    whole = F.col("b") * 16 <= F.col("_room")
    lot = F.when(whole, unit(F.col("_g"), F.lit(turn), seed=1)).otherwise(unit(F.col("_u"), F.lit(turn), seed=2))
    joined = state.join(moves, (F.col("_group") == F.col("_g")) & (F.col("shard") == F.col("_from")), "left")
    goes = F.col("_to").isNotNull() & F.coalesce((F.col("_demand") <= F.col("_room")) | (lot < share * 0.98), F.lit(False))
    after = joined.withColumn("_moved", goes).withColumn("shard", F.when(goes, F.col("_to")).otherwise(F.col("shard")))
    after = pin(after.drop("_g", "_from", "_to", "b", "_demand", "_room"))
    moved = after.where("_moved").agg(F.sum("size")).first()[0] or 0
    return after.drop("_moved"), int(moved)


def propagate(linked: DataFrame, quota: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Move linked documents towards their group's shard until little moves any more."""
    state, total = linked, None
    for turn in range(rounds):
        state, moved = _round(state, quota, shards, turn)
        total = moved if total is None else total
        if moved * 200 <= total:
            break
    return state


def _deal(rows: DataFrame, loads: DataFrame, target: float) -> DataFrame:
    """Give each unlinked row a shard so that shards come as near to `target` as bucket sizes let them.

    Rows fall into DEAL buckets by hash; along the line of all buckets' bytes each shard owns a stretch as long as its free bytes.
    """
    bucket = F.least(F.floor(F.col("_u") * DEAL), F.lit(DEAL - 1)).cast("int")
    rows = rows.withColumn("_bucket", bucket)
    line = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("_bucket").agg(F.sum("size").alias("_b"))
    sums = sums.withColumn("_upto", F.sum("_b").over(line))
    total = sums.agg(F.max("_upto")).first()[0] or 0
    owned = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    room = loads.withColumn("_free", F.greatest(F.lit(float(target)) - F.col("load"), F.lit(0.0)))
    scale = float(total) / max(1.0, float(room.agg(F.sum("_free")).first()[0]))
    room = room.withColumn("_end", F.sum(F.col("_free") * scale).over(owned)).withColumn("_begin", F.col("_end") - F.col("_free") * scale)
    # A row's place on the line: within its bucket by the rest of its random number.
    place = F.col("_upto") - F.col("_b") + F.col("_b") * (F.col("_u") * DEAL - F.col("_bucket"))
    placed = rows.join(F.broadcast(sums), "_bucket").withColumn("_at", place)
    stretches = [(r["shard"], float(r["_end"])) for r in room.orderBy("shard").collect()]  # one row per shard
    shard: Column = F.lit(max((s for s, e in stretches), default=0))
    for s, end in reversed(stretches):
        shard = F.when(F.col("_at") < end, F.lit(s)).otherwise(shard)
    return placed.withColumn("shard", shard.cast("int")).drop("_bucket", "_b", "_upto", "_at")


def _even_out(rows: DataFrame, target: float, shards: int) -> DataFrame:
    """Move single documents, the unlinked first, from shards above the target to those below it."""
    bucket = F.least(F.floor(F.col("_u") * DEAL), F.lit(DEAL - 1)).cast("int")
    marked = rows.withColumn("_bucket", bucket)
    sums = marked.groupBy("shard", "_linked", "_bucket").agg(F.sum("size").alias("_b"))
    inside = Window.partitionBy("shard").orderBy("_linked", "_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("shard")
    sums = sums.withColumn("_upto", F.sum("_b").over(inside)).withColumn("_over", F.sum("_b").over(whole) - F.lit(float(target)))
    leaving = sums.where(F.col("_upto") - F.col("_b") / 2 <= F.col("_over"))
    line = Window.orderBy("shard", "_linked", "_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaving = leaving.withColumn("_at", F.sum("_b").over(line) - F.col("_b") / 2)
    loads = _loads(rows, shards)
    left = leaving.groupBy("shard").agg(F.sum("_b").alias("_gone"))
    below = loads.join(left, "shard", "left").withColumn("_free", F.greatest(F.lit(float(target)) - F.col("load") + F.coalesce("_gone", F.lit(0)), F.lit(0.0)))
    ends, at = [], 0.0
    for r in below.orderBy("shard").collect():  # one row per shard
        at += float(r["_free"])
        ends.append((r["shard"], at))
    goes: Column = F.lit(ends[-1][0])
    for s, end in reversed(ends):
        goes = F.when(F.col("_at") < end, F.lit(s)).otherwise(goes)
    moves = F.broadcast(leaving.select("shard", "_linked", "_bucket", goes.cast("int").alias("_to")))  # at most shards * 2 * DEAL rows
    out = marked.join(moves, ["shard", "_linked", "_bucket"], "left")
    return out.withColumn("shard", F.coalesce("_to", "shard")).drop("_bucket", "_to")


def numbered(rows: DataFrame, shards: int, n_rows: int) -> DataFrame:
    """`slot`, gapless from 0 in each shard, in buckets of about SLOT_ROWS rows so that no task holds a shard."""
    parts = max(8, -(-n_rows // (SLOT_ROWS * shards)))
    # Not by the random number itself: dealt shards hold a stretch of it.
    cut = rows.withColumn("_part", F.least(F.floor(unit(F.col("_u"), seed=4) * parts), F.lit(parts - 1)).cast("int"))
    counts = cut.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy("shard", "_part").orderBy("_u", "doc_id", "size", "text_crc32")
    placed = cut.withColumn("_row", F.row_number().over(order) - 1)
    # shards * parts rows, one for SLOT_ROWS documents
    return placed.join(starts, ["shard", "_part"]).withColumn("slot", (F.col("_row") + F.col("_start")).cast("long")).drop("_part", "_row", "_start")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is `bytes`) and group_rows of every document.

    Shards have nearly equal bytes as far as no single document exceeds the mean.
    Null texts count as empty and are equal to empty ones; null ids and repeated
    rows are documents like others.
    """
    rows = pin(sized(docs))
    size = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_b"))
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    total = int(total or 0)
    target = total / shards
    groups = pin(size.where("_n > 1").select(F.col("_group").alias("_g"), F.col("_n").alias("group_rows")))
    start = F.pmod(F.xxhash64("_u"), F.lit(shards)).cast("int")
    known = rows.join(groups, F.col("_group") == F.col("_g"), "left").drop("_g").withColumn("shard", start)
    known = pin(known.withColumn("_linked", F.col("group_rows").isNotNull()).withColumn("group_rows", F.coalesce("group_rows", F.lit(1))))
    linked = propagate(known.where("_linked"), int(target), shards, rounds)
    dealt = _deal(known.where("not _linked"), _loads(linked, shards), target)
    whole = pin(linked.unionByName(dealt.select(*linked.columns)))
    even = pin(_even_out(whole, target, shards)) if n_rows else whole
    out = numbered(even, shards, n_rows)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        F.col("group_rows").cast("long").alias("group_rows"),
    )

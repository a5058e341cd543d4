"""Sharding: balanced label propagation (operator 3, built-in functions only).

Linked documents share a hub (here: equal texts), so a group of n copies is n
hub memberships, never n^2 edges. Documents start in a pseudo-random shard.
In each round every hub counts its members per shard, and its members propose
to move to the hub's favourite shard that still has room; proposals are
accepted up to that room. Moves therefore never break a quota, and each one
follows a majority, so fewer edges are cut round by round. At the end the
unlinked documents fill what room is left, which makes the row counts of the
shards differ by one at most (law ``rows``).

Ranks (who is accepted, who fills which room, the slot in a shard) are taken
in two levels (``common.ranked``), so no task holds a shard. A hub with a
third of all rows is counted map-side and looked up by broadcast.

Defined cases: a null text has size 1 and is linked with empty and other null
texts; rows that repeat an id are separate rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import Hot, hot_keys, lookup, ranked, stored, union_all

HUB_CELLS, SALTS = 64, 64


def _cell() -> Column:
    """Cells keep a hub's members together, yet deal a hot hub over SALTS tasks."""
    return (F.pmod(F.xxhash64("hub"), F.lit(HUB_CELLS)) * SALTS + F.pmod(F.xxhash64("row"), F.lit(SALTS))).cast("int")


def _per_shard(df: DataFrame, shards: int) -> list[int]:
    got = {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}  # one row per shard
    return [got.get(s, 0) for s in range(shards)]


def _pick(values: list[int], by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), by + 1)


def cut_edges(rows: DataFrame) -> DataFrame:
    """Links cut, counted per hub as members outside its largest shard (columns hub, shard)."""
    per = rows.groupBy("hub", "shard").count().groupBy("hub").agg((F.sum("count") - F.max("count")).alias("cut"))
    return per.agg(F.coalesce(F.sum("cut"), F.lit(0)).alias("cut"))


def propagate(linked: DataFrame, hot: Hot, quota: list[int], rounds: int) -> DataFrame:
    """Rounds of proposals over (row, hub, shard) until nothing moves, ``rounds`` at most."""
    shards = len(quota)
    for _ in range(rounds):
        room = [q - have for q, have in zip(quota, _per_shard(linked, shards), strict=True)]
        votes = [F.count_if(F.col("shard") == s).alias(f"v{s}") for s in range(shards)]
        score = [F.struct(F.col(f"v{s}").alias("n"), F.xxhash64("hub", F.lit(s)).alias("tie"), F.lit(s).alias("to")) for s in range(shards)]
        open_ = [x for x, free in zip(score, room, strict=True) if free > 0]
        if not open_:
            break
        hubs = linked.groupBy("hub").agg(*votes).select(
            "hub", F.array_max(F.array(*open_)).alias("best"), F.array(*score).alias("all"))
        moves = lookup(linked, hubs, "hub", hot).where(
            (F.col("best.to") != F.col("shard")) & (F.col("best") > F.element_at("all", F.col("shard") + 1)))
        moves = stored(moves.select("row", "hub", "shard", F.col("best.to").alias("to")), "proposals")
        if moves.isEmpty():
            break
        accepted = ranked(moves, ["to"], _cell(), [F.col("hub"), F.col("row")]).where(F.col("rank") < _pick(room, F.col("to")))
        linked = stored(linked.join(accepted.select("row", "to"), "row", "left").select(
            "row", "hub", F.coalesce("to", "shard").alias("shard")), "labels")
    return linked


def balanced_shards(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = 16, rounds: int | None = None) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    A hub fills one shard a round, so a large one needs up to as many rounds as there are shards: by default a few more.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), F.unhex(F.md5(body.cast("binary"))).alias("hub")), "rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    hot = hot_keys(rows, "hub")
    sizes = stored(rows.groupBy("hub").count().where("count > 1").select("hub"), "hubs")
    linked = stored(lookup(rows.select("row", "hub"), sizes, "hub", hot).withColumn(
        "shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")), "linked")
    linked = propagate(linked, hot, quota, shards + 4 if rounds is None else rounds)
    staying = ranked(linked, ["shard"], _cell(), [F.col("hub"), F.col("row")]).where(F.col("rank") < _pick(quota, F.col("shard")))
    staying = stored(staying.select("row", "shard"), "staying")
    free = stored(rows.select("row").join(staying, "row", "left_anti"), "free")
    room = [q - have for q, have in zip(quota, _per_shard(staying, shards), strict=True)]
    ends = [sum(room[: s + 1]) for s in range(shards)]
    spread = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(HUB_CELLS * SALTS)).cast("int")
    fill = ranked(free.withColumn("all", F.lit(0)), ["all"], spread, [F.col("row")])
    fill = fill.select("row", sum((F.col("rank") >= e).cast("int") for e in ends).alias("shard"))
    placed = stored(union_all([staying, fill]).join(rows, "row"), "placed")
    out = ranked(placed, ["shard"], F.pmod(F.xxhash64("row", F.lit(2)), F.lit(SALTS * 16)).cast("int"), [F.col("row")], "slot")
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

"""Sharding by balanced label propagation, under the law `rows`: row counts of the shards are at most one apart.

Documents of equal text are linked. Rows start in a shard by a hash of their id. Each round, the cells of every group (its
rows by first shard and salt) wish to join the shard that holds most of their group. The room of a shard is its quota less
the linked rows it holds, as unlinked rows can always go elsewhere. Wishes are granted in units, small groups first, as far
as rooms and the wishes that leave allow. When no wish is granted, ties go to the shard with more room; when that helps no
more, whole groups of the shards that are too full make way for shards with room. Every granted wish lowers the cut, and
groups make way again only if less than before is without room, so rounds end by themselves. At the end, unlinked rows of
shards that are too large fill up the others; linked rows are touched only if they alone exceed a shard.

Cells, not rows, move: a group that holds a third of all rows is at most SHARDS * SALTS cells, and the part of it that fits
no shard is cut. Ranks in a shard come from ranks in small buckets plus offsets, never from one sorted shard.

Defined results: a null text has size 1, the checksum of an empty text, and is linked with empty texts; rows with a null
doc_id and repeated rows are placed like all others; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import dropped, read, written

SHARDS = 8
SALTS = 16
PARTS = 64  # units of wishes between two shards, for every power of two of group sizes
BUCKET_ROWS = 20_000
MOST_BUCKETS = 4096

UNIT = ["shard", "want", "rank", "part"]
Unit = tuple[int, int, int, int]


def digests(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = F.xxhash64(F.col(doc_id), body)
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.struct(F.xxhash64(body).alias("a"), F.crc32(body.cast("binary")).alias("b")).alias("grp"),
        F.pmod(hashed, F.lit(SHARDS)).cast("int").alias("home"), F.pmod(F.shiftright(hashed, 8), F.lit(SALTS)).cast("int").alias("salt"),
        F.shiftright(hashed, 16).alias("spread"),
    )


def _granted(wishes: dict[Unit, int], room: dict[int, int]) -> set[Unit]:
    """The wishes (rows by unit) that together leave no shard fuller than its room; those of small groups come first."""
    left, into = dict(room), {s: [] for s in range(SHARDS)}
    for unit in sorted(wishes, key=lambda u: (u[2:], u[:2])):
        into[unit[1]].append(unit)
        left[unit[0]] += wishes[unit]
        left[unit[1]] -= wishes[unit]
    refused, full = [], set(range(SHARDS))
    while full:
        b = full.pop()
        while into[b] and left[b] < min(0, room[b]):
            unit = into[b].pop()
            left[b] += wishes[unit]
            left[unit[0]] -= wishes[unit]
            full.add(unit[0])
            refused.append(unit)
    granted = {unit for own in into.values() for unit in own}
    for unit in sorted(refused, key=lambda u: (u[2:], u[:2])):
        if wishes[unit] <= left[unit[1]]:
            granted.add(unit)
            left[unit[0]] += wishes[unit]
            left[unit[1]] -= wishes[unit]
    return granted


def _relief(whole: dict[Unit, int], need: dict[int, int], room: dict[int, int]) -> set[Unit]:
    """Units of whole groups that leave shards where rows are needed for shards that have room."""
    need, room, granted = dict(need), dict(room), set()
    for unit in sorted(whole, key=lambda u: (u[2:], u[:2])):
        a, b = unit[:2]
        if need[a] > 0 and whole[unit] <= room[b]:
            granted.add(unit)
            need[a] -= whole[unit]
            room[b] -= whole[unit]
    return granted


def _by_unit(wished: DataFrame) -> dict[Unit, int]:
    """Rows by unit, at most SHARDS * SHARDS * 63 * PARTS of them."""
    return {tuple(r)[:4]: r["n"] for r in wished.where("shard <> want").groupBy(*UNIT).agg(F.sum("n").alias("n")).collect()}


def _moved(cells: DataFrame, wished: DataFrame, granted: set[Unit]) -> DataFrame:
    units = wished.sparkSession.createDataFrame(sorted(granted), ", ".join(f"{c} int" for c in UNIT)).withColumn("granted", F.lit(True))
    joined = wished.join(F.broadcast(units), UNIT, "left")
    moved = written(joined.withColumn("shard", F.when(F.col("granted"), F.col("want")).otherwise(F.col("shard"))).select(*cells.columns), "cells")
    dropped(cells)
    return moved


def propagated(cells: DataFrame, rows: int) -> DataFrame:
    """Cells (grp, home, salt, n, members) with their shard after label propagation."""
    cells = written(cells.withColumn("rank", F.floor(F.log2("members")).cast("int")).withColumn("shard", F.col("home")), "cells")
    room = dict.fromkeys(range(SHARDS), rows // SHARDS)
    for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        room[r["shard"]] -= r["n"]

    def settle(units: dict[Unit, int], granted: set[Unit]) -> None:
        for unit in granted:
            room[unit[0]] += units[unit]
            room[unit[1]] -= units[unit]

    roomy, least = False, None  # whether ties go to the shard with more room; rows without room before the last relief
    while True:
        held = cells.groupBy("grp", "shard").agg(F.sum("n").alias("n"))
        tie = F.element_at(F.create_map(*[F.lit(x) for s in range(SHARDS) for x in (s, room[s])]), F.col("shard")) if roomy else F.lit(0)
        best = held.groupBy("grp").agg(F.max_by("shard", F.struct("n", tie.alias("room"), F.xxhash64("grp", "shard").alias("tie"))).alias("want"))
        wished = cells.join(best, "grp").withColumn("part", F.pmod(F.xxhash64("grp", "salt"), F.lit(PARTS)).cast("int"))
        wishes = _by_unit(wished)
        granted = _granted(wishes, room)
        if granted:
            settle(wishes, granted)
            cells = _moved(cells, wished, granted)
            continue
        if wishes and not roomy:
            roomy = True
            continue
        # Whole groups make way for what has found no room.
        need = {s: max(0, -room[s]) for s in range(SHARDS)}
        for unit, n in wishes.items():
            need[unit[1]] += n
        lacking = sum(need.values())
        open_ = [s for s in range(SHARDS) if not need[s] and room[s] > 0]
        if not lacking or not open_ or least is not None and lacking >= least:
            return cells
        least, roomy = lacking, False
        settled = held.join(cells.groupBy("grp").agg(F.max("members").alias("members")), "grp").where("n = members").select("grp")
        choice = F.pmod(F.xxhash64("grp", F.lit(lacking)), F.lit(len(open_))).cast("int")
        away = F.element_at(F.array(*map(F.lit, open_)), choice + 1)
        leaving = F.col("whole") & F.col("shard").isin([s for s in range(SHARDS) if need[s]])
        wished = cells.join(settled.withColumn("whole", F.lit(True)), "grp", "left").withColumn("want", F.when(leaving, away).otherwise(F.col("shard")))
        wished = wished.withColumn("part", F.pmod(F.xxhash64("grp"), F.lit(PARTS)).cast("int"))
        whole = _by_unit(wished)
        granted = _relief(whole, need, room)
        if not granted:
            return cells
        settle(whole, granted)
        cells = _moved(cells, wished, granted)


def sharded(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of `docs`."""
    rows = written(digests(docs, text=text, doc_id=doc_id), "digests")
    groups = rows.groupBy("grp", "home", "salt").agg(F.count("*").alias("n"))
    linked = groups.join(groups.groupBy("grp").agg(F.sum("n").alias("members")).where("members > 1"), "grp")
    total = rows.count()
    cells = propagated(linked, total)

    placed = rows.join(cells.select("grp", "home", "salt", "shard"), ["grp", "home", "salt"], "left").select(
        "doc_id", "size", "text_crc32", F.coalesce("shard", "home").alias("shard"), F.col("shard").isNull().cast("int").alias("alone"), "spread"
    )
    buckets = max(1, min(MOST_BUCKETS, total // (SHARDS * BUCKET_ROWS)))
    placed = written(placed.withColumn("bucket", F.pmod("spread", F.lit(buckets)).cast("int")), "placed")

    # Rank in the shard, linked rows first: rank in the bucket plus the rows of the buckets before.
    counts = placed.groupBy("shard", "alone", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("alone", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "alone", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = Window.partitionBy("shard", "alone", "bucket").orderBy("doc_id", "text_crc32", "size")
    slots = placed.withColumn("at", F.row_number().over(ranked) - 1)
    slots = slots.join(F.broadcast(offsets), ["shard", "alone", "bucket"])  # at most 2 * SHARDS * MOST_BUCKETS rows
    slots = slots.withColumn("slot", (F.col("offset") + F.col("at")).cast("long"))
    return evened(slots, {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def evened(slots: DataFrame, held: dict[int, int]) -> DataFrame:
    """Moves the last rows of shards that are too large to the ends of those that are too small."""
    total = sum(held.values())
    largest_first = sorted(range(SHARDS), key=lambda s: (-held.get(s, 0), s))
    quota = {s: total // SHARDS + (k < total % SHARDS) for k, s in enumerate(largest_first)}
    start, surplus = {}, 0
    for s in range(SHARDS):
        start[s] = surplus
        surplus += max(0, held.get(s, 0) - quota[s])
    number = F.col("slot") - F.element_at(F.create_map(*[F.lit(x) for s in range(SHARDS) for x in (s, quota[s] - start[s])]), F.col("shard"))
    over = F.col("slot") >= F.element_at(F.create_map(*[F.lit(x) for s in range(SHARDS) for x in (s, quota[s])]), F.col("shard"))
    shard, slot, taken = F.col("shard"), F.col("slot"), 0
    for s in range(SHARDS):
        free = max(0, quota[s] - held.get(s, 0))
        here = over & (number >= taken) & (number < taken + free)
        shard, slot = F.when(here, F.lit(s)).otherwise(shard), F.when(here, number - taken + held.get(s, 0)).otherwise(slot)
        taken += free
    return slots.select(*[c for c in slots.columns if c not in ("shard", "slot")], shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharded(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

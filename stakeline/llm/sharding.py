"""Sharding by balanced label propagation (operator 1), in built-in expressions only.

Documents with equal texts are linked. Linking each copy with each other would need all pairs of a group, so
a group stands for its links: a copy's neighbours in a shard are the copies of its group there. Copies of one
group in one shard form a piece, and a piece is what moves, all at once; a group starts as up to as many
pieces as there are shards, so even a group of a third of all rows is spread and counted by partial sums.

Each round, every piece asks for the shard where most of its group is, if that is not its own. Requests are
met under quotas: between two shards as many rows may go one way as want to go the other, and beside these
exchanges a shard may take the room that it has below its capacity, ``SLACK`` above an even share. Requests
are ordered by gain and dealt into bins; whole bins are admitted while they fit, so no ranking of single
rows is needed. A bin larger than the room left is passed over and does not count in the running sum, ``PASSES``
times a round, so that a piece of a huge group does not hold up those after it. Moves stop when no request is admitted or after ``ROUNDS`` rounds.

At last rows are put in order of (shard, group, id) and cut into runs whose lengths are at most one apart.
That makes the law exact and cuts one group at most at each border, beside those that are larger than a
shard. Positions come from sorted partitions and their counts, not from a window over all rows.

Defined cases: a null text is of size 1, with null-text rows as one group and the checksum of an empty text;
null ids come first in their group; repeated rows take separate slots; an empty table gives no rows; other
columns do not matter; the shards beyond the number of rows stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import id_and_text, settle

SHARDS, ROUNDS, SLACK, BINS, PASSES = 16, 5, 0.25, 64, 3


def measured(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return id_and_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit("")).otherwise(F.md5(F.col("text").cast("binary"))).alias("group"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("first_shard"))


def admit(bins_of: DataFrame, name: str, within: list[str], order: list[str], room: Column) -> DataFrame:
    """Adds ``name``: whether a bin of ``wanted`` rows fits into ``room``, with those before it that fit."""
    every = Window.partitionBy(*within)
    found = bins_of.withColumn(name, F.lit(False))
    for _ in range(PASSES):
        found = found.withColumn("__left", room - F.sum(F.when(F.col(name), F.col("wanted")).otherwise(0)).over(every))
        fits = ~F.col(name) & (F.col("wanted") <= F.col("__left"))
        found = found.withColumn("__run", F.sum(F.when(fits, F.col("wanted")).otherwise(0)).over(every.orderBy(*order)))
        found = found.withColumn(name, F.col(name) | (fits & (F.col("__run") <= F.col("__left"))))
    return found.drop("__left", "__run")


def propagate(pieces: DataFrame, rows: int, shards: int, rounds: int = ROUNDS, slack: float = SLACK,
              bins: int = BINS) -> DataFrame:
    """``group, first_shard, shard, n``: pieces after label propagation under quotas."""
    capacity = int(-(-rows // shards) * (1 + slack)) + 1
    for k in range(rounds):
        here = pieces.groupBy("group", "shard").agg(F.sum("n").alias("weight"))
        # most copies first, then a shard that depends on the group, so that ties spread evenly
        tie = F.pmod(F.xxhash64("group") + F.col("shard"), F.lit(shards))
        home = here.groupBy("group").agg(F.max(F.struct("weight", (-tie).alias("tie"), "shard")).alias("home"),
                                         F.count("*").alias("parts")).where("parts > 1")
        asking = pieces.join(here, ["group", "shard"]).join(home, "group").where("shard != home.shard").select(
            "group", "first_shard", "shard", "n", F.col("home.shard").alias("to"),
            (F.col("home.weight") - F.col("weight")).alias("gain"))
        # bins of falling gain: by its size in powers of two, then by a hash of the group
        scale = F.lit(40) - F.least(F.lit(40), F.floor(F.log2(F.col("gain").cast("double") + 1))).cast("int")
        asking = settle(asking.withColumn("bin", scale * bins + F.pmod(F.xxhash64("group"), F.lit(bins)).cast("int")), "asking")
        # at most shards x shards x 41 x bins rows from here on
        bins_of = asking.groupBy("shard", "to", "bin").agg(F.sum("n").alias("wanted"))
        pair = bins_of.groupBy("shard", "to").agg(F.sum("wanted").alias("returned"))
        back = pair.select(F.col("to").alias("shard"), F.col("shard").alias("to"), "returned")
        free = pieces.groupBy(F.col("shard").alias("to")).agg((F.lit(capacity) - F.sum("n")).alias("free"))
        offered = bins_of.join(back, ["shard", "to"], "left").join(free, "to", "left")
        offered = admit(offered, "swapped", ["shard", "to"], ["bin"], F.coalesce("returned", F.lit(0)))
        # what is swapped needs no room
        rest = admit(offered.where(~F.col("swapped")), "filled", ["to"], ["bin", "shard"], F.coalesce("free", F.lit(capacity)))
        admitted = offered.where("swapped").select("shard", "to", "bin").unionByName(rest.where("filled").select("shard", "to", "bin"))
        moving = asking.join(admitted, ["shard", "to", "bin"]).select("group", "first_shard", F.col("to").alias("target"))
        moved = settle(moving, "moving")
        if moved.isEmpty():
            break
        pieces = settle(pieces.join(moved, ["group", "first_shard"], "left").select(
            "group", "first_shard", F.coalesce("target", "shard").alias("shard"), "n"), "pieces")
    return pieces


def positions(ordered: DataFrame) -> DataFrame:
    """Adds ``position``, gapless from 0, to a frame that is range partitioned and sorted within partitions."""
    numbered = settle(ordered.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", 33)
    # one row per partition
    counts = numbered.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return numbered.withColumn("__part", part).join(F.broadcast(offsets), "__part").withColumn(
        "position", F.col("__at") - F.shiftleft("__part", 33) + F.col("__before")).drop("__at", "__part", "__before")


def assign_shards(docs: DataFrame, shards: int = SHARDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` with counts at most one apart."""
    rows = settle(measured(docs, id_col, text_col, shards), "measured")
    total = rows.count()
    counted = rows.groupBy("group", "first_shard").agg(F.count("*").alias("n"))
    groups = settle(counted, "groups")
    # a text that is there once has no links
    linked = groups.join(groups.groupBy("group").agg(F.sum("n").alias("copies")).where("copies > 1").select("group"), "group")
    # single rows count towards the shards' fill, as one piece per shard
    single = groups.join(linked.select("group").distinct(), "group", "left_anti").groupBy("first_shard").agg(F.sum("n").alias("n")).select(
        F.concat(F.lit("single "), F.col("first_shard").cast("string")).alias("group"), "first_shard",
        F.col("first_shard").alias("shard"), "n")
    pieces = settle(linked.select("group", "first_shard", F.col("first_shard").alias("shard"), "n").unionByName(single), "pieces")
    placed = propagate(pieces, total, shards).where(~F.col("group").startswith("single ")).select(
        "group", "first_shard", "shard")
    labelled = rows.join(placed, ["group", "first_shard"], "left").withColumn(
        "shard", F.coalesce("shard", "first_shard")).drop("first_shard")
    order = ["shard", "group", "doc_id", "text_crc32"]
    placed_rows = positions(labelled.repartitionByRange(*order).sortWithinPartitions(*order))
    # shard s holds the positions from floor(s * total / shards) on
    final = F.floor(((F.col("position") + 1) * shards - 1) / F.lit(max(total, 1)))
    start = F.floor(F.col("final") * F.lit(total) / shards)
    return placed_rows.withColumn("final", final.cast("bigint")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("final").cast("int").alias("shard"),
        (F.col("position") - start).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("shard").alias("label"))

"""Shards of equal bytes by best-fit-decreasing bin packing of indivisible groups.

Equal texts form a group that stays in one shard. A group larger than a shard cannot: it alone is
cut, into pieces by a hash of its rows. Items are packed largest first into the tightest bin that
still has room, found in a list of the bins ordered by room; the capacity is the smallest at which
the items fit the wanted number of bins.

The packing itself is sequential, so the number of items is bounded whatever the table's size: a
group of at least ``1 / GRAIN`` of a shard is an item (there are at most shards * GRAIN of them);
smaller ones are bundled by hash, ``shards * GRAIN`` bundles in all, and a bundle moves as one.

A null text counts as empty (16 bytes). Repeated rows are rows like others. doc_id may be null or
repeated. Empty table: empty result. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import stage, whole

SHARDS = 40
GRAIN = 128
PIECES = 16  # of a shard's capacity, for a group too large for one shard
OVERHEAD = 16
SLOT_ROWS = 1 << 19  # rows that one task numbers


def best_fit(sizes: list[int], bins: int, capacity: int) -> list[int] | None:
    """The bin of each item, largest first into the tightest fitting bin; None if they don't fit.

    The open bins are held ordered by room, so the tightest is found by bisection.
    """
    rooms: list[tuple[int, int]] = []
    out = [0] * len(sizes)
    opened = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, bin_ = rooms.pop(at)
        elif opened < bins and sizes[i] <= capacity:
            room, bin_ = capacity, opened
            opened += 1
        else:
            return None
        insort(rooms, (room - sizes[i], bin_))
        out[i] = bin_
    return out


def pack(sizes: list[int], bins: int) -> list[int]:
    """Bins of the items at the smallest capacity, within a 40,000th, at which they fit."""
    if not sizes:
        return []
    total = sum(sizes)
    low = max(-(-total // bins), max(sizes))
    step = max(1, low // 1000)
    found = best_fit(sizes, bins, low)
    high = low
    while found is None:
        high += step
        step *= 2
        found = best_fit(sizes, bins, high)
    tick = max(1, low // 40000)
    while high - low > tick:
        middle = (low + high) // 2
        trial = best_fit(sizes, bins, middle)
        low, high, found = (middle, high, found) if trial is None else (low, middle, trial)
    return found


def _hash(salt: str, *columns: Column) -> Column:
    return F.xxhash64(F.lit(salt), *columns)


def _mod(value: Column, n: int | Column) -> Column:
    return F.pmod(value, F.lit(n) if isinstance(n, int) else n)


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    grain: int = GRAIN,
    id_: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, shard, slot`` and ``item``, what it was packed with."""
    body = whole(text)
    rows = stage(
        docs.select(
            F.col(id_).alias("doc_id"),
            (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(body).alias("group"),
        ),
        "op8-rows",
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size").alias("t"), F.count(F.lit(1)).alias("n")).first()
    capacity = max(1, (total["t"] or 0) // shards)
    least = max(1, capacity // grain)
    groups = stage(groups, "op8-groups")
    # At most shards * grain * 2 rows, as each has at least half of 1 / grain of a shard's bytes.
    large = groups.where(F.col("bytes") >= least).collect()
    pieces = {
        r["group"]: -(-r["bytes"] * PIECES // capacity) if r["bytes"] > capacity else 1
        for r in large
    }
    bundles = shards * grain

    # item: the group itself, a piece of it, or a bundle of small groups.
    spark = rows.sparkSession
    marks = spark.createDataFrame(list(pieces.items()), "group long, pieces int")
    marked = rows.join(F.broadcast(marks), "group", "left")
    item = (
        F.when(F.col("pieces").isNull(), F.struct(
            F.lit(0).alias("kind"), _mod(_hash("bundle", F.col("group")), bundles).alias("id"),
            F.lit(0).cast("long").alias("piece")))
        .otherwise(F.struct(
            F.lit(1).alias("kind"), F.col("group").alias("id"),
            _mod(_hash("piece", F.col("doc_id")), F.col("pieces")).cast("long").alias("piece")))
    )
    items = marked.withColumn("item", item).drop("pieces")
    sizes = items.groupBy("item").agg(F.sum("size").alias("bytes")).collect()
    sizes.sort(key=lambda r: tuple(r["item"]))
    placed = pack([r["bytes"] for r in sizes], shards)
    where = spark.createDataFrame(
        [(tuple(r["item"]), s) for r, s in zip(sizes, placed, strict=True)],
        "item struct<kind int, id long, piece long>, shard int",
    )
    return with_slots(items.join(F.broadcast(where), "item"), shards, total["n"])


def with_slots(rows: DataFrame, shards: int, count: int) -> DataFrame:
    """Number the rows of each shard from 0, in an order dealt by hash.

    A shard is cut by hash into parts of some SLOT_ROWS rows that are numbered apart; the rows of
    earlier parts are added from the table of their counts.
    """
    parts = max(4, -(-count // (shards * SLOT_ROWS)))
    row = [F.col(c) for c in ("doc_id", "size", "text_crc32")]
    rows = rows.withColumn("deal", _hash("slot", *row))
    rows = rows.withColumn("part", _mod(F.col("deal"), parts))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "part").count().withColumn(
        "start", F.coalesce(F.sum("count").over(before), F.lit(0))
    )
    inside = Window.partitionBy("shard", "part").orderBy("deal", "doc_id", "size", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(counts.drop("count"), ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"), "item",
        )
    )

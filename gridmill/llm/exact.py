"""Exact duplicates by an extendible-hash index kept in shared files.

A key is the 64-bit hash of a text. The directory maps the leading ``depth`` bits of a key to a
bucket; while a bucket holds more keys than its capacity it is split by one more bit and, where
needed, the directory doubles. Equal texts share a key and so never fill a bucket: the copies of a
text are combined inside each task, and one entry of the index stands for all of them. Each owner
task writes the buckets of a contiguous range of keys; within a bucket, different texts with one key
form a chain, told apart by comparing their bytes. Documents then find their entry by key, and only
those whose key has a chain of several texts compare bytes again.

Null and empty texts are equal. Of equal texts the row with the largest doc_id stays; a null doc_id
is smaller than any. Rows that repeat both doc_id and text stay and go together in the decisions;
``unique_documents`` keeps one of them. An empty table gives an empty result. Other columns of the
input are not read, so their names cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import same, stage, whole

CAPACITY = 1 << 20  # keys in a bucket
MOST_DEPTH = 16  # the directory has at most 65,536 slots
KEY_BITS = 64


def hash_key(text: Column) -> Column:
    return F.xxhash64(text)


def _prefix(key: Column | str, depth: int) -> Column:
    return F.shiftrightunsigned(key, KEY_BITS - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[int, list[tuple[int, int]]]:
    """The global depth and the buckets ``(prefix, local depth)`` of a frame of distinct keys.

    Every round counts the keys of the buckets still overfull and splits them, so the driver gets at
    most two rows per bucket it split, and 65,536 in all.
    """
    total = keys.count()
    depth = 0
    done: list[tuple[int, int]] = []
    open_: list[int] = [0]
    full = {0: total}
    while open_:
        split = [p for p in open_ if full.get(p, 0) > capacity and depth < MOST_DEPTH]
        done += [(p, depth) for p in open_ if p not in split]
        if not split:
            break
        parent = _prefix(F.col("key"), depth)
        chosen = keys if len(split) == 1 << depth else keys.where(parent.isin(split))
        depth += 1
        rows = chosen.groupBy(_prefix(F.col("key"), depth).alias("p")).count().collect()
        full = {r["p"]: r["count"] for r in rows}
        open_ = [2 * p + i for p in split for i in (0, 1)]
    return depth, sorted(done, key=lambda b: b[0] << (MOST_DEPTH - b[1]))


def bucket_of(key: Column, depth: int, buckets: list[tuple[int, int]]) -> Column:
    """The number of the bucket that the directory's slot for the key points to."""
    if depth == 0:
        return F.lit(0)
    slots: list[int] = []
    for number, (_, local) in enumerate(buckets):
        slots += [number] * (1 << (depth - local))
    if len(buckets) == 1 << depth:
        return _prefix(key, depth).cast("int")
    table = F.array(*[F.lit(s) for s in slots])
    return F.element_at(table, (_prefix(key, depth) + 1).cast("int"))


def build_index(
    docs: DataFrame, capacity: int = CAPACITY, key=hash_key, id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The stored index: one row per distinct text, in files of contiguous bucket ranges.

    ``bucket, key, link`` (place in the key's chain, from 0), ``links`` (length of the chain),
    ``keep_id, group_size, text_sha256`` and ``body``, the text itself where the chain is longer
    than one.
    """
    rows = docs.select(F.col(id_).alias("doc_id"), whole(text).alias("text"))
    # Grouping by the text compares bytes; copies are combined before the shuffle.
    entries = (
        rows.groupBy(key(F.col("text")).alias("key"), "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"))
    )
    entries = stage(entries, "op4-entries")
    chains = entries.groupBy("key").agg(F.count(F.lit(1)).alias("links"))
    depth, buckets = directory(chains.select("key"), capacity)
    long_ = chains.where("links > 1")
    single = entries.join(long_, "key", "left_anti").withColumns(
        {
            "link": F.lit(0),
            "links": F.lit(1).cast("long"),
            "body": F.lit(None).cast("string"),
        }
    )
    parts = [single]
    if not long_.isEmpty():
        bodies = (
            rows.withColumn("key", key(F.col("text")))
            .join(long_, "key", "left_semi")
            .groupBy("key", "text")
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        )
        chain = Window.partitionBy("key")
        place = bodies.withColumn("text_sha256", F.sha2("text", 256)).withColumns(
            {
                "link": F.row_number().over(chain.orderBy("text_sha256")) - 1,
                "links": F.count(F.lit(1)).over(chain),
            }
        )
        parts.append(place.withColumnRenamed("text", "body"))
    index = reduce(DataFrame.unionByName, parts).withColumn(
        "bucket", bucket_of(F.col("key"), depth, buckets)
    )
    return stage(
        index.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "link"),
        "op4-index",
    )


def duplicates(
    docs: DataFrame, capacity: int = CAPACITY, key=hash_key, id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256, bucket``."""
    index = build_index(docs, capacity, key, id_, text)
    rows = docs.select(F.col(id_).alias("doc_id"), whole(text).alias("text"))
    rows = rows.withColumn("key", key(F.col("text")))
    single = rows.select("doc_id", "key").join(
        index.where("links = 1").drop("link", "links", "body"), "key"
    )
    found = single.drop("key")
    chained = index.where("links > 1")
    if not chained.isEmpty():
        several = rows.join(chained, "key").where(F.col("text") == F.col("body"))
        found = found.unionByName(several.select(*found.columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        same(F.col("doc_id"), F.col("keep_id")).alias("kept"),
        "text_sha256",
        "bucket",
    )


def unique_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, each once."""
    kept = duplicates(docs, capacity).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha")
    )
    return keep_rows(docs, kept)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id (and text digest, where given) is in ``kept``, each once.

    ``kept`` has ``kept_id`` and perhaps ``kept_sha``.
    """
    packed = docs.select(
        F.col("doc_id").alias("id"),
        F.sha2(whole("text"), 256).alias("sha"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    match = same(F.col("id"), F.col("kept_id"))
    if "kept_sha" in kept.columns:
        match &= F.col("sha") == F.col("kept_sha")
    joined = packed.join(kept.distinct(), match, "left_semi")
    return joined.groupBy("id", "sha").agg(F.first("doc").alias("doc")).select("doc.*")

"""The trie of conversation prefixes, by vertical bitmaps per shard.

A conversation takes the first turns of the first conversation of its group, so groups of
``GROUP`` consecutive ids stay together. Ranges of groups make shards, and each task takes its range
in bounded batches of conversations. A batch keeps, for each (position, turn), the set of its
conversations that have this turn there, as one bitset. Depth first, the members of a node are the
members of its parent intersected with the posting of a turn: popcounts give the number of members,
the lowest bit the smallest, and the members whose turns end there the node's end list. A node is
known by the digest of its turns, chained, so the nodes of all batches are put together by one
aggregation; end lists of batches are stretches of ascending ids and are hashed one after the other.

Sums over subtrees do not walk the trie. A node with one member has one leaf below it and saves
nothing. All nodes with the same smallest member are one path; a path hangs below a node of another.
Totals of paths come from doubling (each round reaches twice as far up, so rounds are the logarithm
of the depth), and sums along a path from one window.

Null roles and texts are empty. Turns are ordered by number, nulls first, then by role and text, so
reruns agree; repeated rows are repeated turns. Rows without a conversation id belong to none and are
left out. A conversation's turns are held in one task, some 150 bytes each and
none of their text. A
conversation without turns is a member of the root. An empty table has no conversation and so no
root: an empty result. Only four columns of the input are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import stage

GROUP = 5  # ids; the conversation whose id is a multiple lends its first turns
MOST_LENT = 9
BATCH = 2048  # conversations
BATCH_TURNS = 200_000
ENDS = 4096  # ids in one piece of an end list

NODES = (
    "node binary, parent binary, depth long, conv_id long, n_convs long, bytes long,"
    " ends array<struct<first: long, ids: string>>"
)
ROOT = b"\0" * 32


def lent(conv: int) -> int:
    """How many turns a conversation takes from the first of its group."""
    return zlib.crc32(str(conv).encode()) % MOST_LENT


def _turn(role: str, text: bytes) -> tuple[bytes, int]:
    """What tells turns apart, and the bytes of the text."""
    mark = hashlib.sha256(b"%d:" % len(role))
    mark.update(role)
    mark.update(text)
    return mark.digest(), len(text)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list]]:
    """Conversations in order of their ids, with the turns they take from their group's first."""
    conv, turns, base, head = None, [], None, []

    def whole():
        nonlocal base, head
        if conv - conv % GROUP != base:
            base, head = conv - conv % GROUP, []
        if conv == base:
            head = turns[: MOST_LENT - 1]
        n = lent(conv)
        return conv, [*head[:n], *turns[n:]]

    for batch in batches:
        rows = zip(
            batch.column(0).to_pylist(),
            batch.column(1).cast(pa.large_binary()).to_pylist(),
            batch.column(2).cast(pa.large_binary()).to_pylist(),
            strict=True,
        )
        for id_, role, text in rows:
            if id_ != conv:
                if conv is not None:
                    yield whole()
                conv, turns = id_, []
            turns.append(_turn(role, text))
    if conv is not None:
        yield whole()


def _listed(convs: list[int], members: int) -> list[int]:
    out = []
    while members:
        low = members & -members
        out.append(convs[low.bit_length() - 1])
        members ^= low
    return out


def _trie(convs: list[int], turns: list[list]) -> Iterator[tuple]:
    """The nodes of one batch, depth first."""
    postings: list[dict[bytes, int]] = []
    ending: dict[int, int] = {}
    for i, own in enumerate(turns):
        bit = 1 << i
        ending[len(own)] = ending.get(len(own), 0) | bit
        while len(postings) < len(own):
            postings.append({})
        for at, (mark, _) in enumerate(own):
            postings[at][mark] = postings[at].get(mark, 0) | bit
    open_ = [(ROOT, None, 0, 0, (1 << len(convs)) - 1)] if convs else []
    while open_:
        node, parent, depth, size, members = open_.pop()
        first = (members & -members).bit_length() - 1
        ends = _listed(convs, members & ending.get(depth, 0))
        pieces = [ends[i : i + ENDS] for i in range(0, len(ends), ENDS)]
        pieces = [{"first": p[0], "ids": ",".join(map(str, p))} for p in pieces]
        yield node, parent, depth, convs[first], members.bit_count(), size, pieces
        left = members & ~ending.get(depth, 0)
        while left:
            mark, size = turns[(left & -left).bit_length() - 1][depth]
            child = left & postings[depth][mark]
            left ^= child
            key = hashlib.sha256(node + mark).digest()
            open_.append((key, node, depth + 1, size, child))


def _nodes(conversations: int):
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nodes of one batch of conversations after the other."""
        convs: list[int] = []
        turns: list[list] = []
        held = 0
        for conv, own in _rebuilt(batches):
            convs.append(conv)
            turns.append(own)
            held += len(own)
            if len(convs) == conversations or held >= BATCH_TURNS:
                yield from _packed(_trie(convs, turns))
                convs, turns, held = [], [], 0
        yield from _packed(_trie(convs, turns))

    return nodes


def _packed(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    ends = pa.list_(pa.struct([("first", pa.int64()), ("ids", pa.string())]))
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4, ends]
    names = ["node", "parent", "depth", "conv_id", "n_convs", "bytes", "ends"]
    for some in batched(rows, 10_000):
        columns = zip(zip(*some, strict=True), kinds, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces in order; a piece at a time is held."""
    node, mark = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([mark.hexdigest()])], ["node", "ends_sha256"]
        )

    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
        for key, ids in rows:
            if key != node:
                if node is not None:
                    yield row()
                node, mark = key, hashlib.sha256(ids.encode())
            else:
                mark.update(b"," + ids.encode())
    if node is not None:
        yield row()


def shard_nodes(turns: DataFrame, conversations: int = BATCH) -> DataFrame:
    """The nodes of every batch of conversations: see ``NODES``."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    group = (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("group")
    keep = rows.select(group, "conv_id", "turn", "role", "text")
    ordered = keep.repartitionByRange("group").sortWithinPartitions(
        "group", "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.select("conv_id", "role", "text").mapInArrow(_nodes(conversations), NODES)


def merged(shards: DataFrame) -> DataFrame:
    """One row per node: ``node, parent, depth, conv_id, n_convs, bytes``."""
    return shards.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.first("bytes").alias("bytes"),
    )


def end_digests(shards: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes where conversations end."""
    pieces = shards.select("node", F.explode("ends").alias("e")).select(
        "node", F.col("e.first").alias("first"), F.col("e.ids").alias("ids")
    )
    ordered = pieces.repartition("node").sortWithinPartitions("node", "first")
    return ordered.mapInArrow(_digests, "node binary, ends_sha256 string")


def path_totals(paths: DataFrame) -> DataFrame:
    """``path, leaves, saved`` with those of all paths below it added, from rows ``path, above``
    (null: none) and the path's own ``leaves`` and ``saved``.

    Before each round a path has what lies within a distance of it, and ``above`` is that far up;
    the round adds what its descendants at that distance have, and doubles the distance.
    """
    held = stage(paths, "op13-paths")
    while not held.where("above IS NOT NULL").isEmpty():
        more = held.where("above IS NOT NULL").groupBy("above").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        jump = held.select(F.col("path").alias("above"), F.col("above").alias("next"))
        held = stage(
            held.join(jump, "above", "left")
            .join(more.withColumnRenamed("above", "path"), "path", "left")
            .select(
                "path",
                F.col("next").alias("above"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "op13-paths",
        )
    return held.select("path", "leaves", "saved")


def prefix_trie(turns: DataFrame, conversations: int = BATCH) -> DataFrame:
    """Per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``."""
    shards = stage(shard_nodes(turns, conversations), "op13-shards")
    nodes = stage(merged(shards), "op13-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_children")
    )
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = (
        nodes.join(above, "parent", "left")
        .join(children.withColumnRenamed("parent", "node"), "node", "left")
        .join(end_digests(shards), "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
    linked = stage(linked, "op13-linked")
    leaf = (F.col("n_children") == 0).cast("long")
    # A path: all nodes with one smallest member. It hangs below a node one level up.
    paths = linked.groupBy(F.col("conv_id").alias("path")).agg(
        F.max(F.when(~F.col("parent_conv_id").eqNullSafe(F.col("conv_id")),
                     F.col("parent_conv_id"))).alias("above"),
        (F.min("depth") - 1).alias("at"),
        F.sum(leaf).alias("leaves"),
        F.sum("own_saved").alias("saved"),
        F.max("n_convs").alias("most"),
    )
    paths = stage(paths, "op13-tops")
    # Paths of a single member have one leaf and save nothing, and no path hangs below them.
    several = paths.where("most > 1")
    totals = path_totals(several.select("path", "above", "leaves", "saved").join(
        paths.where("most = 1").groupBy(F.col("above").alias("path")).agg(
            F.count(F.lit(1)).alias("single")), "path", "left",
    ).select("path", "above", (F.col("leaves") + F.coalesce("single", F.lit(0))).alias("leaves"),
             "saved"))
    hanging = (
        paths.where("above IS NOT NULL")
        .select("path", "above", "at", "most", "leaves")
        .join(totals.select("path", F.col("leaves").alias("t"), "saved"), "path", "left")
        .groupBy(F.col("above").alias("conv_id"), F.col("at").alias("depth"))
        .agg(
            F.sum(F.coalesce("t", "leaves")).alias("below_leaves"),
            F.sum(F.coalesce("saved", F.lit(0).cast("long"))).alias("below_saved"),
        )
    )
    down = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    zero = F.lit(0).cast("long")
    shared = linked.where("n_convs > 1").join(hanging, ["conv_id", "depth"], "left")
    # The end of a path may have a single member; its leaf belongs to the path's shared nodes too.
    tails = paths.where("most > 1").select(F.col("path").alias("conv_id"), "leaves")
    shared = shared.join(tails, "conv_id").select(
        *[c for c in linked.columns if c != "own_saved"],
        (F.col("leaves") + F.sum(F.coalesce("below_leaves", zero)).over(down)).alias("n_leaves"),
        F.sum(F.col("own_saved") + F.coalesce("below_saved", zero)).over(down).alias(
            "saved_tokens"
        ),
    )
    alone = linked.where("n_convs = 1").withColumns(
        {"n_leaves": F.lit(1).cast("long"), "saved_tokens": zero}
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    return shared.select(columns).unionByName(alone.select(columns))

"""Near duplicates: tensored MinHash tables propose, full shingle sets confirm.

A table key is a pair of short hashes, one from each of two collections of ``m``; the ``m * m``
pairs are that many tables at the price of ``2 * m`` short hashes. ``m`` is chosen so that a pair of
texts just at the threshold shares no key with a probability of at most MISSED.

1. Equal shingle sets form a class, which its smallest doc_id stands for.
2. Classes that share a key are screened by the agreement of their MinHash values, which only
   drops pairs far below the threshold. A bucket of n classes gives at most n - 1 edges, a spanning
   forest of all its pairs that pass, so nothing is lost and nothing grows with the pairs. A bucket
   of more than BUCKET classes is cut by a salt into parts, joined by some that all parts get; those
   that are still apart after that are screened once more, over the whole bucket.
3. The components of these edges are groups outside of which no link can be. Each class is sent to
   its group once, with its full set, and links are confirmed exactly; again a forest of all
   confirmed links leaves the task.
4. From a group of more than GROUP classes go those that can have no partner in it, by the number
   of their shingles that nobody else in it has. What is left is cut by a salt into parts. Some
   GROUP / 2 of its classes meet every part and so are done with; the rest meet their part only, and a set is copied twice on
   average. What is linked by then is one, and only classes that still share a key with others, pass
   the screen with them and are apart go on to the next turn, in groups of their own. After TURNS
   turns all pairs of blocks of what is left are compared, so no link is lost.
5. The components of the confirmed links are the result.

A text with fewer words than a shingle is one shingle; one without words (null, empty) has none and
is linked with nothing. Rows that share a doc_id are one document, which
links whatever any of them is linked with. A row without a doc_id takes part
in no link: its component is null, and it stays. An empty table gives an empty result. Only the id
and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import same, stage
from gridmill.llm.components import components
from gridmill.llm.exact import keep_rows
from gridmill.llm.segments import Memory

MISSED = 1e-5
DEEP = 2  # MinHash values in a short hash
GROUP = 512
BUCKET = 2048  # classes of one key that one task screens
SAMPLE = 16  # one class of so many is looked at for large buckets
TURNS = 12
BROADCAST_ROWS = 1_000_000
SEED = 5
ROWS_AT_ONCE = 4096
REMEMBERED = 150_000  # hashes of words


@dataclass(frozen=True)
class Match:
    """Shingles of ``words`` words; linked if 100 * common >= ``percent`` * united."""

    words: int = 5
    percent: int = 80

    @property
    def m(self) -> int:
        short = (self.percent / 100) ** DEEP
        return math.ceil(math.log(MISSED / 2) / math.log(1 - short))

    @property
    def least_agreeing(self) -> int:
        """MinHash values that agree in all but a millionth of the pairs at the threshold."""
        n, p = 2 * DEEP * self.m, self.percent / 100
        below = 0.0
        for k in range(n + 1):
            below += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if below > 1e-6:
                return k
        return n


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(draw: np.random.Generator, count: int) -> np.ndarray:
    return draw.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, words: int) -> None:
        self.words = words
        draw = np.random.default_rng(SEED)
        self.weights = _odd(draw, words + 1)
        hashes = lambda words: [xxhash.xxh3_64_intdigest(w) for w in words]
        self.memory = Memory(hashes, REMEMBERED)

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(self.memory.values_of(words), np.uint64, len(words))
        size = min(self.words, len(words))
        count = len(words) - size + 1
        total = np.full(count, self.weights[-1] * np.uint64(size))
        for i in range(size):
            total += hashes[i : i + count] * self.weights[i]
        return np.unique(_mixed(total))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column(batch.num_columns - 1).cast(pa.large_binary()):
        yield value.as_py() or b""


def signatures(docs: DataFrame, match: Match, key: str, text: str) -> DataFrame:
    """Per row: ``doc_id, n_shingles, set_id, shorts`` (2m short hashes) and ``agree``, one byte of
    each MinHash value."""
    m = match.m
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(match.words)
        draw = np.random.default_rng(SEED + 1)
        factors = _odd(draw, 2 * m * DEEP)
        terms = draw.integers(0, 2**63, 2 * m * DEEP, dtype=np.uint64)
        for batch in batches:
            sizes, ids, lows = [], [], []
            for value in _texts(batch):
                hashes = shingle(value)
                sizes.append(len(hashes))
                ids.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                low = np.full(len(factors), np.iinfo(np.uint64).max)
                for at in range(0, len(hashes), ROWS_AT_ONCE):
                    part = hashes[at : at + ROWS_AT_ONCE, None] * factors + terms
                    np.minimum(low, part.min(axis=0), out=low)
                lows.append(low)
            low = np.array(lows, np.uint64).reshape(len(lows), -1)
            spread = _mixed(low)
            pairs = low.reshape(len(low), 2 * m, DEEP) * factors[:DEEP]
            shorts = (_mixed(pairs.sum(axis=2, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
            flat = pa.array(shorts.view(np.int32).ravel())
            agree = (spread & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(low) + 1, dtype=np.int32) * 2 * m), flat
                    ),
                    pa.array([row.tobytes() for row in agree], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_id", "shorts", "agree"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        sign, f"doc_id {kind}, n_shingles long, set_id binary, shorts array<int>, agree binary"
    )


def _keys(classes: DataFrame, m: int) -> DataFrame:
    """``key, rep`` of every class and table."""
    first = classes.select(
        "rep",
        F.posexplode(F.slice("shorts", 1, m)).alias("i", "x"),
        F.slice("shorts", m + 1, m).alias("y"),
    )
    both = first.select("rep", "i", "x", F.posexplode("y").alias("j", "y"))
    return both.select(F.xxhash64("i", "j", "x", "y").alias("key"), "rep")


def large_buckets(classes: DataFrame, m: int) -> DataFrame:
    """``key, parts`` of the buckets of some BUCKET classes and more, judged by a sample."""
    some = classes.where(_deal("sample", F.lit(SAMPLE)) == 0)
    n = _keys(some, m).groupBy("key").agg((F.count(F.lit(1)) * SAMPLE).alias("n"))
    parts = F.ceil(F.col("n") / (BUCKET // 2)).cast("int")
    return n.where(F.col("n") > BUCKET).select("key", parts.alias("parts"))


def _rank(salt: str) -> Column:
    """A hash of 62 bits. The first of a bucket or part is the hub of its forest; as the same ranks
    hold in all of them, they share their hubs and with these most of their edges."""
    return F.xxhash64(F.lit(salt), F.col("rep")).bitwiseAND(F.lit((1 << 62) - 1))


def _first(salt: str, parts: Column) -> Column:
    """Whether a row is of the part with the lowest ranks, of so many parts."""
    return _rank(salt) < F.floor(F.lit(1 << 62) / parts)


def _deal(salt: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col("rep")), parts).cast("int")


def _dealt(own: Column, everywhere: Column) -> Column:
    """The parts a row goes to: all of ``parts``, or its own; -1 where nothing is cut."""
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    return F.explode(
        F.when(F.col("parts").isNull(), F.array(F.lit(-1)))
        .when(everywhere, every)
        .otherwise(F.array(own))
    )


def _small(frame: DataFrame) -> DataFrame:
    """The written table ``frame``, to be broadcast if it is small enough."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def bucket_members(classes: DataFrame, m: int, large: DataFrame | None = None) -> DataFrame:
    """``key, rep`` of every class and table in whose bucket there are others.

    A bucket of ``large`` is cut into parts, each a bucket with a key of its own.
    """
    keys = _keys(classes, m)
    if large is not None:
        parts = F.col("parts")
        keys = keys.join(large, "key", "left").select(
            "key", "rep", _dealt(_deal("part", parts), _first("all", parts)).alias("part")
        )
        part_key = F.when(F.col("part") < 0, F.col("key")).otherwise(F.xxhash64("key", "part"))
        keys = keys.select(part_key.alias("key"), "rep")
    count = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return keys.withColumn("n", count).where("n > 1").drop("n")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of sorted rows: the last group of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], 1)
        changes = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        if held and (marks[0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        if len(changes):
            held.append(batch.slice(0, changes[-1]))
            yield pa.Table.from_batches(held)
            held = [batch.slice(changes[-1])]
        else:
            held.append(batch)
        last = marks[-1]
    if held:
        yield pa.Table.from_batches(held)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    marks = np.stack([table.column(k).to_numpy() for k in keys], 1)
    return np.r_[0, np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, len(marks)]


def _forest(n: int, linked) -> list[tuple[int, int]]:
    """Stars that join what ``linked(i, others)`` joins; each member looks once at those not reached."""
    left = np.arange(n)
    edges = []
    while len(left) > 1:
        hub, left = int(left[0]), left[1:]
        queue = [hub]
        while queue and len(left):
            i = queue.pop()
            hit = linked(i, left)
            found = left[hit].tolist()
            edges += [(hub, j) for j in found]
            queue += found
            left = left[~hit]
    return edges


def _forest_apart(labels: np.ndarray, near) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that are ``near`` and differ in their labels.

    Those of the most common label are never compared with each other.
    """
    names, counts = np.unique(labels, return_counts=True)
    top = names[counts.argmax()]
    few, many = np.flatnonzero(labels != top), np.flatnonzero(labels == top)
    edges = []
    while len(few):
        queue, few = [int(few[0])], few[1:]
        while queue:
            i = queue.pop()
            hit = near(i, few) & (labels[few] != labels[i])
            found, few = few[hit].tolist(), few[~hit]
            if labels[i] != top:
                hit = near(i, many)
                found += many[hit].tolist()
                many = many[~hit]
            edges += [(i, j) for j in found]
            queue += found
    return edges


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _edge_batch(edges: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], schema=EDGES
    )


def screened(members: DataFrame, match: Match) -> DataFrame:
    """Edges ``u, v`` that connect, bucket by bucket, all pairs that pass the screen.

    If ``members`` have a ``label``, only pairs that differ in it are looked at.
    """
    least, percent = match.least_agreeing, match.percent
    labelled = "label" in members.columns

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ["key"]):
            table = table.combine_chunks()
            reps = table.column("rep").to_numpy()
            sizes = table.column("n_shingles").to_numpy()
            agree = np.frombuffer(
                b"".join(table.column("agree").to_pylist()), np.uint8
            ).reshape(len(reps), -1)

            def near(i, j, sizes=sizes, agree=agree):
                small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
                return (100 * small >= percent * large) & (
                    (agree[i] == agree[j]).sum(axis=-1) >= least
                )

            bounds = _bounds(table, ["key"])
            labels = table.column("label").to_numpy() if labelled else np.arange(len(reps))
            two = bounds[:-1][np.diff(bounds) == 2]
            two = two[labels[two] != labels[two + 1]]
            hit = two[near(two, two + 1)] if len(two) else two
            edges = [np.stack([reps[hit], reps[hit + 1]], 1)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 2:
                    here = lambda i, left, a=a: near(a + i, a + left)
                    found = _forest_apart(labels[a:b], here) if labelled else _forest(b - a, here)
                    if found:
                        edges.append(reps[a + np.array(found)])
            yield _edge_batch(edges)

    dealt = members.repartition("key").sortWithinPartitions("key", _rank("all"))
    return dealt.mapInArrow(screen, "u long, v long").distinct()


def candidate_groups(classes: DataFrame, match: Match) -> DataFrame:
    """``rep, group``: components of all pairs of classes that share a key and pass the screen."""
    facts = classes.select("rep", "n_shingles", "agree")
    large = stage(large_buckets(classes, match.m), "op6-large-buckets")
    if large.isEmpty():
        members = bucket_members(classes, match.m).join(facts, "rep")
        return _grouping(components(screened(members, match)))
    large = _small(large)
    members = bucket_members(classes, match.m, large).join(facts, "rep")
    groups = components(screened(members, match))
    # The parts of a bucket that nothing has joined yet meet as a whole.
    labels = _grouping(groups).withColumnRenamed("group", "label")
    members = stage(
        _keys(classes, match.m)
        .join(large, "key", "left_semi")
        .join(labels, "rep", "left")
        .withColumn("label", F.coalesce("label", "rep")),
        "op6-large-members",
    )
    apart = members.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    apart = _small(stage(apart.where("a <> b").select("key"), "op6-apart-buckets"))
    if apart.isEmpty():
        return labels.withColumnRenamed("label", "group")
    more = screened(members.join(apart, "key", "left_semi").join(facts, "rep"), match)
    return _grouping(components(_edges(groups).unionByName(more)))


def _grouping(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"node": "rep", "component": "group"})


def _edges(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"node": "u", "component": "v"})


def shingle_rows(docs: DataFrame, match: Match, extra: list[str]) -> DataFrame:
    """Per row of ``docs`` (the columns ``extra`` and last ``text``): ``extra`` and ``hashes``."""
    source = docs.select(*extra, "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(match.words)
        for batch in batches:
            rows = [shingle(t).tobytes() for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(rows, pa.large_binary()).cast(pa.binary())],
                [*extra, "hashes"],
            )

    fields = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in extra)
    return source.mapInArrow(make, f"{fields}, hashes binary")


def confirmed(rows: DataFrame, match: Match) -> DataFrame:
    """Edges ``u, v`` that connect all linked pairs of ``rows`` (group, rep, hashes).

    In a group of more than GROUP classes every two blocks meet in a task of their own.
    """
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > GROUP).select(
        "group", F.ceil(F.col("n") / (GROUP // 2)).cast("int").alias("blocks")
    )
    marked = rows.join(large, "group", "left")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(
        F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != own)
        )
    )
    dealt = marked.withColumn("other", other).select(
        "group",
        F.when(F.col("other") < 0, 0).otherwise(F.least(own, "other")).alias("low"),
        F.when(F.col("other") < 0, 0).otherwise(F.greatest(own, "other")).alias("high"),
        "rep",
        "hashes",
    )
    return compared(dealt, ["group", "low", "high"], match)


def compared(dealt: DataFrame, keys: list[str], match: Match, salt: str = "all") -> DataFrame:
    """Edges ``u, v`` that connect all linked pairs of ``dealt`` that agree in ``keys``."""
    percent = match.percent

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, keys):
            bounds = _bounds(table, keys)
            reps = table.column("rep").to_numpy()
            edges = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                sets = [
                    np.frombuffer(x, np.uint64)
                    for x in table.column("hashes").slice(a, b - a).to_pylist()
                ]
                counts = np.array([len(s) for s in sets])
                _, flat = np.unique(np.concatenate(sets), return_inverse=True)
                ends = np.cumsum(counts)
                mark = np.zeros(flat.max() + 1, bool)

                def linked(i, left, flat=flat, ends=ends, counts=counts, mark=mark):
                    mine = flat[ends[i] - counts[i] : ends[i]]
                    mark[mine] = True
                    common = np.add.reduceat(mark[flat], ends - counts, dtype=np.int64)[left]
                    mark[mine] = False
                    return 100 * common >= percent * (counts[i] + counts[left] - common)

                found = _forest(b - a, linked)
                if found:
                    edges.append(reps[a + np.array(found)])
            yield _edge_batch(edges)

    sorted_ = dealt.repartition(*keys).sortWithinPartitions(*keys, _rank(salt))
    return sorted_.mapInArrow(confirm, "u long, v long")


def _shingles(rows: DataFrame) -> DataFrame:
    """``group, rep, own, shingle`` of rows with ``hashes``; ``own`` tells sets of one id apart."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [x.as_py() for x in part.column(3)]
                counts = [len(x) // 8 for x in raw]
                columns = [
                    pa.array(np.repeat(part.column(k).to_numpy(zero_copy_only=False), counts))
                    for k in (0, 1, 2)
                ]
                shingle = pa.array(np.frombuffer(b"".join(raw), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*columns, shingle], ["group", "rep", "own", "shingle"]
                )

    return rows.select("group", "rep", "own", "hashes").mapInArrow(
        spread, "group long, rep long, own long, shingle long"
    )


def _coarse(size: Column) -> Column:
    """A size, rounded down to ten leading bits, so that a group has few different ones."""
    step = F.greatest(F.floor(F.log2(size)) - 9, F.lit(0))
    unit = F.pow(F.lit(2), step).cast("long")
    return size - size % unit


def with_partners(rows: DataFrame, match: Match) -> DataFrame:
    """The ``rows`` (group, rep, hashes) that may be linked with another of their group.

    Shingles that no other row of the group has are in no intersection, so the others bound the
    largest one, and this bounds the size of a partner. Rows for which the group has no other row
    of such a size are linked with nothing. All is counted; no pairs are looked at.
    """
    p = match.percent
    size = (F.octet_length("hashes") / 8).cast("long")
    sized = rows.withColumn("size", size).withColumn("own", F.xxhash64("hashes"))
    alone = (
        _shingles(sized)
        .groupBy("group", "shingle")
        .agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep"), F.min("own").alias("own"))
        .where("n = 1")
        .groupBy("group", "rep", "own")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    sizes = (
        sized.groupBy("group", _coarse(F.col("size")).alias("size"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("group")
        .agg(F.collect_list(F.struct("size", "n")).alias("sizes"))
    )
    most = F.floor((100 + p) * (F.col("size") - F.coalesce("alone", F.lit(0))) / p) - F.col("size")
    low = _coarse(F.floor(F.col("size") * p / 100).cast("long"))
    high = _coarse(F.greatest(most.cast("long"), F.lit(1)))
    partner = F.exists(
        "sizes",
        lambda s: s["size"].between(low, high)
        & ((s["size"] != _coarse(F.col("size"))) | (s["n"] > 1)),
    )
    return (
        sized.join(alone, ["group", "rep", "own"], "left")
        .join(sizes, "group")
        .where(partner)
        .select(*rows.columns)
    )


def peeled(sets: DataFrame, match: Match) -> DataFrame:
    """``sets`` (group, rep, hashes) without rows of large groups that are linked with nothing.

    Rows that go may have been all that shared a shingle with others, so it is done again until a
    round takes less than a sixteenth away; the work of all rounds is in proportion to the first.
    """
    count = F.count(F.lit(1))
    sizes = sets.groupBy("group").agg(count.alias("n"))
    large = stage(sizes.where(F.col("n") > GROUP).select("group"), "op6-peeled-groups")
    if large.isEmpty():
        return sets
    large = _small(large)
    held = stage(sets.join(large, "group", "left_semi"), "op6-peeled")
    before = held.count()
    while True:
        held = stage(with_partners(held, match), "op6-peeled")
        after = held.count()
        if 16 * (before - after) <= before:
            break
        before = after
    return stage(sets.join(large, "group", "left_anti").unionByName(held), "op6-sets")


def _large_groups(left: DataFrame) -> DataFrame:
    """Groups of more than GROUP classes: ``parts`` to cut them into, their most common label
    ``top``, and of how many classes with other labels one meets all parts."""
    labels = left.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    groups = labels.groupBy("group").agg(
        F.sum("n").alias("n"),
        F.max("n").alias("most"),
        F.max_by("label", F.struct("n", "label")).alias("top"),
    )
    half = GROUP // 2
    # Where one label holds most rows, copies are few, and more of the others can meet all parts.
    meeting = F.when(2 * F.col("most") > F.col("n"), GROUP).otherwise(half)
    return groups.where(F.col("n") > GROUP).select(
        "group",
        F.ceil(F.col("n") / half).cast("int").alias("parts"),
        "top",
        F.greatest(F.ceil((F.col("n") - F.col("most")) / meeting), F.lit(1)).cast("int").alias("deals"),
    )


def linked(sets: DataFrame, classes: DataFrame, match: Match) -> DataFrame:
    """``node, component`` of all linked pairs of the written table ``sets`` (group, rep, hashes)."""
    facts = classes.select("rep", "n_shingles", "agree")
    left = sets.withColumn("label", F.col("rep"))
    known = None
    for turn in range(TURNS + 1):
        large = stage(_large_groups(left), "op6-large-groups")
        last = turn == TURNS or large.isEmpty()
        if last:
            edges = confirmed(left.drop("label"), match)
        else:
            everywhere = (F.col("label") != F.col("top")) & (
                _first(f"all {turn}", F.col("deals"))
            )
            marked = left.join(_small(large), "group", "left")
            part = _dealt(_deal(f"part {turn}", F.col("parts")), everywhere)
            dealt = marked.select("group", part.alias("part"), "rep", "hashes")
            edges = compared(dealt, ["group", "part"], match, f"all {turn}")
        known = components(edges if known is None else _edges(known).unionByName(edges))
        if last:
            return known
        # Those that met all of their group are done with, and so is a group that is one by now.
        labels = _grouping(known).withColumnRenamed("group", "label")
        open_ = stage(
            marked.where(F.col("parts").isNotNull() & ~everywhere)
            .select("group", "rep")
            .distinct()
            .join(labels, "rep", "left")
            .withColumn("label", F.coalesce("label", "rep")),
            "op6-open",
        )
        apart = open_.groupBy("group").agg(F.min("label").alias("a"), F.max("label").alias("b"))
        apart = _small(stage(apart.where("a <> b").select("group"), "op6-apart"))
        if apart.isEmpty():
            return known
        open_ = open_.join(apart, "group", "left_semi").select("rep", "label")
        members = bucket_members(classes.join(open_, "rep", "left_semi"), match.m)
        again = stage(screened(members.join(facts, "rep").join(open_, "rep"), match), "op6-again")
        if again.isEmpty():
            return known
        groups = _grouping(components(again))
        left = stage(
            sets.drop("group").join(groups, "rep").join(open_, "rep")
            .select("group", "rep", "label", "hashes"),
            "op6-left",
        )


def near_duplicates(
    docs: DataFrame, match: Match = Match(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept`` and ``set_id``."""
    rows = stage(signatures(docs, match, key, text), "op6-signatures")
    linkable = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(
        linkable.groupBy("set_id", "n_shingles").agg(
            F.min("doc_id").cast("long").alias("rep"),
            F.first("shorts").alias("shorts"),
            F.first("agree").alias("agree"),
        ),
        "op6-classes",
    )
    groups = stage(candidate_groups(classes, match), "op6-groups")
    few = groups.count() <= BROADCAST_ROWS
    source = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
    of_groups = source.join(F.broadcast(groups) if few else groups, "rep")
    # A document whose rows differ brings each of its sets.
    sets = stage(
        shingle_rows(of_groups, match, ["group", "rep"])
        .where(F.octet_length("hashes") > 0)
        .distinct(),
        "op6-sets",
    )
    links = linked(peeled(sets, match), classes, match)
    # An id whose rows differ joins the classes of all its rows.
    several = stage(
        linkable.groupBy("doc_id")
        .agg(F.min("set_id").alias("a"), F.max("set_id").alias("b"))
        .where("a <> b")
        .select("doc_id"),
        "op6-several",
    )
    if not several.isEmpty():
        of_ids = (
            linkable.join(several, "doc_id", "left_semi")
            .join(classes.select("set_id", "rep"), "set_id")
            .select(F.col("doc_id").cast("long").alias("u"), F.col("rep").alias("v"))
        )
        links = components(_edges(links).unionByName(of_ids))
    links = links.withColumnRenamed("node", "rep")
    found = classes.select("set_id", "rep").join(links, "rep", "left").select(
        F.col("set_id").alias("right_id"), F.coalesce("component", "rep").alias("component")
    )
    joined = rows.select("doc_id", "n_shingles", "set_id").join(
        found,
        (F.col("set_id") == F.col("right_id"))
        & (F.col("n_shingles") > 0)
        & F.col("doc_id").isNotNull(),
        "left",
    )
    component = F.coalesce("component", F.col("doc_id").cast("long"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        same(F.col("doc_id").cast("long"), component).alias("kept"),
        "set_id",
    )


def unique_documents(docs: DataFrame, match: Match = Match()) -> DataFrame:
    """The rows of ``docs``, all their columns, that stay, each once."""
    kept = near_duplicates(docs, match).where("kept OR doc_id IS NULL")
    return keep_rows(docs, kept.select(F.col("doc_id").alias("kept_id")))

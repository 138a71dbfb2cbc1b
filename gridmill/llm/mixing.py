"""Mixing sources to target weights by a splitting tree over exact block quotas.

Each source's documents are dealt by hash into about as many blocks as a block has documents, the
square root of their number. A source's target says how many whole passes it makes and how many
words of a further pass; in every pass its blocks come in an order of their own. The number of
blocks each source gives is its quota, and a tree splits the quotas among the output shards: at each
node the left half's share is a multivariate hypergeometric draw. A shard then takes the next blocks
of each source's order, disjoint from all other shards', and shuffles its draws locally by hash.

Only the last block of the further pass is taken in part, document by document, and its last
document in part: by words in the plan, so that every source meets its target to a word.

Sources are ordered by code point, null last, and weigh WEIGHTS, repeating. A target stops at
MOST_PASSES times its source's words; the excess goes to the others by weight. Null and empty texts
have no words and are drawn as often as their block. Rows that repeat both doc_id and text count
each; the order among them doesn't matter. An empty table gives an empty result. The driver holds
one row per source, at most MOST_SOURCES, and one number per source and shard.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import same, stage, whole, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MOST_PASSES = 2
SHARDS = 16
MOST_SOURCES = 20_000
SEED = 17


def targets(sizes: list[int], weights=WEIGHTS, share: float = SHARE) -> list[float]:
    """Words wanted of each source, in the order of the sources."""
    weigh = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    open_ = list(range(len(sizes)))
    rest = share * sum(sizes)
    while open_:
        total = sum(weigh[i] for i in open_)
        for i in open_:
            out[i] = rest * weigh[i] / total
        above = [i for i in open_ if out[i] > MOST_PASSES * sizes[i]]
        if not above:
            break
        for i in above:
            out[i] = float(MOST_PASSES * sizes[i])
            rest -= out[i]
        open_ = [i for i in open_ if i not in set(above)]
    return out


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks per shard and source: rows sum to equal loads, columns to the quotas."""
    quotas_ = np.array(quotas, np.int64)
    total = int(quotas_.sum())
    loads = [total * (k + 1) // shards - total * k // shards for k in range(shards)]
    out = np.zeros((shards, len(quotas)), np.int64)

    def split(low: int, high: int, held: np.ndarray) -> None:
        if high - low == 1:
            out[low] = held
            return
        middle = (low + high) // 2
        draw = np.random.default_rng((seed, low, high))
        left = draw.multivariate_hypergeometric(held, sum(loads[low:middle]), method="marginals")
        split(low, middle, left)
        split(middle, high, held - left)

    if len(quotas):
        split(0, shards, quotas_)
    return out


def measured(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """``doc_id, source, size, deal`` per row: its words and the hash that deals it."""
    return docs.select(
        F.col(id_).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        deal_hash(id_, text).alias("deal"),
    )


def deal_hash(id_: str, text: str) -> Column:
    return F.xxhash64(F.lit(SEED), F.col(id_), whole(text))


@dataclass(frozen=True)
class Plan:
    """``sources``: one row per source; ``blocks``: one row per source and block.

    sources: ``sid, source, source_size, n_blocks, target, passes, cut`` (the block taken in part,
    or -1) and ``cut_words``. blocks: ``sid, block`` and ``draws``, an array with the ``epoch`` and
    ``shard`` of each time it is drawn.
    """

    sources: DataFrame
    blocks: DataFrame


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    facts = sources.withColumnRenamed("source", "right_source")
    joined = rows.join(
        F.broadcast(facts), same(F.col("source"), F.col("right_source"))
    ).drop("right_source")
    return joined.withColumn("block", F.pmod("deal", F.col("n_blocks")))


def make_plan(rows: DataFrame, shards: int = SHARDS) -> Plan:
    """The plan for ``rows`` (see ``measured``), which are read three times."""
    spark = rows.sparkSession
    totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    found = totals.limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"More than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["size"] for r in found])
    facts = []
    for sid, (row, target) in enumerate(zip(found, wanted, strict=True)):
        words = round(target)
        passes = min(words // row["size"], MOST_PASSES) if row["size"] else 0
        part = words - passes * row["size"]
        blocks = math.isqrt(max(row["n"] - 1, 0)) + 1
        facts.append((sid, row["source"], row["size"], blocks, target, passes, part))
    sources = spark.createDataFrame(
        facts,
        "sid int, source string, source_size long, n_blocks long, target double,"
        " passes int, part long",
    )
    dealt = _with_source(rows, sources)
    blocks = dealt.groupBy("sid", "block").agg(
        F.sum("size").alias("words"),
        F.first("passes").alias("passes"),
        F.first("part").alias("part"),
    )
    own = Window.partitionBy("sid")
    for epoch in range(MOST_PASSES):
        order = own.orderBy(F.xxhash64(F.lit(SEED + epoch), "sid", "block"), "block")
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        blocks = blocks.withColumns(
            {
                f"rank_{epoch}": F.row_number().over(order) - 1,
                f"before_{epoch}": F.coalesce(F.sum("words").over(earlier), F.lit(0)),
            }
        )
    epochs = range(MOST_PASSES)
    of_part = F.coalesce(
        *[F.when(F.col("passes") == e, F.col(f"before_{e}")) for e in epochs], F.col("part")
    )
    blocks = stage(
        blocks.withColumns(
            {
                "drawn": F.col("passes") + (of_part < F.col("part")).cast("int"),
                "taken": F.when(
                    (of_part < F.col("part")) & (of_part + F.col("words") > F.col("part")),
                    F.col("part") - of_part,
                ),
                "count": F.count(F.lit(1)).over(own),
            }
        ),
        "op3-blocks",
    )
    # One row per source: its quota of blocks, and the block that is taken in part.
    given = {
        r["sid"]: r
        for r in blocks.groupBy("sid")
        .agg(
            F.sum("drawn").alias("quota"),
            F.max(F.when(F.col("taken").isNotNull(), F.col("block"))).alias("cut"),
            F.max("taken").alias("cut_words"),
        )
        .collect()
    }
    quotas = [given[f[0]]["quota"] for f in facts]
    ends = np.cumsum(split_quotas(quotas, shards), axis=0)
    sources = spark.createDataFrame(
        [
            (*f[:6], -1 if (g := given[f[0]])["cut"] is None else g["cut"], g["cut_words"] or 0)
            for f in facts
        ],
        "sid int, source string, source_size long, n_blocks long, target double, passes int,"
        " cut long, cut_words long",
    )
    shares = spark.createDataFrame(
        [(f[0], ends[:, f[0]].tolist()) for f in facts], "sid int, ends array<long>"
    )

    def draw_of(epoch: int) -> Column:
        at = F.col("count") * epoch + F.col(f"rank_{epoch}")
        shard = F.size(F.filter("ends", lambda end: end <= at))
        made = F.struct(F.lit(epoch).alias("epoch"), shard.alias("shard"))
        return F.when(F.col("drawn") > epoch, made)

    drawn = [draw_of(e) for e in epochs]
    placed = blocks.join(F.broadcast(shares), "sid").select(
        "sid", "block", F.array_compact(F.array(*drawn)).alias("draws")
    )
    return Plan(sources, placed)


def draw(rows: DataFrame, plan: Plan) -> DataFrame:
    """Each of ``rows`` with ``source_size, target`` and ``draws``: per draw its ``epoch, shard,
    place`` (order in the shard) and ``words``.

    ``rows`` have ``source, size, deal`` and any other columns; only the blocks taken in part, one
    per source, are ordered.
    """
    names = rows.columns
    dealt = _with_source(rows, plan.sources)
    cut = F.col("block") == F.col("cut")
    order = Window.partitionBy("sid").orderBy("deal", "size")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    part = F.least(F.greatest(F.col("cut_words") - before, F.lit(0)), F.col("size"))
    every = dealt.where(~cut).withColumn("part", F.col("size")).unionByName(
        dealt.where(cut).withColumn("part", part)
    )
    draws = F.transform(
        "draws",
        lambda d: F.struct(
            d["epoch"].alias("epoch"),
            d["shard"].alias("shard"),
            F.xxhash64(F.lit(SEED), d["shard"], d["epoch"], F.col("deal")).alias("place"),
            F.when(d["epoch"] < F.col("passes"), F.col("size"))
            .otherwise(F.col("part"))
            .alias("words"),
        ),
    )
    return every.join(plan.blocks, ["sid", "block"]).select(
        *names, "source_size", "target", draws.alias("draws")
    )


def taken() -> Column:
    return F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])


def mixed_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs``, all their columns, as often as the mix draws them, by shard and place.

    A document drawn in part is there if at least half of its words are.
    """
    plan = make_plan(stage(measured(docs), "op3-rows"), shards)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("source"),
        word_count("text").alias("size"),
        deal_hash("doc_id", "text").alias("deal"),
    )
    drawn = draw(rows, plan).select("doc", "size", F.explode("draws").alias("draw"))
    kept = drawn.where((F.col("draw.words") * 2 >= F.col("size")))
    return kept.select("doc.*")

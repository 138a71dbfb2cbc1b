"""Word pairs and triples that belong together, counted by prefix-free parsing.

Documents are parsed at places that their content chooses: a chunk begins where the hash of two
words hits a trigger, and overlaps the next by those two words. Copies of a passage are parsed
alike, so the dictionary of different chunks with their frequencies stands for the corpus. Phrases
are counted inside the different chunks, weighted by frequency; a phrase belongs to the chunk where
it begins, so what lies in an overlap counts once.

The dictionary is written in blocks. A block first asks, by bucket of a hash, which of its phrases
can be frequent: it sends 32 bits and a weight up to the threshold for each different phrase. Sums
of these are upper bounds, so no frequent phrase is missed; only phrases that pass are counted as
texts, exactly. All sums are combined before a shuffle, and a phrase of any frequency is one row per
task. Scores join the counts of both parts of each cut.

Null and empty texts have no words; a null lang counts as ``und``. Repeated rows count as often as
they are there. Runs without a trigger are cut after ``MOST_WORDS`` words. Ties go to the smallest
cut and then by phrase. An empty table gives an empty result. Only two columns of the input are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import stage
from gridmill.llm.wordarrays import (
    GOLDEN,
    Words,
    by_bucket,
    cut,
    grouped,
    offsets,
    power_bits,
    short,
    slices,
    squeeze,
    stirred,
    unsqueeze,
)

LONGEST = 3  # words of a phrase
LEAST = 10
MOST = 2000
COVERED_PERCENT = 50

OVERLAP = LONGEST - 1
TRIGGER = 24  # a chunk begins at one place in so many, on average
MOST_WORDS = 256
SLICE_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
BUCKET_PHRASES = 4 << 20

CHUNKS = "lang string, own int, chunk string"
BLOCKS = "block long, langs array<string>, parts binary, body binary, words long"
ASKS = "bucket int, block long, keys binary, weights binary"
REPLIES = "block long, bucket int, bits binary"
COUNTS = "lang string, phrase string, n long"

BREAK, SPACE, END = 10, 32, 13
# Fixed: A-Z in lower case; what ends a piece; what parts the words of one.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?\n\x0b\x0c\r"]] = True
APART = BREAKS.copy()
APART[[9, 32]] = True


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Langs and texts of some MB."""
    langs, texts, held = [], [], 0
    for batch in batches:
        rows = zip(batch.column(0), batch.column(1).cast(pa.large_binary()), strict=True)
        for lang, text in rows:
            langs.append(lang.as_py())
            texts.append(text.as_py() or b"")
            held += len(texts[-1])
            if held >= SLICE_BYTES:
                yield langs, texts
                langs, texts, held = [], [], 0
    if langs:
        yield langs, texts


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks: their words, with a space or a line break (the end of a piece) between two, and how
    many of them are their own; the others are the overlap."""
    for langs, texts in _texts(batches):
        data = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        words = Words(data, APART[data])
        n = len(words)
        if not n:
            continue
        bounds = np.searchsorted(
            words.begins, offsets(np.array([len(t) + 1 for t in texts], np.int64))
        )
        before = offsets(BREAKS[data])
        ends = np.ones(n, bool)
        ends[:-1] = before[words.begins[1:]] > before[words.ends[:-1]]
        hashes = words.hashes()
        pair = hashes * GOLDEN
        pair[:-1] += hashes[1:]
        new = stirred(pair) % np.uint64(TRIGGER) == 0
        new[bounds[:-1][np.diff(bounds) > 0]] = True
        begin = np.flatnonzero(new)
        place = np.arange(n) - np.repeat(begin, np.diff([*begin, n]))
        begin = np.flatnonzero(new | (place % MOST_WORDS == 0))
        end = np.append(begin[1:], n)
        own, over = end - begin, end.copy()
        for _ in range(OVERLAP):
            over += ~ends[over - 1]
        plain, at = words.spaced(np.where(ends, BREAK, SPACE))
        doc = np.searchsorted(bounds, begin, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()).take(pa.array(doc)),
                pa.array(own, pa.int32()),
                cut(plain, at[begin], at[over] - at[begin] - 1, pa.string()),
            ],
            ["lang", "own", "chunk"],
        )


def _packing(most_bytes: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``lang, own, chunk, n`` packed by some MB."""
        number = TaskContext.get().partitionId() << 33
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= most_bytes:
                yield _packed(number, pa.Table.from_batches(held))
                number, held = number + 1, []
        if held:
            yield _packed(number, pa.Table.from_batches(held))

    return blocks


def _packed(number: int, table: pa.Table) -> pa.RecordBatch:
    lang = table["lang"].combine_chunks().dictionary_encode()
    parts = [lang.indices, table["own"], table["n"]]
    parts = np.stack([p.to_numpy().astype(np.int64) for p in parts])
    body = b"\r".join([*table["chunk"].cast(pa.large_binary()).to_pylist(), b""])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([lang.dictionary.to_pylist()], pa.list_(pa.string())),
            pa.array([squeeze(parts.tobytes())], pa.binary()),
            pa.array([squeeze(body)], pa.binary()),
            pa.array([int(parts[1].sum())]),
        ],
        ["block", "langs", "parts", "body", "words"],
    )


class Block:
    """Different chunks: at each own word the phrases of 1 to 3 words that begin there."""

    def __init__(self, row: dict) -> None:
        self.langs = row["langs"]
        parts = np.frombuffer(unsqueeze(row["parts"]), np.int64).reshape(3, -1)
        data = np.frombuffer(unsqueeze(row["body"]), np.uint8)
        self.words = Words(data, (data == SPACE) | (data == BREAK) | (data == END))
        bounds = np.searchsorted(self.words.begins, offsets(np.diff(np.flatnonzero(data == END),
                                                                     prepend=-1)))
        sizes = np.diff(bounds)
        chunk = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(self.words)) - np.repeat(bounds[:-1], sizes)
        self.own = place < parts[1][chunk]
        self.lang, self.weight = parts[0][chunk], parts[2][chunk]
        ends = data[self.words.ends] != SPACE
        # At which words a phrase of k words begins.
        self.begins = [self.own]
        for k in range(1, LONGEST):
            ok = self.begins[-1].copy()
            ok[len(ok) - k :] = False
            ok[: len(ok) - k] &= ~ends[k - 1 : len(ok) - 1]
            self.begins.append(ok)

    def hashes(self) -> np.ndarray:
        """Of all phrases: those of one word, then of two, then of three."""
        lang = np.frombuffer(
            b"".join(f"{x}\n".encode() for x in self.langs), np.uint8
        )
        lang = Words(lang, lang == BREAK).hashes()[self.lang] if len(lang) else lang
        word, out = self.words.hashes(), []
        for k, ok in enumerate(self.begins):
            at = np.flatnonzero(ok)
            h = lang[at] + np.uint64(k)
            for i in range(k + 1):
                h = h * GOLDEN + word[at + i]
            out.append(stirred(h))
        return np.concatenate(out)

    def asks(self, bits: int, least: int) -> Iterator[tuple[int, bytes, bytes]]:
        hashes = self.hashes()
        order, begins = grouped(hashes)
        if not len(order):
            return
        weight = np.concatenate([self.weight[ok] for ok in self.begins])[order]
        total = np.minimum(np.add.reduceat(weight, begins), least).astype(np.uint8)
        keys = hashes[order[begins]]
        for bucket, part in by_bucket(keys, bits):
            yield bucket, short(keys[part], bits).tobytes(), squeeze(total[part].tobytes())

    def frequent(self, bits: int, replies: dict[int, bytes]) -> list[np.ndarray]:
        """For each length, the words where a phrase begins that can be frequent."""
        hashes = self.hashes()
        order, begins = grouped(hashes)
        flags = np.zeros(len(begins), bool)
        for bucket, part in by_bucket(hashes[order[begins]], bits):
            got = np.frombuffer(replies[bucket], np.uint8)
            flags[part] = np.unpackbits(got, count=part.stop - part.start)
        hit = np.zeros(len(order), bool)
        hit[order] = np.repeat(flags, np.diff([*begins, len(order)]))
        at = offsets(np.array([ok.sum() for ok in self.begins]))
        return [
            np.flatnonzero(ok)[hit[b:e]]
            for ok, b, e in zip(self.begins, at[:-1], at[1:], strict=True)
        ]

    def counts(self, bits: int, replies: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        """Exact weights of the phrases that can be frequent, by text; and under the empty phrase
        the words of each lang."""
        names = pa.array(self.langs, pa.string())
        total = np.bincount(self.lang[self.own], self.weight[self.own], len(self.langs))
        yield _counted(names, pa.array([""] * len(self.langs)), total)
        code, many = self.words.codes()
        plain, at = self.words.spaced()
        key_of = code.astype(np.int64)
        for k, begin in enumerate(self.frequent(bits, replies)):
            if not len(begin):
                continue
            # A phrase's key: the place of its beginning among those of one word less, times the
            # number of words, plus its last word. The lang joins the first.
            if k == 0:
                key = self.lang[begin] * many + key_of[begin]
            else:
                key = shorter[begin] * many + code[begin + k]  # noqa: F821
            order, first = grouped(key)
            if k + 1 < LONGEST:
                shorter = np.full(len(self.words), -1)
                shorter[begin[order]] = np.repeat(
                    np.arange(len(first)), np.diff([*first, len(order)])
                )
            one = begin[order[first]]
            texts = cut(plain, at[one], at[one + k + 1] - at[one] - 1, pa.string())
            weight = np.add.reduceat(self.weight[begin][order], first)
            yield _counted(names.take(pa.array(self.lang[one])), texts, weight)


def _counted(lang: pa.Array, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [lang, phrase, pa.array(n.astype(np.int64))], ["lang", "phrase", "n"]
    )


def _asking(bits: int, least: int):
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                asks = Block(row).asks(bits, least)
                rows = [(bucket, row["block"], *rest) for bucket, *rest in asks]
                if rows:
                    names = ["bucket", "block", "keys", "weights"]
                    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    columns = zip(zip(*rows, strict=True), kinds, strict=True)
                    arrays = [pa.array(c, k) for c, k in columns]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return ask


def _answering(least: int):
    def answer(table: pa.Table) -> pa.Table:
        """One bit for each key a block sent: whether the weights of all blocks reach ``least``."""
        keys = [np.frombuffer(k, np.uint32) for k in table["keys"].to_pylist()]
        sizes = [len(k) for k in keys]
        weights = [np.frombuffer(unsqueeze(w), np.uint8) for w in table["weights"].to_pylist()]
        order, begins = grouped(np.concatenate(keys))
        total = np.add.reduceat(np.concatenate(weights)[order].astype(np.int64), begins)
        hit = np.zeros(len(order), bool)
        hit[order] = np.repeat(total >= least, np.diff([*begins, len(order)]))
        bits = [np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(sizes)[:-1])]
        names = ["block", "bucket", "bits"]
        return pa.Table.from_arrays([table["block"], table["bucket"], pa.array(bits)], names)

    return answer


def _counting(bits: int):
    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = dict(zip(right["bucket"].to_pylist(), right["bits"].to_pylist(), strict=True))
        out = [b for row in left.to_pylist() for b in Block(row).counts(bits, replies)]
        return pa.Table.from_batches(out)

    return count


def frequent_phrases(
    docs: DataFrame,
    least: int = LEAST,
    block_bytes: int = BLOCK_BYTES,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """Rows ``lang, phrase, n``: all phrases of 1 to 3 words that occur ``least`` times or more, by
    lang, and under the empty phrase how many words the lang has. Written once."""
    source = docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text")
    )
    chunks = source.mapInArrow(_parsed, CHUNKS).groupBy("lang", "own", "chunk")
    dictionary = chunks.agg(F.count(F.lit(1)).alias("n"))
    blocks = stage(dictionary.mapInArrow(_packing(block_bytes), BLOCKS), "op12-blocks")
    words = blocks.agg(F.sum("words")).first()[0] or 0
    bits = power_bits(LONGEST * words / BUCKET_PHRASES, 5)
    asked = blocks.mapInArrow(_asking(bits, least), ASKS).groupBy("bucket")
    replies = asked.applyInArrow(_answering(least), REPLIES)
    counted = (
        blocks.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(_counting(bits), COUNTS)
    )
    total = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return stage(total.where((F.col("n") >= least) | (F.col("phrase") == "")), "op12-phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two or three words with their lowest-scoring cut: ``lang, phrase, a, k, l, r,
    score``. Both parts of a cut are at least as frequent as the phrase, so they are there."""
    word = F.split("phrase", " ")
    wide = phrases.where(F.contains("phrase", F.lit(" "))).withColumn("w", word)
    part = lambda begin, size: F.array_join(F.slice("w", begin, size), " ")
    cuts = wide.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        "k",
        part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"),
    )
    l_of = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    r_of = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(l_of, ["lang", "left"]).join(r_of, ["lang", "right"])
    # Whole-number division; products have up to 38 digits.
    score = F.expr(
        "(cast(1000000 as decimal(7,0)) * cast(cast(a as decimal(19,0)) * cast(a as decimal(19,0))"
        " as decimal(31,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    cut_ = F.struct(score.alias("score"), "k", "l", "r")
    lowest = both.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(cut_).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.k", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    most: int = MOST,
    covered_percent: int = COVERED_PERCENT,
    block_bytes: int = BLOCK_BYTES,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """Per lang the ``most`` best phrases: ``lang, rank, phrase, a, l, r, n, score, k``.

    A phrase is left out if a longer one around it has ``covered_percent`` of its occurrences.
    """
    phrases = frequent_phrases(docs, least, block_bytes, lang, text)
    found = stage(scored(phrases), "op12-scores")
    word = F.split("phrase", " ")
    inner = F.array(
        F.array_join(F.slice(word, 1, LONGEST - 1), " "),
        F.array_join(F.slice(word, 2, LONGEST - 1), " "),
    )
    longer = found.where(F.size(word) == LONGEST).select(
        "lang", F.explode(inner).alias("phrase"), "a"
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = found.join(longer, ["lang", "phrase"], "left").where(
        "longest IS NULL OR "
        f"cast(100 as decimal(3,0)) * longest < cast({covered_percent} as decimal(3,0)) * a"
    )
    # Two levels: however many tasks hold a lang, its last list is made of at most 256 lists.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    kept = kept.withColumn("place", F.row_number().over(part)).where(F.col("place") <= most)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = kept.withColumn("rank", rank.cast("long"))
    totals = phrases.where("phrase = ''").select("lang", "n")
    return (
        best.where(F.col("rank") <= most)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k")
    )

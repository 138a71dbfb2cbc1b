"""Passages that repeat across documents, by a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window that covers it
also begins in a document with a smaller id. Documents are searched where their matches can be:

1. Texts are packed into blocks of some MB, written once. Every window has an anchor, the smallest
   hash of its five-word runs, so equal windows have one anchor. Each block asks for its anchors,
   by bucket of the hash, whether another block or another of its documents has them too.
2. Runs of windows with a repeated anchor become segments. A block sends each segment once, with
   the smallest document that has it, to the shard of its anchor.
3. A shard builds one FM-index over its different segments. The windows of all segments are read
   backward through the wavelet matrix; a window whose match statistic reaches its length at two
   places or more gets the smallest document among the rows of its range. What returns to the block
   is one bit a window.
4. Blocks put windows, words and texts together.

Hashes only choose candidates; what counts as equal is decided on the words themselves. A passage of
a third of all documents is sent once per block, and its copies inside a block are settled there.

Null and empty texts have no words. A null id is smaller than any other. Rows that share an id are
parts of one document: they never take words from each other, and each has its own result, repeated
rows too. Very long texts make a block of their own, very long repetitions several segments. An
empty table gives an empty result. Only two columns of the input are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import stage
from gridmill.llm.fmindex import FMIndex
from gridmill.llm.wordarrays import (
    GOLDEN,
    SPACE,
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

WINDOW = 13
ANCHOR = 5  # words
BLOCK_BYTES = 4 << 20
SEGMENT_WINDOWS = 64
BUCKET_BYTES = 8 << 20  # of text, per bucket of anchors and per shard
NO_ID = np.iinfo(np.int64).min

BLOCKS = "block long, ids array<long>, sizes array<long>, body binary"
ASKS = "bucket int, block long, keys binary, several binary"
REPLIES = "block long, bucket int, bits binary"
SEGMENTS = "shard int, block long, body binary, least binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, first_removed long"


def _packing(most_bytes: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of one task in blocks; a line break after each keeps the words of two apart."""
        number = TaskContext.get().partitionId() << 33
        ids, texts, held = [], [], 0
        for batch in batches:
            texts_of = batch.column(1).cast(pa.large_binary())
            for id_, text in zip(batch.column(0), texts_of, strict=True):
                ids.append(id_.as_py())
                texts.append(text.as_py() or b"")
                held += len(texts[-1]) + 1
                if held >= most_bytes:
                    yield _packed(number, ids, texts)
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield _packed(number, ids, texts)

    return blocks


def _packed(number: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
    numbers = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.array([ids], numbers),
            pa.array([[len(t) + 1 for t in texts]], numbers),
            pa.array([squeeze(b"\n".join([*texts, b""]))], pa.binary()),
        ],
        ["block", "ids", "sizes", "body"],
    )


class Block:
    """The words of a block and its runs of windows that share an anchor."""

    def __init__(self, ids: list, sizes: list, body: bytes, window: int) -> None:
        self.ids = ids
        self.order = np.array([NO_ID if i is None else i for i in ids], np.int64)
        data = np.frombuffer(unsqueeze(body), np.uint8)
        self.words = Words(data, SPACE[data])
        self.bounds = np.searchsorted(self.words.begins, offsets(np.array(sizes, np.int64)))
        self.doc = np.repeat(np.arange(len(ids)), np.diff(self.bounds))
        self.window = window
        self._runs()

    def _runs(self) -> None:
        """``first`` word, number of ``windows``, ``anchor`` and ``owner`` of each run."""
        n = len(self.words) - self.window + 1
        self.first = self.windows = self.owner = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        if n <= 0:
            return
        hashes, span = self.words.hashes(), min(ANCHOR, self.window)
        gram = np.zeros(len(hashes) - span + 1, np.uint64)
        for k in range(span):
            gram = gram * GOLDEN + hashes[k : k + len(gram)]
        gram = stirred(gram)
        least, wide, width = gram, 1, self.window - span + 1
        while wide < width:
            step = min(wide, width - wide)
            least = np.minimum(least[:-step], least[step:])
            wide += step
        doc = self.doc[:n]
        at = np.flatnonzero(doc == self.doc[self.window - 1 :])
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]]) | (np.diff(doc[at]) > 0)
        begin = np.flatnonzero(new)
        place = np.arange(len(at)) - np.repeat(begin, np.diff([*begin, len(at)]))
        begin = np.flatnonzero(new | (place % SEGMENT_WINDOWS == 0))
        self.first, self.windows = at[begin], np.diff([*begin, len(at)])
        self.anchor, self.owner = least[self.first], doc[self.first]

    def asks(self, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
        """Per bucket: the block's different anchors, and whether several documents have each."""
        order, begins = grouped(self.anchor)
        if not len(order):
            return
        doc = self.order[self.owner[order]]
        several = np.minimum.reduceat(doc, begins) < np.maximum.reduceat(doc, begins)
        anchors = self.anchor[order[begins]]
        for bucket, part in by_bucket(anchors, bits):
            yield (
                bucket,
                short(anchors[part], bits).tobytes(),
                np.packbits(several[part]).tobytes(),
            )

    def segments(self, bits: int, replies: dict[int, bytes]) -> None:
        """Choose the runs whose anchor repeats: ``chosen``, with the number ``code`` of a run's
        text among the different ``texts``, which ``least`` document has it, and its shard."""
        order, begins = grouped(self.anchor)
        flags = np.zeros(len(begins), bool)
        for bucket, part in by_bucket(self.anchor[order[begins]], bits):
            if bucket in replies:
                got = np.frombuffer(replies[bucket], np.uint8)
                flags[part] = np.unpackbits(got, count=part.stop - part.start)
        chosen = np.zeros(len(order), bool)
        chosen[order] = np.repeat(flags, np.diff([*begins, len(order)]))
        self.chosen = np.flatnonzero(chosen)
        plain, at = self.words.spaced()
        first = self.first[self.chosen]
        last = first + self.windows[self.chosen] + self.window - 1
        found = cut(plain, at[first], at[last] - at[first] - 1).dictionary_encode()
        self.code, self.texts = found.indices.to_numpy(), found.dictionary
        own = self.order[self.owner[self.chosen]]
        self.least = np.full(len(self.texts), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.code, own)
        self.shard = np.zeros(len(self.texts), np.int64)
        anchor = stirred(self.anchor[self.chosen] + GOLDEN)
        self.shard[self.code] = (anchor >> np.uint64(64 - bits)).astype(np.int64)

    def shards(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each shard with its segments, in an order that the block can repeat."""
        order, begins = grouped(self.shard)
        for part in np.split(order, begins[1:]) if len(order) else []:
            yield int(self.shard[part[0]]), part

    def removed(self, replies: dict[int, bytes]) -> np.ndarray:
        """Whether each word goes. A segment that a smaller document of the block has goes whole;
        otherwise the shard's bits tell which of its windows a smaller document has."""
        sizes = np.zeros(len(self.texts), np.int64)
        sizes[self.code] = self.windows[self.chosen]
        at, bits = offsets(sizes), np.zeros(int(sizes.sum()), bool)
        for shard, part in self.shards():
            got = np.frombuffer(replies[shard], np.uint8)
            places = slices(at[part], sizes[part])
            bits[places] = np.unpackbits(got, count=len(places))
        own = self.order[self.owner[self.chosen]]
        size = self.windows[self.chosen]
        hit = bits[slices(at[self.code], size)] | np.repeat(own > self.least[self.code], size)
        start = slices(self.first[self.chosen], size)[hit]
        change = np.zeros(len(self.words) + 1, np.int64)
        change[:-1] += np.bincount(start, minlength=len(self.words))
        np.subtract.at(change, start + self.window, 1)
        return np.cumsum(change)[:-1] > 0

    def results(self, replies: dict[int, bytes]) -> pa.RecordBatch:
        gone = self.removed(replies)
        plain, at = self.words.spaced()
        stay = ~gone
        kept = plain[slices(at[:-1][stay], np.diff(at)[stay])].tobytes()
        place = offsets(np.diff(at) * stay)[self.bounds]
        # Each kept word is followed by one space; the last one's is left out.
        digests = [
            hashlib.sha256(kept[b : max(b, e - 1)]).hexdigest()
            for b, e in zip(place[:-1], place[1:], strict=True)
        ]
        total = offsets(gone)
        n_removed = total[self.bounds[1:]] - total[self.bounds[:-1]]
        where = np.append(np.flatnonzero(gone), 0)
        first = where[np.searchsorted(where[:-1], self.bounds[:-1])] - self.bounds[:-1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids, pa.int64()),
                pa.array(np.diff(self.bounds)),
                pa.array(n_removed),
                pa.array(digests, pa.string()),
                pa.array(first, mask=n_removed == 0),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "first_removed"],
        )


def _held(table: pa.Table, window: int) -> Iterator[tuple[int, Block]]:
    for r in table.select(["block", "ids", "sizes", "body"]).to_pylist():
        yield r["block"], Block(r["ids"], r["sizes"], r["body"], window)


def _asking(bits: int, window: int):
    def ask(batches):
        for batch in batches:
            for number, block in _held(pa.Table.from_batches([batch]), window):
                rows = [(k, number, a, s) for k, a, s in block.asks(bits)]
                if rows:
                    names = ["bucket", "block", "keys", "several"]
                    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    columns = [
                        pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return ask


def _repeated(table: pa.Table) -> pa.Table:
    """Which keys of a bucket several blocks, or several documents of one, have."""
    keys = [np.frombuffer(k, np.uint32) for k in table["keys"].to_pylist()]
    sizes = np.array([len(k) for k in keys])
    several = [
        np.unpackbits(np.frombuffer(s, np.uint8), count=n).astype(bool)
        for s, n in zip(table["several"].to_pylist(), sizes, strict=True)
    ]
    order, begins = grouped(np.concatenate(keys))
    count = np.diff([*begins, len(order)])
    hit = np.zeros(len(order), bool)
    hit[order] = np.repeat(count > 1, count)
    hit |= np.concatenate(several)
    bits = [np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table["block"], "bucket": table["bucket"], "bits": pa.array(bits)})


def _cutting(bits: int, window: int):
    def segments(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = dict(zip(right["bucket"].to_pylist(), right["bits"].to_pylist(), strict=True))
        rows = []
        for number, block in _held(left, window):
            block.segments(bits, replies)
            for shard, part in block.shards():
                body = b"\n".join(block.texts.take(pa.array(part)).to_pylist())
                rows.append((shard, number, squeeze(body), block.least[part].tobytes()))
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, ["shard", "block", "body", "least"])

    return segments


def _searching(window: int):
    def search(table: pa.Table) -> pa.Table:
        """Per block: one bit for each window of its segments, set if a smaller document has it."""
        least = [np.frombuffer(x, np.int64) for x in table["least"].to_pylist()]
        texts = [t for body in table["body"].to_pylist() for t in unsqueeze(body).split(b"\n")]
        found = pa.array(texts, pa.large_binary()).dictionary_encode()
        del texts
        code, sent = found.indices.to_numpy(), np.concatenate(least)
        smallest = np.full(len(found.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(smallest, code, sent)
        data = np.frombuffer(b"\n".join([*found.dictionary.to_pylist(), b""]), np.uint8)
        words = Words(data, SPACE[data])
        bounds = np.searchsorted(words.begins, np.flatnonzero(data == 10) + 1)
        bounds = np.concatenate([[0], bounds])
        # The text of the index: codes from 1, and 0 after each segment.
        segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        text = np.zeros(len(words) + len(bounds) - 1, np.int64)
        text[np.arange(len(words)) + segment] = words.codes()[0] + 1
        windows = np.diff(bounds) - window + 1
        begins = slices(bounds[:-1] + np.arange(len(windows)), windows)
        own = np.repeat(np.arange(len(windows)), windows)
        first = smallest[own]
        if len(begins):
            index = FMIndex(text)
            ends = np.flatnonzero(text == 0)
            doc = smallest[np.searchsorted(ends, index.order)]
            hit, low, high = index.matches(text, begins, window)
            if len(hit):
                low, which = np.unique(low, return_inverse=True)
                top = np.zeros(len(low), np.int64)
                top[which] = high
                # Ranges of different windows are apart, so each row is looked at once.
                pairs = np.stack([low, top], 1).ravel()
                doc = np.append(doc, np.iinfo(np.int64).max)
                first[hit] = np.minimum.reduceat(doc, pairs)[::2][which]
        at = offsets(windows)
        bits, begin = [], 0
        for part in least:
            use = code[begin : begin + len(part)]
            smaller = first[slices(at[use], windows[use])] < np.repeat(part, windows[use])
            bits.append(np.packbits(smaller).tobytes())
            begin += len(part)
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["shard"],
                "bits": pa.array(bits, pa.binary()),
            }
        )

    return search


def _joining(bits: int, window: int):
    def results(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = np.array(right["kind"].to_pylist(), np.int64)
        buckets, answers = right["bucket"].to_pylist(), right["bits"].to_pylist()
        replies = [{buckets[i]: answers[i] for i in np.flatnonzero(kind == k)} for k in (0, 1)]
        out = []
        for _, block in _held(left, window):
            block.segments(bits, replies[0])
            out.append(block.results(replies[1]))
        return pa.Table.from_batches(out)

    return results


def repeated_passages(
    docs: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    id_: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256`` of the words that stay, joined by one
    space, and ``first_removed``, the place of the first word that goes (null: none)."""
    source = docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = stage(source.mapInArrow(_packing(block_bytes), BLOCKS), "op11-blocks")
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    total = blocks.agg(F.sum(size)).first()[0] or 0
    bits = power_bits(total / BUCKET_BYTES, 5)
    asked = blocks.mapInArrow(_asking(bits, window), ASKS)
    repeated = stage(asked.groupBy("bucket").applyInArrow(_repeated, REPLIES), "op11-anchors")
    by_block = blocks.groupBy("block")
    segments = by_block.cogroup(repeated.groupBy("block")).applyInArrow(
        _cutting(bits, window), SEGMENTS
    )
    found = segments.groupBy("shard").applyInArrow(_searching(window), REPLIES)
    replies = repeated.withColumn("kind", F.lit(0)).unionByName(
        stage(found, "op11-windows").withColumn("kind", F.lit(1))
    )
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(_joining(bits, window), RESULT)

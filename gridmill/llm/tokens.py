"""Token ids written as shuffled planes, and read back.

Documents are put in ascending doc_id order (nulls first, then by the text's hash) by one range
shuffle. A task encodes its documents in that order and cuts the ids into blocks of BLOCK_IDS.
A block's ids are little-endian unsigned 32-bit integers, transposed into four byte planes (byte 0
of all ids, then byte 1, ...) or 32 bit planes, and each plane is compressed with zstandard by
itself: the high planes of token ids are nearly empty and shrink to a few bytes.

The file format, in one folder:

* ``chunks``: one row per chunk, a run of whole documents with at least CHUNK_IDS ids unless it ends
  a shard: ``shard, chunk, first`` (ids of the shard before it), ``n_ids, doc_ids, lengths`` and
  ``blocks``, per block ``n`` and ``planes``. A shard is what one task wrote.
* ``index``: one row per chunk: ``shard, chunk, start`` (ids of all documents before it), ``n_ids,
  n_docs, n_bytes`` and the first and last ``doc_id``, so that a reader finds any range of ids or
  documents without touching the blocks.

Spark writes the rows, so tasks may be lost and repeated, and any store will do. A null text counts
as empty and has the end id alone; repeated rows are documents of their own; an empty table gives
empty files. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmill.llm.common import whole
from gridmill.llm.segments import Joined

END_ID = 2
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 18
LEVEL = 1

# Places where the byte-level splitting rule always cuts: before a single space, around other
# spaces, and between a word of Latin letters and punctuation, unless an apostrophe is near.
_SPACES = r" \t\n\r\v\f"
_LATIN = r"A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = r"!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~"
_PIECES = re.compile(
    rf" ?[{_LATIN}]+(?=[{_SIGNS}{_SPACES}]|\Z)| ?[{_SIGNS}]+(?=[{_SPACES}]|\Z)"
    rf"| ?[^{_SPACES}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
_WORD = re.compile(rf" ?[{_LATIN}]+").fullmatch
_ID = attrgetter("id")
_BYTE_LEVEL = {
    "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
}


def _byte_signs() -> dict[int, str]:
    """For code points below 256, the signs that byte-level models write their UTF-8 bytes with."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    signs = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(signs[b] for b in chr(c).encode()) for c in range(256)}


_BYTES = _byte_signs()

# Spaces beyond ASCII and added tokens are rare: such texts are encoded as they are.
_UNUSUAL = re.compile(
    r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
)

BLOCKS = "array<struct<n int, planes array<binary>>>"
CHUNK_FIELDS = f"chunk int, first long, n_ids long, lengths array<long>, blocks {BLOCKS}"


class Encoder:
    """Ids of whole texts as the tokenizers library gives them, as little-endian 32-bit bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        splitter = self.tokenizer.pre_tokenizer
        rules = json.loads(splitter.__getstate__()) if splitter else None
        # Nothing but the splitting rule and the bytes' signs comes before the model.
        self.plain = self.tokenizer.normalizer is None and rules == _BYTE_LEVEL
        self.memory = Joined(self.encode_piece)

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one piece. The splitting rule leaves a word of Latin letters whole, so the model
        can be asked for it at once."""
        if self.plain and _WORD(piece):
            return array("I", map(_ID, self.model.tokenize(piece.translate(_BYTES)))).tobytes()
        return self.encode([piece])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def ids(self, text: str) -> bytes:
        if _UNUSUAL.search(text) or any(token in text for token in self.added):
            return self.encode([text])[0]
        return self.memory.bytes_of(_PIECES.findall(text))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def to_planes(ids: bytes, bits: bool = False) -> list[bytes]:
    """The compressed planes of a block of 32-bit ids."""
    raw = np.frombuffer(ids, np.uint8).reshape(-1, 4)
    if bits:
        spread = np.unpackbits(raw, axis=1, bitorder="little")
        planes = np.packbits(spread.T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(raw.T)
    pack = zstandard.ZstdCompressor(level=LEVEL)
    return [pack.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> bytes:
    """The ids of a block of n ids, from its byte or bit planes."""
    unpack = zstandard.ZstdDecompressor()
    held = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]
    if len(held) == 32:
        spread = np.unpackbits(np.stack(held), axis=1, count=n, bitorder="little")
        raw = np.packbits(spread.T, axis=1, bitorder="little")
    else:
        raw = np.stack(held, 1)
    return raw.tobytes()


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    bits: bool = False,
) -> None:
    """Encode ``docs`` with the tokenizer file and write ``chunks`` and ``index`` to ``folder``."""
    source = docs.select(F.col(key).alias("doc_id"), whole(text).alias("text"))
    dealt = source.withColumn("order", F.xxhash64("text"))
    dealt = dealt.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order")
    kind = source.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()
    block_type = pa.list_(
        pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))])
    )

    def row(number: int, first: int, doc_ids: list, parts: list[bytes], kind_: pa.DataType):
        held = b"".join(parts)
        blocks = []
        for at in range(0, len(held), 4 * BLOCK_IDS):
            part = held[at : at + 4 * BLOCK_IDS]
            blocks.append({"n": len(part) // 4, "planes": to_planes(part, bits)})
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([len(held) // 4], pa.int64()),
                pa.array([[len(p) // 4 for p in parts]], pa.list_(pa.int64())),
                pa.array([blocks], block_type),
                pa.array([doc_ids], pa.list_(kind_)),
            ],
            ["chunk", "first", "n_ids", "lengths", "blocks", "doc_ids"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        number = first = held = 0
        doc_ids: list = []
        parts: list[bytes] = []
        kind_ = None
        for batch in batches:
            kind_ = batch.column(0).type
            keys = batch.column(0).to_pylist()
            for key_, value in zip(keys, batch.column(1), strict=True):
                ids = encode.ids(value.as_py()) + end
                doc_ids.append(key_)
                parts.append(ids)
                held += len(ids) // 4
                if held >= CHUNK_IDS:
                    yield row(number, first, doc_ids, parts, kind_)
                    number, first, held, doc_ids, parts = number + 1, first + held, 0, [], []
        if parts:
            yield row(number, first, doc_ids, parts, kind_)

    chunks = dealt.select("doc_id", "text").mapInArrow(
        pack, f"{CHUNK_FIELDS}, doc_ids array<{kind}>"
    )
    chunks.withColumn("shard", F.spark_partition_id()).write.option(
        "compression", "uncompressed"
    ).parquet(f"{folder}/chunks")
    spark = docs.sparkSession
    stored = spark.read.parquet(f"{folder}/chunks")
    planes = F.flatten(F.transform("blocks", lambda b: b["planes"]))
    sizes = F.aggregate(
        planes, F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p).cast("long")
    )
    starts = shard_starts(stored)
    index = stored.join(starts, "shard").select(
        "shard",
        "chunk",
        (F.col("base") + F.col("first")).alias("start"),
        "n_ids",
        F.size("doc_ids").alias("n_docs"),
        sizes.alias("n_bytes"),
        F.element_at("doc_ids", 1).alias("first_doc"),
        F.element_at("doc_ids", -1).alias("last_doc"),
    )
    index.write.parquet(f"{folder}/index")


def shard_starts(chunks: DataFrame) -> DataFrame:
    """``shard, base``: the ids of all shards before it. One row per task that wrote."""
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids``.

    The blocks are decoded where they lie; only the documents' places are joined with the index.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                blocks = batch.column("blocks")[i].as_py()
                held = b"".join(from_planes(b["planes"], b["n"]) for b in blocks)
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                places = zip((4 * (ends - lengths)).tolist(), (4 * ends).tolist(), strict=True)
                own = [held[a:b] for a, b in places]
                columns = [
                    batch.column("doc_ids")[i].values,
                    pa.array([batch.column("shard")[i].as_py()] * len(own), pa.int32()),
                    pa.array(ends - lengths + batch.column("first")[i].as_py()),
                    pa.array(lengths),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                names = ["doc_id", "shard", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in own]
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    chunks = spark.read.parquet(f"{folder}/chunks")
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    fields = f"doc_id {kind}, shard int, place long, n_tokens long, ids_crc32 long"
    fields += ", ids array<long>" if with_ids else ""
    rows = chunks.select("shard", "first", "doc_ids", "lengths", "blocks").mapInArrow(
        decode, fields
    )
    bases = spark.read.parquet(f"{folder}/index").where("chunk = 0").select(
        "shard", F.col("start").alias("base")
    )
    return rows.join(bases, "shard").select(
        "doc_id",
        (F.col("base") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *["ids"] * with_ids,
    )

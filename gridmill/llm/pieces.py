"""Encoding with a piece model so that every piece keeps its place in the original text.

A text is normalised by the model's compiled character map (see ``charmap``), which records the
source of every byte. The normalised text is cut before each run of space signs, where no piece of
the model can cross; the library merges each cut part, and parts seen before are remembered. As the
pieces of a text, laid end to end, are the normalised text, their lengths give each piece's place in
it, and the record of sources the bytes of the original.

Null and empty texts have the end id alone and decode to the empty text. Repeated rows are encoded
like any others; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.charmap import Normaliser
from gridmill.llm.segments import Memory

_PARTS = re.compile("▁+[^▁]*|[^▁]+")


class Encoder:
    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            raw = file.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(raw)
        spec = model.normalizer_spec
        self.normalise = Normaliser(
            spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces
        )
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=raw)
        # The same pieces for texts that are normalised already.
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end = self.decoder.eos_id()
        ids = range(self.decoder.get_piece_size())
        names = [self.decoder.id_to_piece(i) for i in ids]
        self.sizes = np.array([len(n.encode()) for n in names])
        self.sizes[[i for i in ids if self.decoder.is_byte(i)]] = 1
        crossing = any("▁" in n.lstrip("▁") for n in names)
        self.parted = not crossing and any(self.decoder.is_byte(i) for i in ids)
        self.memory = Memory(self.merge, REMEMBERED)

    def merge(self, parts: list[str]) -> list[bytes]:
        return [array("i", x).tobytes() for x in self.merger.encode(parts, num_threads=1)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids, without the end id, and the byte span of each in the original text."""
        aligned = self.normalise(text.encode())
        normal = aligned.text.decode()
        if self.parted:
            parts = _PARTS.findall(normal)
            ids = np.frombuffer(b"".join(self.memory.values_of(parts)), "<i4")
        else:
            ids = np.frombuffer(self.merge([normal])[0], "<i4")
        cuts = np.cumsum(self.sizes[ids])
        if len(cuts) and cuts[-1] != len(aligned.text):
            raise ValueError("The pieces do not make up the normalised text")
        begin, end = aligned.spans(cuts)
        return ids, begin, end


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32, copy=False)))


BATCH_CHARS = 1 << 19  # texts whose pieces are held at once
REMEMBERED = 150_000


def encode_pieces(docs: DataFrame, model: str, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """Per row: the columns of ``keep``, ``ids`` (with the end id), ``begins`` and ``ends`` (bytes
    of the original text; the end id stands after the last) and ``decoded``."""
    source = docs.select(*[F.col(c) for c in keep], F.col(text).alias("text"))
    kept = source.drop("text") if "text" not in keep else docs.select(*keep)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            at = 0
            while at < len(texts):
                start, held = at, 0
                ids, begins, ends = [], [], []
                while at < len(texts) and held < BATCH_CHARS:
                    text = texts[at].as_py() or ""
                    own, begin, end = tool.encode(text)
                    size = len(text.encode())
                    ids.append(np.r_[own, tool.end].astype(np.int32))
                    begins.append(np.r_[begin, size].astype(np.int32))
                    ends.append(np.r_[end, size].astype(np.int32))
                    held += len(text)
                    at += 1
                decoded = tool.decoder.decode([x.tolist() for x in ids], num_threads=1)
                columns = [
                    *[c.slice(start, at - start) for c in batch.columns[:-1]],
                    _lists(ids),
                    _lists(begins),
                    _lists(ends),
                    pa.array(decoded, pa.string()),
                ]
                names = [*batch.schema.names[:-1], "ids", "begins", "ends", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return source.mapInArrow(
        encode,
        f"{fields}, ids array<int>, begins array<int>, ends array<int>, decoded string",
    )

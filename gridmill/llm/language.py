"""Language identification by hyperdimensional profiles.

Every letter has a random vector of -1 and 1, drawn from its code point alone. Three letters in a
row are bound into one vector by rotating the first twice and the second once and multiplying; a
text is the sum (bundle) of its bound triples, a language the sum of its texts. A text gets the
language whose prototype has the largest cosine with it, so nothing but the text is used.

Letters are lower-cased; every run of other characters counts as one space, which is a letter of the
triples too. A null text or one without letters is ``und`` with score 0, as is every text when no
row may be learned from. The score is the cosine, at least 0. Equal cosines: the first language by
code point. Repeated rows count as often as they occur; other columns are not read.

The driver holds one vector of DIMENSIONS sums per language, whatever the number of rows; at most
MOST_LANGUAGES languages are accepted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import whole

DIMENSIONS = 1024
MOST_LANGUAGES = 4096
UNKNOWN = "und"
SPACE = 32
SEED = 20_011
BLOCK_CHARS = 1 << 20
COUNTS = 1 << 22  # cells of a table of counts

_letters: np.ndarray | None = None
_vectors: dict[int, np.ndarray] = {}


def held_out(key: str) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.crc32(whole(F.col(key).cast("string"))) % 4 == 2


def letters() -> np.ndarray:
    """Per code point the lower-case letter it counts as, or the space."""
    global _letters
    if _letters is None:
        out = np.full(0x110000, SPACE, np.int32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                lower = char.lower()
                out[code] = ord(lower) if len(lower) == 1 else code
        _letters = out
    return _letters


def letter_vector(code: int) -> np.ndarray:
    if code not in _vectors:
        draw = np.random.default_rng((SEED, int(code)))
        _vectors[code] = (draw.integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.float32)
    return _vectors[code]


def triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bound vectors of the distinct triples, and per triple read its text and its row there.

    A text is framed by spaces; texts without letters have no triples.
    """
    framed = " " + "  ".join(texts) + " "
    codes = letters()[np.frombuffer(framed.encode("utf-32-le"), np.uint32)]
    lengths = np.array([len(t) + 2 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    # Only the first space of a run stays, and the one that ends a text.
    keep = codes != SPACE
    first = np.r_[True, owner[1:] != owner[:-1]]
    keep |= first | np.r_[True, codes[:-1] != SPACE]
    codes, owner = codes[keep], owner[keep]
    inside = (owner[2:] == owner[:-2]) if len(codes) > 2 else np.zeros(0, bool)
    alphabet, index = np.unique(codes, return_inverse=True)
    n = len(alphabet)
    key = ((index[:-2] * n + index[1:-1]) * n + index[2:])[inside]
    distinct, row = np.unique(key, return_inverse=True)
    table = np.stack([letter_vector(c) for c in alphabet])
    bound = (
        np.roll(table, 2, 1)[distinct // (n * n)]
        * np.roll(table, 1, 1)[distinct // n % n]
        * table[distinct % n]
    )
    return bound, owner[2:][inside], row


def bundles(texts: list[str]) -> np.ndarray:
    """One vector per text: the sum of its triples' vectors."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    bound, owner, row = triples(texts)
    if not len(row):
        return out
    step = max(1, COUNTS // len(bound))
    for start in range(0, len(texts), step):
        part = (owner >= start) & (owner < start + step)
        rows = min(step, len(texts) - start)
        counts = np.bincount(
            (owner[part] - start) * len(bound) + row[part], minlength=rows * len(bound)
        )
        out[start : start + rows] = counts.reshape(rows, -1).astype(np.float32) @ bound
    return out


def has_letters(texts: list[str]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t)) for t in texts], bool)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of some BLOCK_CHARS characters, each with the row it begins at."""
    block: list[str] = []
    held = start = 0
    for i, value in enumerate(batch.column("text")):
        block.append(value.as_py() or "")
        held += len(block[-1])
        if held >= BLOCK_CHARS:
            yield start, block
            block, held, start = [], 0, i + 1
    if block:
        yield start, block


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for start, texts in _blocks(batch):
            vectors = bundles(texts).astype(np.float64)
            names = np.array(langs[start : start + len(texts)], object)
            for lang in set(names):
                own = vectors[names == lang].sum(0)
                sums[lang] = sums[lang] + own if lang in sums else own
    for lang, vector in sorted(sums.items()):
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang] * DIMENSIONS, pa.string()),
                "place": pa.array(np.arange(DIMENSIONS, dtype=np.int32)),
                "total": pa.array(vector),
            }
        )


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The prototype of every language of ``docs``: sums of whole numbers, in no order's favour."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    sums = (
        rows.mapInArrow(_sums, "lang string, place int, total double")
        .groupBy("lang", "place")
        .agg(F.sum("total").alias("total"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("place", "total")))["total"].alias("total"))
    )
    found = sums.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"More than {MOST_LANGUAGES} languages")
    return {r["lang"]: np.array(r["total"]) for r in sorted(found, key=lambda r: r["lang"])}


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, lang_pred, score``."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    names = np.array([*prototypes, UNKNOWN], object)
    units = np.zeros((DIMENSIONS, len(prototypes)))
    for i, vector in enumerate(prototypes.values()):
        units[:, i] = vector / max(np.linalg.norm(vector), 1e-9)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            for _, texts in _blocks(batch):
                vectors = bundles(texts).astype(np.float64)
                norms = np.linalg.norm(vectors, axis=1)
                known = has_letters(texts) & (norms > 0) & (len(names) > 1)
                best = np.full(len(texts), len(names) - 1)
                score = np.zeros(len(texts))
                if len(names) > 1:
                    cosines = (vectors @ units) / np.maximum(norms, 1e-9)[:, None]
                    best[known] = cosines.argmax(1)[known]
                    score[known] = np.clip(cosines.max(1)[known], 0, 1)
                langs += names[best].tolist()
                scores += score.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(compare, f"doc_id {kind}, lang_pred string, score double")


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows."""
    prototypes = learn(docs.where(~held_out(key)), text, lang)
    return predict(docs, prototypes, key, text).withColumn("held_out", held_out("doc_id"))

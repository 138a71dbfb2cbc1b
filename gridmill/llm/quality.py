"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; policies are versioned sets of rules applied to the bits later, and ablations are bitwise
sums over the few distinct bit patterns, so neither reads a text again.

Null and empty texts have no words: all measurements are 0 and the rules on too few words fail.
Repeated rows and equal doc_ids are independent rows; an empty table gives an empty ledger. Columns
of the input other than the id and the text are not carried, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# Bit position by rule name: positions are never reused, so old ledgers stay readable.
RULES = {
    "few_words": 0,
    "repeated_windows": 1,
    "short_words": 2,
    "long_words": 3,
    "many_symbols": 4,
    "duplicate_lines": 5,
}


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules; whole-number ratios, so that no rounding decides."""

    least_words: int = 50
    most_repeated_percent: int = 50
    least_mean_chars_x10: int = 15
    most_mean_chars_x10: int = 250
    most_symbols_per_100_words: int = 30
    most_duplicate_line_percent: int = 60


@dataclass(frozen=True)
class Policy:
    """A version of what is rejected: the rules whose failure alone rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
FULL = Policy("full-1", tuple(RULES))


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = text.split()
    count = len(words)
    if not count:
        return (0, 0, len(text) - len(text.translate(None, SYMBOLS)), 0, 0, 0)
    packed = b"".join(words)
    chars = len(packed) if packed.isascii() else len(packed.decode())
    symbols = len(packed) - len(packed.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    repeated = 0
    if count > 3:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, count)
        pairs = ids[:-1] * len(seen) + ids[1:]
        _, pairs = np.unique(pairs, return_inverse=True)
        _, window, times = np.unique(
            pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True
        )
        again = times[window] > 1
        covered = np.zeros(count, bool)
        for i in range(3):
            covered[i : i + count - 2] |= again
        repeated = int(covered.sum())
    return (count, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        rows = np.array([measure(t.as_py() or b"") for t in texts], np.int64)
        columns = [pa.array(x) for x in rows.reshape(-1, len(MEASURES)).T]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *MEASURES]
        )


def failure_bits(limits: Limits) -> Column:
    """One bit per failed rule, from the measurements."""
    n, chars = F.col("n_words"), F.col("word_chars")
    failed = {
        "few_words": n < limits.least_words,
        "repeated_windows": 100 * F.col("n_repeat_words") > limits.most_repeated_percent * n,
        "short_words": 10 * chars < limits.least_mean_chars_x10 * n,
        "long_words": 10 * chars > limits.most_mean_chars_x10 * n,
        "many_symbols": 100 * F.col("n_symbols") > limits.most_symbols_per_100_words * n,
        "duplicate_lines": (F.col("n_dup_lines") > 1)
        & (100 * F.col("n_dup_lines") > limits.most_duplicate_line_percent * F.col("n_lines")),
    }
    bits = F.lit(0)
    for rule, test in failed.items():
        bits = bits.bitwiseOR(F.when(test, 1 << RULES[rule]).otherwise(0))
    return bits.cast("long")


def ledger(
    docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the measurements and ``failed``, the failure bits."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    names = ", ".join(f"{m} long" for m in MEASURES)
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = source.mapInArrow(_measured, f"doc_id {kind}, {names}")
    return rows.withColumn("failed", failure_bits(limits))


def rejected(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(policy.mask) != 0


def ablations(rows: DataFrame, policies: list[Policy]) -> DataFrame:
    """Per policy and rule: ``version, rule, failed`` rows, ``alone`` (rejected by this rule only)
    and ``kept_without`` (kept if the rule is left out).

    The ledger is first counted by bit pattern, at most 2 ** rules rows.
    """
    patterns = rows.groupBy("failed").count().withColumnRenamed("failed", "bits")
    bits, bit, mask = F.col("bits"), F.col("bit"), F.col("mask")
    spread = patterns.withColumn(
        "policy", F.explode(F.array(*[
            F.struct(F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                     F.lit(1 << RULES[r]).alias("bit"), F.lit(p.mask).alias("mask"))
            for p in policies for r in p.rules
        ]))
    ).select("bits", "count", "policy.*")
    inside = bits.bitwiseAND(mask)
    others = inside.bitwiseAND(F.bitwise_not(bit))
    total = lambda test: F.sum(F.when(test, F.col("count")).otherwise(0))
    return spread.groupBy("version", "rule").agg(
        total(bits.bitwiseAND(bit) != 0).alias("failed"),
        total((inside != 0) & (others == 0)).alias("alone"),
        total(others == 0).alias("kept_without"),
    )


def accepted(docs: DataFrame, policy: Policy = FULL, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, all their columns, that the policy keeps.

    All columns pass through the same task as the text, so nothing is shuffled or joined.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    kind = packed.schema["doc"].dataType.simpleString()
    names = ", ".join(f"{m} long" for m in MEASURES)
    rows = packed.select("doc", F.col("doc.text").alias("text")).mapInArrow(
        _measured, f"doc {kind}, {names}"
    )
    kept = rows.withColumn("failed", failure_bits(limits)).where(~rejected(policy))
    return kept.select("doc.*")

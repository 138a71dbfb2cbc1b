"""Secrets found by one automaton for all rules.

The rules are compiled together (subset construction, minimisation) on the driver; the transition
array, whose size depends on the rules alone, goes with the task. A task joins its texts with a
byte that resets the automaton and reads them in one pass for the triggers of all rules, the
beginnings that every match has. Only around these does the automaton of the rule itself run, to
place each match: leftmost, longest, not overlapping within a rule.

Offsets are code points, the end exclusive. Null and empty texts have no spans; rows that repeat
are treated alike and separately; an empty table gives an empty result. Only the id and the text
are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.automaton import RESET, Automaton, Rule, compile_rules, longest, run_states

_NAME = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
_ASSIGN = _NAME + r"\x20*[\"']?([A-Za-z0-9+/_.=\-]+)"
# The base rules. Lengths that decide are part of the rule where that finds the same matches.
BASE = [
    Rule("assign", _ASSIGN, _NAME, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", "AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
]
# What the method adds: issuers' own prefixes and key files.
ADDED = [
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}", r"gh[oprsu]_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9\-]{10,}", r"xox[abprs]-"),
    Rule("google", r"AIza[A-Za-z0-9_\-]{35}", "AIza"),
    Rule("stripe", r"[rs]k_(live|test)_[A-Za-z0-9]{16,}", r"[rs]k_(live|test)_"),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+", "eyJ"),
    Rule("keyfile", r"-----BEGIN ([A-Z]+ )?PRIVATE KEY-----", r"-----BEGIN "),
]
RULES = BASE + ADDED
LEAST_VALUE = 6
BLOCK_BYTES = 1 << 22

_VALUE = re.compile(_ASSIGN.encode(), re.IGNORECASE)
SPANS = "array<struct<kind string, start long, end long>>"


def _holds(rule: str, found: bytes) -> bool:
    return rule != "assign" or len(_VALUE.fullmatch(found)[2]) >= LEAST_VALUE


class Scanner:
    """The combined automaton, and one anchored automaton per rule to place its matches."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = rules
        self.all: Automaton = compile_rules(rules)
        self.each = [compile_rules([rule], anchored=True) for rule in rules]

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """The spans of each text, by start and then by rule."""
        joined = bytes([RESET]).join([*texts, b""])
        states = run_states(self.all, joined)
        accepted = self.all.accepts[states]
        hits = np.flatnonzero(accepted)
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        if not len(hits):
            return out
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, hits, side="right")
        for doc in np.unique(owner):
            first = int(ends[doc]) - len(texts[doc]) - 1
            at = hits[owner == doc]
            calm = np.flatnonzero(states[first : first + len(texts[doc])] == 0) + 1
            out[doc] = self._place(texts[doc], at - first + 1, accepted[at], calm)
        return out

    def _place(self, text: bytes, ends: np.ndarray, rules: np.ndarray, calm: np.ndarray):
        """``ends``: where rules (bits) end; ``calm``: offsets at which nothing is in progress."""
        spans = []
        for k, rule in enumerate(self.rules):
            cursor = 0
            for end in ends[(rules >> k & 1) == 1].tolist():
                if end <= cursor:
                    continue
                before = np.searchsorted(calm, end) - 1
                begin = max(cursor, int(calm[before]) if before >= 0 else 0)
                cursor = end
                for start in range(begin, end):
                    stop = longest(self.each[k], text, start)
                    if stop > 0:
                        cursor = stop
                        if _holds(rule.name, text[start:stop]):
                            spans.append((start, k, stop))
                        break
        spans.sort()
        if not text.isascii() and spans:
            points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
            count = lambda at: int(points[at - 1]) if at else 0
            spans = [(count(start), k, count(stop)) for start, k, stop in spans]
        return [(self.rules[k].name, start, stop) for start, k, stop in spans]


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    block: list[bytes] = []
    held = 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_secrets(
    docs: DataFrame, rules: list[Rule] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of ``kind, start, end``."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    scanner = Scanner(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        )
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1).cast(pa.large_binary())]
            found = [s for block in _blocks(texts) for s in scanner.scan(block)]
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"]
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {kind}, spans {SPANS}")

"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

All of it is column expressions. Per kind the matches of a pattern and the gaps between them give
the places of the matches; what fails its check is dropped without another try. Texts that lack a
sign every match needs (an at sign, a plus) are not searched. Patterns are possessive where the
greedy match is the only one, so that no text makes them backtrack or recurse deeply.

Spans are code points, the end exclusive, ordered by kind as listed and then by start. Null and
empty texts have none; rows that repeat are treated alike and separately; an empty table gives an
empty result. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import whole

NEARBY = 40  # characters before and after a match in which context words count
BONUS = 0.1
BLOCK = 128  # matches whose places are added up at a time


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def _any(found: Column) -> Column:
    return F.lit(True)


def _address(found: Column) -> Column:
    """Four parts of at most 255, whatever zeros stand before them."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return found.rlike(rf"^{part}(?:\.{part}){{3}}$")


def luhn(found: Column) -> Column:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""
    digits = _digits(found)
    size = F.length(digits)
    value = lambda i: F.substring(digits, size - i, F.lit(1)).cast("int")
    doubled = lambda i: F.when(
        i % 2 == 1, value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)
    ).otherwise(value(i))
    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda sum_, i: sum_ + doubled(i))
    return F.when(_between(size, 13, 19), total % 10 == 0).otherwise(False)


def _phone(found: Column) -> Column:
    return _between(F.length(_digits(found)), 9, 15)


def mod97(found: Column) -> Column:
    """15 to 34 signs that leave 1 when divided by 97, the first four moved to the end."""
    signs = F.regexp_replace(found, " ", "")
    size = F.length(signs)
    turned = F.concat(F.substring(signs, 5, 40), F.substring(signs, 1, 4))
    code = lambda i: F.ascii(F.substring(turned, i, F.lit(1)))
    step = lambda rest, i: F.when(
        code(i) < 65, (rest * 10 + code(i) - 48) % 97
    ).otherwise((rest * 100 + code(i) - 55) % 97)
    rest = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), step)
    return F.when(_between(size, 15, 34), rest == 1).otherwise(False)


@dataclass(frozen=True)
class Kind:
    """``needs``: a text that every match contains; ``words``: what raises the score nearby."""

    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    words: str
    needs: str | None = None


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = [
    # A match begins where a run of its first part does, or where the match before it ended.
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
         _any, 0.9, "mail|contact|correo|courriel|kontakt", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         _address, 0.6, r"\bip\b|address|host|server|adresse", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         luhn, 0.8, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         _phone, 0.7, r"phone|call|\btel|mobile|fax", "+"),
]
ADDED = [
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
         mod97, 0.9, "iban|account|bank|konto|cuenta|compte"),
]
KINDS = BASE + ADDED


def _placed(found: Column, gaps: Column) -> Column:
    """The matches in blocks, with their places from the start of their block.

    Places are sums of the gaps and matches before. The sums run over blocks of matches and then
    over the blocks, because an array that grows by one element at a time is copied as often as it
    has elements.
    """
    none = F.array().cast("array<struct<start long, end long, found string, near string>>")
    items = F.transform(
        found,
        lambda text, i: F.struct(
            F.length(F.get(gaps, i)).cast("long").alias("gap"),
            F.length(text).cast("long").alias("size"),
            text.alias("found"),
            F.concat(
                F.right(F.get(gaps, i), F.lit(NEARBY)), F.lit(" "),
                F.left(F.get(gaps, i + 1), F.lit(NEARBY)),
            ).alias("near"),
        ),
    )
    count = F.size(found)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((count - 1) / BLOCK).cast("int")),
        lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)),
    )
    empty = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    return F.transform(
        blocks,
        lambda block: F.aggregate(
            block,
            empty,
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + x["size"]).alias("end"),
                            x["found"].alias("found"),
                            x["near"].alias("near"),
                        )
                    ),
                ).alias("out"),
            ),
        ),
    )


def _shifted(kind: Kind, blocks: Column) -> Column:
    """The blocks' spans, moved by the blocks before them, checked and scored."""
    bases = F.aggregate(
        blocks,
        F.array(F.lit(0).cast("long")),
        lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + b["at"])),
    )
    return F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("b"), F.slice(bases, F.lit(1), F.size(blocks)).alias("base")),
            lambda pair: F.transform(
                F.filter(pair["b"]["out"], lambda s: kind.check(s["found"])),
                lambda s: F.struct(
                    F.lit(kind.name).alias("kind"),
                    (s["start"] + pair["base"]).alias("start"),
                    (s["end"] + pair["base"]).alias("end"),
                    F.round(
                        F.lit(kind.score)
                        + F.when(F.lower(s["near"]).rlike(kind.words), BONUS).otherwise(0.0),
                        2,
                    ).alias("score"),
                ),
            ),
        )
    )


def find_personal_data(
    docs: DataFrame, kinds: list[Kind] = KINDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of ``kind, start, end, score``."""
    rows = docs.select(F.col(key).alias("doc_id"), whole(text).alias("text"))
    nothing = F.array().cast("array<string>")

    def matches(kind: Kind) -> Column:
        found = F.regexp_extract_all("text", F.lit(kind.pattern), F.lit(0))
        if kind.needs is None:
            return found
        return F.when(F.contains("text", F.lit(kind.needs)), found).otherwise(nothing)

    rows = rows.withColumns({f"found_{k.name}": matches(k) for k in kinds})
    rows = rows.withColumns(
        {
            f"gaps_{k.name}": F.when(
                F.size(f"found_{k.name}") > 0, F.split("text", k.pattern, -1)
            )
            for k in kinds
        }
    ).drop("text")
    rows = rows.withColumns(
        {
            f"blocks_{k.name}": F.when(
                F.size(f"found_{k.name}") > 0,
                _placed(F.col(f"found_{k.name}"), F.col(f"gaps_{k.name}")),
            )
            for k in kinds
        }
    )
    none = F.array().cast("array<struct<kind string, start long, end long, score double>>")
    spans = [
        F.coalesce(_shifted(k, F.col(f"blocks_{k.name}")), none) for k in kinds
    ]
    return rows.select("doc_id", F.concat(*spans).alias("spans"))

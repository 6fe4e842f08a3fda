r"""Places of matches in texts, and texts with places replaced, as Spark expressions of a row.

Places are found by putting a character that no pattern holds round every match and adding up the lengths
of what lies between. The marks are put only into texts that match at all. All places count code points.
Nothing is looked up by counting from the start of a text, so the time grows with its length alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicktally.llm.expressions import let

# A character that the patterns exclude, and what stands for it in a text that holds it.
MARK = "﷐"
INSTEAD = "﷑"

# Values that are folded at once, and code points of a text that are cut off at once.
BLOCK = 128
CUT = 512


def before(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each value the fold of all values before it: of whole blocks, then within its own."""

    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, merge)

    def folds_of(values: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
            lambda b: fold(F.slice(values, b * BLOCK + 1, F.lit(BLOCK))),
        )
        return F.aggregate(
            blocks,
            F.array(zero),
            lambda folds, more: F.concat(folds, F.array(merge(F.element_at(folds, -1), more))),
        )

    def within(values: Column, folds: Column) -> Column:
        return F.transform(
            values,
            lambda _, i: merge(
                F.get(folds, F.floor(i / BLOCK).cast("int")),
                fold(F.slice(values, i - i % BLOCK + 1, i % BLOCK)),
            ),
        )

    return let(values, lambda held: let(folds_of(held), lambda folds: within(held, folds)))


def matches(text: Column, pattern: str, around: int = 0) -> Column:
    """The matches of a pattern in a text that is not null: start, end and value of each.

    The pattern has two groups: a prefix, which belongs to the match, and the value. With ``around``, a
    match also tells ``left`` and ``right``: so many code points next to it, as far as the neighbouring
    matches of the pattern.
    """

    def of_parts(parts: Column, starts: Column) -> Column:
        # Outside, prefix, value, outside, prefix, value, ..., outside: values are at 2, 5, 8, ...
        def match(i: Column) -> Column:
            fields = [
                F.get(starts, i - 1).alias("start"),
                (F.get(starts, i) + F.length(F.get(parts, i))).alias("end"),
                F.get(parts, i).alias("value"),
            ]
            if around:
                fields += [
                    F.right(F.get(parts, i - 2), F.lit(around)).alias("left"),
                    F.left(F.get(parts, i + 1), F.lit(around)).alias("right"),
                ]
            return F.struct(*fields)

        return F.transform(F.sequence(F.lit(2), F.size(parts) - 2, F.lit(3)), match)

    def placed(parts: Column) -> Column:
        sums = before(F.transform(parts, F.length), F.lit(0), lambda total, more: total + more)
        return let(sums, lambda starts: of_parts(parts, starts))

    clean = F.translate(text, MARK, INSTEAD)
    found = let(F.split(F.regexp_replace(clean, pattern, f"{MARK}$1{MARK}$2{MARK}"), MARK), placed)
    words = ", left:string, right:string" if around else ""
    none = F.array().cast(f"array<struct<start:int, end:int, value:string{words}>>")
    return F.when(text.rlike(pattern), found).otherwise(none)


def _piece(cuts: Column, start: Column, end: Column) -> Column:
    """The text between two places, out of the few cuts that hold it."""
    first = F.floor(start / CUT).cast("int")
    last = F.floor(end / CUT).cast("int")
    held = F.array_join(F.slice(cuts, first + 1, last - first + 1), "")
    return F.substring(held, start % CUT + 1, end - start)


def replaced(text: Column, spans: Column, mask: str) -> Column:
    """A text that is not null with its spans replaced by a mask; spans that overlap become one.

    Spans are ordered by ``start``; the text between two of them is cut out of short pieces of it.
    """

    def of_cuts(cuts: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])

        def masked(reached: Column) -> Column:
            kept = F.transform(
                spans,
                lambda s, i: F.when(
                    s["start"] >= F.get(reached, i),
                    F.concat(_piece(cuts, F.get(reached, i), s["start"]), F.lit(mask)),
                ).otherwise(""),
            )
            tail = _piece(cuts, F.array_max(ends), F.length(text))
            return F.concat(F.array_join(kept, ""), tail)

        return let(before(ends, F.lit(0), lambda a, b: F.greatest(a, b)), masked)

    cuts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(cuts, of_cuts)).otherwise(text)

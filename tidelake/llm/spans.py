"""Positions of regular-expression matches, with DataFrame functions only.

Spark returns the texts of matches but not their places.  Splitting a text at
the same pattern gives the gaps between matches, so the running sum of gap and
match lengths gives each match's place in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,rank:int,kind:string,stop:int,value:string,before:string,after:string>>"
#: Elements of a block of a running fold, and code points of a block of text.
FOLD, BLOCK = 64, 1024


def none() -> Column:
    return F.array().cast(SPAN)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a one-element transform."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, combine, start: int = 0) -> Column:
    """The running results, from ``start`` on, of an associative ``combine`` over an array of integers.

    Every element is folded with those before it in its block of ``FOLD``, and every
    block with the blocks before it, so the time is about linear and nothing is appended.
    """
    fold = lambda all_, first, n: F.aggregate(F.slice(all_, first, n), F.lit(start).cast("long"), combine)

    def folded(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(v) / FOLD).cast("int"))

        def carried(total: Column) -> Column:
            base = F.transform(blocks, lambda i: fold(total, F.lit(1), i))
            of = lambda b: F.transform(v, lambda x, i: combine(F.get(b, F.floor(i / FOLD).cast("int")), fold(v, i - i % FOLD + 1, i % FOLD + 1)))
            return bound(base, of)

        return bound(F.transform(blocks, lambda i: fold(v, i * FOLD + 1, F.lit(FOLD))), carried)

    return bound(values.cast("array<bigint>"), folded)


def spans(text: Column, pattern: str, kind: str, rank: int, wanted: Column | None = None, context: int = 40) -> Column:
    """All leftmost, non-overlapping matches of ``pattern`` as an array of span structs, in order.

    ``wanted``: a cheap condition without which the text holds no match.
    ``before`` and ``after`` have up to ``context`` code points of the gaps beside the match.
    The time is linear in the text and its matches.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(all_: Column) -> Column:
        gap, value = all_["gaps"], all_["found"]

        def made(stops: Column) -> Column:
            def one(own: Column, i: Column) -> Column:
                stop = F.get(stops, i).cast("int")
                return F.struct(
                    (stop - F.length(own)).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), stop.alias("stop"), own.alias("value"),
                    F.right(F.get(gap, i), F.lit(context)).alias("before"), F.left(F.get(gap, i + 1), F.lit(context)).alias("after"),
                )

            return F.transform(value, one).cast(SPAN)

        sizes = F.transform(value, lambda own, i: F.length(F.get(gap, i)) + F.length(own))
        return F.when(F.size(value) > 0, bound(running(sizes, lambda a, b: a + b), made)).otherwise(none())

    # bound once: both arrays would be computed again in the lambda
    here = bound(F.struct(gaps.alias("gaps"), found.alias("found")), placed)
    return here if wanted is None else F.when(wanted, here).otherwise(none())


def apart(found: Column, from_: Column) -> Column:
    """The spans of ``found`` that overlap none of ``from_``; both are sorted by start."""
    marked = lambda spans_, own: F.transform(spans_, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s.alias("span")))
    both = F.array_sort(F.concat(marked(from_, 0), marked(found, 1)))

    def kept(all_: Column) -> Column:
        n = F.size(all_)
        far = F.lit(1 << 40)
        stops = running(F.transform(all_, lambda s: F.when(s["own"] == 0, s["span"]["stop"]).otherwise(0)), lambda a, b: F.greatest(a, b))
        starts = running(F.reverse(F.transform(all_, lambda s: F.when(s["own"] == 0, s["start"].cast("long")).otherwise(far))), lambda a, b: F.least(a, b), 1 << 40)

        def free(edges: Column) -> Column:
            alone = lambda s, i: (s["own"] == 1) & (F.get(edges["stops"], i) <= s["start"]) & (F.get(edges["starts"], n - 1 - i) >= s["span"]["stop"])
            return F.transform(F.filter(all_, alone), lambda s: s["span"])

        return bound(F.struct(stops.alias("stops"), starts.alias("starts")), free)

    return F.when((F.size(found) > 0) & (F.size(from_) > 0), bound(both, kept)).otherwise(found)


def replaced(text: Column, found: Column, label) -> Column:
    """``text`` with ``label(span)`` in place of every span; overlapping spans give the first one's label.

    ``found`` is sorted by start.  The text is cut into blocks, so that no part is looked for from the text's start.
    """

    def built(blocks: Column) -> Column:
        def part(a: Column, b: Column) -> Column:
            first = F.floor(a / BLOCK).cast("int")
            here = F.array_join(F.slice(blocks, first + 1, F.floor((b - 1) / BLOCK).cast("int") - first + 1), "")
            return F.when(b > a, F.substring(here, (a % BLOCK).cast("int") + 1, (b - a).cast("int"))).otherwise("")

        def joined(stops: Column) -> Column:
            def one(s: Column, i: Column) -> Column:
                at = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(stops, i - 1))
                return F.when(s["start"] >= at, F.concat(part(at, s["start"].cast("long")), label(s))).otherwise("")

            rest = part(F.get(stops, F.size(stops) - 1), F.length(text).cast("long"))
            return F.concat(F.array_join(F.transform(found, one), ""), rest)

        return bound(running(F.transform(found, lambda s: s["stop"]), lambda a, b: F.greatest(a, b)), joined)

    whole = bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), built)
    return F.when(F.size(found) > 0, whole).otherwise(text)


def listed(found: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

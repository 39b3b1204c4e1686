"""Matches of a pattern with their places, in built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTEXT = 24
RUN = 128
_MATCH = "struct<start:int,end:int,text:string,before:string,after:string>"
NONE = f"cast(array() as array<{_MATCH}>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str, gate: Column) -> Column:
    """All leftmost matches that do not overlap, in order: start, end, text, before, after.

    Places are code points, the end exclusive. ``before`` holds up to
    ``CONTEXT`` characters that precede the match since the last one, ``after``
    the next character. Texts without ``gate`` cannot match and are not searched.
    """

    def step_over(z: Column):
        def step(state: Column, i: Column) -> Column:
            piece, found = F.element_at(z["p"], i), F.element_at(z["m"], i)
            start = state["at"] + F.char_length(piece)
            end = start + F.char_length(found)
            match = F.struct(
                start.alias("start"),
                end.alias("end"),
                found.alias("text"),
                F.right(piece, F.lit(CONTEXT)).alias("before"),
                F.left(F.element_at(z["p"], i + 1), F.lit(1)).alias("after"),
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(match)).alias("out"))

        return step

    def walk(z: Column) -> Column:
        """Places within runs of RUN matches, then the runs one after the other: linear in the matches."""
        runs = F.sequence(F.lit(0), F.floor((F.size(z["m"]) - 1) / RUN).cast("int"))
        first = F.struct(F.lit(0).alias("at"), F.expr(NONE).alias("out"))

        def run(c: Column) -> Column:
            return F.aggregate(F.sequence(c * RUN + 1, F.least((c + 1) * RUN, F.size(z["m"]))), first, step_over(z))

        def add(state: Column, x: Column) -> Column:
            return F.struct((state["at"] + x["at"]).alias("at"), F.concat(state["bases"], F.array(state["at"])).alias("bases"))

        def place(x: Column) -> Column:
            none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("bases"))
            bases = F.aggregate(x, none, add, lambda s: s["bases"])
            return let(bases, lambda b: F.flatten(F.transform(x, lambda r, i: _moved(r["out"], F.get(b, i)))))

        return F.when(F.size(z["m"]) > 0, let(F.transform(runs, run), place)).otherwise(F.expr(NONE))

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p")
    )
    return F.when(gate, let(found, walk)).otherwise(F.expr(NONE))


def _moved(found: Column, by: Column) -> Column:
    kept = ("text", "before", "after")
    return F.transform(
        found, lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end"), *[m[k].alias(k) for k in kept])
    )


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of spans (kind, start, end) by start, then kind as in ``kinds``, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    order = F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.array_position(names, s["kind"]).alias("k"), s["end"].alias("end")),
    )
    return F.array_join(
        F.transform(
            F.array_sort(order),
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["k"].cast("int")), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def of_kind(kind: str, found: Column, base: bool) -> Column:
    """Matches as spans of a kind."""
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("base")
        ),
    )

"""Places in a long total order, found by counting instead of sorting.

Rows are ordered by one number and then by byte strings (``order_keys``). The
value of the number at a rank comes from ``quantiles.select_ranks``. Where many
rows share it, the rank is looked for among their strings: rows are counted by
the next two bytes, the group that holds the rank is taken, and its rows' common
beginning is skipped, key after key, until a group is small. Each pass is one
scan with a partial aggregation into at most 2^16 + 257 groups. So a page in the
middle of a tied time gathers a few pages of rows and no more.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import select_ranks

_PIECE = 2
_OFFSET = 1 << 62


@dataclass(frozen=True)
class Place:
    """Rows whose first keys equal ``exact`` and whose next key begins with ``prefix``; ``before`` rows come earlier."""

    exact: tuple
    prefix: bytes | None
    before: int

    def _ends(self, keys: list[str]) -> tuple[list[Column], list]:
        bound = [*self.exact] + ([self.prefix] if self.prefix is not None else [])
        return [F.col(k) for k in keys[: len(bound)]], [F.lit(v) for v in bound]

    def onwards(self, keys: list[str]) -> Column:
        """Rows of the place and behind it."""
        columns, bound = self._ends(keys)
        return F.struct(*columns) >= F.struct(*[b.alias(k) for k, b in zip(keys, bound)])

    def upto(self, keys: list[str]) -> Column:
        """Rows before the place and of it."""
        columns, bound = self._ends(keys)
        if self.prefix is not None:
            columns[-1] = F.substring(columns[-1], 1, len(self.prefix)).alias(keys[len(bound) - 1])
        return F.struct(*columns) <= F.struct(*[b.alias(k) for k, b in zip(keys, bound)])


def text_key(c: str) -> Column:
    """A text as bytes, in the order of the text; NULL as the empty one."""
    return F.coalesce(F.col(c), F.lit("")).cast("binary")


def time_key(c: str) -> Column:
    """A time as eight bytes, in the order of the time; NULL first."""
    return F.coalesce(F.unhex(F.lpad(F.hex(F.unix_micros(c) + F.lit(_OFFSET)), 16, "0")), F.lit(b""))


def find_place(rows: DataFrame, keys: list[str], rank: int, room: int, weight: str) -> Place:
    """The place that holds the row of an ascending ``rank`` (from 1, no larger than the sum of ``weight``).

    ``keys``: a non-negative long, then binary columns. A row counts ``weight``
    times. The place has at most ``room`` rows, unless they agree in all keys.
    """
    found = select_ranks(rows.select(F.lit(0).alias("all"), F.col(keys[0]).alias("v"), weight), [(0, 0, rank)], ["all"], weight)[0]
    exact, before = (found["lo"],), rank - found["r"]
    if found["n"] <= room:
        return Place(exact, None, before)
    held = rows.where(F.col(keys[0]) == found["lo"])
    for key in keys[1:]:
        prefix = b""
        while True:
            same = held.where(F.substring(key, 1, len(prefix)) == F.lit(prefix)) if prefix else held
            group = _group_of(same, key, len(prefix), rank - before, weight)
            before += group["earlier"]
            low, high = bytes(group["lo"]), bytes(group["hi"])
            prefix = os.path.commonprefix([low, high])
            if group["rows"] <= room:
                return Place(exact, prefix, before)
            if low == high:
                break
        exact, held = (*exact, low), held.where(F.col(key) == F.lit(low))
    return Place(exact, None, before)


def _group_of(rows: DataFrame, key: str, known: int, rank: int, weight: str):
    """Of the groups by the two bytes behind the ``known`` first ones that with the ``rank``: its range, size and what is before it."""
    groups = rows.groupBy(F.substring(key, known + 1, _PIECE).alias("piece")).agg(
        F.sum(weight).alias("n"), F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi")
    )
    # one window partition of at most 2^16 + 257 rows
    upto = F.sum("n").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = groups.withColumn("upto", upto).withColumn("earlier", F.col("upto") - F.col("n"))
    return numbered.where((F.col("earlier") < rank) & (F.col("upto") >= rank)).first()


def rows_at(rows: DataFrame, keys: list[str], first: int, last: int, weight: str, number: str) -> DataFrame:
    """The rows of ranks ``first`` to ``last``, each as often as it counts there, with its rank as ``number``."""
    room = last - first + 1
    start, end = (find_place(rows, keys, rank, room, weight) for rank in (first, last))
    # What lies between the places is on the page, and each place has at most a page of rows: three pages at most.
    near = rows.where(start.onwards(keys) & end.upto(keys))
    return numbered(near, keys, first, last, weight, number, start.before)


def numbered(rows: DataFrame, keys: list[str], first: int, last: int, weight: str, number: str, before: int = 0) -> DataFrame:
    """``rows_at`` of a few rows, which are sorted in one task; ``before``: the rank in front of them."""
    upto = F.sum(weight).over(Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.lit(before)
    near = rows.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col(weight) + 1)
    near = near.where((F.col("_upto") >= first) & (F.col("_from") <= last))
    copies = F.sequence(F.greatest("_from", F.lit(first).cast("long")), F.least("_upto", F.lit(last).cast("long")))
    return near.withColumn(number, F.explode(copies)).drop("_upto", "_from")

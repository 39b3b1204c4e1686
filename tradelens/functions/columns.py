"""Column expressions shared by the operators (all built-in, JVM-side)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EVENTS, IST_OFFSET

MICROS_PER_SECOND = 1_000_000
_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: str | Column) -> Column:
    """A text value that is set: not NULL and not empty."""
    c = col_(c)
    return c.isNotNull() & (c != "")


def blank_to_null(c: str | Column) -> Column:
    """Empty text becomes NULL."""
    return F.nullif(col_(c), F.lit(""))


def positive(c: str | Column) -> Column:
    c = col_(c)
    return c.isNotNull() & (c > 0)


def gap_us(later: str | Column, earlier: str | Column) -> Column:
    """``later - earlier`` in integer microseconds."""
    return F.unix_micros(col_(later)) - F.unix_micros(col_(earlier))


def clamped_gap_us(later: str | Column, earlier: str | Column, minus_us: int = 0) -> Column:
    """``GREATEST(later - earlier - minus, 0)``; NULL inputs give 0 (GREATEST skips NULL)."""
    d = gap_us(later, earlier)
    if minus_us:
        d = d - F.lit(minus_us)
    return F.greatest(d, F.lit(0).cast("long"))


def us_to_seconds(c: str | Column) -> Column:
    return col_(c).cast("double") / F.lit(float(MICROS_PER_SECOND))


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds to a timestamp; epoch 0 (or NULL) means "not found"."""
    c = col_(c)
    return F.when(c.isNotNull() & (c != 0), F.timestamp_seconds(c))


_DAY_US = 86_400 * MICROS_PER_SECOND


def utc_text(us: Column, separator: str) -> Column:
    """Epoch microseconds as ``yyyy-MM-dd<separator>HH:mm:ss.SSS`` on the UTC clock, whatever the session's zone."""
    in_day = F.pmod(us, F.lit(_DAY_US))
    ms = F.floor(in_day / 1000)
    clock = F.format_string(
        "%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000
    )
    return F.when(us.isNotNull(), F.concat(utc_date(us).cast("string"), F.lit(separator), clock))


def utc_date(us: Column) -> Column:
    """The UTC date of epoch microseconds."""
    days = F.round((us - F.pmod(us, F.lit(_DAY_US))) / _DAY_US).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def instant(t) -> Column:
    """A datetime (with its zone) as a timestamp literal."""
    return F.timestamp_micros(F.lit((t - _EPOCH) // _dt.timedelta(microseconds=1)))


def iso_utc(c: str | Column) -> Column:
    """``Date.toISOString()`` form: 2024-01-31T12:00:00.000Z."""
    return F.concat(utc_text(F.unix_micros(col_(c)), "T"), F.lit("Z"))


def ist_display(epoch_seconds: str | Column) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss.SSS+05:30``; 0 or NULL gives NULL."""
    c = col_(epoch_seconds)
    shifted = utc_text((c + F.lit(5 * 3600 + 30 * 60)) * MICROS_PER_SECOND, " ")
    return F.when(c.isNotNull() & (c != 0), F.concat(shifted, F.lit(IST_OFFSET)))


def hex_to_long(c: str | Column) -> Column:
    """``0x1a2b`` style text to a number."""
    return F.conv(F.regexp_replace(col_(c), "^0[xX]", ""), 16, 10).cast("long")


def tx_hash_head(c: str | Column) -> Column:
    """Text before the first ':' (bitcoin hashes carry an output index)."""
    return F.split(col_(c), ":").getItem(0)


def missing_time_gate() -> Column:
    """Some event of an order has a block number but no timestamp."""
    return reduce(
        lambda a, b: a | b,
        [F.col(f"{e}_block_number").isNotNull() & F.col(e).isNull() for e in EVENTS],
    )

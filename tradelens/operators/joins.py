"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that are looked for, and that the sketch tracks to find them.
HOT_KEYS = 1000
TRACKED = 10 * HOT_KEYS
_SEPARATOR = "\u0001"


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The heaviest keys, as found by a bounded sketch: at most ``HOT_KEYS`` rows.

    A key counts as hot from one part in ``HOT_KEYS`` of all rows. The sketch has
    ``TRACKED`` entries in every task, so no key is shuffled to be counted, and
    what it finds may be broadcast. It need not be exact: ``lookup_join`` gives
    the same result for any set of keys.
    """
    item = F.concat_ws(_SEPARATOR, *[F.col(k).cast("string") for k in keys])
    sketch = df.select(item.alias("item")).agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k", F.col("item"), F.lit(HOT_KEYS), F.lit(TRACKED)).alias("top"),
    )
    top = sketch.select("n", F.inline("top")).where(F.col("count") * HOT_KEYS >= F.col("n"))
    parts = F.split("item", _SEPARATOR, len(keys))
    kinds = [df.schema[k].dataType for k in keys]
    return top.select(*[parts[i].cast(kind).alias(k) for i, (k, kind) in enumerate(zip(keys, kinds))])


def lookup_join(
    left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, salt: Column, keep: list[str] | None = None
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``keys``, where ``right`` has one row per key.

    ``hot`` lists keys that may hold many left rows (any set gives the same
    result; see ``hot_keys``). Their right rows - at most as many as ``hot`` has
    rows - are broadcast and joined map-side. The left rows of hot keys then
    enter the shuffle join under ``salt`` instead of their key: a value unique
    per row that matches no right key. So the shuffle spreads them evenly and
    no task receives a hot key, and ``left`` is read once. ``keep`` names the left
    columns of the result (default all); the last key travels once if it is not among them.
    """
    last = keys[-1]
    values = [c for c in right.columns if c not in keys]
    # an inner join (right and hot are both unique per key): unlike a semi join it is
    # not pushed below an aggregate that builds ``right``, so it probes that
    # aggregate's shuffle output, which the shuffle join below reuses
    hot_right = right.join(F.broadcast(hot), keys, "inner").select(
        *keys, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values]
    )
    marked = left.join(F.broadcast(hot_right), keys, "left")
    routed = marked.withColumn("_k", F.when(F.col("_hot"), salt).otherwise(F.col(last)))
    cold = right.withColumnRenamed(last, "_k")
    j = routed.join(cold, [*keys[:-1], "_k"], "left")
    return j.select(
        *(keep or left.columns),
        *[F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values],
    )

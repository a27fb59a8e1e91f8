"""Exact medians of groups of any size, without sorting a group in one task.

A mergeable sketch gives two values of a group around its middle place; one pass counts what is below, at, between and above them, which
tells the part that holds the place; that part, mostly some thousandth of the rows, is kept and searched again until it is small
enough to sort. The sketch only decides how large the part is: places are counted, so medians are exact, and as
neither value is in a part that is kept, every round leaves less, however often values repeat."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored

_GRID = 1000


def medians(rows: DataFrame, keys: list[str], column: str, name: str, most: int = 100_000, accuracy: int = 10_000) -> DataFrame:
    """keys, name: the median of `column` (nulls left out; of an even number the mean of the two middle values) for the groups
    that have values. Parts of at most `most` rows are sorted. Groups are few enough for a broadcast, as each has many rows."""
    x = F.col(column)
    left = rows.where(x.isNotNull()).select(*keys, x.cast("double").alias("_x"))
    sizes = left.groupBy(*keys).agg(F.count("*").alias("_n"))
    # a search for each of the one or two middle places, from 1
    middle = F.explode(F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1)))
    state = stored(sizes.select(*keys, "_n", middle.alias("_k")).withColumn("_w", F.col("_k") * 2 > F.col("_n") + 1), "places")
    left, each, found = left.join(F.broadcast(state.select(*keys, "_w")), keys), [*keys, "_w"], []
    while not state.isEmpty():
        small = left.join(F.broadcast(state.where(F.col("_n") <= most)), each)
        place = F.row_number().over(Window.partitionBy(*each).orderBy("_x"))
        found.append(small.withColumn("_i", place).where("_i = _k").select(*each, "_x"))
        large = left.join(F.broadcast(state.where(F.col("_n") > most)), each)
        sketch = large.groupBy(*each).agg(F.percentile_approx("_x", [i / _GRID for i in range(_GRID + 1)], accuracy).alias("_s"), F.max("_n").alias("_n"), F.max("_k").alias("_k"))
        at = F.col("_k") / F.col("_n") * _GRID
        near = lambda i: F.get("_s", F.greatest(F.lit(0), F.least(F.lit(_GRID), i)).cast("int"))
        bounds = stored(sketch.withColumns({"_lo": near(F.floor(at) - 1), "_hi": near(F.ceil(at) + 1)}).drop("_s"), "bounds")
        lo, hi, k, v = F.col("_lo"), F.col("_hi"), F.col("_k"), F.col("_x")
        parts = left.join(F.broadcast(bounds), each).groupBy(*each, "_lo", "_hi", "_k", "_n").agg(
            F.count_if(v < lo).alias("_below"), F.count_if(v <= lo).alias("_to_lo"), F.count_if(v < hi).alias("_to_hi"), F.count_if(v <= hi).alias("_with_hi")
        )
        none = F.lit(None).cast("double")
        part = lambda above, under, value, before, upto: F.struct(above.alias("_a"), under.alias("_b"), value.alias("_v"), (k - before).alias("_k"), (upto - before).alias("_n"))
        chosen = (
            F.when(k <= F.col("_below"), part(none, lo, none, F.lit(0), F.col("_below")))
            .when(k <= F.col("_to_lo"), part(none, none, lo, F.lit(0), F.lit(0)))
            .when(k <= F.col("_to_hi"), part(lo, hi, none, F.col("_to_lo"), F.col("_to_hi")))
            .when(k <= F.col("_with_hi"), part(none, none, hi, F.lit(0), F.lit(0)))
            .otherwise(part(hi, none, none, F.col("_with_hi"), F.col("_n")))
        )
        parts = stored(parts.select(*each, chosen.alias("_r")).select(*each, "_r.*"), "parts")
        found.append(parts.where("_v is not null").select(*each, F.col("_v").alias("_x")))
        open_ = parts.where("_v is null")
        inside = (F.col("_a").isNull() | (v > F.col("_a"))) & (F.col("_b").isNull() | (v < F.col("_b")))
        left = stored(left.join(F.broadcast(open_.select(*each, "_a", "_b")), each).where(inside).select(*each, "_x"), "part")
        state = open_.select(*each, "_n", "_k")
    if not found:
        return sizes.select(*keys, F.lit(None).cast("double").alias(name))
    return reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.avg("_x").alias(name))

"""The statistics of stats.py where a few (pv, bucket) hold very many samples.

Hot groups are those above a number of rows. Their rows are dealt by range of (pv, bucket, order), so that a group is many blocks of
even size; differences, intervals and peaks are taken within blocks, whose edges (the last time and value before a block and the
first value after it) are stitched from a row a block. What is left are aggregates that combine before they are shuffled, and
medians from order_stats.py. Other groups take the one exchange of stats.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .order_stats import medians
from .stats import TIME_STATS, VALUE_STATS, _no_nan, _time_stats, _value_stats, scalar_stats, vector_stats


def spread_stats(rows: DataFrame, keys: list[str], vector: bool = False, blocks: int | None = None, most: int = 100_000) -> DataFrame:
    """A row per group of keys: length, nan_count, VALUE_STATS, TIME_STATS, as scalar_stats() or vector_stats() have them.
    blocks: into how many ranges all rows are dealt."""
    n = blocks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = _no_nan(F.col("x"))
    named = rows.select(*keys, "seq", "offset_ms", "x", v.alias("_v"), (F.when(F.abs(v) < float("inf"), v) if vector else v).alias("_f"))
    dealt = stored(named.repartitionByRange(n, *keys, "seq").withColumn("_p", F.spark_partition_id()), "ranges")
    block = [*keys, "_p"]
    # edges: what precedes and follows each block
    ends = dealt.groupBy(*block).agg(
        F.max_by("offset_ms", "seq").alias("_t"), F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("seq"))).alias("_z"), F.min_by("_v", F.when(F.col("_v").isNotNull(), F.col("seq"))).alias("_a"),
        F.max_by("x", "seq").alias("_x"),
    )
    over = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY _p)"
    ends = ends.select(*block, F.expr(f"lag(_t) {over}").alias("_t0"), F.expr(f"lag(_z, 1) IGNORE NULLS {over}").alias("_z0"), F.expr(f"lead(_a, 1) IGNORE NULLS {over}").alias("_a1"), F.expr(f"lag(_x) {over}").alias("_x0"))
    inside = f"OVER (PARTITION BY {', '.join(block)} ORDER BY seq)"
    placed = dealt.join(ends, block).withColumns({
        "_dt": F.col("offset_ms") - F.coalesce(F.expr(f"lag(offset_ms) {inside}"), F.col("_t0")),
        "_before": F.coalesce(F.expr(f"lag(_v, 1) IGNORE NULLS {inside}"), F.col("_z0")),
        "_after": F.coalesce(F.expr(f"lead(_v, 1) IGNORE NULLS {inside}"), F.col("_a1")),
        "_last": F.when(F.row_number().over(Window.partitionBy(*block).orderBy("seq")) == 1, F.col("_x0")).otherwise(F.expr(f"lag(x) {inside}")),
    })
    # scalars difference the values that are there, vectors raw neighbours
    step = _no_nan(F.col("_v") - _no_nan(F.col("_last"))) if vector else F.col("_v") - F.col("_before")
    placed = stored(placed.select(*keys, "seq", "offset_ms", "x", "_v", "_f", "_dt", step.alias("_d"), ((F.col("_v") > F.col("_before")) & (F.col("_v") > F.col("_after"))).alias("_peak")), "steps")
    mid = stored(medians(placed, keys, "_f", "_mid", most), "medians")
    dev = placed.join(F.broadcast(mid), keys).withColumn("_dev", F.abs(F.col("_f") - F.col("_mid")))
    found = placed.withColumn("_mid_dt", F.lit(False)).groupBy(*keys).agg(
        F.count("*").alias("length"), F.count_if(F.isnan("x")).alias("nan_count"), *_value_stats(F.col("_f"), F.col("_v"), F.lit(True) if vector else F.count("_v") >= 3),
        F.avg("_d").alias("rate_of_change"), F.var_pop("_d").alias("rate_of_change_variance"), F.count_if("_peak").alias("peaks"), *_time_stats(),
    ).drop("median_interval")
    for m in (medians(dev, keys, "_dev", "mad", most), medians(placed, keys, "_dt", "_ms", most)):
        found = found.join(m, keys, "left")
    return found.withColumn("median_interval", F.col("_ms") / 1000.0).select(*keys, "length", "nan_count", *VALUE_STATS, *TIME_STATS)


def balanced_stats(rows: DataFrame, vector: bool = False, hot: int = 10_000_000, blocks: int | None = None, most: int = 100_000) -> DataFrame:
    """scalar_stats(), or vector_stats() of components, where groups may have any number of rows: those above `hot` rows are
    spread over tasks. What is joined to the rows is a row per hot group."""
    keys = ["pv", "bucket", "comp"] if vector else ["pv", "bucket"]
    plain = vector_stats if vector else scalar_stats
    large = stored(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select(*keys), "hot")
    if large.isEmpty():
        return plain(rows)
    few = F.broadcast(large)  # a row for every `hot` rows at most
    return plain(rows.join(few, keys, "left_anti")).unionByName(spread_stats(rows.join(few, keys, "left_semi"), keys, vector, blocks, most))

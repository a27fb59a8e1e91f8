"""The statistics of a signal per bucket.

Order-dependent and order-free statistics share one partitioning, (pv, bucket), so a batch costs one exchange. Within it rows
are sorted by arrival, and for the exact medians by value, deviation and interval: sorts spill, where a median of all values
in memory would not. NaN becomes null before it is aggregated. Scalar signals drop NaN before they are differenced, vector signals
difference raw neighbours; vectors also leave infinities out of the order-free statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALUE_STATS = ["min", "max", "mean", "std", "skewness", "kurtosis", "snr", "cv", "mad", "rate_of_change", "rate_of_change_variance", "peaks"]
TIME_STATS = ["sampling_frequency", "avg_interval", "median_interval", "jitter", "interval_variance", "max_interval", "duration", "start_time", "end_time"]


def _no_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def _value_stats(x: Column, moments: Column, guard: Column) -> list[Column]:
    """Order-free statistics over x; moments: the values that skewness and kurtosis see."""
    std, mean = F.stddev_pop(x), F.avg(x)
    return [
        F.min(x).alias("min"), F.max(x).alias("max"), mean.alias("mean"), std.alias("std"),
        F.when(guard, F.skewness(moments)).alias("skewness"), F.when(guard, F.kurtosis(moments) + 3).alias("kurtosis"),
        F.try_divide(mean, F.nullif(std, F.lit(0.0))).alias("snr"), F.try_divide(std, F.abs(F.nullif(mean, F.lit(0.0)))).alias("cv"),
    ]


def _middle(c: str, keys: list[str]) -> Column:
    """Whether a row has the middle value, or one of the two middle ones, of the values of c in its group."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(c).asc_nulls_last()))
    n = F.count(c).over(Window.partitionBy(*keys))
    return (place == F.floor((n + 1) / 2)) | (place == F.floor(n / 2) + 1) & (n > 0)


def _with_medians(rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Adds _dev, the deviations of `value` from its median, and _mid_dev and _mid_dt, which mark the middle rows of _dev and
    _dt: an average over them is the median."""
    rows = rows.withColumn("_mid", _middle(value, keys))
    rows = rows.withColumn("_dev", F.abs(F.col(value) - F.avg(F.when(F.col("_mid"), F.col(value))).over(Window.partitionBy(*keys))))
    return rows.withColumn("_mid_dev", _middle("_dev", keys)).withColumn("_mid_dt", _middle("_dt", keys))


def _median(c: str, mark: str) -> Column:
    return F.avg(F.when(F.col(mark), F.col(c)))


#: Rows of a group up to which variances of differences are added up in order of arrival, one after the other.
_FEW = 256


def _variance_in_order(values: Column) -> Column:
    """The population variance of an array, by Welford's update from the first value to the last, to the last bit as an engine
    has it that takes a group's rows in order. Of few values the exact variance may lie halfway between two roundings; then
    that bit, which F.var_pop() has by the order in which rows come, tells which one is found."""

    def add(a: Column, x: Column) -> Column:
        n = a["n"] + 1
        mean = a["mean"] + (x - a["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + (x - mean) * (x - a["mean"])).alias("m2"))

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "mean", "m2")])
    return F.aggregate(values, zero, add, lambda a: F.when(a["n"] > 0, a["m2"] / a["n"]))


def _time_stats(order: tuple[str, ...] = ("seq",)) -> list[Column]:
    """Seconds from _dt and offset_ms, which are in ms: whole numbers of ms add up exactly."""
    many, mean, at = F.count("*") > 1, F.avg("_dt") / 1000.0, F.struct(*order)
    span = F.when(many, (F.max_by("offset_ms", at) - F.min_by("offset_ms", at)) / 1000.0).otherwise(0.0)
    return [
        F.when(mean > 0, 1 / mean).alias("sampling_frequency"), mean.alias("avg_interval"), (_median("_dt", "_mid_dt") / 1000.0).alias("median_interval"), (F.stddev_pop("_dt") / 1000.0).alias("jitter"),
        (F.var_pop("_dt") / 1e6).alias("interval_variance"), (F.max("_dt") / 1000.0).alias("max_interval"), span.alias("duration"), F.lit(0.0).alias("start_time"), span.alias("end_time"),
    ]


def scalar_stats(bucketed: DataFrame, extra_keys: list[str] | None = None, by: tuple[str, ...] = ("seq",), more: list[Column] | None = None) -> DataFrame:
    """A row per (pv, bucket) of samples (pv, bucket, seq, offset_ms, x): length, nan_count, VALUE_STATS, TIME_STATS. by: the
    columns that order samples; more: further aggregates of the same groups."""
    keys = ["pv", "bucket", *(extra_keys or [])]
    order = Window.partitionBy(*keys).orderBy(*by)
    over = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(by)})"
    rows = bucketed.withColumn("_v", _no_nan(F.col("x")))
    rows = rows.withColumns({
        "_place": F.row_number().over(order),
        "_dt": F.col("offset_ms") - F.lag("offset_ms").over(order),
        "_before": F.expr(f"lag(_v, 1) IGNORE NULLS {over}"),
        "_after": F.expr(f"lead(_v, 1) IGNORE NULLS {over}"),
    })
    rows = _with_medians(rows, "_v", keys)
    d = F.col("_v") - F.col("_before")
    peak = (F.col("_v") > F.col("_before")) & (F.col("_v") > F.col("_after"))
    few = F.count("_v") >= 3
    first = F.sort_array(F.collect_list(F.when((F.col("_place") <= _FEW) & d.isNotNull(), F.struct(F.col("_place"), d.alias("d")))))
    variance = F.when(F.count("*") <= _FEW, _variance_in_order(first["d"])).otherwise(F.var_pop(d))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("length"), F.count_if(F.isnan("x")).alias("nan_count"), *_value_stats(F.col("_v"), F.col("_v"), few),
        _median("_dev", "_mid_dev").alias("mad"), F.avg(d).alias("rate_of_change"), variance.alias("rate_of_change_variance"), F.count_if(peak).alias("peaks"), *_time_stats(by), *(more or []),
    )


def vector_stats(components: DataFrame, extra_keys: list[str] | None = None, by: tuple[str, ...] = ("seq",), more: list[Column] | None = None) -> DataFrame:
    """A row per (pv, bucket, comp) of component rows (pv, bucket, seq, offset_ms, comp, x); by and more as in scalar_stats()."""
    keys = ["pv", "bucket", *(extra_keys or []), "comp"]
    order = Window.partitionBy(*keys).orderBy(*by)
    over = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(by)})"
    v = _no_nan(F.col("x"))
    finite = F.when(F.abs(v) < float("inf"), v)
    rows = components.withColumns({"_v": v, "_f": finite})
    rows = rows.withColumns({
        "_d": _no_nan(F.col("_v") - F.lag("_v").over(order)),
        "_dt": F.col("offset_ms") - F.lag("offset_ms").over(order),
        "_before": F.expr(f"lag(_v, 1) IGNORE NULLS {over}"),
        "_after": F.expr(f"lead(_v, 1) IGNORE NULLS {over}"),
    })
    rows = _with_medians(rows, "_f", keys)
    peak = (F.col("_v") > F.col("_before")) & (F.col("_v") > F.col("_after"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("length"), F.count_if(F.isnan("x")).alias("nan_count"), *_value_stats(F.col("_f"), F.col("_v"), F.lit(True)),
        _median("_dev", "_mid_dev").alias("mad"), F.avg("_d").alias("rate_of_change"), F.var_pop("_d").alias("rate_of_change_variance"), F.count_if(peak).alias("peaks"), *_time_stats(by), *(more or []),
    )


def pack_vector(stats: DataFrame, extra_keys: list[str] | None = None, arrays: list[str] | None = None, more: list[Column] | None = None) -> DataFrame:
    """A row per (pv, bucket) with every value statistic as an array by component. arrays: further columns to pack so; more:
    further aggregates over the components."""
    keys, cols = ["pv", "bucket", *(extra_keys or [])], ["nan_count", *VALUE_STATS, *(arrays or [])]
    rows = F.sort_array(F.collect_list(F.struct("comp", *cols)))
    packed = stats.groupBy(*keys).agg(rows.alias("_r"), *[F.first(c).alias(c) for c in ("length", *TIME_STATS)], *(more or []))
    return packed.select(*[c for c in packed.columns if c not in ("_r", "length", *TIME_STATS)], "length", *[F.col(f"_r.{c}").alias(c) for c in cols], *TIME_STATS)

"""Queries of signal statistics (A*) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.buckets import gather_payload
from ..operators.hot_stats import balanced_stats
from ..operators.stats import pack_vector, scalar_stats, vector_stats
from .tables import COMPONENTS_SQL, components, scalar_samples, scalar_sql

#: Digits that both sides round to (None: exact); variances of large numbers keep fewer, so that no exact value lies halfway.
DIGITS = {
    "length": None, "nan_count": None, "min": None, "max": None, "mean": 6, "std": 6, "skewness": 6, "kurtosis": 5, "snr": 5, "cv": 6, "mad": 6, "rate_of_change": 6, "rate_of_change_variance": 1,
    "peaks": None, "sampling_frequency": None, "avg_interval": None, "median_interval": None, "jitter": 3, "interval_variance": -3, "max_interval": None, "duration": None, "start_time": None, "end_time": None,
}


def stats_sql(base: str, keys: str, scalar: bool) -> str:
    """All statistics in SQL over s (keys, seq, offset_ms, v, is_nan)."""
    step = "v - lag(v IGNORE NULLS) OVER o" if scalar else "v - lag(v) OVER o"
    guard = "count(v) >= 3" if scalar else "TRUE"
    return f"""WITH {base},
w AS (
  SELECT *, offset_ms - lag(offset_ms) OVER o AS dt, {step} AS d,
         lag(v IGNORE NULLS) OVER o AS pb, lead(v IGNORE NULLS) OVER o AS pa, median(v) OVER g AS mid, avg(v) OVER g AS mu, stddev_pop(v) OVER g AS sd
  FROM s WINDOW o AS (PARTITION BY {keys} ORDER BY seq), g AS (PARTITION BY {keys})),
st AS (
  SELECT {keys}, count(*) AS length, count(*) FILTER (WHERE is_nan) AS nan_count, min(v) AS "min", max(v) AS "max", avg(v) AS mean, stddev_pop(v) AS std,
         CASE WHEN {guard} THEN avg(power((v - mu) / nullif(sd, 0), 3)) END AS skewness, CASE WHEN {guard} THEN avg(power((v - mu) / nullif(sd, 0), 4)) END AS kurtosis,
         avg(v) / nullif(stddev_pop(v), 0) AS snr, stddev_pop(v) / abs(nullif(avg(v), 0)) AS cv, median(abs(v - mid)) AS mad,
         avg(d) AS rate_of_change, var_pop(d) AS rate_of_change_variance, count(*) FILTER (WHERE v > pb AND v > pa) AS peaks,
         CASE WHEN avg(dt) > 0 THEN 1 / (avg(dt) / 1000) END AS sampling_frequency, avg(dt) / 1000 AS avg_interval, median(dt) / 1000 AS median_interval, stddev_pop(dt) / 1000 AS jitter,
         var_pop(dt) / 1e6 AS interval_variance, max(dt) / 1000 AS max_interval,
         CASE WHEN count(*) > 1 THEN (arg_max(offset_ms, seq) - arg_min(offset_ms, seq)) / 1000 ELSE 0 END AS duration, CAST(0 AS DOUBLE) AS start_time,
         CASE WHEN count(*) > 1 THEN (arg_max(offset_ms, seq) - arg_min(offset_ms, seq)) / 1000 ELSE 0 END AS end_time
  FROM w GROUP BY {keys})"""


def _round(name: str, digits: dict = DIGITS):
    """As SQL rounds: the scaled double to a whole number. F.round() goes by the decimal digits of the double, which end halfway
    where the scaled double may not."""
    d = digits[name]
    if d is None:
        return F.col(name)
    scale = F.lit(10.0 ** abs(d))
    return (F.round(F.col(name) * scale) / scale if d >= 0 else F.round(F.col(name) / scale) * scale).alias(name)


def _round_sql(name: str, digits: dict = DIGITS) -> str:
    d = digits[name]
    return f'"{name}"' if d is None else f'round("{name}", {d}) AS "{name}"'


SCALAR = {
    "a01_length": ["length"], "a02_nan_count": ["nan_count"], "a03_min_max": ["min", "max"], "a04_mean": ["mean"], "a05_std": ["std"], "a06_skewness": ["skewness"], "a07_kurtosis": ["kurtosis"],
    "a08_snr": ["snr"], "a09_cv": ["cv"], "a10_mad": ["mad"], "a11_rate_of_change": ["rate_of_change"], "a12_rate_of_change_variance": ["rate_of_change_variance"], "a13_peaks": ["peaks"],
    "a14_sampling_frequency": ["sampling_frequency"], "a15_avg_interval": ["avg_interval"], "a16_median_interval": ["median_interval"], "a17_jitter": ["jitter"],
    "a18_interval_variance": ["interval_variance"], "a19_max_interval": ["max_interval"], "a20_duration": ["duration", "start_time", "end_time"],
}
VECTOR = ["length", "avg_interval", "median_interval", "max_interval", "duration", "nan_count", "min", "max", "mean", "std", "skewness", "kurtosis", "snr", "mad", "rate_of_change", "rate_of_change_variance", "peaks"]


def build() -> dict:
    out = {}
    for name, cols in SCALAR.items():
        def run(spark, sf_dir, cols=cols):
            return scalar_stats(scalar_samples(spark, sf_dir)).select("pv", "bucket", *map(_round, cols))

        out[name] = run, f"{stats_sql(scalar_sql(), 'pv, bucket', True)} SELECT pv, bucket, {', '.join(map(_round_sql, cols))} FROM st"
    out["a00_all_scalar_stats"] = (
        lambda spark, d: scalar_stats(scalar_samples(spark, d)).select("pv", "bucket", *map(_round, DIGITS)),
        f"{stats_sql(scalar_sql(), 'pv, bucket', True)} SELECT pv, bucket, {', '.join(map(_round_sql, DIGITS))} FROM st",
    )
    out["a03_vector_stats"] = (
        lambda spark, d: vector_stats(components(spark, d)).select("pv", "bucket", "comp", *map(_round, VECTOR)),
        f"{stats_sql(COMPONENTS_SQL, 'pv, bucket, comp', False)} SELECT pv, bucket, comp, {', '.join(map(_round_sql, VECTOR))} FROM st",
    )

    def packed(spark, sf_dir):
        p = pack_vector(vector_stats(components(spark, sf_dir)))
        return p.select("pv", "bucket", "length", F.size("mean").alias("width"), F.array_join("peaks", ",").alias("peaks"), F.array_join("nan_count", ",").alias("nan_counts"), F.round(F.element_at("mean", 1), 6).alias("first_mean"), F.round(F.element_at("mean", -1), 6).alias("last_mean"))

    out["a21_vector_packing"] = packed, f"""{stats_sql(COMPONENTS_SQL, 'pv, bucket, comp', False)}
SELECT pv, bucket, max(length) AS length, CAST(count(*) AS INTEGER) AS width, string_agg(CAST(peaks AS VARCHAR), ',' ORDER BY comp) AS peaks, string_agg(CAST(nan_count AS VARCHAR), ',' ORDER BY comp) AS nan_counts,
       round(arg_min(mean, comp), 6) AS first_mean, round(arg_max(mean, comp), 6) AS last_mean FROM st GROUP BY pv, bucket"""

    def gathered(spark, sf_dir):
        g = gather_payload(scalar_samples(spark, sf_dir))
        return g.select("pv", "bucket", F.posexplode(F.arrays_zip("times", "vals")).alias("i", "r")).select("pv", "bucket", "i", F.round("r.times", 3).alias("t"), F.when(~F.isnan("r.vals"), F.col("r.vals")).alias("x"))

    out["a22_gather_payload"] = gathered, f"WITH {scalar_sql()} SELECT pv, bucket, CAST(row_number() OVER (PARTITION BY pv, bucket ORDER BY seq) - 1 AS INTEGER) AS i, round(offset_ms / 1000.0, 3) AS t, v AS x FROM s"

    def empty(spark, sf_dir):
        s = scalar_samples(spark, sf_dir)
        gone = s.withColumn("x", F.when(F.col("pv").cast("int") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("x")))
        return scalar_stats(gone).select("pv", "bucket", "length", "min", "max", _round("mean"), _round("mad"), "peaks")

    months = DIGITS | {"mean": 9, "rate_of_change": 9}  # means of 64 or 128 values end there

    def hot(spark, sf_dir):
        """One signal has half of all rows of a month; groups above 500 rows are spread."""
        s = scalar_samples(spark, sf_dir, "month").withColumn("pv", F.when(F.col("seq") % 2 == 0, "hot").otherwise(F.col("pv")))
        return balanced_stats(s, hot=500, most=200).select("pv", "bucket", *[_round(c, months) for c in DIGITS])

    half = scalar_sql("month").replace("CAST(user_id AS VARCHAR)", "CASE WHEN event_id % 2 = 0 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END")
    out["a24_hot_signal"] = hot, f"{stats_sql(half, 'pv, bucket', True)} SELECT pv, bucket, {', '.join(_round_sql(c, months) for c in DIGITS)} FROM st"

    base = scalar_sql().replace("WHEN event_id % 11 = 0 THEN NULL", "WHEN event_id % 11 = 0 OR user_id % 3 = 0 THEN NULL")
    out["a23_empty_input"] = empty, f"""{stats_sql(base, 'pv, bucket', True)} SELECT pv, bucket, length, "min", "max", {_round_sql('mean')}, {_round_sql('mad')}, peaks FROM st"""
    return out

"""Buckets, segments, chunks and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import absolute_ms, bucket_key
from ..sources.shared import stored


def bucketize(samples: DataFrame, granularity: str = "day", tz_hours: float = 0) -> DataFrame:
    """Adds the calendar bucket, whatever the order of arrival."""
    return samples.withColumn("bucket", bucket_key(absolute_ms(F.col("t0"), F.col("offset_ms")), granularity, tz_hours))


def segment_runs(bucketed: DataFrame, block: int = 1_000_000) -> DataFrame:
    """Adds segment, from 1 within (pv, bucket): a new one whenever the bucket changes in order of arrival. Changes are found
    within blocks of seq and the blocks' edges are stitched, so that a signal with very many samples is many groups; what a
    signal's window runs over is a row per block or per run. Samples that share a seq are taken in order of bucket and are in one
    run, that which begins last among them."""
    inside, upto = Window.partitionBy("pv", "_block").orderBy("seq", "bucket"), Window.partitionBy("pv", "_block").orderBy("seq")
    rows = bucketed.withColumn("_block", F.floor(F.col("seq") / block))
    rows = rows.withColumn("_in", F.coalesce((F.col("bucket") != F.lag("bucket").over(inside)).cast("long"), F.lit(0)))
    rows = rows.withColumn("_in", F.sum("_in").over(upto.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    at = F.struct("seq", "bucket")
    edges = rows.groupBy("pv", "_block").agg(F.min_by("bucket", at).alias("first"), F.max_by("bucket", at).alias("last"), F.max("_in").alias("n"))
    blocks = Window.partitionBy("pv").orderBy("_block")
    edges = edges.withColumn("_new", F.coalesce((F.col("first") != F.lag("last").over(blocks)).cast("long"), F.lit(1)))
    before = F.sum(F.col("n") + F.col("_new")).over(blocks.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select("pv", "_block", (F.coalesce(before, F.lit(0)) + F.col("_new")).alias("_base"))
    placed = rows.join(edges, ["pv", "_block"]).withColumn("_run", F.col("_base") + F.col("_in")).drop("_block", "_in", "_base")
    runs = placed.select("pv", "bucket", "_run").distinct()
    runs = runs.withColumn("segment", F.row_number().over(Window.partitionBy("pv", "bucket").orderBy("_run")))
    return placed.join(runs, ["pv", "bucket", "_run"]).select(*bucketed.columns, "segment")


def chunk_samples(bucketed: DataFrame, rows_per_chunk: int) -> DataFrame:
    """Adds chunk, from 1 within (pv, bucket), of rows_per_chunk samples in order of arrival."""
    place = F.row_number().over(Window.partitionBy("pv", "bucket").orderBy("seq"))
    return bucketed.withColumn("chunk", F.floor((place - 1) / rows_per_chunk).cast("int") + 1)


def is_monotonic(bucketed: DataFrame) -> DataFrame:
    """pv, bucket, monotonic: no sample is earlier than the one that arrived before it."""
    w = Window.partitionBy("pv", "bucket").orderBy("seq")
    step = bucketed.withColumn("_d", F.col("offset_ms") - F.lag("offset_ms").over(w))
    return step.groupBy("pv", "bucket").agg(F.coalesce(F.bool_and(F.col("_d") >= 0), F.lit(True)).alias("monotonic"))


def sort_by_time(bucketed: DataFrame) -> DataFrame:
    """pv, bucket, times (ms), vals: payload arrays in order of time, ties in order of arrival."""
    rows = F.array_sort(F.collect_list(F.struct("offset_ms", "seq", "x")))
    return bucketed.groupBy("pv", "bucket").agg(rows.alias("_r")).select("pv", "bucket", F.col("_r.offset_ms").alias("times"), F.col("_r.x").alias("vals"))


def gather_payload(bucketed: DataFrame) -> DataFrame:
    """pv, bucket, times (s), vals: payload arrays in order of arrival; for sinks only."""
    rows = F.array_sort(F.collect_list(F.struct("seq", "offset_ms", "x")))
    out = bucketed.groupBy("pv", "bucket").agg(rows.alias("_r"))
    return out.select("pv", "bucket", F.transform("_r", lambda r: r["offset_ms"] / 1000.0).alias("times"), F.col("_r.x").alias("vals"))


def top_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key by order; without keys a sorted limit."""
    if not keys:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


def assign_bundles(files: DataFrame, key: str, size: int) -> DataFrame:
    """Adds bundle: consecutive groups of `size` rows in order of key (unique). The rank is the place in a range partition
    plus the sizes of the partitions before it, so no partition holds all rows; what is summed over is one row per
    partition. Range bounds come from a sample, so the partitioned rows are stored once."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(files.repartitionByRange(n, key).withColumn("_p", F.spark_partition_id()), "ranged")
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_p").agg(F.count("*").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(key)))
    return placed.join(starts, "_p").withColumn("bundle", F.floor((F.col("_before") + F.col("_i") - 1) / size).cast("int")).drop("_p", "_i", "_before")

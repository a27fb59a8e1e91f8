"""Sinks: archives, chunks, wide tables, reports, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def write_archive(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Snappy Parquet without dictionaries, a folder per date and shape."""
    df.write.mode(mode).option("compression", "snappy").option("parquet.enable.dictionary", "false").partitionBy("date", "shape").parquet(path)


def write_records(found: dict[str, DataFrame], path: str, mode: str = "append") -> None:
    """Records by shape, as an archive whose files have the schema of their shape. Rows of a day are dealt to as many files as their
    bytes need."""
    for shape, df in found.items():
        write_archive(df.withColumn("shape", F.lit(shape)).hint("rebalance", "date"), path, mode)


def replace_days(df: DataFrame, path: str) -> None:
    """Overwrites only the partitions that df has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def rebuild_catalog(files: DataFrame, path: str) -> None:
    """Replaces the whole snapshot of the catalog (path, size, mtime)."""
    files.select("path", "size", "mtime").write.mode("overwrite").parquet(path)


def write_chunks(df: DataFrame, path: str, existing: DataFrame | None = None) -> None:
    """Chunks (pv, bucket, chunk, ...), numbered on from the highest that existing (pv, bucket, chunk) has."""
    if existing is not None:
        top = existing.groupBy("pv", "bucket").agg(F.max("chunk").alias("_top"))
        df = df.join(top, ["pv", "bucket"], "left").withColumn("chunk", F.col("chunk") + F.coalesce("_top", F.lit(0))).drop("_top")
    df.write.mode("append").option("compression", "snappy").parquet(path)


def wide_columns(df: DataFrame, nval: int, vals: str = "vals", name: str = "value") -> DataFrame:
    """timestamp_s and value, or value_0 to value_n."""
    cols = [F.col(vals)[i].alias(name if nval == 1 else f"{name}_{i}") for i in range(nval)]
    return df.select((F.col("offset_ms") / 1000.0).alias("timestamp_s"), *cols)


def export_wide(df: DataFrame, path: str, nval: int, vals: str = "vals", name: str = "value") -> None:
    wide_columns(df, nval, vals, name).write.option("sep", "\t").option("header", "true").csv(path)


def report(progress: DataFrame, months: DataFrame, summaries: DataFrame, retry: DataFrame, all_time: DataFrame, recent: int = 5) -> DataFrame:
    """One row: progress, available_months, months (an array of month, days, totals), summaries (the `recent` latest by
    event_ts), retry (of one run, null without) and all_time. Nothing in it grows with the number of inputs; months do with the
    calendar only."""
    row = lambda df, name: df.select(F.struct(*df.columns).alias(name))
    listed = months.agg(F.array_sort(F.collect_list(F.struct("month", *[c for c in months.columns if c != "month"]))).alias("months"))
    latest = summaries.orderBy(F.col("event_ts").desc(), F.col("file").desc()).limit(recent)
    latest = latest.agg(F.reverse(F.array_sort(F.collect_list(F.struct("event_ts", "file", *[c for c in summaries.columns if c not in ("event_ts", "file")])))).alias("summaries"))
    one = row(progress, "progress").join(listed.withColumn("available_months", F.col("months.month"))).join(latest).join(row(all_time, "all_time"))  # one row each
    return one.join(row(retry, "retry"), F.lit(True), "left").select("progress", "available_months", "months", "summaries", "retry", "all_time")


def export_report_json(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def write_manifests(files: DataFrame, path: str) -> None:
    """A folder per date with the sorted paths of files (date, path), one per line."""
    files.repartition("date").sortWithinPartitions("date", "path").write.partitionBy("date").text(path)


def oversize_lines(files: DataFrame, limit: int) -> DataFrame:
    """One text column: inputs over the size limit."""
    big = files.where(F.col("size") > limit)
    return big.select(F.format_string("%s\t%d bytes\t%.2f MB", "path", "size", F.col("size") / 1e6).alias("value"))


def oversize_report(files: DataFrame, path: str, limit: int) -> None:
    oversize_lines(files, limit).write.text(path)

"""Structured Streaming forms of sample and log processing. All run to the end of what is there with one_shot()."""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.logs import file_status, last_status, log_events, resolved_events
from ..operators.merge import dedupe_keep_last, last_by
from ..operators.stats import scalar_stats
from ..sources.commits import append_promoted, read_table, replace_part
from ..sources.readers import first_headers, header_lines, in_order, raw_lines, sample_lines
from ..sources.shared import stored

SAMPLE = "pv string, seq long, t0 long, offset_ms double, x double"


def stream_samples(spark: SparkSession, path: str, schema: str = SAMPLE, files_per_tick: int = 4) -> DataFrame:
    """New Parquet files of samples under path, each once (the checkpoint remembers), a few per tick."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_tick).parquet(path)


def stream_text(spark: SparkSession, path: str, files_per_tick: int = 4) -> DataFrame:
    """The raw lines of new sample text files under path."""
    return raw_lines(spark.readStream.option("maxFilesPerTrigger", files_per_tick).text(path))


def keep_lines(spark: SparkSession, folder: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function of stream_text(): the lines of each batch, as read_samples() gives them, in folder/lines/batch=n and the
    headers of its files in folder/headers/batch=n. A file is read in one batch; t0 and Nval that it lacks are those of the
    first file, by name, among the headers kept so far."""

    def each(batch: DataFrame, n: int) -> None:
        raw = in_order(batch)
        header_lines(raw).write.mode("overwrite").parquet(f"{folder}/headers/batch={n}")
        kept = spark.read.parquet(f"{folder}/headers").where(F.col("batch") <= n)
        sample_lines(raw, kept.where(F.col("batch") == n), *first_headers(kept)).write.mode("overwrite").parquet(f"{folder}/lines/batch={n}")

    return each


def with_time(samples: DataFrame) -> DataFrame:
    return samples.withColumn("ts", F.timestamp_millis((F.col("t0") + F.floor("offset_ms")).cast("long")))


def tumbling(samples: DataFrame, granularity: str = "day", tz_hours: int = 0, late: str = "1 day") -> DataFrame:
    """Algebraic statistics of each (pv, window): bucket, length, valid (values that are no NaN), min, max, mean, std. Samples
    later than `late` are left out and the state of windows that far back is freed. Months are no windows of Spark: there the watermark is
    on the months' ends, and a month's state is freed when a sample is `late` and 31 days beyond its end, so that two or three are
    kept."""
    v = F.when(~F.isnan("x"), F.col("x"))
    stats = [F.count("*").alias("length"), F.count(v).alias("valid"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std")]
    shift = F.make_dt_interval(hours=F.lit(tz_hours))
    if granularity == "month":
        ends = samples.withColumn("_end", F.add_months(F.trunc(F.col("ts") + shift, "month"), 1).cast("timestamp"))
        out = ends.withWatermark("_end", f"{late} 31 days").groupBy("pv", "_end").agg(*stats)
        return out.select("pv", F.date_format(F.date_sub("_end", 1), "yyyy_MM").alias("bucket"), "length", "valid", "min", "max", "mean", "std")
    starts = {"day": ("1 day", -tz_hours), "week": ("7 days", 4 * 24 - tz_hours)}
    size, start = starts[granularity]
    w = F.window("ts", size, size, f"{start % (24 if granularity == 'day' else 168)} hours")
    out = samples.withWatermark("ts", late).groupBy("pv", w.alias("w")).agg(*stats)
    local = F.date_from_unix_date(F.floor((F.unix_seconds("w.start") + tz_hours * 3600) / 86400).cast("int"))
    return out.select("pv", F.date_format(local, "yyyy_MM_dd").alias("bucket"), "length", "valid", "min", "max", "mean", "std")


def months_of(days: DataFrame) -> DataFrame:
    """The same columns by month, from those of days."""
    whole = days.groupBy("pv", F.substring("bucket", 1, 7).alias("bucket")).agg(
        F.sum("length").alias("length"), F.sum("valid").alias("valid"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.try_divide(F.sum(F.col("mean") * F.col("valid")), F.sum("valid")).alias("mean"), F.try_divide(F.sum((F.col("std") * F.col("std") + F.col("mean") * F.col("mean")) * F.col("valid")), F.sum("valid")).alias("square"),
    )
    return whole.withColumn("std", F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0)))).drop("square")


def keep_updates(root: str, keys: list[str], compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """foreachBatch function of an update-mode aggregate: commits each batch's changed rows to the table at root and puts them
    together every `compact_every` batches. The last batch counts; one that is run again commits the same rows again."""

    def each(batch: DataFrame, n: int) -> None:
        new = batch.withColumn("batch", F.lit(n))
        if (n + 1) % compact_every:
            append_promoted(new, root)
        else:
            old = read_table(batch.sparkSession, root)
            replace_part(last_by(new if old is None else old.unionByName(stored(new, "batch")), keys, ["batch"]), root)

    return each


def latest_updates(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The last row of each key that keep_updates() kept."""
    return last_by(read_table(spark, root), keys, ["batch"]).drop("batch")


def one_shot(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None, path: str | None = None, mode: str = "append") -> None:
    """Runs the stream once over all that is there: into each(batch, id), or as Parquet under path."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(path)
    query.awaitTermination()


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("pv"), F.lit(slots)).cast("int").alias("slot")


def _in_order(rows: Iterator[pd.DataFrame], columns: list[str]) -> tuple[list[tuple[str, int, int]], pd.DataFrame]:
    """The rows of a slot in order of pv and seq, and the (pv, from, to) of each PV in them."""
    found = pd.concat([r[["pv", "seq", *columns]] for r in rows], ignore_index=True)
    code, names = pd.factorize(found["pv"])
    place = np.lexsort((found["seq"].to_numpy(), code))
    starts = np.flatnonzero(np.diff(code[place], prepend=-1)).tolist()
    return [(names[i], a, b) for i, (a, b) in enumerate(itertools.pairwise([*starts, len(found)]))], found.take(place)


class SegmentRuns(StatefulProcessor):
    """Strict order: a new segment of a PV whenever its bucket changes in order of arrival. State: last bucket, run number and
    seq of each PV. A sample that comes in a later batch than one with a higher seq is late: it gets no run and doesn't change the state.
    Keys are slots of PVs, whose state is read and written as one list, so that frames and calls of a batch are as many as slots
    and not as PVs."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", "pv string, bucket string, run int, seq long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, found = _in_order(rows, ["bucket"])
        buckets, seqs, runs = found["bucket"].tolist(), found["seq"].tolist(), []
        last = {r[0]: tuple(r[1:]) for r in self.last.get()}
        for pv, start, stop in parts:
            bucket, run, seq = last.get(pv, (None, 0, None))
            first = start if seq is None else bisect.bisect_right(seqs, seq, start, stop)
            runs += [0] * (first - start)
            for i in range(first, stop):
                if buckets[i] != bucket:
                    bucket, run = buckets[i], run + 1
                runs.append(run)
            if first < stop:
                last[pv] = (bucket, run, seqs[stop - 1])
        self.last.put([(pv, *v) for pv, v in last.items()])
        run = np.array(runs, dtype="int32")
        yield found[["pv", "bucket", "seq"]].assign(run=run, late=run == 0)

    def close(self) -> None:
        pass


def strict_segments(bucketed: DataFrame, slots: int = 1024) -> DataFrame:
    """pv, bucket, seq, run, late of a stream of (pv, bucket, seq), by PV; keyed by slot, a hash of the PV. Late samples have run 0;
    where("late") is the side output. Needs a state store that transformWithState knows (RocksDB)."""
    rows = bucketed.select(_slot(slots), "pv", "bucket", "seq")
    return rows.groupBy("slot").transformWithStateInPandas(SegmentRuns(), "pv string, bucket string, seq long, run int, late boolean", "Append", "None")


class OpenBuckets(StatefulProcessor):
    """Late samples with at most `most` open buckets a PV. A sample goes to its bucket, which it opens if need be; if more than `most`
    are then open, the one whose latest sample (by arrival) has the least time is flushed, of equal ones that opened first. A bucket that comes
    again is opened anew. State: the open buckets with their statistics so far; samples are not kept. With idle_ms, a PV
    without samples for so long (by processing time) has all its buckets flushed."""

    FIELDS = ("last", "opened", "length", "valid", "total", "min", "max")

    def __init__(self, most: int = 1, idle_ms: int = 0):
        self.most, self.idle_ms = max(1, most), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "bucket string", "last double, opened long, length long, valid long, total double, min double, max double")

    def _replay(self, open_: dict[str, dict], buckets: list, seqs: list, ats: list, xs: list) -> list[tuple[str, dict, bool]]:
        """Takes the samples of a PV, which are in order of arrival, into its open buckets; gives what was flushed or is still open."""
        flushed, touched = [], set()
        for bucket, seq, at, x in zip(buckets, seqs, ats, xs, strict=True):
            b = open_.get(bucket)
            touched.add(bucket)
            if b is None:
                b = open_[bucket] = {"last": 0.0, "opened": seq, "length": 0, "valid": 0, "total": 0.0, "min": None, "max": None}
            b["last"], b["length"] = at, b["length"] + 1
            if x == x:
                b["valid"], b["total"] = b["valid"] + 1, b["total"] + x
                b["min"] = x if b["min"] is None or x < b["min"] else b["min"]
                b["max"] = x if b["max"] is None or x > b["max"] else b["max"]
            if len(open_) > self.most:
                victim = min(open_, key=lambda k: (open_[k]["last"], open_[k]["opened"]))
                flushed.append((victim, open_.pop(victim), False))
        return flushed + [(k, b, True) for k, b in open_.items() if k in touched]

    def _rows(self, told: list[tuple[str, list[tuple[str, dict, bool]]]]) -> pd.DataFrame:
        out = [(pv, bucket, b["opened"], b["length"], b["valid"], b["total"] if b["valid"] else None, b["min"], b["max"], still) for pv, flushed in told for bucket, b, still in flushed]
        frame = pd.DataFrame(out, columns=["pv", "bucket", "opened", "length", "valid", "total", "min", "max", "open"])
        return frame.astype({"total": "float64", "min": "float64", "max": "float64"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        open_ = {k[0]: dict(zip(self.FIELDS, v, strict=True)) for k, v in self.open.iterator()}
        found = pd.concat([r[["bucket", "seq", "at", "x"]] for r in rows]).sort_values("seq", kind="stable")
        flushed = self._replay(open_, *[found[c].tolist() for c in ("bucket", "seq", "at", "x")])
        self.open.clear()
        for k, b in open_.items():
            self.open.updateValue((k,), tuple(b[f] for f in self.FIELDS))
        if self.idle_ms:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._rows([(key[0], flushed)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone = [(k[0], dict(zip(self.FIELDS, v, strict=True)), False) for k, v in self.open.iterator()]
        self.open.clear()
        yield self._rows([(key[0], gone)])

    def close(self) -> None:
        pass


class SlotBuckets(OpenBuckets):
    """OpenBuckets without timers, keyed by slots of PVs, whose state (the open buckets of each PV) is read and written as one list, so
    that frames and calls of a batch are as many as slots and not as PVs."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", "pv string, bucket string, last double, opened long, length long, valid long, total double, min double, max double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, found = _in_order(rows, ["bucket", "at", "x"])
        columns, kept = [found[c].tolist() for c in ("bucket", "seq", "at", "x")], {}
        for pv, bucket, *values in self.kept.get():
            kept.setdefault(pv, {})[bucket] = dict(zip(self.FIELDS, values, strict=True))
        told = [(pv, self._replay(kept.setdefault(pv, {}), *[c[start:stop] for c in columns])) for pv, start, stop in parts]
        self.kept.put([(pv, k, *[b[f] for f in self.FIELDS]) for pv, open_ in kept.items() for k, b in open_.items()])
        yield self._rows(told)


FLUSH = "pv string, bucket string, opened long, length long, valid long, total double, min double, max double, open boolean"


def open_buckets(bucketed: DataFrame, most: int = 1, idle_ms: int = 0, slots: int = 1024) -> DataFrame:
    """A stream of flushes (FLUSH) of a stream of samples (pv, bucket, seq, t0, offset_ms, x), keyed by slot, a hash of the PV, or by
    PV if there are timers (idle_ms), which belong to a key; opened is the seq of the first sample. Samples of a batch are taken in order of seq, batches as they come: files must be read in order of arrival.
    Buckets still open after a batch that touched them are told with open = true; flushes_of() keeps the last word on each. Needs a state
    store that transformWithState knows (RocksDB)."""
    at = (F.col("t0") + F.col("offset_ms")).alias("at")
    rows = bucketed.select(_slot(slots), "pv", "bucket", "seq", at, F.when(~F.isnan("x"), F.col("x")).alias("x"))
    if idle_ms:
        return rows.drop("slot").groupBy("pv").transformWithStateInPandas(OpenBuckets(most, idle_ms), FLUSH, "Append", "ProcessingTime")
    return rows.groupBy("slot").transformWithStateInPandas(SlotBuckets(most), FLUSH, "Append", "None")


def flushes_of(rows: DataFrame) -> DataFrame:
    """One row a flush, and one for each bucket that is still open, from what open_buckets() wrote."""
    return last_by(rows.withColumn("_done", ~F.col("open")), ["pv", "bucket", "opened"], ["length", "_done"]).drop("_done")


def part_moments(samples: DataFrame) -> DataFrame:
    """pv, bucket and what the algebraic statistics of some samples are made of: length, nan_count, valid, min, max, mean and m2, the
    squared deviations summed."""
    v = F.when(~F.isnan("x"), F.col("x"))
    return samples.groupBy("pv", "bucket").agg(
        F.count("*").alias("length"), F.count_if(F.isnan("x")).alias("nan_count"), F.count(v).alias("valid"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
    )


def merged_moments(parts: DataFrame) -> DataFrame:
    """The moments of all samples from those of parts of them; applied to its own results, and in any order, it gives the same."""
    whole = Window.partitionBy("pv", "bucket")
    centre = F.sum(F.col("mean") * F.col("valid")).over(whole) / F.nullif(F.sum("valid").over(whole), F.lit(0))
    rows = parts.withColumn("_c", centre)
    return rows.groupBy("pv", "bucket").agg(
        F.sum("length").alias("length"), F.sum("nan_count").alias("nan_count"), F.sum("valid").alias("valid"), F.min("min").alias("min"), F.max("max").alias("max"), F.max("_c").alias("mean"),
        F.sum(F.col("m2") + F.col("valid") * (F.col("mean") - F.col("_c")) * (F.col("mean") - F.col("_c"))).alias("m2"),
    )


#: The statistics that algebraic_stats() has.
ADDED_UP = ("length", "nan_count", "min", "max", "mean", "std", "snr", "cv")


def algebraic_stats(parts: DataFrame) -> DataFrame:
    """A row per (pv, bucket): ADDED_UP."""
    m = merged_moments(parts).withColumn("std", F.sqrt(F.try_divide(F.col("m2"), F.col("valid"))))
    snr, cv = F.try_divide("mean", F.nullif("std", F.lit(0.0))), F.try_divide("std", F.abs(F.nullif("mean", F.lit(0.0))))
    return m.select("pv", "bucket", "length", "nan_count", "min", "max", "mean", "std", snr.alias("snr"), cv.alias("cv"))


def incremental_stats(spark: SparkSession, root: str, slots: int = 64) -> Callable[[DataFrame, int], None]:
    """foreachBatch function. Statistics that add up are kept as moments: a batch commits those of its own samples to root/moments and
    reads nothing. Statistics that depend on order are computed anew for the (pv, bucket) that the batch has samples of, and
    committed to root/ordered, without those that add up: samples lie by bucket and slot, a hash of their PV, so that a batch reads the slots of its own PVs.
    A batch that is run again writes the same folders and commits the same rows again; stats_now() takes the last of each batch."""
    samples, tasks = f"{root}/samples", spark.sparkContext.defaultParallelism
    own_keys = ["pv", "bucket"]

    def each(batch: DataFrame, n: int) -> None:
        if batch.isEmpty():
            return
        placed = batch.withColumns({"batch": F.lit(n), "slot": F.pmod(F.xxhash64("pv"), F.lit(slots)).cast("int")})
        # all cores write, each its own folders, however few the files of the batch
        placed.repartition(tasks, "bucket", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket", "slot").parquet(samples)
        kept = spark.read.schema(placed.schema).parquet(samples)
        new = kept.where(F.col("batch") == n)
        places = new.select("bucket", "slot").distinct().collect()  # of a calendar times `slots`
        append_promoted(part_moments(new).withColumn("batch", F.lit(n)), f"{root}/moments")
        table = kept.where(F.col("batch") <= n)
        table = table.where(F.col("bucket").isin([r.bucket for r in places]) & F.col("slot").isin([r.slot for r in places]))
        own = scalar_stats(table.join(new.select(*own_keys).distinct(), own_keys, "left_semi"))
        append_promoted(own.drop(*ADDED_UP).withColumn("batch", F.lit(n)), f"{root}/ordered")

    return each


def stats_now(spark: SparkSession, root: str) -> DataFrame:
    """All statistics of every (pv, bucket) as incremental_stats() keeps them."""
    parts = last_by(read_table(spark, f"{root}/moments"), ["pv", "bucket", "batch"], ["length"])
    algebraic = algebraic_stats(parts)
    ordered = last_by(read_table(spark, f"{root}/ordered"), ["pv", "bucket"], ["batch"]).drop("batch")
    return ordered.join(algebraic, ["pv", "bucket"])


def upsert_batches(spark: SparkSession, folder: str, key: str, order: list[str], part: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the table at folder, partitioned by the column `part`, holds the last row by order of each key in
    each partition, new rows before old ones where that ties. Only the partitions that a batch has rows of are read and
    overwritten; as the order decides, neither the order of batches nor a batch that is run again changes the result."""
    begun = []

    def each(batch: DataFrame, n: int) -> None:
        new = stored(batch.withColumn("_src", F.lit(1)), "batch")
        parts = [r[0] for r in new.select(part).distinct().collect()]  # of a calendar
        if not parts:
            return
        if n or begun:
            old = spark.read.schema(batch.schema).parquet(folder).where(F.col(part).isin(parts)).withColumn("_src", F.lit(0))
            new = new.unionByName(old)
        last = stored(dedupe_keep_last(new, [part, key], [*order, "_src"]).drop("_src"), "upsert")
        last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(folder)
        begun.append(n)

    return each


def live_ledger(spark: SparkSession, root: str, inputs: DataFrame, out_root: str, in_root: str, naming: str = "dated", compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the status of the inputs that log lines (file, line_no, line) tell of. A batch resolves the outputs
    that its own lines name and commits its file_status() to the table at root; as that can be put together in any order, the rule
    of the first event in a file holds over batches, and a batch that is run again changes nothing. Every `compact_every` batches the
    table is written anew, for readers by one commit. The inputs are stored once, not made by each batch; a batch's lines are dealt to
    all cores before they are parsed, however few its files."""
    inputs, tasks = stored(inputs, "inputs"), spark.sparkContext.defaultParallelism

    def each(batch: DataFrame, n: int) -> None:
        told = file_status(log_events(batch.repartition(tasks, "file", "line_no")))  # a row a log and target is what is stored and resolved
        state = file_status(resolved_events(told, inputs, out_root, in_root, naming))
        if (n + 1) % compact_every:
            append_promoted(state, root)
        else:
            old = read_table(spark, root)
            replace_part(state if old is None else file_status(old.unionByName(state)), root)

    return each


def ledger_now(spark: SparkSession, root: str) -> DataFrame:
    """target, status, message: the ledger that live_ledger() keeps."""
    return last_status(read_table(spark, root))

"""Job logs, as a table (file, line_no, line), turned into statuses, summaries and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import after_colon, base_name, parquet_path, parse_rss, parse_size, stem
from ..sources.shared import stored
from .catalog import resolve_outputs

#: Lines that show that a job wrote its summary (fixed texts of the log format).
SUMMARY_MARKERS = ["------ Chunk Summary ------", "------ Chunker Summary ------", "PV-chunk merge summary", "✅ Date ", "✅ PV unsplit"]
#: What a failure line holds or starts with (fixed texts of the log format).
FAILURE_PARTS = ["ERROR", "Failed to merge", "pb2tsv failed", "FAILED (pb2tsv)", "FAILED (convert/save)"]
FAILURE_STARTS = ["❌", "FAIL:", "FAILED"]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def file_kind(name: Column) -> Column:
    """small, big, legacy or other by the log's name."""
    return F.when(name.startswith("small_bundle_"), "small").when(name.startswith("big_chunk_"), "big").when(name.startswith("log_chunk_"), "legacy").otherwise("other")


def _target(text: Column) -> Column:
    """The first absolute .parquet or .pb path, else what follows the first colon up to a bracket."""
    found = F.regexp_extract(text, r"(/[^ \t()]+?\.(?:parquet|pb))", 1)
    rest = F.trim(F.regexp_replace(text, r"^[^:]*:", ""))
    return F.when(found != "", found).otherwise(F.regexp_replace(rest, r" +\(.*$", ""))


def log_events(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """file, line_no, status, target, message, and the columns in `keep`, of the lines that tell one; the first rule that fits
    counts."""
    ls = F.trim(F.col("line"))
    low = F.lower(ls)
    saved = low.rlike(r"^(saved|wrote|output):")
    chunk = low.rlike(r"^saved( final)? chunk:")
    merged = ls.startswith("✅ Merged") | F.contains(ls, F.lit("->")) | F.contains(ls, F.lit("→"))
    failed = ls.startswith("❌") | ls.startswith("FAIL:") | F.contains(ls, F.lit("pb2tsv failed")) | F.contains(ls, F.lit("FAILED"))
    skipped = ls.startswith("⚠️ Skipped:") | ls.startswith("SKIP:") | F.contains(ls, F.lit("SKIPPED (empty)"))
    status = F.when(saved, "success").when(chunk, "chunked").when(merged, "success").when(ls.startswith("✅ Date "), None).when(failed, "failed").when(skipped, "skipped")
    body = F.trim(F.regexp_replace(ls, r"^[^:]*:", ""))
    arrow = F.when(F.contains(ls, F.lit("→")), F.regexp_extract(ls, "→(.*)$", 1)).otherwise(F.regexp_extract(ls, "->(.*)$", 1))
    target = F.when(saved | chunk, _target(ls)).when(merged, _target(F.trim(arrow))).otherwise(_target(body))
    why = F.when(failed & F.contains(body, F.lit("-")), F.trim(F.regexp_replace(body, "^[^-]*-", ""))).when(failed, "failed")
    note = F.when(F.contains(body, F.lit("(")) & body.endswith(")"), F.regexp_extract(body, r"^[^(]*\((.*?)\)+$", 1)).otherwise("skipped")
    message = F.when(saved | chunk | merged, "").when(failed, why).otherwise(note)
    return lines.select("file", "line_no", status.alias("status"), target.alias("target"), message.alias("message"), *(keep or [])).where("status is not null")


def resolved_events(events: DataFrame, inputs: DataFrame, out_root: str, in_root: str, naming: str = "dated") -> DataFrame:
    """file, line_no, status, target (the input), message: events whose target is an input or the output of one; others tell
    nothing about inputs and are left out. The events are stored, as they are both resolved and returned."""
    events = stored(events, "events")
    found = resolve_outputs(events.select(F.col("target").alias("out")).distinct(), inputs, out_root, in_root, naming).where("path is not null")
    return events.join(found, F.col("target") == F.col("out")).select("file", "line_no", "status", F.col("path").alias("target"), "message")


def file_status(events: DataFrame) -> DataFrame:
    """file, target, line_no, status, message: the last event of each target in a file; a chunk line (then line_no is null) counts
    only if the file has no other event of the target. Parts of a file may be put together by applying it to their results."""
    told = F.max(F.when(F.col("status") != "chunked", F.struct("line_no", "status", "message"))).alias("r")
    per_file = events.groupBy("file", "target").agg(told)
    return per_file.select("file", "target", "r.line_no", F.coalesce("r.status", F.lit("chunked")).alias("status"), F.when(F.col("r").isNull(), "").otherwise(F.col("r.message")).alias("message"))


def last_status(events: DataFrame) -> DataFrame:
    """target, status, message: those of the last event of each target in order of file and line, as file_status() tells."""
    last = file_status(events).groupBy("target").agg(F.max_by(F.struct("status", "message"), "file").alias("r"))
    return last.select("target", "r.status", "r.message")


def is_failure(line: Column) -> Column:
    ls = F.trim(line)
    return _any([F.contains(ls, F.lit(t)) for t in FAILURE_PARTS] + [ls.startswith(t) for t in FAILURE_STARTS])


def extract_failures(lines: DataFrame) -> DataFrame:
    return lines.where(is_failure(F.col("line"))).select("file", "line_no", F.trim("line").alias("line"))


def failure_report(lines: DataFrame) -> DataFrame:
    """file, failures (its failure lines in order)."""
    found = extract_failures(lines).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return found.select("file", F.col("l.line").alias("failures"))


def _is_chunk(ls: Column) -> Column:
    return F.contains(ls, F.lit("SAVED CHUNK:")) | F.contains(ls, F.lit("SAVED FINAL CHUNK:"))


def _merge_kind(ls: Column) -> Column:
    return F.when(ls.startswith("✅ Merged "), "pv_merged").when(ls.startswith("✅ Date "), "date_merged").when(ls.startswith("✅ Unsplit PV"), "unsplit_merged")


def job_facts(lines: DataFrame) -> DataFrame:
    """A row per log: submission, file, kind, started, ended, peak_gb, saved, chunks, pv_merges, date_merges, unsplit_merges,
    failures, input_bytes, has_marker. What a line tells depends on the kind of its log. Lines are read once, into a stored table of
    what each tells, so that the aggregate is one of plain columns."""
    ls, kind = F.trim(F.col("line")), F.col("kind")
    small, big, rest = kind == "small", kind == "big", kind.isin("legacy", "other")
    chunk = big & _is_chunk(ls)
    peak = F.when(small & ls.startswith("Peak RSS"), parse_size(after_colon(ls)) / 1024.0**3).when(chunk, parse_rss(ls))
    total = F.when(small & F.contains(ls, F.lit("Total .pb input size")), parse_size(after_colon(ls)))
    stamp = lambda a, b: F.when((small & ls.startswith(a)) | (big & ls.startswith(b)), after_colon(ls)).try_cast("timestamp_ntz")
    told = lines.withColumn("kind", file_kind(F.col("file"))).select(
        "submission", "file", "kind", stamp("Start time", "Started at").alias("started"), stamp("End time", "Finished at").alias("ended"), peak.alias("peak"), (small & ls.startswith("SAVED:")).alias("saved"), chunk.alias("chunk"),
        F.when(rest, _merge_kind(ls)).alias("merge"), is_failure(F.col("line")).alias("failure"), total.alias("total"), _any([F.contains(ls, F.lit(m)) for m in SUMMARY_MARKERS]).alias("marker"),
    )
    merges = [F.count_if(F.col("merge") == m).alias(n) for m, n in (("pv_merged", "pv_merges"), ("date_merged", "date_merges"), ("unsplit_merged", "unsplit_merges"))]
    return stored(told, "told").groupBy("submission", "file").agg(
        F.first("kind").alias("kind"), F.min("started").alias("started"), F.max("ended").alias("ended"), F.coalesce(F.max("peak"), F.lit(0.0)).alias("peak_gb"), F.count_if("saved").alias("saved"), F.count_if("chunk").alias("chunks"),
        *merges, F.count_if("failure").alias("failures"), F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("input_bytes"), F.bool_or("marker").alias("has_marker"),
    )


OUTPUT_KINDS = ["small_saved", "big_chunk", "pv_merged", "date_merged", "unsplit_merged"]


def output_bytes(lines: DataFrame, outputs: DataFrame) -> DataFrame:
    """submission and the bytes of the files that its lines name, by OUTPUT_KINDS: outputs (path, size) by path, and for lines
    of older logs, which name the input, by the file name that its output has."""
    ls, kind = F.trim(F.col("line")), file_kind(F.col("file"))
    what = F.when((kind == "small") & ls.startswith("SAVED:"), "small_saved").when((kind == "big") & _is_chunk(ls), "big_chunk").when(kind.isin("legacy", "other"), _merge_kind(ls))
    named = F.regexp_replace(base_name(F.regexp_replace(after_colon(ls), "^[\"']+|[\"']+$", "")), r"\.pb$", "")
    legacy = F.when(F.contains(ls, F.lit("SAVED:")) | F.contains(ls, F.lit("Saved:")), F.concat(F.replace(named, F.lit(":"), F.lit("-")), F.lit(".parquet")))
    rows = lines.select("submission", what.alias("what"), parquet_path(ls).alias("path"), legacy.alias("base")).where("what is not null").groupBy("submission", "what", "path", "base").agg(F.count("*").alias("n"))
    by_base = outputs.groupBy(base_name(F.col("path")).alias("base")).agg(F.min_by("size", "path").alias("base_size"))
    sized = rows.join(outputs.select("path", "size"), "path", "left").join(by_base, "base", "left").withColumn("bytes", F.col("n") * F.coalesce("size", "base_size", F.lit(0)))
    return sized.groupBy("submission").agg(*[F.coalesce(F.sum(F.when(F.col("what") == k, F.col("bytes"))), F.lit(0)).alias(k) for k in OUTPUT_KINDS])


def _mb(n: Column) -> Column:
    return F.round(n / (1024.0 * 1024.0), 2)


def submission_summary(facts: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row per submission: jobs by kind, counts, inputs by route, megabytes read and written (sizes as of output_bytes())."""
    kinds = [F.count_if(F.col("kind") == k).alias(f"{k}_jobs") for k in ("small", "big", "legacy", "other")]
    sums = [F.sum(c).alias(c) for c in ("saved", "chunks", "pv_merges", "date_merges", "unsplit_merges", "failures", "input_bytes")]
    per = facts.groupBy("submission").agg(*kinds, *sums).join(sizes, "submission", "left")
    parts = [F.coalesce(F.col(k), F.lit(0)) for k in OUTPUT_KINDS]
    megabytes = [_mb(F.col("input_bytes")).alias("input_mb"), _mb(reduce(lambda a, b: a + b, parts)).alias("output_mb"), *[_mb(p).alias(f"{k}_mb") for p, k in zip(parts, OUTPUT_KINDS, strict=True)]]
    return per.select("submission", *[f"{k}_jobs" for k in ("small", "big", "legacy", "other")], "saved", "chunks", "pv_merges", "date_merges", "unsplit_merges", "failures", F.col("saved").alias("small_pb"), F.col("big_jobs").alias("big_pb"), *megabytes)


def pv_examples(lines: DataFrame, n: int = 10) -> DataFrame:
    """submission, route, names: the first n different names of outputs (small) or inputs (big) by file and line."""
    ls, kind = F.trim(F.col("line")), file_kind(F.col("file"))
    small = F.when((kind == "small") & ls.startswith("SAVED:"), stem(parquet_path(ls)))
    big = F.when((kind == "big") & ls.startswith("PB file"), F.replace(stem(after_colon(ls)), F.lit(":"), F.lit("_")))
    rows = lines.select("submission", F.when(small.isNotNull(), "small").otherwise("big").alias("route"), F.coalesce(small, big).alias("name"), F.struct("file", "line_no").alias("at"), kind.alias("kind")).where("name != ''")
    last = rows.where("route = 'big'").groupBy("submission", "at.file").agg(F.max_by("name", "at").alias("name"), F.max("at").alias("at"))  # a big log's last one counts
    rows = rows.where("route = 'small'").select("submission", "route", "name", "at").unionByName(last.select("submission", F.lit("big").alias("route"), "name", "at"))
    firsts = rows.groupBy("submission", "route", "name").agg(F.min("at").alias("at"))
    placed = firsts.withColumn("i", F.row_number().over(Window.partitionBy("submission", "route").orderBy("at"))).where(F.col("i") <= n)
    return placed.groupBy("submission", "route").agg(F.array_sort(F.collect_list(F.struct("i", "name"))).alias("r")).select("submission", "route", F.col("r.name").alias("names"))


def wall_time(facts: DataFrame) -> DataFrame:
    """submission, seconds from the first start to the last end (null if either is missing), and as text."""
    out = facts.groupBy("submission").agg(F.min("started").alias("started"), F.max("ended").alias("ended"))
    seconds = F.unix_seconds(F.date_trunc("second", "ended").cast("timestamp")) - F.unix_seconds(F.date_trunc("second", "started").cast("timestamp"))
    minutes = F.floor(F.col("seconds") / 60)
    text = F.when(minutes != 0, F.format_string("%dm %ds", minutes, F.pmod("seconds", F.lit(60)))).otherwise(F.format_string("%ds", F.pmod("seconds", F.lit(60))))
    return out.select("submission", seconds.alias("seconds")).withColumn("text", F.when(F.col("seconds").isNotNull(), text))


def peak_memory(facts: DataFrame) -> DataFrame:
    return facts.groupBy("submission").agg(F.round(F.max("peak_gb"), 3).alias("peak_gb"), F.round(F.sum("peak_gb"), 3).alias("sum_of_peaks_gb"))


def fail_skip_counts(lines: DataFrame) -> DataFrame:
    s = F.ltrim(F.col("line"))
    fail = s.startswith("FAIL:") | F.contains(s, F.lit("❌ Failed"))
    skip = ~fail & (s.startswith("Skipped:") | s.startswith("⚠️ Skipped:"))
    return lines.groupBy("submission").agg(F.count_if(fail).alias("failed"), F.count_if(skip).alias("skipped"))


def jobs_and_inputs(lines: DataFrame) -> DataFrame:
    """submission, jobs (logs with a chunk summary), inputs (`Input files : n` after the marker, and `PB file :` lines)."""
    s = F.col("line")
    marker = F.contains(s, F.lit(SUMMARY_MARKERS[0]))
    other = F.contains(s, F.lit(SUMMARY_MARKERS[1]))
    before = Window.partitionBy("submission", "file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    seen = lines.withColumn("_seen", F.coalesce(F.bool_or(marker).over(before), F.lit(False)))
    files = F.regexp_extract(s, r"^\s*Input files\s*:\s*(\d+)", 1).try_cast("long")
    n = F.when(F.col("_seen") & ~marker, F.coalesce(files, F.lit(0))).otherwise(F.lit(0)) + F.when(~other & ~marker & s.rlike(r"^\s*PB file\s*:"), 1).otherwise(0)
    per_file = seen.groupBy("submission", "file").agg(F.bool_or(marker | other).alias("job"), F.sum(n).alias("inputs"))
    return per_file.groupBy("submission").agg(F.count_if("job").alias("jobs"), F.sum("inputs").cast("long").alias("inputs"))


def submission_complete(submissions: DataFrame, facts: DataFrame, files: DataFrame, now: str, minutes: int = 15) -> DataFrame:
    """submission, complete: it has logs, and every one has a marker or was last written over `minutes` ago. files:
    submission, file, mtime."""
    rows = files.join(facts.select("submission", "file", "has_marker"), ["submission", "file"], "left")
    old = F.col("mtime") < F.to_timestamp(F.lit(now)) - F.make_dt_interval(mins=F.lit(minutes))
    done = rows.groupBy("submission").agg(F.bool_and(F.coalesce("has_marker", F.lit(False)) | old).alias("done"))
    return submissions.select("submission").distinct().join(done, "submission", "left").select("submission", F.coalesce("done", F.lit(False)).alias("complete"))


def type_breakdown(rows: DataFrame) -> DataFrame:
    """route and a count column per class of rows (route, class)."""
    classes = ["numeric_scalar", "numeric_vector", "text_scalar", "text_vector", "unknown"]
    return rows.groupBy("route").pivot("class", classes).count().na.fill(0, classes)


def _percent(part: Column, whole: Column) -> Column:
    """A whole number, halves to even; 0 of nothing."""
    return F.coalesce(F.bround(F.try_divide(100.0 * part, whole), 0), F.lit(0.0)).cast("long")


def progress(catalog: DataFrame, ledger: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row: total, converted (by then), remaining (not below 0), percent."""
    total = catalog.agg(F.count("*").alias("total"))
    done = ledger.where(F.col("status").isin("success", "skipped"))
    done = (done if as_of is None else done.where(F.col("event_ts") <= F.to_timestamp(F.lit(as_of)))).agg(F.count("*").alias("converted"))
    both = total.join(done)  # one row each
    return both.select("total", "converted", F.greatest(F.lit(0), F.col("total") - F.col("converted")).alias("remaining"), _percent(F.col("converted"), F.col("total")).alias("percent"))


STATUSES = ["success", "chunked", "skipped", "failed"]


def day_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(F.to_date("event_ts").alias("day")).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def day_report(counts: DataFrame, summaries: DataFrame) -> DataFrame:
    """day, STATUSES, summaries: the counts of each day with its submissions' summary rows (day, file, ...) as an array of
    structs by file; days that have only one of both are there too."""
    cols = [c for c in summaries.columns if c != "day"]
    rows = summaries.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("file", *[c for c in cols if c != "file"]))).alias("summaries"))
    return counts.join(rows, "day", "full").select("day", *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in STATUSES], F.coalesce("summaries", F.array().cast(rows.schema["summaries"].dataType)).alias("summaries"))


def months_with_data(ledger: DataFrame, summaries: DataFrame) -> DataFrame:
    months = lambda d: d.where("event_ts is not null").select(F.date_format("event_ts", "yyyy-MM").alias("month"))
    return months(ledger).unionByName(months(summaries)).distinct()


def all_time_counts(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "failed").alias("failed"))


def retry_progress(items: DataFrame, campaigns: DataFrame, hint: int = 0) -> DataFrame:
    """run_id, planned (the campaign's total, else the number of items, else the hint), converted_ok, skipped, failed_again,
    in_progress (begun and not finished), queued (not begun), percent of planned that is converted or skipped. Items have no
    start time; the time at which they were queued for the run stands for it."""
    outcome = lambda o: F.count_if(F.col("outcome") == o).alias(o)
    per = items.groupBy("run_id").agg(
        F.count("*").alias("n"), outcome("converted_ok"), outcome("skipped"), outcome("failed_again"),
        F.count_if(F.col("queued_ts").isNotNull() & F.col("finished_ts").isNull()).alias("in_progress"), F.count_if(F.col("queued_ts").isNull()).alias("queued"),
    )
    rows = per.join(campaigns.select("run_id", "total_planned"), "run_id", "full")
    planned = F.coalesce(F.nullif("total_planned", F.lit(0)), F.nullif("n", F.lit(0)), F.lit(hint)).cast("long")
    counts = ["converted_ok", "skipped", "failed_again", "in_progress", "queued"]
    rows = rows.select("run_id", planned.alias("planned"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts])
    return rows.withColumn("percent", _percent(F.col("converted_ok") + F.col("skipped"), F.col("planned")))


def latest_retry_run(items: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row, run_id: the newest campaign, else the run with the newest item."""
    c = campaigns.select(F.lit(0).alias("rank"), F.col("started_ts").alias("ts"), "run_id")
    i = items.groupBy("run_id").agg(F.max(F.coalesce("queued_ts", "finished_ts")).alias("ts")).select(F.lit(1).alias("rank"), "ts", "run_id")
    return c.unionByName(i).orderBy("rank", F.col("ts").desc(), F.col("run_id").desc()).limit(1).select("run_id")


def summary_fallback_by_day(summaries: DataFrame, counts: DataFrame) -> DataFrame:
    """day and STATUSES from summaries (submission, event_ts, saved, chunks) and fail_skip_counts."""
    rows = summaries.select("submission", "event_ts", "saved", "chunks").join(counts, "submission", "left")
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return rows.groupBy(F.to_date("event_ts").alias("day")).agg(total("saved", "success"), total("chunks", "chunked"), total("skipped", "skipped"), total("failed", "failed"))

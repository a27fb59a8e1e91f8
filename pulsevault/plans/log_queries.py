"""Queries of job logs and progress (L*) and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import logs as L
from ..operators.ledger import date_spine
from ..sources.shared import stored
from .tables import LEDGER_SQL, LOGS_SQL, catalog, ledger, log_inputs, log_outputs, logs, table

_STATUS = "CASE WHEN k IN (0, 4, 13) THEN 'success' WHEN k IN (1, 17) THEN 'chunked' WHEN k IN (2, 18) THEN 'failed' WHEN k = 3 THEN 'skipped' END"
#: Events as the lines tell them. A message of a failure begins after the first dash, so after that of a PV's name or before the reason.
_EVENTS = f"""{LOGS_SQL},
v AS (SELECT submission || '_' || file AS file, line_no, {_STATUS} AS status, n, source,
             CASE WHEN k = 13 THEN '/out/day/2024_01_05.parquet' WHEN k IN (2, 3, 18) OR k = 0 AND legacy THEN source WHEN k IN (1, 17) THEN out || '_chunk0003.parquet' ELSE out || '.parquet' END AS target,
             CASE k WHEN 2 THEN 'broken' WHEN 18 THEN 'no space' WHEN 3 THEN 'empty' ELSE '' END AS message, k
      FROM g WHERE k IN (0, 1, 2, 3, 4, 13, 17, 18))"""
#: The inputs that they are about.
_RESOLVED = f"{_EVENTS}, r AS (SELECT file, line_no, status, source AS target, message FROM v WHERE k <> 13 AND n % 50 <> 0)"
_MARK = "k = 10 AND event_type <> 'error'"
_HAS_MARK = f"({_MARK} OR k = 13)"
_FACTS = f"""{LOGS_SQL},
j AS (SELECT submission, file, kind,
       min(CASE WHEN k = 5 AND kind = 'small' OR k = 15 AND kind = 'big' THEN date_trunc('second', ts) END) AS started, max(CASE WHEN k = 6 AND kind = 'small' OR k = 16 AND kind = 'big' THEN date_trunc('second', ts) END) AS ended,
       coalesce(max(CASE WHEN k IN (1, 17) AND kind = 'big' OR k = 12 AND kind = 'small' THEN gb END), 0) AS peak_gb,
       count(*) FILTER (WHERE k = 0 AND kind = 'small') AS saved, count(*) FILTER (WHERE k IN (1, 17) AND kind = 'big') AS chunks,
       count(*) FILTER (WHERE k = 4 AND kind IN ('legacy', 'other')) AS pv_merges, count(*) FILTER (WHERE k = 13 AND kind IN ('legacy', 'other')) AS date_merges, count(*) FILTER (WHERE k = 14 AND kind IN ('legacy', 'other')) AS unsplit_merges,
       count(*) FILTER (WHERE k IN (2, 18)) AS failures, CAST(sum(CASE WHEN k = 7 AND kind = 'small' THEN 1572864 ELSE 0 END) AS BIGINT) AS input_bytes, bool_or({_HAS_MARK}) AS has_marker
     FROM g GROUP BY 1, 2, 3),
z AS (SELECT submission, sum(CASE WHEN k = 0 AND kind = 'small' AND n % 50 <> 0 THEN n * 1000 + 1 ELSE 0 END) AS small_saved, sum(CASE WHEN k IN (1, 17) AND kind = 'big' AND n % 50 <> 0 THEN n * 10 ELSE 0 END) AS big_chunk,
       sum(CASE WHEN k = 4 AND kind IN ('legacy', 'other') AND n % 50 <> 0 THEN n * 1000 + 1 ELSE 0 END) AS pv_merged, sum(CASE WHEN k = 13 AND kind IN ('legacy', 'other') THEN 12345 ELSE 0 END) AS date_merged,
       sum(CASE WHEN k = 14 AND kind IN ('legacy', 'other') AND n % 50 <> 0 THEN n * 1000 + 1 ELSE 0 END) AS unsplit_merged FROM g GROUP BY 1)"""
_COUNTS = ("saved", "chunks", "pv_merges", "date_merges", "unsplit_merges", "failures")
_JOBS = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS {k}_jobs" for k in ("small", "big", "legacy", "other"))
_SUMMARY = f"""{_FACTS},
y AS (SELECT submission, {_JOBS}, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in _COUNTS)}, CAST(sum(saved) AS BIGINT) AS small_pb, round(sum(input_bytes) / 1048576.0, 2) AS input_mb,
       epoch(max(ended)) - epoch(min(started)) AS wall, round(max(peak_gb), 3) AS peak_gb, round(sum(peak_gb), 3) AS sum_of_peaks_gb FROM j GROUP BY 1),
u AS (SELECT y.*, big_jobs AS big_pb, round((small_saved + big_chunk + pv_merged + date_merged + unsplit_merged) / 1048576.0, 2) AS output_mb, {', '.join(f'round({k} / 1048576.0, 2) AS {k}_mb' for k in L.OUTPUT_KINDS)} FROM y JOIN z USING (submission))"""
_SUMMARY_COLUMNS = f"submission, {', '.join(f'{k}_jobs' for k in ('small', 'big', 'legacy', 'other'))}, {', '.join(_COUNTS)}, small_pb, big_pb, input_mb, output_mb, {', '.join(f'{k}_mb' for k in L.OUTPUT_KINDS)}"


def _facts(spark, d):
    return L.job_facts(logs(spark, d))


def _summary(spark, d, facts=None):
    return L.submission_summary(_facts(spark, d) if facts is None else facts, L.output_bytes(logs(spark, d), log_outputs(spark, d)))


def _on_a_day(summaries):
    """Summaries on the day of their submission's number."""
    return summaries.withColumn("event_ts", (F.date_add(F.lit("1995-01-01").cast("date"), F.substring("submission", 4, 9).cast("int") % 6)).cast("timestamp"))


def _classes(spark, d):
    """route, class of the events as archived PVs, and the submission that made them."""
    k, m = F.col("event_id") % 5, F.col("event_id") % 3
    names = F.array(*[F.lit(x) for x in ("numeric_scalar", "numeric_vector", "text_scalar", "text_vector", "unknown")])
    return table(spark, d, "events").select(F.concat(F.lit("sub"), F.col("user_id") % 20).alias("submission"), F.when(m == 0, "small").when(m == 1, "big").otherwise("other").alias("route"), F.element_at(names, (k + 1).cast("int")).alias("class"))


def summary_json(spark, d):
    """submission and its summary as JSON text: jobs, counts, sizes, memory, wall time and types of PVs by route."""
    facts = stored(_facts(spark, d), "facts")
    s = _summary(spark, d, facts).join(L.wall_time(facts), "submission").join(L.peak_memory(facts), "submission").join(L.jobs_and_inputs(logs(spark, d)), "submission")
    types = _classes(spark, d).where("route != 'other'").groupBy("submission").agg(*[
        F.struct(*[F.count_if((F.col("route") == r) & (F.col("class") == c)).alias(c) for c in ("numeric_scalar", "numeric_vector", "text_scalar", "text_vector", "unknown")]).alias(r) for r in ("small", "big")])
    s = s.join(types, "submission", "left")
    parts = [F.struct(*[f"{k}_jobs" for k in ("small", "big", "legacy", "other")]).alias("jobs"), F.struct(*_COUNTS).alias("counters"), F.struct("input_mb", "output_mb", *[f"{k}_mb" for k in L.OUTPUT_KINDS]).alias("sizes"), F.struct("small", "big").alias("types")]
    return s.select("submission", F.to_json(F.struct("submission", *parts, "seconds", "peak_gb", "inputs")).alias("j"))


def summary_rows(summaries):
    """The eleven columns that a summary's row shows, of summaries (submission, j)."""
    get = lambda p, t="long": F.coalesce(F.get_json_object("j", p).cast(t), F.lit(0).cast(t))
    add = lambda *names: sum((get(f"$.types.{r}.{n}") for r in ("small", "big") for n in names), F.lit(0))
    return summaries.select(
        F.concat(F.lit("submission_summary_"), "submission", F.lit(".json")).alias("file"), (get("$.jobs.small_jobs") + get("$.jobs.big_jobs") + get("$.jobs.legacy_jobs")).alias("jobs"), get("$.inputs").alias("pb_submitted"),
        get("$.counters.chunks").alias("chunked"), F.bround(get("$.peak_gb", "double") * 1024, 0).cast("long").alias("peak_ram_mb"), get("$.sizes.input_mb", "double").alias("total_pb_mb"), get("$.sizes.output_mb", "double").alias("total_pq_mb"),
        add("numeric_scalar", "numeric_vector").alias("numeric"), add("text_scalar", "text_vector").alias("text"), add("numeric_scalar", "text_scalar").alias("scalar"), add("numeric_vector", "text_vector").alias("vector"),
    )


_TYPES = "ty AS (SELECT 'sub' || (user_id % 20) AS submission, " + ", ".join(f"count(*) FILTER (WHERE event_id % 3 <> 2 AND event_id % 5 IN ({i})) AS {n}" for n, i in (("numeric", "0, 1"), ("text", "2, 3"), ("scalar", "0, 2"), ("vector", "1, 3"))) + " FROM events GROUP BY 1)"
_INPUTS = f"""s6 AS (SELECT *, coalesce(bool_or({_MARK}) OVER (PARTITION BY submission, file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS seen FROM g),
p6 AS (SELECT submission, file, bool_or({_MARK}) AS job, sum(CASE WHEN k = 11 AND seen THEN event_id % 9 WHEN k = 8 THEN 1 ELSE 0 END) AS inputs FROM s6 GROUP BY 1, 2),
q6 AS (SELECT submission, count(*) FILTER (WHERE job) AS jobs, CAST(sum(inputs) AS BIGINT) AS inputs FROM p6 GROUP BY 1)"""
_ROWS = f"""{_SUMMARY}, {_INPUTS}, {_TYPES},
rw AS (SELECT u.submission, 'submission_summary_' || u.submission || '.json' AS file, small_jobs + big_jobs + legacy_jobs AS jobs, q6.inputs AS pb_submitted, chunks AS chunked, CAST(round_even(peak_gb * 1024, 0) AS BIGINT) AS peak_ram_mb, input_mb AS total_pb_mb, output_mb AS total_pq_mb,
         numeric, text, scalar, vector FROM u JOIN q6 USING (submission) JOIN ty USING (submission))"""


def _retry(spark, d):
    """Retry items of the orders, a run of about 25 each, and a campaign of each run but every fourth."""
    l = ledger(spark, d)  # noqa: E741
    k = F.col("k")
    run = F.concat(F.lit("run"), F.floor(k / 100))
    outcome = F.when(k % 3 == 0, "converted_ok").when(k % 5 == 0, "failed_again").when(k % 7 == 0, "skipped")
    items = l.select(run.alias("run_id"), "path", outcome.alias("outcome"), F.when(k % 11 != 0, F.col("event_ts")).alias("queued_ts"), F.when(outcome.isNotNull(), F.col("event_ts")).alias("finished_ts"))
    campaigns = l.where("floor(k / 100) % 4 != 0").groupBy(run.alias("run_id")).agg(F.min("event_ts").alias("started_ts"), (F.floor(F.min("k") / 100) % 3 * 40).alias("total_planned"))
    return items, campaigns.withColumn("label", F.lit("again"))


_RETRY = """it AS (SELECT 'run' || (k // 100) AS run_id, CASE WHEN k % 3 = 0 THEN 'converted_ok' WHEN k % 5 = 0 THEN 'failed_again' WHEN k % 7 = 0 THEN 'skipped' END AS outcome, CASE WHEN k % 11 <> 0 THEN event_ts END AS queued_ts, event_ts, k FROM l),
camp AS (SELECT 'run' || (k // 100) AS run_id, min(event_ts) AS started_ts, k // 100 % 3 * 40 AS planned FROM l WHERE k // 100 % 4 <> 0 GROUP BY k // 100)"""


def build() -> dict:
    out = {}
    renamed = lambda spark, d: logs(spark, d).drop("file").withColumnRenamed("unique_file", "file")
    resolved = lambda spark, d: L.resolved_events(L.log_events(renamed(spark, d)), log_inputs(spark, d), "/out", "/data")
    out["l01_log_events"] = lambda spark, d: L.log_events(renamed(spark, d)), f"WITH {_EVENTS} SELECT file, line_no, status, target, message FROM v"
    out["l01_resolved_events"] = resolved, f"WITH {_RESOLVED} SELECT file, line_no, status, target, message FROM r"
    out["l02_last_status"] = (
        lambda spark, d: L.last_status(resolved(spark, d)),
        f"""WITH {_RESOLVED}, f AS (SELECT *, row_number() OVER (PARTITION BY file, target ORDER BY line_no) AS i FROM r)
SELECT target, status, message FROM f WHERE status <> 'chunked' OR i = 1 QUALIFY row_number() OVER (PARTITION BY target ORDER BY file DESC, line_no DESC) = 1""",
    )
    out["l03_extract_failures"] = (lambda spark, d: L.extract_failures(logs(spark, d)), f"WITH {LOGS_SQL} SELECT file, line_no, CASE k WHEN 2 THEN 'FAIL: ' || source || ' - broken' ELSE 'FAILED (pb2tsv): ' || source || ' - no space' END AS line FROM g WHERE k IN (2, 18)")
    out["l04_submission_summary"] = _summary, f"WITH {_SUMMARY} SELECT {_SUMMARY_COLUMNS} FROM u"
    out["l04_pv_examples"] = (
        lambda spark, d: L.pv_examples(logs(spark, d)).select("submission", "route", F.array_join("names", ",").alias("names")),
        f"""WITH {LOGS_SQL}, e AS (SELECT submission, 'small' AS route, 'PV-' || n AS name, file, line_no FROM g WHERE k = 0 AND kind = 'small' AND NOT legacy UNION ALL
  SELECT submission, 'big', arg_max('PV_' || n, line_no), file, max(line_no) FROM g WHERE k = 8 AND kind = 'big' GROUP BY submission, file),
f AS (SELECT submission, route, name, min((file, line_no)) AS spot FROM e GROUP BY 1, 2, 3), t AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY submission, route ORDER BY spot) <= 10)
SELECT submission, route, string_agg(name, ',' ORDER BY spot) AS names FROM t GROUP BY 1, 2""",
    )
    out["l05_wall_time"] = (
        lambda spark, d: L.wall_time(_facts(spark, d)),
        f"WITH {_SUMMARY} SELECT submission, CAST(wall AS BIGINT) AS seconds, CASE WHEN wall >= 60 OR wall < 0 THEN CAST(floor(wall / 60) AS BIGINT) || 'm ' ELSE '' END || CAST(wall - 60 * floor(wall / 60) AS BIGINT) || 's' AS text FROM u",
    )
    out["l06_peak_memory"] = (lambda spark, d: L.peak_memory(_facts(spark, d)), f"WITH {_SUMMARY} SELECT submission, peak_gb, sum_of_peaks_gb FROM u")

    kinds = ["numeric_scalar", "numeric_vector", "text_scalar", "text_vector", "unknown"]
    cases = ", ".join(f"count(*) FILTER (WHERE event_id % 5 = {i}) AS {k}" for i, k in enumerate(kinds))
    out["l07_type_breakdown"] = lambda spark, d: L.type_breakdown(_classes(spark, d)), f"SELECT CASE event_id % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'big' ELSE 'other' END AS route, {cases} FROM events GROUP BY 1"
    out["l08_progress"] = (
        lambda spark, d: L.progress(ledger(spark, d).unionByName(ledger(spark, d).where("k % 9 = 0")), ledger(spark, d), "1996-01-01 00:00:00"),
        f"""WITH {LEDGER_SQL}, t AS (SELECT (SELECT count(*) + count(*) FILTER (WHERE k % 9 = 0) FROM l) AS total, (SELECT count(*) FROM l WHERE status IN ('success', 'skipped') AND event_ts <= TIMESTAMP '1996-01-01') AS converted)
SELECT total, converted, greatest(0, total - converted) AS remaining, CAST(round_even(100.0 * converted / total, 0) AS BIGINT) AS percent FROM t""",
    )
    per_day = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in L.STATUSES)
    out["l09_day_counts"] = (lambda spark, d: L.day_counts(ledger(spark, d)).withColumn("day", F.date_format("day", "yyyy-MM-dd")), f"WITH {LEDGER_SQL} SELECT strftime(event_ts, '%Y-%m-%d') AS day, {per_day} FROM l GROUP BY 1")

    def l09(spark, d):
        js = _on_a_day(summary_json(spark, d))
        rows = summary_rows(js.select("submission", "j")).join(js.select(F.concat(F.lit("submission_summary_"), "submission", F.lit(".json")).alias("file"), F.to_date("event_ts").alias("day")), "file")
        report = L.day_report(L.day_counts(ledger(spark, d)), rows)
        names, total = F.array_join(F.col("summaries.file"), ","), F.aggregate("summaries", F.lit(0).cast("long"), lambda a, s: a + s["pb_submitted"])
        return report.select(F.date_format("day", "yyyy-MM-dd").alias("day"), *L.STATUSES, names.alias("files"), total.alias("submitted"))

    zeros = ", ".join(f"coalesce(a.{s}, 0) AS {s}" for s in L.STATUSES)
    out["l09_day_report"] = l09, f"""WITH {LEDGER_SQL}, {_ROWS}, c AS (SELECT CAST(event_ts AS DATE) AS day, {per_day} FROM l GROUP BY 1),
t AS (SELECT DATE '1995-01-01' + CAST(CAST(substring(submission, 4) AS INTEGER) % 6 AS INTEGER) AS day, string_agg(file, ',' ORDER BY file) AS files, sum(pb_submitted) AS submitted FROM rw GROUP BY 1)
SELECT strftime(coalesce(a.day, t.day), '%Y-%m-%d') AS day, {zeros}, coalesce(files, '') AS files, CAST(coalesce(submitted, 0) AS BIGINT) AS submitted FROM c a FULL JOIN t ON a.day = t.day"""
    filled = ", ".join(f"coalesce({s}, 0) AS {s}" for s in L.STATUSES)

    def l10(spark, d):
        days = stored(L.day_counts(ledger(spark, d)), "days")
        first, last = days.agg(F.trunc(F.min("day"), "month"), F.last_day(F.max("day"))).first()
        c = date_spine(days, str(first), str(last), L.STATUSES)
        return c.withColumn("month_total", F.sum("success").over(Window.partitionBy(F.date_trunc("month", "day")))).withColumn("day", F.date_format("day", "yyyy-MM-dd"))

    out["l10_month_calendar"] = l10, f"""WITH {LEDGER_SQL}, q AS (SELECT CAST(event_ts AS DATE) AS day, {per_day} FROM l GROUP BY 1),
w AS (SELECT UNNEST(generate_series(date_trunc('month', min(day)), last_day(max(day)), INTERVAL 1 DAY)) AS d FROM q), r AS (SELECT CAST(w.d AS DATE) AS day, {filled} FROM w LEFT JOIN q ON q.day = CAST(w.d AS DATE))
SELECT strftime(day, '%Y-%m-%d') AS day, {', '.join(L.STATUSES)}, CAST(sum(success) OVER (PARTITION BY date_trunc('month', day)) AS BIGINT) AS month_total FROM r"""
    out["l11_months_with_data"] = (lambda spark, d: L.months_with_data(ledger(spark, d), table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("event_ts"))), f"WITH {LEDGER_SQL} SELECT strftime(event_ts, '%Y-%m') AS month FROM l UNION SELECT strftime(ts, '%Y-%m') FROM events")
    out["l12_all_time_counts"] = (lambda spark, d: L.all_time_counts(ledger(spark, d)), f"WITH {LEDGER_SQL} SELECT count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'failed') AS failed FROM l")
    out["l13_retry_progress"] = (
        lambda spark, d: L.retry_progress(*_retry(spark, d)),
        f"""WITH {LEDGER_SQL}, {_RETRY}, q AS (SELECT run_id, count(*) AS n, count(*) FILTER (WHERE outcome = 'converted_ok') AS converted_ok, count(*) FILTER (WHERE outcome = 'skipped') AS skipped, count(*) FILTER (WHERE outcome = 'failed_again') AS failed_again,
  count(*) FILTER (WHERE queued_ts IS NOT NULL AND outcome IS NULL) AS in_progress, count(*) FILTER (WHERE queued_ts IS NULL) AS queued FROM it GROUP BY 1), t AS (SELECT *, CAST(coalesce(nullif(planned, 0), n) AS BIGINT) AS p FROM q LEFT JOIN camp USING (run_id))
SELECT run_id, p AS planned, converted_ok, skipped, failed_again, in_progress, queued, CAST(round_even(100.0 * (converted_ok + skipped) / p, 0) AS BIGINT) AS percent FROM t""",
    )
    out["l14_latest_retry_run"] = (lambda spark, d: L.latest_retry_run(*_retry(spark, d)), f"WITH {LEDGER_SQL}, {_RETRY} SELECT run_id FROM camp ORDER BY started_ts DESC, run_id DESC LIMIT 1")

    def l14b(spark, d):
        items, campaigns = _retry(spark, d)
        return L.latest_retry_run(items, campaigns.limit(0))

    out["l14_latest_run_of_items"] = l14b, f"WITH {LEDGER_SQL}, {_RETRY} SELECT run_id FROM it GROUP BY run_id ORDER BY max(coalesce(queued_ts, CASE WHEN outcome IS NOT NULL THEN event_ts END)) DESC NULLS LAST, run_id DESC LIMIT 1"
    out["l15_summary_rows"] = lambda spark, d: summary_rows(summary_json(spark, d)), f"WITH {_ROWS} SELECT * EXCLUDE (submission) FROM rw"
    out["l16_jobs_and_inputs_from_logs"] = lambda spark, d: L.jobs_and_inputs(logs(spark, d)), f"WITH {LOGS_SQL}, {_INPUTS} SELECT * FROM q6"

    def l17(spark, d):
        files = logs(spark, d).groupBy("submission", "file").agg(F.max(F.col("ts").cast("timestamp")).alias("mtime"))
        submissions = files.select("submission").unionByName(spark.range(1).select(F.lit("sub without logs").alias("submission")))
        return L.submission_complete(submissions, _facts(spark, d), files, "2024-01-31 00:00:00", 60 * 24 * 3)

    out["l17_submission_complete"] = l17, f"""WITH {LOGS_SQL}, p AS (SELECT submission, file, bool_or({_HAS_MARK}) OR max(ts) < TIMESTAMP '2024-01-28' AS ok FROM g GROUP BY 1, 2)
SELECT submission, bool_and(ok) AS complete FROM p GROUP BY 1 UNION ALL SELECT 'sub without logs', FALSE"""
    out["l18_fail_skip_counts"] = (lambda spark, d: L.fail_skip_counts(logs(spark, d)), f"WITH {LOGS_SQL} SELECT submission, count(*) FILTER (WHERE k = 2) AS failed, count(*) FILTER (WHERE k = 9) AS skipped FROM g GROUP BY 1")
    out["l19_summary_fallback_by_day"] = (
        lambda spark, d: L.summary_fallback_by_day(_on_a_day(_summary(spark, d)), L.fail_skip_counts(logs(spark, d))).withColumn("day", F.date_format("day", "yyyy-MM-dd")),
        f"""WITH {LOGS_SQL} SELECT strftime(DATE '1995-01-01' + CAST(CAST(substring(submission, 4) AS INTEGER) % 6 AS INTEGER), '%Y-%m-%d') AS day, count(*) FILTER (WHERE k = 0 AND kind = 'small') AS success,
  count(*) FILTER (WHERE k IN (1, 17) AND kind = 'big') AS chunked, count(*) FILTER (WHERE k = 9) AS skipped, count(*) FILTER (WHERE k = 2) AS failed FROM g GROUP BY 1""",
    )
    out["l20_catalog_by_route"] = (
        lambda spark, d: catalog(spark, d).groupBy(F.when(F.col("size") >= 50_000_000, "big").otherwise("small").alias("route")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes")),
        "SELECT CASE WHEN n_chars * 20000 >= 50000000 THEN 'big' ELSE 'small' END AS route, count(*) AS n, CAST(sum(n_chars * 20000) AS BIGINT) AS bytes FROM documents GROUP BY 1",
    )
    return out

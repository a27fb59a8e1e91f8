"""Queries of sources (S*), sinks (K*) and streams (T*): each writes what it needs to the shared folder, reads it back, and
returns the rows; their SQL computes the same from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import T0, bucket_key
from ..operators import buckets as B
from ..operators import logs as L
from ..operators import samples as P
from ..sources import commits as C
from ..sources import readers as R
from ..sources import writers as W
from ..sources.shared import shared_path
from ..streaming import jobs as S
from ..operators.catalog import classify_schema
from .log_queries import _RESOLVED, _RETRY, _ROWS, _retry, summary_json, summary_rows
from .stats_queries import _round, _round_sql, stats_sql
from .tables import CATALOG_SQL, LEDGER_SQL, LOGS_SQL, catalog, ledger, log_inputs, logs, scalar_samples, scalar_sql, table


def _write_sample_text(spark, d, no_t0="view"):
    """A sample file per event type: header lines, then `offset value`; that of no_t0 lacks its t0, that of `error` its name."""
    path = shared_path(spark, "sample-text")
    s = P.samples_from_events(table(spark, d, "events"), "event_type").select("pv", F.lit(1).alias("part"), "seq", F.concat_ws(" ", F.col("offset_ms").cast("long"), "x").alias("line"))
    types = s.select("pv").distinct()
    heads = [(0, F.concat(F.lit("# PV name TYPE:"), "pv"), "error"), (1, F.lit(f"# t0 {T0}"), no_t0), (2, F.lit("# Nval 1"), ""), (3, F.lit(""), "")]
    for i, line, without in heads:
        s = s.unionByName(types.where(F.col("pv") != without).select("pv", F.lit(0).alias("part"), F.lit(i).cast("long").alias("seq"), line.alias("line")))
    s.repartition("pv").sortWithinPartitions("pv", "part", "seq").select("line", F.col("pv").alias("kind")).write.partitionBy("kind").text(path)
    return f"{path}/*"


def _stream_input(spark, d, n=4, backwards=False, pieces=1):
    """The samples as n Parquet files, one written after the other in order of arrival, or from the last to the first; with
    pieces, each of them is so many files by ranges of arrival, which as many tasks write."""
    path = shared_path(spark, "stream-in")
    s = P.samples_from_events(table(spark, d, "events"))
    top = (s.agg(F.max("seq")).first()[0] or 0) + 1
    for i in sorted(range(n), reverse=backwards):
        rows = s.where((F.col("seq") >= top * i // n) & (F.col("seq") < top * (i + 1) // n))
        rows = rows.coalesce(1) if pieces == 1 else rows.repartitionByRange(pieces, "seq")
        rows.sortWithinPartitions("seq").write.mode("append").parquet(path)
    return path


def exported_wide(spark, d):
    """Every component of the vectors, as written and read back."""
    path = shared_path(spark, "wide")
    v = P.samples_from_embeddings(table(spark, d, "embeddings")).withColumn("vals", F.transform("vals", lambda x: F.round(x, 6)))
    nval = v.agg(F.max("nval")).first()[0] or 0
    W.export_wide(v, path, nval)
    schema = ", ".join(["timestamp_s double", *[f"value_{i} double" for i in range(nval)]])
    return spark.read.option("sep", "\t").option("header", "true").schema(schema).csv(path)


def build() -> dict:
    out = {}

    def s01(spark, d):
        lines, _ = R.read_samples(spark, _write_sample_text(spark, d))
        p = P.demote_to_text(P.parse_lines(lines))
        x = F.col("vals")[0]
        return p.select("pv", "t0", "nval", "value_type", "offset_ms", F.when(~F.isnan(x), x).alias("x"))

    out["s01_read_samples"] = s01, f"WITH {scalar_sql(pv='event_type')} SELECT 'TYPE:' || pv AS pv, {T0} AS t0, 1 AS nval, 'numeric' AS value_type, offset_ms, v AS x FROM s WHERE pv <> 'error'"
    out["s01_read_samples_rejects"] = (
        lambda spark, d: R.read_samples(spark, _write_sample_text(spark, d))[1].select(F.element_at(F.split("src", "/"), -2).alias("folder"), "reason"),
        "SELECT 'kind=' || event_type AS folder, 'no PV name' AS reason FROM events WHERE event_type = 'error' GROUP BY 1",
    )

    def s02(spark, d):
        path = shared_path(spark, "inputs")
        c = table(spark, d, "documents").select("source", "lang", F.regexp_replace(F.coalesce("text", F.lit("")), "[\\r\\n]", " ").alias("value"))
        c.repartition("source", "lang").write.option("maxRecordsPerFile", 10).partitionBy("source", "lang").text(path)
        files = R.scan_catalog(spark, path, "*.txt").select(F.regexp_extract("path", "source=([^/]*)/lang=([^/]*)/", 1).alias("source"), F.regexp_extract("path", "lang=([^/]*)/", 1).alias("lang"), "size")
        return files.groupBy("source", "lang").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))

    out["s02_scan_catalog"] = s02, "SELECT source, lang, (count(*) + 9) // 10 AS files, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS bytes FROM documents GROUP BY 1, 2"

    def archive_rows(spark, d):
        """Samples of which every other one is text; the shape is that of the payload columns that a row fills."""
        s = scalar_samples(spark, d, "day").withColumnRenamed("bucket", "date")
        x, even = F.when(~F.isnan("x"), F.col("x")), F.col("seq") % 2 == 0
        rows = s.select("pv", "date", "seq", x.alias("x"), F.when(even, F.array(x)).alias("values"), F.when(~even, F.array(x.cast("string"))).alias("values_text"))
        return rows.withColumn("shape", classify_schema(rows)).select("pv", "date", "seq", "x", "shape")

    def s03(spark, d):
        path = shared_path(spark, "archive")
        W.write_archive(archive_rows(spark, d), path)
        bad = path + "/date=2024_01_05/shape=numeric_scalar"
        spark.range(1).select(F.lit("no parquet").alias("value")).coalesce(1).write.mode("append").text(bad)
        return path

    def s03_damaged(spark, d):
        return R.unreadable_files(spark, s03(spark, d)).select(F.element_at(F.split("path", "/"), -3).alias("date"), "size")

    out["s03_unreadable_files"] = s03_damaged, "SELECT 'date=2024_01_05' AS date, CAST(length('no parquet') + 1 AS BIGINT) AS size FROM events LIMIT 1"
    out["s03_read_archive"] = lambda spark, d: R.read_archive(spark, s03(spark, d)).select("pv", "seq", "x"), f"WITH {scalar_sql('day')} SELECT pv, seq, v AS x FROM s"

    def _write_logs(spark, d):
        path = shared_path(spark, "logs")
        g = logs(spark, d).withColumn("name", F.regexp_replace("file", r"\.log$", ""))
        g.repartition("submission", "name").sortWithinPartitions("submission", "name", "line_no").select("line", F.col("submission").alias("s"), F.col("name").alias("n")).write.partitionBy("s", "n").text(path)
        return path

    def s04(spark, d):
        raw = R.read_job_logs(spark, _write_logs(spark, d))
        return raw.groupBy(F.regexp_replace("submission", "^n=", "").alias("name"), L.file_kind(F.regexp_replace("submission", "^n=", "")).alias("kind")).agg(F.count("*").alias("lines"), F.count_if(F.col("line").startswith("SAVED:")).alias("saved"))

    out["s04_read_job_logs"] = s04, f"WITH {LOGS_SQL} SELECT replace(file, '.log', '') AS name, CASE WHEN starts_with(file, 'small_bundle_') THEN 'small' WHEN starts_with(file, 'big_chunk_') THEN 'big' WHEN starts_with(file, 'log_chunk_') THEN 'legacy' ELSE 'other' END AS kind, count(*) AS lines, count(*) FILTER (WHERE k = 0) AS saved FROM g GROUP BY 1, 2"

    def s05(spark, d):
        path = shared_path(spark, "summaries")
        rows = ledger(spark, d).groupBy(F.date_format("event_ts", "yyyy-MM").alias("m")).agg(F.count_if(F.col("status") == "success").alias("saved_files"), F.sum("k").alias("input_bytes"))
        rows.repartition("m").select("m", F.concat("m", F.lit("-01T00:00:00")).alias("timestamp"), "saved_files", F.when(F.col("m") != "1995-05", F.col("input_bytes")).alias("input_bytes")).write.partitionBy("m").json(path)
        return R.read_summaries(spark, path).select(F.date_format("event_ts", "yyyy-MM-dd").alias("day"), "saved_files", "input_bytes", "big_pb_count")

    out["s05_read_summaries"] = s05, f"""WITH {LEDGER_SQL} SELECT strftime(event_ts, '%Y-%m-01') AS day, count(*) FILTER (WHERE status = 'success') AS saved_files,
  CAST(CASE WHEN strftime(event_ts, '%Y-%m-01') <> '1995-05-01' THEN sum(k) ELSE 0 END AS BIGINT) AS input_bytes, CAST(0 AS BIGINT) AS big_pb_count FROM l GROUP BY 1"""

    def dated(spark, d):
        return catalog(spark, d).select(F.regexp_extract("path", r"_(2024_01_\d\d)\.pb$", 1).alias("date"), "path")

    def s06(spark, d):
        path = shared_path(spark, "manifests")
        W.write_manifests(dated(spark, d).unionByName(dated(spark, d).select("date", F.lit("  ").alias("path")).distinct()), path)
        return R.read_manifest(spark, path + "/*")

    out["s06_read_manifest"] = s06, f"WITH {CATALOG_SQL} SELECT path, regexp_extract(path, '([^/]*)$', 1) AS base FROM c"

    def k01(spark, d):
        path = shared_path(spark, "archive")
        W.write_archive(archive_rows(spark, d), path)
        return spark.read.parquet(path).select("pv", "date", "shape", "seq", "x")

    out["k01_write_archive"] = k01, f"WITH {scalar_sql('day')} SELECT pv, bucket AS date, CASE WHEN seq % 2 = 0 THEN 'numeric_scalar' ELSE 'text_scalar' END AS shape, seq, v AS x FROM s"

    def k02(spark, d):
        path = shared_path(spark, "days")
        rows = archive_rows(spark, d).select("pv", "date", "seq", "x")
        W.replace_days(rows, path)
        W.replace_days(rows.where("date >= '2024_01_15'").withColumn("x", F.col("seq").cast("double")), path)
        return spark.read.parquet(path).select("pv", "date", "seq", "x")

    out["k02_append_or_replace"] = k02, f"WITH {scalar_sql('day')} SELECT pv, bucket AS date, seq, CASE WHEN bucket >= '2024_01_15' THEN CAST(seq AS DOUBLE) ELSE v END AS x FROM s"

    def k02b(spark, d):
        path = shared_path(spark, "promoted")
        e = table(spark, d, "events").select("event_id", F.col("user_id").alias("v"), "event_type")
        C.append_promoted(e.where("event_id % 3 = 0").select("event_id", "v"), path)
        C.append_promoted(e.where("event_id % 3 = 1").select("v", "event_id"), path)  # the same columns
        C.append_promoted(e.where("event_id % 3 = 2").select("event_id", F.array(F.col("v").cast("double") / 2).alias("v"), "event_type"), path)
        return C.read_table(spark, path).select("event_id", F.size("v").alias("n"), F.col("v")[0].alias("v"), "event_type")

    out["k02_append_promoted"] = k02b, "SELECT event_id, 1 AS n, CASE WHEN event_id % 3 = 2 THEN user_id / 2.0::DOUBLE ELSE CAST(user_id AS DOUBLE) END AS v, CASE WHEN event_id % 3 = 2 THEN event_type END AS event_type FROM events"

    def k03(spark, d):
        path = shared_path(spark, "chunks")
        s = B.chunk_samples(scalar_samples(spark, d), 4).select("pv", "bucket", "chunk", "seq")
        W.write_chunks(s.where("seq % 2 = 0"), path)
        W.write_chunks(s.where("seq % 2 = 1"), path, spark.read.parquet(path).select("pv", "bucket", "chunk"))
        return spark.read.parquet(path).select("pv", "bucket", "chunk", "seq")

    out["k03_write_chunks"] = k03, f"""WITH {scalar_sql()}, q AS (SELECT *, CAST((row_number() OVER (PARTITION BY pv, bucket ORDER BY seq) - 1) // 4 + 1 AS INTEGER) AS chunk FROM s),
t AS (SELECT pv, bucket, max(chunk) AS top FROM q WHERE seq % 2 = 0 GROUP BY 1, 2)
SELECT pv, bucket, CASE WHEN seq % 2 = 1 THEN chunk + coalesce(top, 0) ELSE chunk END AS chunk, seq FROM q LEFT JOIN t USING (pv, bucket)"""

    def k04(spark, d):
        return exported_wide(spark, d).select("timestamp_s", "value_0", "value_1", "value_2")  # those of the SQL

    out["k04_export_wide"] = k04, "SELECT vec_id * 60.0::DOUBLE AS timestamp_s, round(CAST(embedding[1] AS DOUBLE), 6) AS value_0, round(CAST(embedding[2] AS DOUBLE), 6) AS value_1, round(CAST(embedding[3] AS DOUBLE), 6) AS value_2 FROM embeddings"

    def k04b(spark, d):
        path = shared_path(spark, "wide-text")
        e = P.samples_from_events(table(spark, d, "events")).join(table(spark, d, "events").select(F.col("event_id").alias("seq"), F.array("event_type", F.concat(F.lit("user "), "user_id")).alias("txts")), "seq")
        W.export_wide(e, path, 2, "txts", "text")
        return spark.read.option("sep", "\t").option("header", "true").schema("timestamp_s double, text_0 string, text_1 string").csv(path).select(F.round("timestamp_s", 3).alias("timestamp_s"), "text_0", "text_1")

    out["k04_export_text"] = k04b, f"SELECT round((epoch_us(ts) // 1000 - {T0}) / 1000.0, 3) AS timestamp_s, event_type AS text_0, 'user ' || user_id AS text_1 FROM events"

    def k05(spark, d):
        path = shared_path(spark, "report")
        l = ledger(spark, d)  # noqa: E741
        days = L.day_counts(l).withColumn("month", F.date_format("day", "yyyy-MM")).withColumn("day", F.date_format("day", "yyyy-MM-dd"))
        months = days.groupBy("month").agg(F.array_sort(F.collect_list(F.struct("day", *L.STATUSES))).alias("days"), F.struct(*[F.sum(s).alias(s) for s in L.STATUSES]).alias("totals"))
        W.export_report_json(months, path)
        t = "struct<success:bigint,chunked:bigint,skipped:bigint,failed:bigint>"
        back = spark.read.schema(f"month string, days array<struct<day:string,success:bigint>>, totals {t}").json(path)
        return back.select("month", F.size("days").alias("n_days"), F.col("days")[0]["day"].alias("first"), *[F.col(f"totals.{s}").alias(s) for s in L.STATUSES])

    per = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in L.STATUSES)
    out["k05_export_report_json"] = k05, f"WITH {LEDGER_SQL} SELECT strftime(event_ts, '%Y-%m') AS month, CAST(count(DISTINCT CAST(event_ts AS DATE)) AS INTEGER) AS n_days, strftime(min(event_ts), '%Y-%m-%d') AS first, {per} FROM l GROUP BY 1"

    def k05b(spark, d):
        path, l = shared_path(spark, "report"), ledger(spark, d)  # noqa: E741
        days = L.day_counts(l).withColumn("month", F.date_format("day", "yyyy-MM")).withColumn("day", F.date_format("day", "yyyy-MM-dd"))
        months = days.groupBy("month").agg(F.array_sort(F.collect_list(F.struct("day", *L.STATUSES))).alias("days"), F.struct(*[F.sum(s).alias(s) for s in L.STATUSES]).alias("totals"))
        js = summary_json(spark, d)
        rows = summary_rows(js).withColumn("event_ts", F.concat(F.lit("1995-01-0"), F.substring("file", 23, 9).substr(F.lit(1), F.lit(1))))
        items, campaigns = _retry(spark, d)
        run = L.latest_retry_run(items, campaigns)
        retry = L.retry_progress(items.join(run, "run_id", "left_semi"), campaigns.join(run, "run_id", "left_semi"))
        W.export_report_json(W.report(L.progress(l, l), months, rows, retry, L.all_time_counts(l)), path)
        back = spark.read.json(path)
        return back.select(
            "progress.total", "progress.converted", "progress.percent", F.size("available_months").alias("n_months"), F.array_join("available_months", ",").alias("available"),
            F.aggregate("months", F.lit(0).cast("long"), lambda a, m: a + m["totals"]["success"]).alias("success_of_months"), F.array_join("summaries.file", ",").alias("files"), F.col("retry.run_id").alias("run_id"), F.col("retry.planned").alias("planned"), F.col("all_time.success").alias("success"), F.col("all_time.failed").alias("failed"),
        )

    out["k05_dashboard_report"] = k05b, f"""WITH {LEDGER_SQL}, {_ROWS}, {_RETRY}, f AS (SELECT file FROM rw ORDER BY substring(file, 23, 1) DESC, file DESC LIMIT 5), m AS (SELECT DISTINCT strftime(event_ts, '%Y-%m') AS m FROM l), c AS (SELECT run_id, planned FROM camp ORDER BY started_ts DESC, run_id DESC LIMIT 1)
SELECT (SELECT count(*) FROM l) AS total, (SELECT count(*) FROM l WHERE status IN ('success', 'skipped')) AS converted, (SELECT CAST(round_even(100.0 * count(*) FILTER (WHERE status IN ('success', 'skipped')) / count(*), 0) AS BIGINT) FROM l) AS percent,
  (SELECT CAST(count(*) AS INTEGER) FROM m) AS n_months, (SELECT string_agg(m, ',' ORDER BY m) FROM m) AS available, (SELECT count(*) FROM l WHERE status = 'success') AS success_of_months,
  (SELECT string_agg(file, ',' ORDER BY substring(file, 23, 1) DESC, file DESC) FROM f) AS files, c.run_id, CAST(coalesce(nullif(c.planned, 0), (SELECT count(*) FROM it WHERE it.run_id = c.run_id)) AS BIGINT) AS planned,
  (SELECT count(*) FROM l WHERE status = 'success') AS success, (SELECT count(*) FROM l WHERE status = 'failed') AS failed FROM c"""

    def k06(spark, d):
        path = shared_path(spark, "manifests")
        W.write_manifests(dated(spark, d), path)
        return spark.read.text(path).groupBy("date").agg(F.count("*").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"), F.sum(F.length("value")).alias("chars"))

    out["k06_write_manifests"] = k06, f"WITH {CATALOG_SQL} SELECT regexp_extract(path, '_([0-9_]*)\\.pb$', 1) AS date, count(*) AS n, min(path) AS first, max(path) AS last, CAST(sum(length(path)) AS BIGINT) AS chars FROM c GROUP BY 1"

    def k07(spark, d):
        path = shared_path(spark, "oversize")
        W.oversize_report(catalog(spark, d), path, 100_000_000)
        return spark.read.text(path)

    out["k07_oversize_report"] = k07, f"WITH {CATALOG_SQL} SELECT path || chr(9) || size || ' bytes' || chr(9) || printf('%.2f MB', size / 1e6) AS value FROM c WHERE size > 100000000"
    out["k08_failure_report"] = (
        lambda spark, d: L.failure_report(logs(spark, d)).select("file", F.size("failures").alias("n"), F.md5(F.array_join("failures", "\n")).alias("digest")),
        f"WITH {LOGS_SQL} SELECT file, CAST(count(*) AS INTEGER) AS n, md5(string_agg(CASE k WHEN 2 THEN 'FAIL: ' || source || ' - broken' ELSE 'FAILED (pb2tsv): ' || source || ' - no space' END, chr(10) ORDER BY line_no)) AS digest FROM g WHERE k IN (2, 18) GROUP BY 1",
    )

    def t01(spark, d):
        path = shared_path(spark, "t01")
        S.one_shot(S.stream_samples(spark, _stream_input(spark, d), files_per_tick=1), path + "-cp", path=path)
        return spark.read.schema(S.SAMPLE).parquet(path).select("pv", "seq", "offset_ms")

    out["t01_stream_samples"] = t01, f"WITH {scalar_sql()} SELECT pv, seq, offset_ms FROM s"

    def t01_text(spark, d):
        path = shared_path(spark, "t01")
        S.one_shot(S.stream_text(spark, _write_sample_text(spark, d, no_t0=""), files_per_tick=1), path + "-cp", S.keep_lines(spark, path))
        p = P.demote_to_text(P.parse_lines(spark.read.parquet(f"{path}/lines")))
        return p.select("pv", "nval", "value_type", "offset_ms", F.when(~F.isnan(F.col("vals")[0]), F.col("vals")[0]).alias("x"))

    out["t01_stream_text"] = t01_text, f"WITH {scalar_sql(pv='event_type')} SELECT 'TYPE:' || pv AS pv, 1 AS nval, 'numeric' AS value_type, offset_ms, v AS x FROM s WHERE pv <> 'error'"

    def tumbled(spark, d, granularity):
        path = shared_path(spark, "t02")
        stream = S.tumbling(S.with_time(S.stream_samples(spark, _stream_input(spark, d))), granularity, 9, "10 days")
        S.one_shot(stream, path + "-cp", S.keep_updates(path, ["pv", "bucket"], compact_every=2), mode="update")
        return S.latest_updates(spark, path, ["pv", "bucket"])

    def tumbling(granularity, digits=6):
        def run(spark, d):
            found = S.months_of(tumbled(spark, d, "day")) if granularity == "month" else tumbled(spark, d, granularity)
            return found.select("pv", "bucket", "length", "min", "max", F.round("mean", digits).alias("mean"), F.round("std", 6).alias("std"))

        return run

    def _keep_all(spark, path):
        return lambda batch, _: batch.write.mode("overwrite").parquet(path)

    algebraic = 'count(*) AS length, min(v) AS "min", max(v) AS "max", round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std'
    def t02_months(spark, d):
        found = tumbled(spark, d, "month")
        return found.select("pv", "bucket", "length", "min", "max", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))

    out["t02_closed_months"] = t02_months, f"WITH {scalar_sql('month')} SELECT pv, bucket, {algebraic} FROM s GROUP BY 1, 2"
    out["t02_tumbling_day"] = tumbling("day"), f"WITH {scalar_sql('day')} SELECT pv, bucket, {algebraic} FROM s GROUP BY 1, 2"
    out["t02_tumbling_week"] = tumbling("week"), f"WITH {scalar_sql('day')}, q AS (SELECT *, strftime(date_trunc('week', strptime(bucket, '%Y_%m_%d')), '%Y_%m_%d') AS w FROM s) SELECT pv, w AS bucket, {algebraic} FROM q GROUP BY 1, 2"
    # means of 64 values end with the eighth digit
    out["t02_tumbling_month"] = tumbling("month", 8), f"WITH {scalar_sql('month')} SELECT pv, bucket, {algebraic.replace('avg(v), 6', 'avg(v), 8')} FROM s GROUP BY 1, 2"

    def with_state(spark, run):
        """run() with the state store that transformWithState needs."""
        store, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        before = spark.conf.get(store)
        spark.conf.set(store, rocks)
        try:
            run()
        finally:
            spark.conf.set(store, before)

    def segments(spark, d, backwards):
        path = shared_path(spark, "t03")
        s = S.stream_samples(spark, _stream_input(spark, d, backwards=backwards), files_per_tick=1).withColumn("bucket", bucket_key((F.col("t0") + F.floor("offset_ms")).cast("long"), "day", 9))
        with_state(spark, lambda: S.one_shot(S.strict_segments(s), path + "-cp", path=path))
        return spark.read.schema("pv string, bucket string, seq long, run int, late boolean").parquet(path)

    def opened(spark, d):
        """Every fifth sample comes three days late, every seventh one day; at most two days are open."""
        path = shared_path(spark, "t03")
        s = S.stream_samples(spark, _stream_input(spark, d), files_per_tick=1)
        late = F.when(F.col("seq") % 5 == 0, 3).when(F.col("seq") % 7 == 0, 1).otherwise(0)
        s = B.bucketize(s.withColumn("offset_ms", F.col("offset_ms") - late * 86_400_000), "day", 9)
        with_state(spark, lambda: S.one_shot(S.open_buckets(s, 2), path + "-cp", path=path))
        return S.flushes_of(spark.read.schema(S.FLUSH).parquet(path)).select("pv", "bucket", "opened", "length", "valid", F.round("total", 4).alias("total"), "min", "max", "open")

    first = "coalesce(list_filter(r.opened, lambda b: b.bucket = q.bucket)[1].{0}, {1})"
    now = f"""struct_pack(ts := q.ts, o := {first.format('o', 'q.seq')}, bucket := q.bucket, n := {first.format('n', '0')} + 1, valid := {first.format('valid', '0')} + CAST(q.v IS NOT NULL AS BIGINT), total := {first.format('total', '0')} + coalesce(q.v, 0),
  low := least({first.format('low', 'q.v')}, coalesce(q.v, {first.format('low', 'NULL')})), high := greatest({first.format('high', 'q.v')}, coalesce(q.v, {first.format('high', 'NULL')})))"""
    kind = "STRUCT(ts DOUBLE, o BIGINT, bucket VARCHAR, n BIGINT, valid BIGINT, total DOUBLE, low DOUBLE, high DOUBLE)"
    told = 'pv, b.bucket AS bucket, b.o AS opened, b.n AS length, b.valid AS valid, CASE WHEN b.valid > 0 THEN round(b.total, 4) END AS total, b.low AS "min", b.high AS "max"'
    late = "(CASE WHEN event_id % 5 = 0 THEN 3 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END)"
    # one sample of every signal a step
    out["t03_open_buckets"] = opened, f"""WITH RECURSIVE q AS (SELECT CAST(user_id AS VARCHAR) AS pv, event_id AS seq, CAST((epoch_us(ts) // 1000) - {late} * 86400000 AS DOUBLE) AS ts, CASE WHEN event_id % 11 <> 0 THEN value END AS v,
    strftime(ts + INTERVAL 9 HOUR - to_days({late}), '%Y_%m_%d') AS bucket, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
r AS (SELECT DISTINCT pv, CAST(0 AS BIGINT) AS i, CAST([] AS {kind}[]) AS opened, CAST(NULL AS {kind}) AS gone FROM q
  UNION ALL SELECT pv, i, CASE WHEN len(p) > 2 THEN list_filter(p, lambda b: b.bucket <> list_sort(p)[1].bucket) ELSE p END, CASE WHEN len(p) > 2 THEN list_sort(p)[1] END
  FROM (SELECT q.pv, q.i, list_append(list_filter(r.opened, lambda b: b.bucket <> q.bucket), {now}) AS p FROM r JOIN q ON q.pv = r.pv AND q.i = r.i + 1))
SELECT {told}, FALSE AS open FROM (SELECT pv, gone AS b FROM r WHERE gone IS NOT NULL) UNION ALL SELECT {told}, TRUE AS open FROM (SELECT pv, UNNEST(opened) AS b FROM (SELECT * FROM r QUALIFY i = max(i) OVER (PARTITION BY pv)))"""

    runs = """r AS (SELECT *, CASE WHEN bucket IS DISTINCT FROM lag(bucket) OVER (PARTITION BY pv ORDER BY seq) THEN 1 ELSE 0 END AS c FROM {0}), q AS (SELECT pv, bucket, seq, CAST(sum(c) OVER (PARTITION BY pv ORDER BY seq) AS INTEGER) AS run FROM r)"""
    out["t03_strict_segments"] = lambda spark, d: segments(spark, d, False), f"WITH {scalar_sql('day')}, {runs.format('s')} SELECT *, FALSE AS late FROM q"
    # files that come last to first: a sample is late if its PV has one in a file that came before
    out["t03_late_samples"] = lambda spark, d: segments(spark, d, True), f"""WITH {scalar_sql('day')}, p AS (SELECT s.*, max(i) AS part FROM s JOIN range(4) t(i) ON (SELECT max(event_id) + 1 FROM events) * i // 4 <= seq GROUP BY ALL),
w AS (SELECT *, max(part) OVER (PARTITION BY pv) > part AS late FROM p), o AS (SELECT * FROM w WHERE NOT late), {runs.format('o')} SELECT *, FALSE AS late FROM q UNION ALL SELECT pv, bucket, seq, 0, TRUE FROM w WHERE late"""

    t04_stats = ("length", "nan_count", "min", "max", "mean", "std", "snr", "rate_of_change", "mad", "peaks", "median_interval")

    def t04(spark, d):
        src, path = _stream_input(spark, d, pieces=8), shared_path(spark, "t04")
        stream = B.bucketize(S.stream_samples(spark, src, files_per_tick=8), "week", 9)
        S.one_shot(stream, path + "-cp", S.incremental_stats(spark, path, slots=8))
        return S.stats_now(spark, path).select("pv", "bucket", *map(_round, t04_stats))

    out["t04_incremental_stats"] = t04, f"{stats_sql(scalar_sql(), 'pv, bucket', True)} SELECT pv, bucket, {', '.join(map(_round_sql, t04_stats))} FROM st"

    def t05(spark, d):
        return upserted(spark, _stream_input(spark, d, backwards=True), 2)

    out["t05_upsert_day"] = t05, f"WITH {scalar_sql('day')} SELECT pv, bucket AS date, seq, offset_ms FROM s QUALIFY row_number() OVER (PARTITION BY pv, bucket ORDER BY seq DESC) = 1"

    def t06(spark, d):
        src, path = _stream_input(spark, d), shared_path(spark, "t06")
        for _ in range(2):  # the second tick finds nothing new
            S.one_shot(S.stream_samples(spark, src).groupBy("pv").agg(F.count("*").alias("n")), path + "-cp", _keep_all(spark, path), mode="complete")
        return spark.read.parquet(path)

    out["t06_one_shot_tick"] = t06, f"WITH {scalar_sql()} SELECT pv, count(*) AS n FROM s GROUP BY 1"

    def t07(spark, d):
        src, path = shared_path(spark, "t07-in"), shared_path(spark, "t07")
        rows = logs(spark, d).select(F.col("unique_file").alias("file"), "line_no", "line")
        rows.repartitionByRange(32, "line_no").write.parquet(src)  # four batches of eight files each
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(src)
        S.one_shot(stream, path + "-cp", S.live_ledger(spark, path, log_inputs(spark, d), "/out", "/data", compact_every=3))
        return S.ledger_now(spark, path)

    # in each log a chunk line counts only if nothing came before; then the last line of the last log
    out["t07_live_ledger"] = t07, f"""WITH {_RESOLVED}, f AS (SELECT *, row_number() OVER (PARTITION BY file, target ORDER BY line_no) AS i FROM r)
SELECT target, status, message FROM f WHERE status <> 'chunked' OR i = 1 QUALIFY row_number() OVER (PARTITION BY target ORDER BY file DESC, line_no DESC) = 1"""
    return out


def upserted(spark, src, files_per_tick):
    """The last sample of each PV and day, as a stream over the files of src leaves it."""
    path = shared_path(spark, "t05")
    stream = B.bucketize(S.stream_samples(spark, src, files_per_tick=files_per_tick), "day", 9).select("pv", "seq", "offset_ms", F.col("bucket").alias("date"))
    S.one_shot(stream, path + "-cp", S.upsert_batches(spark, path, "pv", ["seq"], "date"))
    return spark.read.schema("pv string, seq long, offset_ms double, date string").parquet(path)

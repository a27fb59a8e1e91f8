"""The driver's tables in the roles of the archive: samples, catalog, ledger, logs. Each role is a Spark frame and the same in
SQL, as a list of common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.buckets import bucketize
from ..operators.samples import explode_components, samples_from_embeddings, samples_from_events


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; sets the session to UTC, which all event times here are meant in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scalar_samples(spark: SparkSession, sf_dir: str, granularity: str = "week", pv: str = "user_id") -> DataFrame:
    return bucketize(samples_from_events(table(spark, sf_dir, "events"), pv), granularity, 9)


_FORMATS = {"day": "%Y_%m_%d", "week": "%G_W%V", "month": "%Y_%m"}


def scalar_sql(granularity: str = "week", pv: str = "user_id") -> str:
    return f"""s AS (
  SELECT CAST({pv} AS VARCHAR) AS pv, event_id AS seq, CAST((epoch_us(ts) // 1000) - 1704034800000 AS DOUBLE) AS offset_ms,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS v, event_id % 11 = 0 AS is_nan,
         strftime(ts + INTERVAL 9 HOUR, '{_FORMATS[granularity]}') AS bucket
  FROM events)"""


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the embeddings, a third of those of every eleventh NaN."""
    c = explode_components(bucketize(samples_from_embeddings(table(spark, sf_dir, "embeddings")), "day", 9))
    return c.withColumn("x", F.when((F.col("seq") % 11 == 0) & (F.col("comp") % 3 == 0), F.lit(float("nan"))).otherwise(F.col("x")))


COMPONENTS_SQL = """e AS (
  SELECT CAST(label AS VARCHAR) AS pv, vec_id AS seq, CAST(vec_id * 60000 AS DOUBLE) AS offset_ms, UNNEST(range(len(embedding))) AS comp, CAST(UNNEST(embedding) AS DOUBLE) AS x,
         strftime(make_timestamp((1704034800000 + vec_id * 60000) * 1000) + INTERVAL 9 HOUR, '%Y_%m_%d') AS bucket
  FROM embeddings),
s AS (SELECT pv, seq, offset_ms, comp, bucket, seq % 11 = 0 AND comp % 3 = 0 AS is_nan, CASE WHEN NOT (seq % 11 = 0 AND comp % 3 = 0) THEN x END AS v FROM e)"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, size, mtime of the documents as input files."""
    d = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "lang", F.lit("/PV-"), F.col("doc_id"), F.lit("_2024_01_"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit(".pb"))
    return d.select("doc_id", path.alias("path"), (F.col("n_chars") * 20000).alias("size"), (F.col("doc_id") % 1000).cast("double").alias("mtime"))


CATALOG_SQL = """c AS (
  SELECT doc_id, '/data/' || source || '/' || lang || '/PV-' || doc_id || '_2024_01_' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '.pb' AS path,
         n_chars * 20000 AS size, CAST(doc_id % 1000 AS DOUBLE) AS mtime
  FROM documents)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, event_ts, status, message, k of the orders as ledger rows."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderkey") % 7 == 0, "skipped").when(F.col("o_orderkey") % 11 == 0, "chunked").when(F.col("o_orderstatus") == "O", "queued").otherwise("failed")
    return o.select(F.concat(F.lit("/data/"), "o_orderkey", F.lit(".pb")).alias("path"), F.col("o_orderdate").cast("timestamp").alias("event_ts"), status.alias("status"), F.col("o_orderpriority").alias("message"), F.col("o_orderkey").alias("k"))


LEDGER_SQL = """l AS (
  SELECT '/data/' || o_orderkey || '.pb' AS path, o_orderdate AS event_ts,
         CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderkey % 7 = 0 THEN 'skipped' WHEN o_orderkey % 11 = 0 THEN 'chunked'
              WHEN o_orderstatus = 'O' THEN 'queued' ELSE 'failed' END AS status,
         o_orderpriority AS message, o_orderkey AS k
  FROM orders)"""


def _number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n and place (its folder and file name) of each signal that the logs tell of."""
    n = F.col("event_id") % 500
    return table(spark, sf_dir, "events").select(n.alias("n")).distinct().withColumn("place", F.concat(F.lit("g"), F.col("n") % 7, F.lit("/PV")))


def log_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path of the inputs that the logs tell of; every fiftieth is gone."""
    return _number(spark, sf_dir).where("n % 50 != 0").select(F.concat(F.lit("/data/"), "place", F.lit(":"), "n", F.lit(".pb")).alias("path"))


def log_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, size of the outputs that the logs tell of: whole, in chunks, and of a day; every fiftieth is gone."""
    there = _number(spark, sf_dir).where("n % 50 != 0")
    name = F.concat(F.lit("/out/"), "place", F.lit("-"), "n")
    rows = there.select(F.concat(name, F.lit(".parquet")).alias("path"), (F.col("n") * 1000 + 1).alias("size"))
    rows = rows.unionByName(there.select(F.concat(name, F.lit("_chunk0003.parquet")).alias("path"), (F.col("n") * 10).alias("size")))
    return rows.unionByName(spark.range(1).select(F.lit("/out/day/2024_01_05.parquet").alias("path"), F.lit(12345).cast("long").alias("size")))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """submission, file, line_no, line of the events as job logs: 20 submissions of up to five logs. Every line kind of the
    format occurs, and every log but that of `error` ends with a summary marker."""
    e = table(spark, sf_dir, "events")
    sub = F.concat(F.lit("sub"), F.col("user_id") % 20)
    kind = F.create_map(*[F.lit(x) for p in [("click", "small_bundle_"), ("view", "big_chunk_"), ("error", "log_chunk_"), ("signup", "merge_")] for x in p])
    file = F.concat(F.coalesce(kind[F.col("event_type")], F.lit("misc_")), "event_type", F.lit(".log"))
    n = F.col("event_id") % 500
    place = F.concat(F.lit("g"), n % 7, F.lit("/PV"))
    source, out = F.concat(F.lit("/data/"), place, F.lit(":"), n, F.lit(".pb")), F.concat(F.lit("/out/"), place, F.lit("-"), n)
    gb, stamp = F.col("event_id") % 40 / 8, F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    text = {
        0: [F.lit("SAVED: "), F.when(F.col("event_id") % 3 == 0, source).otherwise(F.concat(out, F.lit(".parquet")))], 1: [F.lit("SAVED CHUNK: "), out, F.lit("_chunk0003.parquet (rows=10, RSS = "), gb, F.lit(" GB)")],
        2: [F.lit("FAIL: "), source, F.lit(" - broken")], 3: [F.lit("SKIP: "), source, F.lit(" (empty)")], 4: [F.lit("✅ Merged 3 → "), out, F.lit(".parquet")], 5: [F.lit("Start time : "), stamp], 6: [F.lit("End time : "), stamp],
        7: [F.lit("Total .pb input size : 1.5 mb")], 8: [F.lit("PB file : "), source], 9: [F.lit("Skipped: nothing to do")], 11: [F.lit("Input files : "), F.col("event_id") % 9], 12: [F.lit("Peak RSS : "), gb, F.lit(" gb")],
        13: [F.lit("✅ Date 2024_01_05: merged 7 files → /out/day/2024_01_05.parquet (rows=3)")], 14: [F.lit("✅ Unsplit PV "), out, F.lit(".parquet")], 15: [F.lit("Started at : "), stamp], 16: [F.lit("Finished at : "), stamp],
        17: [F.lit("SAVED FINAL CHUNK: "), out, F.lit("_chunk0003.parquet (mem≈"), gb, F.lit(" GB)")], 18: [F.lit("FAILED (pb2tsv): "), source, F.lit(" - no space")],
    }
    k = F.col("event_id") % 20
    line = F.when((k == 10) & (F.col("event_type") != "error"), F.lit("------ Chunk Summary ------"))
    for i, parts in text.items():
        line = line.when(k == i, F.concat(*parts))
    return e.select(sub.alias("submission"), F.concat(sub, F.lit("_"), file).alias("unique_file"), file.alias("file"), F.col("event_id").alias("line_no"), line.otherwise("plain line").alias("line"), "event_id", "ts")


LOGS_SQL = """g AS (
  SELECT 'sub' || (user_id % 20) AS submission, event_id % 20 AS k, event_id AS line_no, event_id, ts, event_type, event_id % 500 AS n, event_id % 40 / 8.0 AS gb, event_id % 3 = 0 AS legacy,
         CASE event_type WHEN 'click' THEN 'small_bundle_' WHEN 'view' THEN 'big_chunk_' WHEN 'error' THEN 'log_chunk_' WHEN 'signup' THEN 'merge_' ELSE 'misc_' END || event_type || '.log' AS file,
         CASE event_type WHEN 'click' THEN 'small' WHEN 'view' THEN 'big' WHEN 'error' THEN 'legacy' ELSE 'other' END AS kind,
         '/data/g' || (event_id % 500 % 7) || '/PV:' || (event_id % 500) || '.pb' AS source, '/out/g' || (event_id % 500 % 7) || '/PV-' || (event_id % 500) AS out
  FROM events)"""

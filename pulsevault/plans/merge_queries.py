"""Queries of merging (M*), ledger and joins (J*) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import chunk_base, chunk_index
from ..operators import buckets as B
from ..operators import catalog as C
from ..operators import ledger as J
from ..operators import merge as M
from ..operators import samples as P
from ..sources import writers as W
from ..sources.shared import shared_path, stored
from .tables import CATALOG_SQL, LEDGER_SQL, catalog, ledger, scalar_samples, scalar_sql, table


def _chunks(spark, d):
    s = B.chunk_samples(scalar_samples(spark, d), 4).groupBy("pv", "bucket", "chunk").agg(F.count("*").alias("length"), F.array_sort(F.collect_list(F.struct("seq", "offset_ms", "x"))).alias("r"))
    return s.select("pv", "bucket", "chunk", "length", F.col("r.offset_ms").alias("times"), F.col("r.x").alias("vals"))


def _chunk_files(spark, d):
    """Catalog with every third file in chunks of its day."""
    c = catalog(spark, d)
    path = F.when(F.col("doc_id") % 3 == 0, F.concat(F.regexp_replace("path", r"PV-\d+", F.lit("PV")), F.lit(""))).otherwise(F.col("path"))
    chunk = F.regexp_replace(path, r"\.pb$", "")
    return c.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(chunk, F.lit("_chunk"), F.lpad(F.col("doc_id").cast("string"), 6, "0"), F.lit(".parquet"))).otherwise(F.concat(chunk, F.lit(".parquet"))).alias("path"))


_FILES = f"""{CATALOG_SQL},
f AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN regexp_replace(replace(path, '.pb', ''), 'PV-[0-9]+', 'PV') || '_chunk' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '.parquet' ELSE replace(path, '.pb', '.parquet') END AS path,
        CASE WHEN doc_id % 3 = 0 THEN regexp_replace(replace(path, '.pb', ''), 'PV-[0-9]+', 'PV') END AS base, regexp_extract(path, '_([0-9_]*)\\.pb$', 1) AS date FROM c)"""


def build() -> dict:
    out = {}

    def m01(spark, d):
        m = M.merge_chunks(_chunks(spark, d), ["pv", "bucket"])
        return m.select("pv", "bucket", "length", F.posexplode("times").alias("i", "t"))

    out["m01_merge_chunks"] = m01, f"WITH {scalar_sql()} SELECT pv, bucket, count(*) OVER (PARTITION BY pv, bucket) AS length, CAST(row_number() OVER (PARTITION BY pv, bucket ORDER BY seq) - 1 AS INTEGER) AS i, offset_ms AS t FROM s"

    def m02(spark, d):
        r = table(spark, d, "lineitem").select(F.col("l_partkey").alias("pv"), F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("date"), "l_linestatus")
        return M.check_headers(r, "pv", ["date", "l_linestatus"])

    out["m02_check_headers"] = m02, """WITH r AS (SELECT l_partkey AS pv, CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS date, l_linestatus FROM lineitem),
q AS (SELECT pv, count(DISTINCT coalesce(date, '?') || '|' || l_linestatus) AS n_headers, CAST(sum(CASE WHEN date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM r GROUP BY pv)
SELECT * FROM q WHERE n_headers > 1 OR missing > 0"""

    def m03(spark, d):
        v = P.samples_from_embeddings(table(spark, d, "embeddings"))
        own = F.when(F.col("seq") % 2 == 0, F.transform("vals", lambda x: F.array(x)))
        matrix = F.when(F.col("seq") % 3 == 0, F.array(F.transform("vals", lambda x: x + 100)))
        return v.select("seq", M.payload(own, matrix, F.col("nval")).alias("p")).select("seq", F.size("p").alias("width"), F.round(F.col("p")[0][0], 4).alias("first"))

    out["m03_payload_precedence"] = m03, "SELECT vec_id AS seq, CASE WHEN vec_id % 2 = 0 OR vec_id % 3 = 0 THEN CAST(len(embedding) AS INTEGER) END AS width, round(CASE WHEN vec_id % 2 = 0 THEN CAST(embedding[1] AS DOUBLE) WHEN vec_id % 3 = 0 THEN CAST(embedding[1] AS DOUBLE) + 100 END, 4) AS first FROM embeddings"

    def m04(spark, d):
        r = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("pv"), F.lit(2).alias("nval"), F.when(F.col("o_custkey") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).when(F.col("o_custkey") % 3 == 0, F.array(F.lit("a"), "o_orderpriority")).otherwise(F.array(F.lit("a"))).alias("component_names"))
        return M.reconcile_names(r).select("pv", F.array_join("component_names", ",").alias("names"))

    out["m04_component_names"] = m04, """SELECT CAST(o_custkey AS VARCHAR) AS pv, CASE WHEN o_custkey % 2 = 0 THEN 'a,b' WHEN o_custkey % 3 = 0 AND count(DISTINCT o_orderpriority) = 1 THEN 'a,' || min(o_orderpriority)
  ELSE o_custkey || '[0],' || o_custkey || '[1]' END AS names FROM orders GROUP BY o_custkey"""
    out["m05_is_vector"] = (
        lambda spark, d: table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", M.is_vector(F.col("l_linenumber"), F.when(F.col("l_tax") > 0.05, F.array("l_tax"))).alias("is_vector")),
        "SELECT l_orderkey, l_linenumber, l_linenumber > 1 OR l_tax > 0.05 AS is_vector FROM lineitem",
    )

    def m06(spark, d):
        e = table(spark, d, "events")
        a = e.where("event_id % 4 = 0").select("event_id", F.col("event_id").alias("v"), F.col("value").alias("w"), F.lit("a").alias("only_a"))
        b = e.where("event_id % 4 = 1").select("event_id", F.array("value", "value").alias("v"), F.col("event_type").alias("w"))
        c = e.where("event_id % 4 >= 2").select("event_id", F.col("event_type").alias("v"), F.col("user_id").alias("w"))
        u = M.union_promote([a, b, c])
        return u.select("event_id", F.size("v").alias("n"), F.col("v")[0].alias("v0"), "w", "only_a")

    out["m06_union_promote"] = m06, """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS n, CASE event_id % 4 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN value END AS v0,
  CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS w, CASE WHEN event_id % 4 = 0 THEN 'a' END AS only_a FROM events"""
    out["m07_dedupe_keep_last"] = (
        lambda spark, d: M.dedupe_keep_last(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type"),
        "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    )

    def m08(spark, d):
        e = table(spark, d, "events").select((F.col("event_id") % 1000).alias("pv"), "event_id", "value")
        old, new = e.where("event_id % 3 = 0"), e.where("event_id % 3 != 0")
        return M.upsert_day(old, new, "pv", ["event_id"])

    out["m08_upsert_day"] = m08, "SELECT event_id % 1000 AS pv, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_id % 1000 ORDER BY event_id % 3 <> 0 DESC, event_id DESC) = 1"

    def m09(spark, d):
        c = catalog(spark, d).select("path", "size", "mtime", "doc_id")
        seen = c.select("path", F.when(F.col("doc_id") % 5 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), "mtime").where("doc_id % 7 != 0")
        return M.changed_inputs(c, seen).select("path", "size")

    out["m09_changed_inputs"] = m09, f"WITH {CATALOG_SQL} SELECT path, size FROM c WHERE doc_id % 5 = 0 OR doc_id % 7 = 0"
    out["m10_files_by_date"] = (
        lambda spark, d: M.files_by_date(_chunk_files(spark, d)).select("date", F.size("paths").alias("n"), F.md5(F.array_join("paths", ",")).alias("digest")),
        f"WITH {_FILES} SELECT date, CAST(count(*) AS INTEGER) AS n, md5(string_agg(path, ',' ORDER BY path)) AS digest FROM f WHERE base IS NULL GROUP BY date",
    )
    out["m10_files_by_final"] = (
        lambda spark, d: M.files_by_final(_chunk_files(spark, d)).select("base", F.size("paths").alias("n"), F.md5(F.array_join("paths", ",")).alias("digest")),
        f"WITH {_FILES} SELECT base, CAST(count(*) AS INTEGER) AS n, md5(string_agg(path, ',' ORDER BY doc_id)) AS digest FROM f WHERE base IS NOT NULL GROUP BY base",
    )

    def m11(spark, d):
        g = M.files_by_date(_chunk_files(spark, d)).select("date")
        return M.skip_existing(g, g.where("substring(date, -1) = '3'"), "date")

    out["m11_skip_existing"] = m11, f"WITH {_FILES} SELECT DISTINCT date FROM f WHERE base IS NULL AND date NOT LIKE '%3'"

    def numbered(spark, d):
        n = F.regexp_extract("path", r"PV-(\d+)_", 1)
        return catalog(spark, d).select(F.concat(F.lit("/data/"), n, F.lit(".pb")).alias("path"), "size")

    def j01(spark, d):
        return J.new_candidates(numbered(spark, d), ledger(spark, d))

    out["j01_new_candidates"] = j01, f"WITH {CATALOG_SQL}, {LEDGER_SQL}, n AS (SELECT '/data/' || doc_id || '.pb' AS path, size FROM c) SELECT path, size FROM n WHERE path NOT IN (SELECT path FROM l WHERE status IN ('queued', 'running', 'success', 'skipped', 'failed'))"
    out["j02_under_root"] = (lambda spark, d: C.under_root(catalog(spark, d), "/data/src3/").select("path"), f"WITH {CATALOG_SQL} SELECT path FROM c WHERE starts_with(path, '/data/src3/')")

    def j03(spark, d):
        l = ledger(spark, d)  # noqa: E741
        jobs = l.where("k % 3 != 0").select("path", F.col("k").cast("string").alias("job_id"), F.when(F.col("k") % 2 == 0, F.col("event_ts") + F.expr("interval 400 days")).alias("submit_ts"))
        states = l.where("k % 5 != 0").select(F.col("k").cast("string").alias("job_id"), F.when(F.col("k") % 4 == 0, "RUN").otherwise("EXIT").alias("state"))
        return J.stale_items(l, jobs, states, "1998-01-01 00:00:00", 24, 24 * 600)

    out["j03_stale_items"] = j03, f"""WITH {LEDGER_SQL}, o AS (SELECT *, k % 3 <> 0 AS has_job, CASE WHEN k % 5 <> 0 THEN CASE WHEN k % 4 = 0 THEN 'RUN' ELSE 'EXIT' END END AS state, CASE WHEN k % 3 <> 0 AND k % 2 = 0 THEN event_ts + INTERVAL 400 DAY ELSE event_ts END AS since FROM l
  WHERE status IN ('queued', 'running') AND event_ts < TIMESTAMP '1997-12-31 00:00:00'),
v AS (SELECT path, CASE WHEN NOT has_job OR state IS NULL OR state = 'EXIT' THEN 'stale' WHEN since < TIMESTAMP '1998-01-01' - INTERVAL 600 DAY THEN 'kill' END AS verdict,
             CASE WHEN NOT has_job THEN 'no job' ELSE 'job ' || k || ' is ' || coalesce(state, 'missing') END AS reason FROM o)
SELECT * FROM v WHERE verdict IS NOT NULL"""

    def same_names(spark, d):
        """Catalog whose file names occur in several folders."""
        return catalog(spark, d).select("doc_id", F.regexp_replace("path", r"PV-\d+_", F.concat(F.lit("PV-"), (F.col("doc_id") % 40).cast("string"), F.lit("_"))).alias("path"))

    names = f"{CATALOG_SQL}, n AS (SELECT DISTINCT regexp_replace(path, 'PV-[0-9]+_', 'PV-' || (doc_id % 40) || '_') AS path FROM c), b AS (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS base FROM n)"
    best = "SELECT base, path FROM b QUALIFY row_number() OVER (PARTITION BY base ORDER BY NOT starts_with(path, '/data/src4/'), path) = 1"
    out["j04_basename_index"] = (lambda spark, d: C.basename_index(same_names(spark, d), "/data/src4"), f"WITH {names} {best}")

    def j05_parts(spark, d):
        """doc_id, folder and the two names that inputs with a colon and their outputs have, in eight forms."""
        i = F.col("doc_id")
        text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        forms = [  # input, output
            (text("A-B:C", i), text("A-B-C", i)), (text("A_B:C", i), text("A_B_C", i, "_chunk0007")), (text("A_B:C-", i), text("A_B_C-", i)), (text("D:2024_01_05_", i), text("D-2024_01_05_", i)), (text("E", i, ":x_2024_W05"), text("E", i, "-x_2024_W05")),
            (text("F", i, "_2024:y"), text("F", i, "_2024_y")), (text("G", i, ":2024"), text("G", i, "-2024_2024_01_02_chunk0001")), (text("H", i), text("H-", i)),
        ]
        k = (i % 8 + 1).cast("int")
        return table(spark, d, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("folder"), F.element_at(F.array(*[a for a, _ in forms]), k).alias("name"), F.element_at(F.array(*[b for _, b in forms]), k).alias("made"))

    def j05(naming):
        def run(spark, d):
            p = j05_parts(spark, d)
            there = F.when(F.col("doc_id") % 3 == 0, F.col("folder")).otherwise("elsewhere")
            made = F.col("made") if naming == "dated" else F.concat(F.regexp_replace("made", r"_chunk\d+$", ""), F.lit("_2024_05_chunk0002"))
            o = p.select(F.concat(F.lit("/out/"), there, F.lit("/"), made, F.lit(".parquet")).alias("out"))
            i = p.select(F.concat(F.lit("/data/"), "folder", F.lit("/"), "name", F.lit(".pb")).alias("path"))
            own = i.select(F.col("path").alias("out")).where(F.endswith("out", F.lit("1.pb")))
            return C.resolve_outputs(o.unionByName(own), i, "/out", "/data", naming)

        return run

    names = ["'A-B:C' || doc_id", "'A_B:C' || doc_id", "'A_B:C-' || doc_id", "'D:2024_01_05_' || doc_id", "'E' || doc_id || ':x_2024_W05'", "'F' || doc_id || '_2024:y'", "'G' || doc_id || ':2024'", "'H' || doc_id"]
    made = ["'A-B-C' || doc_id", "'A_B_C' || doc_id || '_chunk0007'", "'A_B_C-' || doc_id", "'D-2024_01_05_' || doc_id", "'E' || doc_id || '-x_2024_W05'", "'F' || doc_id || '_2024_y'", "'G' || doc_id || '-2024_2024_01_02_chunk0001'", "'H-' || doc_id"]
    pick = lambda xs: f"CASE doc_id % 8 {' '.join(f'WHEN {i} THEN {x}' for i, x in enumerate(xs))} END"
    parts = f"t AS (SELECT doc_id, doc_id % 8 AS k, source || '/' || lang AS folder, {pick(names)} AS name, {pick(made)} AS made, CASE WHEN doc_id % 3 = 0 THEN source || '/' || lang ELSE 'elsewhere' END AS there FROM documents)"
    own = "SELECT '/data/' || folder || '/' || name || '.pb' AS out, '/data/' || folder || '/' || name || '.pb' AS path FROM t WHERE ends_with(name, '1')"
    # H has no colon; with yearly naming only one date at the end goes, so that G keeps its day
    out["j05_resolve_output_to_input"] = j05("dated"), f"WITH {parts} SELECT '/out/' || there || '/' || made || '.parquet' AS out, CASE WHEN k < 7 THEN '/data/' || folder || '/' || name || '.pb' END AS path FROM t UNION ALL {own}"
    out["j05_resolve_yearly"] = j05("yearly"), f"WITH {parts} SELECT '/out/' || there || '/' || regexp_replace(made, '_chunk[0-9]+$', '') || '_2024_05_chunk0002.parquet' AS out, CASE WHEN k < 6 THEN '/data/' || folder || '/' || name || '.pb' END AS path FROM t UNION ALL {own}"

    out["j06_prefer_final"] = (lambda spark, d: _prefer(spark, d)), f"WITH {_FILES} SELECT base, CASE WHEN length(base) % 2 = 0 THEN base || '.parquet' ELSE arg_min(path, doc_id) END AS path FROM f WHERE base IS NOT NULL GROUP BY base"

    def _prefer(spark, d):
        f = _chunk_files(spark, d)
        chunks = f.where(chunk_index(F.col("path")).isNotNull()).select(chunk_base(F.col("path")).alias("base"), chunk_index(F.col("path")).alias("i"), "path")
        finals = chunks.where(F.length("base") % 2 == 0).select("base", F.concat("base", F.lit(".parquet")).alias("path")).distinct()
        return C.prefer_final(finals, chunks)

    def j07(spark, d):
        l = ledger(spark, d)  # noqa: E741
        events = l.where("k % 3 = 0").select("path", (F.col("event_ts") + F.expr("interval 1 day")).alias("event_ts"), F.lit("success").alias("status"), F.repeat("message", 80).alias("message"))
        return J.upsert_status(l, events).select("path", "status", F.date_format("event_ts", "yyyy-MM-dd").alias("day"), F.length("message").alias("n"))

    out["j07_upsert_status"] = j07, f"""WITH {LEDGER_SQL} SELECT path, CASE WHEN k % 3 = 0 THEN 'success' ELSE status END AS status, strftime(CASE WHEN k % 3 = 0 THEN event_ts + INTERVAL 1 DAY ELSE event_ts END, '%Y-%m-%d') AS day,
  CAST(CASE WHEN k % 3 = 0 THEN least(512, 80 * length(message)) ELSE length(message) END AS INTEGER) AS n FROM l"""

    def _runs(spark, d):
        l = ledger(spark, d)  # noqa: E741
        return l.select((F.col("k") % 500).cast("string").alias("run_id"), (F.col("k") % 500 % 28).cast("string").alias("date"), F.col("event_ts").alias("started_at"), F.when(F.col("k") % 500 % 3 != 0, F.col("event_ts") + F.expr("interval 1 hour")).alias("finished_at"), "status", "k")

    def j08(spark, d):
        r = _runs(spark, d)
        return J.merge_runs(r.where("k % 2 = 0"), r.where("k % 2 = 1")).select("run_id", "date", F.date_format("started_at", "yyyy-MM-dd").alias("started"), F.date_format("finished_at", "yyyy-MM-dd HH").alias("finished"), "status")

    out["j08_merge_run_upsert"] = j08, f"""WITH {LEDGER_SQL} SELECT CAST(k % 500 AS VARCHAR) AS run_id, CAST(k % 500 % 28 AS VARCHAR) AS date, strftime(min(event_ts), '%Y-%m-%d') AS started,
  strftime(max(CASE WHEN k % 500 % 3 <> 0 THEN event_ts + INTERVAL 1 HOUR END), '%Y-%m-%d %H') AS finished, max_by(status, strftime(event_ts, '%Y-%m-%d') || status) AS status FROM l GROUP BY k % 500"""

    def j08b(spark, d):
        """Every fifth run has a status of its events, the others have begun."""
        r = _runs(spark, d).withColumn("status", F.when(F.col("k") % 500 % 5 != 0, J.BEGUN).otherwise(F.col("status")))
        return J.running_now(J.merge_runs(r.where("k % 2 = 0"), r.where("k % 2 = 1")), "1992-03-01 00:00:00", 60 * 24 * 45)

    out["j08_running_now"] = j08b, f"""WITH {LEDGER_SQL}, r AS (SELECT CAST(k % 500 AS VARCHAR) AS run_id, CAST(k % 500 % 28 AS VARCHAR) AS date, min(event_ts) AS s FROM l WHERE k % 500 % 3 = 0 AND k % 500 % 5 <> 0 GROUP BY k % 500)
SELECT date, run_id FROM r WHERE s > TIMESTAMP '1992-03-01' - INTERVAL 45 DAY QUALIFY row_number() OVER (PARTITION BY date ORDER BY s DESC, run_id DESC) = 1"""

    def j09(spark, d):
        path = shared_path(spark, "catalog")
        W.rebuild_catalog(catalog(spark, d).withColumn("path", F.concat("path", F.lit(".old"))), path)
        W.rebuild_catalog(catalog(spark, d), path)
        return spark.read.parquet(path)

    out["j09_catalog_rebuild"] = j09, f"WITH {CATALOG_SQL} SELECT path, size, mtime FROM c"

    def j10(spark, d):
        days = stored(ledger(spark, d).groupBy(F.to_date("event_ts").alias("day")).agg(F.count("*").alias("n")), "days")
        first, last = days.agg(F.trunc(F.min("day"), "month"), F.last_day(F.max("day"))).first()
        return J.date_spine(days, str(first), str(last), ["n"]).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")

    out["j10_date_spine"] = j10, f"""WITH {LEDGER_SQL}, q AS (SELECT CAST(event_ts AS DATE) AS day, count(*) AS n FROM l GROUP BY 1), w AS (SELECT UNNEST(generate_series(date_trunc('month', min(day)), last_day(max(day)), INTERVAL 1 DAY)) AS d FROM q)
SELECT strftime(w.d, '%Y-%m-%d') AS day, coalesce(q.n, 0) AS n FROM w LEFT JOIN q ON q.day = CAST(w.d AS DATE)"""
    return out

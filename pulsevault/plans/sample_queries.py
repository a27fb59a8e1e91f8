"""Queries of parsing, projections and buckets (P*, B*) and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.time import T0, absolute_ms, bucket_key, offset_seconds
from ..operators import buckets as B
from ..operators import catalog as C
from ..operators import samples as P
from .tables import CATALOG_SQL, catalog, scalar_samples, scalar_sql, table


def _lines(spark, sf_dir):
    """Sample lines of the events: three fields after the offset, the second NaN, one value short for every third event;
    users that are multiples of 5 also write text."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    text = (F.col("user_id") % 5 == 0) & (k % 4 == 0)
    first = F.when(text, F.concat(F.lit('"'), "event_type", F.lit(' now"'))).otherwise((k % 100).cast("string"))
    line = F.concat_ws(" ", F.when(k % 7 == 0, F.lit("bad")).otherwise((k * 10).cast("string")), first, F.lit("NaN"), F.when(k % 3 != 0, F.lit("5")))
    return e.select(F.col("user_id").cast("string").alias("pv"), k.alias("seq"), F.when(F.col("user_id") % 2 == 0, 2).otherwise(0).alias("nval"), line.alias("line"))


_LINES = """e AS (
  SELECT CAST(user_id AS VARCHAR) AS pv, event_id AS seq, event_id * 10.0 AS offset_ms, user_id, event_type,
         (user_id % 5 = 0 AND event_id % 4 = 0) AS is_text, CASE WHEN event_id % 3 <> 0 THEN 3 ELSE 2 END AS width, CASE WHEN user_id % 2 = 0 THEN 2 ELSE 0 END AS hdr
  FROM events WHERE event_id % 7 <> 0),
ty AS (SELECT pv, CASE WHEN bool_or(is_text) THEN 'text' ELSE 'numeric' END AS value_type FROM e GROUP BY pv)"""


def build() -> dict:
    out = {}

    def p01(spark, d):
        p = P.parse_lines(_lines(spark, d))
        n = F.size(F.filter("nums", lambda x: x.isNotNull()))
        return p.select("seq", "offset_ms", F.size("nums").alias("width"), n.alias("numbers"), F.col("nums")[0].alias("first"), F.isnan(F.col("nums")[1]).alias("second_nan"))

    out["p01_parse_numeric_row"] = p01, f"WITH {_LINES} SELECT seq, CAST(offset_ms AS DOUBLE) AS offset_ms, CASE WHEN is_text THEN width + 1 ELSE width END AS width, CASE WHEN is_text THEN width - 1 ELSE width END AS numbers, CASE WHEN NOT is_text THEN CAST(seq % 100 AS DOUBLE) END AS first, NOT is_text AS second_nan FROM e"

    def p02(spark, d):
        p = P.parse_lines(_lines(spark, d))
        return p.select("seq", "offset_ms", F.size("toks").alias("n"), F.col("toks")[0].alias("first"), F.col("toks")[1].alias("second"))

    out["p02_parse_text_row"] = p02, f"WITH {_LINES} SELECT seq, CAST(offset_ms AS DOUBLE) AS offset_ms, width AS n, CASE WHEN is_text THEN event_type || ' now' ELSE CAST(seq % 100 AS VARCHAR) END AS first, 'NaN' AS second FROM e"
    compat = lambda spark, d: P.parse_lines(_lines(spark, d), compat_tokens=True).select("seq", F.size("toks").alias("n"), F.col("toks")[0].alias("first"))
    out["p02_parse_text_row_compat"] = compat, f"""WITH {_LINES} SELECT seq, CASE WHEN is_text THEN width + 1 ELSE width END AS n, CASE WHEN is_text THEN '"' || event_type ELSE CAST(seq % 100 AS VARCHAR) END AS first FROM e"""
    out["p03_infer_value_type"] = (lambda spark, d: P.infer_value_type(P.parse_lines(_lines(spark, d))), f"WITH {_LINES} SELECT pv, value_type FROM ty")

    def p04(spark, d):
        s = P.demote_to_text(P.parse_lines(_lines(spark, d)))
        return s.select("pv", "seq", "value_type", F.col("vals")[0].alias("number"), F.col("txts")[0].alias("text"))

    out["p04_demote_to_text"] = p04, f"""WITH {_LINES} SELECT pv, seq, value_type, CASE WHEN value_type = 'numeric' THEN CAST(seq % 100 AS DOUBLE) END AS number,
  CASE WHEN value_type = 'text' THEN CASE WHEN is_text THEN event_type || ' now' ELSE CAST(seq % 100 AS VARCHAR) END END AS text FROM e JOIN ty USING (pv)"""
    nv = f"{_LINES}, nv AS (SELECT pv, CASE WHEN max(hdr) > 0 THEN max(hdr) ELSE max(width) END AS nval FROM e GROUP BY pv)"
    out["p05_resolve_nval"] = (lambda spark, d: P.resolve_nval(P.demote_to_text(P.parse_lines(_lines(spark, d)))), f"WITH {nv} SELECT pv, nval FROM nv")

    def p06(spark, d):
        s = P.shaped(P.parse_lines(_lines(spark, d)))
        return s.select("pv", "seq", "nval", F.size("vals").alias("n_vals"), F.size("txts").alias("n_txts"), F.isnan(F.element_at("vals", -1)).alias("last_nan"), F.element_at("txts", -1).alias("last_text"))

    out["p06_fit_width"] = p06, f"""WITH {nv} SELECT pv, seq, nval, CASE WHEN value_type = 'numeric' THEN nval END AS n_vals, CASE WHEN value_type = 'text' THEN nval END AS n_txts,
  value_type = 'numeric' AND (nval = 2 OR width < 3) AS last_nan, CASE WHEN value_type = 'text' THEN CASE WHEN nval = 2 THEN 'NaN' WHEN width < 3 THEN '' ELSE '5' END END AS last_text
FROM e JOIN ty USING (pv) JOIN nv USING (pv)"""

    def p07(spark, d):
        return P.explode_components(P.samples_from_embeddings(table(spark, d, "embeddings"))).select("pv", "seq", "comp", "component", F.round("x", 6).alias("x"))

    emb = "x AS (SELECT CAST(label AS VARCHAR) AS pv, vec_id AS seq, CAST(UNNEST(range(len(embedding))) AS INTEGER) AS comp, CAST(UNNEST(embedding) AS DOUBLE) AS x FROM embeddings)"
    out["p07_explode_components"] = p07, f"WITH {emb} SELECT pv, seq, comp, pv || '[' || comp || ']' AS component, round(x, 6) AS x FROM x"

    def p08(spark, d):
        m = P.samples_from_embeddings(table(spark, d, "embeddings")).groupBy("pv", F.floor(F.col("seq") / 100).alias("block")).agg(F.array_sort(F.collect_list(F.struct("seq", "vals"))).alias("r"), F.max("nval").alias("w"))
        t = m.select("pv", "block", P.by_component(F.col("r.vals"), F.col("w")).alias("c"))
        return t.select("pv", "block", F.posexplode("c").alias("comp", "xs")).select("pv", "block", "comp", F.size("xs").alias("n"), F.round(F.col("xs")[0], 6).alias("first"), F.round(F.element_at("xs", -1), 6).alias("last"))

    out["p08_transpose"] = p08, f"WITH {emb} SELECT pv, CAST(floor(seq / 100) AS BIGINT) AS block, comp, CAST(count(*) AS INTEGER) AS n, round(arg_min(x, seq), 6) AS first, round(arg_max(x, seq), 6) AS last FROM x GROUP BY 1, 2, 3"

    def p09(spark, d):
        s = P.samples_from_events(table(spark, d, "events"))
        return s.select("seq", F.round(offset_seconds(F.col("offset_ms")), 3).alias("offset_s"), absolute_ms(F.col("t0"), F.col("offset_ms")).alias("ms"))

    out["p09_sample_time"] = p09, f"SELECT event_id AS seq, round(((epoch_us(ts) // 1000) - {T0}) / 1000.0, 3) AS offset_s, (epoch_us(ts) // 1000) AS ms FROM events"
    out["p10_escape_text"] = (
        lambda spark, d: table(spark, d, "documents").select("doc_id", F.md5(T.escape_text(F.col("text"))).alias("digest")),
        r"SELECT doc_id, md5(replace(replace(replace(coalesce(text, ''), chr(9), '\t'), chr(10), '\n'), chr(13), '\r')) AS digest FROM documents",
    )

    def p11(spark, d):
        tokens = spark.createDataFrame([("src1/",), ("# a comment",), (" /fr/ ",), ("",)], "token string")
        return C.exclude(catalog(spark, d), tokens).select("path", "size")

    out["p11_is_excluded"] = p11, f"WITH {CATALOG_SQL} SELECT path, size FROM c WHERE NOT contains(path, 'src1/') AND NOT contains(path, '/fr/')"

    def p11b(spark, d):
        """A token for every third document, and some short ones."""
        own = table(spark, d, "documents").where("doc_id % 3 = 0").select(F.concat(F.lit("/PV-"), "doc_id", F.lit("_2024")).alias("token"))
        short = spark.createDataFrame([("src1/",), ("/fr",), ("_28.pb",), ("nothing has this",)], "token string")
        return C.exclude(catalog(spark, d), own.unionByName(short), few=20).select("path", "size")

    out["p11_exclude_many"] = p11b, f"WITH {CATALOG_SQL} SELECT path, size FROM c WHERE doc_id % 3 <> 0 AND NOT contains(path, 'src1/') AND NOT contains(path, '/fr') AND NOT contains(path, '_28.pb')"

    def p12(spark, d):
        c = catalog(spark, d).withColumn("chunk", F.concat(F.regexp_replace("path", r"\.pb$", ""), F.lit("_chunk"), F.lpad((F.col("doc_id") % 9).cast("string"), 4, "0"), F.lit(".parquet")))
        p = F.col("path")
        # the date in the stem in each of its forms: PV_2024_01_05, PV_-2024-01-05, PV2024_01-05
        k, stem = F.col("doc_id") % 3, T.stem(p)
        form = F.when(k == 0, stem).when(k == 1, F.regexp_replace(stem, r"_(\d{4})_(\d\d)_(\d\d)$", "_-$1-$2-$3")).otherwise(F.regexp_replace(stem, r"_(\d{4})_(\d\d)_(\d\d)$", "x$1_$2-$3"))
        return c.select("path", T.dir_name(p).alias("dir"), T.base_name(p).alias("base"), stem.alias("stem"), T.without_date(form).alias("pv"), T.date_token(p).alias("date"), T.chunk_base(F.col("chunk")).alias("final"), T.chunk_index(F.col("chunk")).alias("chunk_no"), T.safe_name(F.replace(stem, F.lit("-"), F.lit(":")), True).alias("big_name"))

    out["p12_path_parts"] = p12, f"""WITH {CATALOG_SQL} SELECT path, regexp_extract(path, '^(.*)/', 1) AS dir, regexp_extract(path, '([^/]*)$', 1) AS base, replace(regexp_extract(path, '([^/]*)$', 1), '.pb', '') AS stem,
  'PV-' || doc_id || CASE WHEN doc_id % 3 = 2 THEN 'x' ELSE '' END AS pv, regexp_extract(path, '_([0-9_]*)\\.pb$', 1) AS date, replace(path, '.pb', '') AS final, CAST(doc_id % 9 AS INTEGER) AS chunk_no, replace(replace(regexp_extract(path, '([^/]*)$', 1), '.pb', ''), '-', '_') AS big_name FROM c"""

    def p13(spark, d):
        c = catalog(spark, d).withColumn("shown", T.format_size(F.col("size")))
        k = F.col("doc_id") % 5
        said = F.when(k == 0, F.lower("shown")).when(k == 1, F.concat(F.lit("  "), "shown", F.lit(" "))).when(k == 2, F.split("shown", " ")[0]).when(k == 3, F.concat(F.split("shown", " ")[0], F.lit("kb"))).otherwise("about 5")
        return c.select("path", "shown", T.parse_size(said).alias("parsed"))

    shown = "CASE WHEN size < 1000000000 THEN printf('%.2f MB', size / 1e6) ELSE printf('%.2f GB', size / 1e9) END"
    out["p13_format_size"] = p13, f"""WITH {CATALOG_SQL}, t AS (SELECT doc_id, path, {shown} AS shown FROM c)
SELECT path, shown, CASE WHEN doc_id % 5 = 4 THEN 0 ELSE CAST(round(CAST(split_part(shown, ' ', 1) AS DOUBLE) * CASE WHEN doc_id % 5 = 3 THEN 1024.0 WHEN doc_id % 5 = 2 OR shown LIKE '%MB' THEN 1048576.0 ELSE 1073741824.0 END) AS BIGINT) END AS parsed FROM t"""

    def p14(spark, d):
        k = F.col("event_id") % 5
        a = table(spark, d, "events").select(
            "event_id", F.when(k == 0, F.array("value")).alias("values"), F.when(k == 1, F.array(F.array("value"))).alias("values_by_component"),
            F.when(k == 2, F.array("event_type")).alias("values_text"), F.when(k == 3, F.array(F.array("event_type"))).alias("values_text_by_component"),
        )
        return a.select("event_id", C.classify_schema(a).alias("class"))

    out["p14_classify_schema"] = p14, "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'numeric_scalar' WHEN 1 THEN 'numeric_vector' WHEN 2 THEN 'text_scalar' WHEN 3 THEN 'text_vector' ELSE 'unknown' END AS class FROM events"

    def p15(spark, d):
        gb = F.col("event_id") % 64 / 8
        forms = [("SAVED CHUNK: /a (rows=1, rss=", " GB)"), ("mem≈", " GB"), ("now MEM= ", "gb left"), ("RSS = ", " GB"), ("memory ", " GB"), ("rss=", " MB")]
        line = F.element_at(F.array(*[F.concat(F.lit(a), gb, F.lit(b)) for a, b in forms]), (F.col("event_id") % 6 + 1).cast("int"))
        return table(spark, d, "events").select("event_id", T.parse_rss(line).alias("gb"))

    out["p15_parse_rss"] = p15, "SELECT event_id, CASE WHEN event_id % 6 < 4 THEN event_id % 64 / 8.0 END AS gb FROM events"
    out["p16_route_by_size"] = (
        lambda spark, d: catalog(spark, d).select("path", C.route_by_size(F.col("path"), F.col("size"), 50_000_000, 200_000_000, ["/src2/"]).alias("route")),
        f"WITH {CATALOG_SQL} SELECT path, CASE WHEN size > 200000000 THEN 'too_large' WHEN contains(path, '/src2/') OR size >= 50000000 THEN 'big' ELSE 'small' END AS route FROM c",
    )
    def p17(spark, d):
        forms = [T.base_name(F.col("path")), F.concat(F.lit("a"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")), "yyyy-MM-dd"), F.lit(".pb")), F.concat(F.lit("202401"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit(".pb")), F.concat(F.lit("plain-"), "doc_id", F.lit(".pb"))]
        named = F.element_at(F.array(*forms), (F.col("doc_id") % 4 + 1).cast("int"))
        files = catalog(spark, d).withColumn("path", F.concat(F.lit("/in/"), named, F.lit("/"), "doc_id", F.lit("-"), named))
        first = [C.decide_split(files).withColumn("case", F.lit("names")), C.decide_split(files, root="/in/2024c").withColumn("case", F.lit("root")), C.decide_split(files, "on").withColumn("case", F.lit("on"))]
        none = C.decide_split(files.where(F.col("doc_id") % 4 == 3)).withColumn("case", F.lit("plain names"))
        return first[0].unionByName(first[1]).unionByName(first[2]).unionByName(none)

    out["p17_decide_split"] = p17, """WITH q AS (SELECT doc_id % 4 AS k, CASE doc_id % 4 WHEN 0 THEN 'PV-' || doc_id || '_2024_01_' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '.pb' WHEN 1 THEN 'a2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '.pb'
    WHEN 2 THEN '202401' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || '.pb' ELSE 'plain-' || doc_id || '.pb' END AS name, doc_id FROM documents),
f AS (SELECT k FROM q ORDER BY '/in/' || name || '/' || doc_id || '-' || name LIMIT 200)
SELECT avg(CASE WHEN k < 3 THEN 1.0 ELSE 0.0 END) < 0.5 AS split, 'names' AS "case" FROM f UNION ALL VALUES (FALSE, 'root'), (TRUE, 'on'), (TRUE, 'plain names')"""

    def b01(spark, d):
        ms = F.unix_millis(F.col("ts").cast("timestamp")) + 86_400_000 * 364 * (F.col("event_id") % 3)
        e = table(spark, d, "events")
        return e.select("event_id", *[bucket_key(ms, g, 9).alias(g) for g in ("day", "week", "month")])

    out["b01_bucket_key"] = b01, "WITH t AS (SELECT event_id, ts + INTERVAL 9 HOUR + to_days(CAST(364 * (event_id % 3) AS INTEGER)) AS u FROM events) SELECT event_id, strftime(u, '%Y_%m_%d') AS day, strftime(u, '%G_W%V') AS week, strftime(u, '%Y_%m') AS month FROM t"
    out["b02_bucketize"] = (
        lambda spark, d: scalar_samples(spark, d, "day").groupBy("pv", "bucket").agg(F.count("*").alias("n"), F.min("seq").alias("first")),
        f"WITH {scalar_sql('day')} SELECT pv, bucket, count(*) AS n, min(seq) AS first FROM s GROUP BY 1, 2",
    )
    mixed = "(event_id * 7919) % 1000003"

    def shuffled(spark, d):
        return scalar_samples(spark, d, "week").withColumn("seq", F.col("seq") * 7919 % 1000003)

    sql_mixed = scalar_sql("week").replace("event_id AS seq", f"{mixed} AS seq")

    def b03(spark, d):
        return B.segment_runs(shuffled(spark, d)).groupBy("pv", "bucket", "segment").agg(F.count("*").alias("n"), F.min("seq").alias("first"))

    out["b03_segment_runs"] = b03, f"""WITH {sql_mixed}, r AS (SELECT *, CASE WHEN bucket IS DISTINCT FROM lag(bucket) OVER (PARTITION BY pv ORDER BY seq) THEN 1 ELSE 0 END AS c FROM s),
q AS (SELECT *, sum(c) OVER (PARTITION BY pv ORDER BY seq) AS run FROM r)
SELECT pv, bucket, CAST(dense_rank() OVER (PARTITION BY pv, bucket ORDER BY run) AS INTEGER) AS segment, count(*) AS n, min(seq) AS first FROM q GROUP BY pv, bucket, run"""
    out["b05_chunk_samples"] = (
        lambda spark, d: B.chunk_samples(scalar_samples(spark, d), 4).groupBy("pv", "bucket", "chunk").agg(F.count("*").alias("n"), F.min("seq").alias("first")),
        f"WITH {scalar_sql()}, q AS (SELECT *, CAST((row_number() OVER (PARTITION BY pv, bucket ORDER BY seq) - 1) // 4 + 1 AS INTEGER) AS chunk FROM s) SELECT pv, bucket, chunk, count(*) AS n, min(seq) AS first FROM q GROUP BY 1, 2, 3",
    )

    def b06(spark, d):
        s = B.sort_by_time(shuffled(spark, d))
        return s.select("pv", "bucket", F.posexplode("times").alias("i", "t"))

    out["b06_sort_by_time"] = b06, f"WITH {sql_mixed} SELECT pv, bucket, CAST(row_number() OVER (PARTITION BY pv, bucket ORDER BY offset_ms, seq) - 1 AS INTEGER) AS i, offset_ms AS t FROM s"
    out["b07_is_monotonic"] = (
        lambda spark, d: B.is_monotonic(shuffled(spark, d)),
        f"WITH {sql_mixed}, q AS (SELECT *, offset_ms - lag(offset_ms) OVER (PARTITION BY pv, bucket ORDER BY seq) AS d FROM s) SELECT pv, bucket, coalesce(bool_and(d >= 0), TRUE) AS monotonic FROM q GROUP BY 1, 2",
    )
    out["b08_top_n"] = (
        lambda spark, d: B.top_n(scalar_samples(spark, d).select("pv", "seq", "offset_ms"), ["pv"], [F.col("offset_ms").desc(), "seq"], 5),
        f"WITH {scalar_sql()} SELECT pv, seq, offset_ms FROM s QUALIFY row_number() OVER (PARTITION BY pv ORDER BY offset_ms DESC, seq) <= 5",
    )
    out["b08_latest"] = (
        lambda spark, d: B.top_n(catalog(spark, d).select("path", "size"), [], [F.col("size").desc(), "path"], 5),
        f"WITH {CATALOG_SQL} SELECT path, size FROM c ORDER BY size DESC, path LIMIT 5",
    )
    out["b09_assign_bundles"] = (
        lambda spark, d: B.assign_bundles(catalog(spark, d).select("path", "size"), "path", 50),
        f"WITH {CATALOG_SQL} SELECT path, size, CAST((row_number() OVER (ORDER BY path) - 1) // 50 AS INTEGER) AS bundle FROM c",
    )
    return out

"""Queries of archive records in their four shapes: made, written, read, merged from chunks, merged by day; and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import T0
from ..operators import records as E
from ..operators.buckets import bucketize
from ..operators.samples import samples_from_embeddings, samples_from_events
from ..sources import commits as C
from ..sources import readers as R
from ..sources import writers as W
from ..sources.shared import shared_path
from .stats_queries import _round, _round_sql, stats_sql
from .tables import COMPONENTS_SQL, scalar_sql, table


def typed_samples(spark, d, disorder=False):
    """The driver's tables as samples of all four shapes by day: values and types of events (N, S, T) and embeddings (V).
    disorder: times that don't rise with arrival and tie."""
    words = (F.col("event_type"), F.concat(F.lit("u"), "user_id").alias("u"))
    e = bucketize(samples_from_events(table(spark, d, "events"), more=words), "day", 9)
    none, texts = F.lit(None).cast("array<double>"), F.lit(None).cast("array<string>")
    cols = ["pv", "t0", "bucket", "seq", "offset_ms", "nval", "value_type", "vals", "txts"]
    named = lambda df, letter, kind, n, vals, txts: df.select(F.concat(F.lit(letter), "pv").alias("pv"), "t0", "bucket", "seq", "offset_ms", n.cast("int").alias("nval"), F.lit(kind).alias("value_type"), vals.alias("vals"), txts.alias("txts"))
    v = bucketize(samples_from_embeddings(table(spark, d, "embeddings")), "day", 9)
    gone = F.transform("vals", lambda x, i: F.when((F.col("seq") % 11 == 0) & (i % 3 == 0), F.lit(float("nan"))).otherwise(x))
    out = (
        named(e, "N", "numeric", F.lit(1), F.array("x"), texts)
        .unionByName(named(v, "V", "numeric", F.col("nval"), gone, texts))
        .unionByName(named(e, "S", "text", F.lit(1), none, F.array("event_type")))
        .unionByName(named(e, "T", "text", F.lit(2), none, F.array("event_type", "u")))
    )
    return out.withColumn("offset_ms", (F.col("seq") * 7919 % 1000 * 1000).cast("double")).select(*cols) if disorder else out.select(*cols)


#: Events by signal and day, with their words.
_EVENTS = scalar_sql("day").replace("SELECT CAST", "SELECT event_type, 'u' || user_id AS u, CAST", 1)
_STATS = ["length", "mean", "std", "skewness", "mad", "rate_of_change", "peaks", "median_interval", "duration"]
_VSTATS = ["mean", "std", "kurtosis", "mad", "rate_of_change", "peaks"]
_HEAD = f"{T0} AS t0"
_PLACE = "CAST(row_number() OVER (PARTITION BY pv, bucket ORDER BY seq) - 1 AS INTEGER) AS i"


def _value(x):
    return F.when(~F.isnan(x), x)


def scalar_rows(found):
    """A row per value of numeric scalar records, with the record's statistics."""
    rows = found.select("pv", "date", "t0", "Nval", *map(_round, _STATS), F.posexplode(F.arrays_zip("times", "values")).alias("i", "r"))
    return rows.select("pv", "date", "t0", "Nval", *_STATS, "i", F.round("r.times", 3).alias("t"), _value(F.col("r.values")).alias("x"))


def vector_rows(found):
    """A row per value of numeric vector records, with the statistics of its component."""
    by = F.arrays_zip("values_by_component", "component_names", "nan_counts", *_VSTATS)
    rows = found.select("pv", "date", "t0", "Nval", "length", "times", _round("median_interval"), F.posexplode(by).alias("comp", "c"))
    rows = rows.select("pv", "date", "t0", "Nval", "length", "median_interval", "comp", F.col("c.component_names").alias("name"), F.col("c.nan_counts").alias("nan_count"), *[F.col(f"c.{s}").alias(s) for s in _VSTATS], F.posexplode(F.arrays_zip("times", "c.values_by_component")).alias("i", "r"))
    return rows.select("pv", "date", "t0", "Nval", "length", "median_interval", "comp", "name", "nan_count", *map(_round, _VSTATS), "i", F.round("r.times", 3).alias("t"), _value(F.col("r.values_by_component")).alias("x"))


def text_rows(found, shape):
    """A row per token of text records."""
    tokens = F.array("values_text") if shape == "text_scalar" else F.col("values_text_by_component")
    rows = found.select("pv", "date", "t0", "Nval", "length", "times", F.posexplode(tokens).alias("comp", "c"))
    rows = rows.select("pv", "date", "t0", "Nval", "length", "comp", F.posexplode(F.arrays_zip("times", "c")).alias("i", "r"))
    return rows.select("pv", "date", "t0", "Nval", "length", "comp", "i", F.round("r.times", 3).alias("t"), F.col("r.c").alias("token"))


def _rows(found, shape):
    return scalar_rows(found) if shape == "numeric_scalar" else vector_rows(found) if shape == "numeric_vector" else text_rows(found, shape)


def _scalar_sql(base, extra=""):
    stats = ", ".join(map(_round_sql, _STATS))
    return f"""{stats_sql(base, 'pv, bucket', True)}, r AS (SELECT pv, bucket, {_PLACE}, round(offset_ms / 1000.0, 3) AS t, v AS x FROM s)
SELECT 'N' || r.pv AS pv, r.bucket AS date, {_HEAD}, CAST(1 AS BIGINT) AS "Nval", {stats}, i, t, x FROM r JOIN st ON r.pv = st.pv AND r.bucket = st.bucket {extra}"""


def _vector_sql(base):
    stats = ", ".join(map(_round_sql, _VSTATS))
    return f"""{stats_sql(base, 'pv, bucket, comp', False)}, r AS (SELECT pv, bucket, comp, CAST(row_number() OVER (PARTITION BY pv, bucket, comp ORDER BY seq) - 1 AS INTEGER) AS i, round(offset_ms / 1000.0, 3) AS t, v AS x FROM s)
SELECT 'V' || r.pv AS pv, r.bucket AS date, {_HEAD}, CAST(64 AS BIGINT) AS "Nval", length, median_interval, CAST(r.comp AS INTEGER) AS comp, 'V' || r.pv || '[' || r.comp || ']' AS name, nan_count, {stats}, i, t, x
FROM r JOIN st ON r.pv = st.pv AND r.bucket = st.bucket AND r.comp = st.comp"""


def _text_sql(shape, base):
    letter, tokens = ("S", "[event_type]") if shape == "text_scalar" else ("T", "[event_type, u]")
    return f"""WITH {base}, r AS (SELECT pv, bucket, {_PLACE}, count(*) OVER (PARTITION BY pv, bucket) AS length, round(offset_ms / 1000.0, 3) AS t, {tokens} AS w FROM s)
SELECT '{letter}' || pv AS pv, bucket AS date, {_HEAD}, CAST(len(w) AS BIGINT) AS "Nval", length, CAST(c - 1 AS INTEGER) AS comp, i, t, w[c] AS token FROM (SELECT *, UNNEST(range(1, len(w) + 1)) AS c FROM r)"""


def _sql(shape, disorder=False):
    """disorder: in order of the changed times, ties by arrival."""
    base = COMPONENTS_SQL if shape == "numeric_vector" else _EVENTS
    if disorder:
        more = "comp, is_nan, v" if shape == "numeric_vector" else "v, is_nan, event_type, u"
        by = "pv, bucket, comp" if shape == "numeric_vector" else "pv, bucket"
        changed = "CAST(seq * 7919 % 1000 * 1000 AS DOUBLE)"
        base = base.replace("s AS (", "s0 AS (") + f", s AS (SELECT pv, bucket, {more}, {changed} AS offset_ms, row_number() OVER (PARTITION BY {by} ORDER BY {changed}, seq) AS seq FROM s0)"
    return _scalar_sql(base) if shape == "numeric_scalar" else _vector_sql(base) if shape == "numeric_vector" else _text_sql(shape, base)


def build() -> dict:
    out = {}

    def written(spark, d, shapes=E.SHAPES):
        path, samples = shared_path(spark, "records"), typed_samples(spark, d)
        W.write_records({s: E.records_of(samples, s) for s in shapes}, path)
        return path

    for shape in E.SHAPES:
        def made(spark, d, shape=shape):
            return _rows(R.read_shape(spark, written(spark, d, (shape,)), shape), shape)

        def merged(spark, d, shape=shape):
            """Chunks of a few samples, written and read."""
            path = shared_path(spark, "chunks")
            chunks = E.records_of(typed_samples(spark, d, disorder=True), shape, most=200 if shape == "numeric_vector" else 4)
            W.write_records({shape: chunks}, path)
            found, _ = E.merge_records(R.read_shape(spark, path, shape), shape)
            return _rows(found, shape)

        out[f"k01_record_{shape}"] = made, _sql(shape)
        out[f"m01_merge_{shape}"] = merged, _sql(shape, disorder=True)

    def payloads(found):
        """A row per value of records of any shape: shape, pv, date, comp, i, x, token."""
        numbers = F.coalesce("values_by_component", F.when(F.col("values").isNotNull(), F.array("values")))
        tokens = F.coalesce("values_text_by_component", F.when(F.col("values_text").isNotNull(), F.array("values_text")))
        parts = []
        for column, kind in ((numbers, "numeric"), (tokens, "text")):
            rows = found.where(F.col("value_type") == kind).select("shape", "pv", "date", F.posexplode(column).alias("comp", "c")).select("shape", "pv", "date", "comp", F.posexplode("c").alias("i", "v"))
            parts.append(rows.select("shape", "pv", "date", "comp", "i", (_value(F.col("v")) if kind == "numeric" else F.lit(None).cast("double")).alias("x"), (F.col("v") if kind == "text" else F.lit(None).cast("string")).alias("token")))
        return parts[0].unionByName(parts[1])

    def payload_sql(changed="v"):
        pick = "SELECT '{0}' AS shape, '{1}' || pv AS pv, bucket AS date, {2} AS comp, i, {3} AS x, {4} AS token FROM {5}"
        return f"""WITH {_EVENTS}, r AS (SELECT *, {_PLACE} FROM s), {COMPONENTS_SQL.replace('s AS (', 'c AS (')}, q AS (SELECT *, CAST(row_number() OVER (PARTITION BY pv, bucket, comp ORDER BY seq) - 1 AS INTEGER) AS i FROM c)
{pick.format('numeric_scalar', 'N', '0', changed, 'NULL', 'r')} UNION ALL {pick.format('numeric_vector', 'V', 'CAST(comp AS INTEGER)', 'v', 'NULL', 'q')} UNION ALL {pick.format('text_scalar', 'S', '0', 'NULL', 'event_type', 'r')}
UNION ALL {pick.format('text_vector', 'T', '0', 'NULL', 'event_type', 'r')} UNION ALL {pick.format('text_vector', 'T', '1', 'NULL', 'u', 'r')}"""

    out["s03_read_records"] = lambda spark, d: payloads(R.read_archive(spark, written(spark, d))), payload_sql()

    def days(spark, d):
        """Two deliveries: records of all shapes; then new scalar records of every third signal beside files that are done."""
        source, root = written(spark, d), shared_path(spark, "days")
        C.merge_days(spark, source, root)
        again = typed_samples(spark, d).where("startswith(pv, 'N') and cast(substring(pv, 2) as long) % 3 = 0").withColumn("vals", F.transform("vals", lambda x: x + 1))
        W.write_records({"numeric_scalar": E.records_of(again, "numeric_scalar")}, source)
        C.merge_days(spark, source, root)
        return payloads(C.read_table(spark, root))

    out["m08_merge_days"] = days, payload_sql("CASE WHEN CAST(pv AS BIGINT) % 3 = 0 THEN v + 1 ELSE v END")
    return out

"""Operators on small inline frames with results worked out by hand or by numpy."""

import math
import re

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType

from pulsevault.functions.text import escape_text, format_size, line_tokens, parse_rss, parse_size, without_date
from pulsevault.functions.time import bucket_key
from pulsevault.operators import buckets, catalog, ledger, logs, merge, samples, stats
from pulsevault.operators.ledger import new_candidates, upsert_status
from pulsevault.operators.logs import log_events
from pulsevault.plans.stats_queries import _round
from pulsevault.sources.readers import read_samples

NAN, INF = float("nan"), float("inf")


def frame(spark, xs, times=None):
    times = times or [1000.0 * i for i in range(len(xs))]
    rows = [("p", "b", i, float(t), x) for i, (t, x) in enumerate(zip(times, xs, strict=True))]
    return spark.createDataFrame(rows, "pv string, bucket string, seq long, offset_ms double, x double")


def numpy_stats(xs):
    v = np.array([x for x in xs if not math.isnan(x)])
    if not len(v):
        return {"mean": None, "peaks": 0}
    d, sd = np.diff(v), v.std()
    z = (v - v.mean()) / sd if sd else None
    return {
        "mean": v.mean(), "std": sd, "mad": np.median(np.abs(v - np.median(v))), "rate_of_change": d.mean() if len(d) else None, "rate_of_change_variance": d.var() if len(d) else None,
        "skewness": (z**3).mean() if sd and len(v) >= 3 else None, "kurtosis": (z**4).mean() if sd and len(v) >= 3 else None,
        "peaks": int(((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])).sum()) if len(v) >= 3 else 0, "snr": v.mean() / sd if sd else None, "cv": sd / abs(v.mean()) if v.mean() else None,
    }


@pytest.mark.parametrize("xs", [[], [NAN], [1.0], [1.0, 4.0], [2.0, 2.0, 2.0], [1.0, NAN, 3.0, 2.0, NAN, 9.0, 1.0], [1.0, 3.0, 3.0, 2.0, 5.0, 4.0]])
def test_scalar_stats(spark, xs):
    got = stats.scalar_stats(frame(spark, xs)).collect()
    if not xs:
        assert got == []
        return
    row, want = got[0], numpy_stats(xs)
    assert row["length"] == len(xs) and row["nan_count"] == sum(map(math.isnan, xs))
    for k, v in want.items():
        assert row[k] is None if v is None else row[k] == pytest.approx(v), k


def test_timing_follows_arrival_not_time(spark):
    row = stats.scalar_stats(frame(spark, [1.0, 2.0, 3.0], [0, 5000, 2000])).first()
    assert (row["duration"], row["start_time"], row["end_time"]) == (2.0, 0.0, 2.0)
    assert row["avg_interval"] == 1.0 and row["max_interval"] == 5.0 and row["median_interval"] == 1.0
    one = stats.scalar_stats(frame(spark, [1.0])).first()
    assert one["duration"] == 0.0 and one["avg_interval"] is None and one["sampling_frequency"] is None


def test_vector_rules_differ(spark):
    c = frame(spark, [1.0, NAN, 3.0, INF, 2.0]).withColumn("comp", F.lit(0))
    row = stats.vector_stats(c).first()
    assert row["max"] == 3.0 and row["mean"] == 2.0  # infinities are left out
    assert row["nan_count"] == 1
    assert row["rate_of_change"] is None or not math.isfinite(row["rate_of_change"])  # inf - 3 and 2 - inf stay in


@pytest.mark.parametrize(("ms", "tz", "day", "week"), [(1704034800000, 9, "2024_01_01", "2024_W01"), (1704034799999, 9, "2023_12_31", "2023_W52"), (1735484400000, 9, "2024_12_30", "2025_W01"), (0, 0, "1970_01_01", "1970_W01")])
def test_bucket_keys(spark, ms, tz, day, week):
    row = spark.range(1).select(bucket_key(F.lit(ms), "day", tz).alias("d"), bucket_key(F.lit(ms), "week", tz).alias("w")).first()
    assert tuple(row) == (day, week)


def test_segments_and_chunks(spark):
    df = spark.createDataFrame([("p", b, i) for i, b in enumerate("aabbaac")], "pv string, bucket string, seq long")
    got = [(r.bucket, r.segment) for r in buckets.segment_runs(df).orderBy("seq").collect()]
    assert got == [("a", 1), ("a", 1), ("b", 1), ("b", 1), ("a", 2), ("a", 2), ("c", 1)]
    chunks = [r.chunk for r in buckets.chunk_samples(df, 3).orderBy("bucket", "seq").collect()]
    assert chunks == [1, 1, 1, 2, 1, 1, 1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=12), st.integers(1, 5))
def test_chunk_then_merge_is_identity(spark, xs, n):
    s = frame(spark, xs)
    c = buckets.chunk_samples(s, n).groupBy("pv", "chunk").agg(F.count("*").alias("length"), F.array_sort(F.collect_list(F.struct("seq", "offset_ms", "x"))).alias("r"))
    m = merge.merge_chunks(c.select("pv", "chunk", "length", F.col("r.offset_ms").alias("times"), F.col("r.x").alias("vals")), ["pv"]).first()
    assert m["vals"] == xs and m["length"] == len(xs)


def test_promotion_order():
    d, l, s, a, t = DoubleType(), LongType(), StringType(), ArrayType(DoubleType()), ArrayType(StringType())  # noqa: E741
    assert merge.promoted_type([l, l]) == l and merge.promoted_type([l, l], promote_ints=True) == d
    assert merge.promoted_type([l, d]) == d and merge.promoted_type([s, d]) == d
    assert merge.promoted_type([s, t]) == t and merge.promoted_type([t, d, a]) == a and merge.promoted_type([s, l]) == d


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "pv string, v long")
    new = spark.createDataFrame([("b", 3), ("c", 4), ("b", 5)], "pv string, v long")
    once = merge.upsert_day(old, new, "pv", ["v"])
    twice = merge.upsert_day(once, new, "pv", ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 1), ("b", 5), ("c", 4)]


def test_demotion_keeps_text_as_written(spark):
    lines = spark.createDataFrame([("p", 0, 1, "10 1.50"), ("p", 1, 1, '20 "two words"'), ("q", 0, 1, "10 NaN"), ("q", 1, 1, "x 5"), ("q", 2, 1, "30 Infinity")], "pv string, seq long, nval int, line string")
    got = {(r.pv, r.seq): (r.value_type, r.vals, r.txts) for r in samples.demote_to_text(samples.parse_lines(lines)).collect()}
    assert got[("p", 0)] == ("text", None, ["1.50"]) and got[("p", 1)] == ("text", None, ["two words"])
    assert got[("q", 2)] == ("numeric", [INF], None) and ("q", 1) not in got


def test_text_helpers(spark):
    row = spark.createDataFrame([('1 "a \\" b" c',)], "line string").select(line_tokens(F.col("line")).alias("t"), line_tokens(F.col("line"), True).alias("c")).first()
    assert row.t == ['a \\" b', "c"] and row.c == ['"a', '\\"', 'b"', "c"]
    sizes = spark.createDataFrame([(1_500_000,), (2_500_000_000,)], "n long").select(format_size(F.col("n")).alias("s"), escape_text(F.lit("a\tb\n")).alias("e")).collect()
    assert [r.s for r in sizes] == ["1.50 MB", "2.50 GB"] and sizes[0].e == "a\\tb\\n"
    assert spark.range(1).select(parse_size(F.lit("1.5 KB")).alias("n")).first().n == 1536


def test_candidates_and_upsert(spark):
    cat = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "path string")
    led = spark.createDataFrame([("a", "success"), ("b", "chunked"), ("c", None)], "path string, status string")
    assert sorted(r.path for r in new_candidates(cat, led).collect()) == ["b", "d"]
    ev = lambda *r: spark.createDataFrame(r, "path string, event_ts string, status string, message string")
    got = upsert_status(ev(("a", "2", "queued", "m")), ev(("a", "1", "failed", ""), ("b", "1", "success", "x" * 600))).orderBy("path").collect()
    assert [(r.path, r.status, len(r.message)) for r in got] == [("a", "queued", 1), ("b", "success", 512)]


def test_log_rules_in_order(spark):
    lines = ["SAVED: /o/a.parquet (3 rows)", "✅ Merged 3 → /o/b.parquet", "✅ Date 2024_01_01", "❌ /o/c.pb - broken pipe", "⚠️ Skipped: /o/d.pb (empty)", "hello", "SAVED FINAL CHUNK: /o/e.parquet"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, line_no long, line string")
    got = [(r.status, r.target, r.message) for r in log_events(df).orderBy("line_no").collect()]
    assert got == [("success", "/o/a.parquet", ""), ("success", "/o/b.parquet", ""), ("failed", "/o/c.pb", "broken pipe"), ("skipped", "/o/d.pb", "empty"), ("chunked", "/o/e.parquet", "")]


def test_read_samples_rejects_files_without_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# PV name X:1\n# t0 0\n# Nval 1\n\n10 1\n20 2\n")
    (tmp_path / "b.txt").write_text("# t0 7\n10 1\n")
    lines, rejects = read_samples(spark, str(tmp_path))
    assert [(r.pv, r.line) for r in lines.orderBy("seq").collect()] == [("X:1", "10 1"), ("X:1", "20 2")]
    assert [r.reason for r in rejects.collect()] == ["no PV name"]


def test_wide_export_has_every_component(spark, sf_dir):
    from pulsevault.plans.io_queries import exported_wide

    found = {r[0]: [round(x, 5) for x in r[1:]] for r in exported_wide(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    assert len(found) == len(rows) and {len(v) for v in found.values()} == {64}
    for r in rows:
        assert all(abs(a - b) < 2e-5 for a, b in zip(found[r.vec_id * 60.0], r.embedding, strict=True))


def one(spark, kind, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_sizes_memory_and_dates_as_the_format_has_them(spark):
    assert one(spark, "string", ["1.5 mb", " 2 GB", "12", "7B", "3kb", "nothing", "", None, "1.5 TB"], parse_size) == [1572864, 2 * 1024**3, 12 * 1024**2, 7, 3072, 0, 0, 0, 0]
    assert one(spark, "string", ["mem≈1.23 GB", "mem=1.23 GB", "RSS = 2.5 GB", "rss=1 gb", "mem~1 GB", "memory 1 GB"], parse_rss) == [1.23, 1.23, 2.5, 1.0, None, None]
    assert one(spark, "string", ["PV_2024-11-08", "PV-2024_11_08", "PV2024_11-08", "PV_-1999_01_01", "PV_2024_11", "2024_11_08"], without_date) == ["PV", "PV", "PV", "PV", "PV_2024_11", ""]


def test_names_of_inputs(spark):
    names = lambda v, naming="dated": one(spark, "string", v, lambda c: catalog.input_names(c, naming))
    assert names(["/o/A_B-C_2024_W05.parquet"]) == [["A_B-C_2024:W05.pb", "A_B:C_2024_W05.pb"]]
    assert names(["/o/A_B-C_2024_W05.parquet", "/o/A-B-C_2024_01_02.parquet", "/o/A_2024_2024_01.parquet"], "yearly") == [["A_B:C.pb", "A:B-C.pb"], ["A-B:C.pb"], ["A:2024.pb"]]
    assert names(["/o/A_2024_2024_01_02_chunk0001.parquet", "/o/plain.parquet", "/o/A_B_chunk1.parquet"]) == [["A:2024.pb"], ["plain.pb"], ["A_B:chunk1.pb"]]


def test_outputs_find_their_inputs(spark):
    inputs = spark.createDataFrame([("/in/x/A_B:C.pb",), ("/in/y/A-B:C.pb",), ("/else/A-B:C.pb",)], "path string")
    outs = ["/out/x/A_B-C_2024_W05.parquet", "/out/zz/A-B-C_2024_01_02.parquet", "/in/y/A-B:C.pb", "/out/x/none.parquet"]
    got = {r.out: r.path for r in catalog.resolve_outputs(spark.createDataFrame([(o,) for o in outs], "out string"), inputs, "/out", "/in", "yearly").collect()}
    assert got == dict(zip(outs, ["/in/x/A_B:C.pb", "/in/y/A-B:C.pb", "/in/y/A-B:C.pb", None]))


def test_stale_items_by_the_ledgers_time(spark):
    led = spark.createDataFrame([("a", "queued", "2024-01-01"), ("b", "running", "2024-01-01"), ("c", "queued", "2024-01-01"), ("d", "queued", "2024-01-10"), ("e", "success", "2024-01-01")], "path string, status string, ts string").withColumn("event_ts", F.to_timestamp("ts"))
    jobs = spark.createDataFrame([("a", "1", "2024-01-09 23:00:00"), ("b", "2", None), ("c", "3", "2024-01-02")], "path string, job_id string, ts string").select("path", "job_id", F.to_timestamp("ts").alias("submit_ts"))
    states = spark.createDataFrame([("2", "RUN"), ("3", "PEND")], "job_id string, state string")
    found = lambda **k: {r.path: r.verdict for r in ledger.stale_items(led, jobs, states, "2024-01-10 00:00:00", 24, **k).collect()}
    assert found() == {"a": "stale"} and found(kill_hours=8.5 * 24) == {"a": "stale", "b": "kill"}


def test_submission_without_logs_is_not_complete(spark):
    facts = spark.createDataFrame([("s", "f", True)], "submission string, file string, has_marker boolean")
    files = spark.createDataFrame([("s", "f", "2024-01-01")], "submission string, file string, t string").select("submission", "file", F.to_timestamp("t").alias("mtime"))
    subs = spark.createDataFrame([("s",), ("none",)], "submission string")
    assert {r.submission: r.complete for r in logs.submission_complete(subs, facts, files, "2024-01-01 00:05:00").collect()} == {"s": True, "none": False}


def test_retry_uses_header_then_items_then_hint(spark):
    items = spark.createDataFrame([("r", "converted_ok", "1", "2"), ("r", "failed_again", "1", "2"), ("r", None, "1", None), ("q", "skipped", None, None)], "run_id string, outcome string, queued_ts string, finished_ts string")
    head = spark.createDataFrame([("r", 8), ("q", 0), ("p", 0)], "run_id string, total_planned long")
    got = {r.run_id: tuple(r)[1:] for r in logs.retry_progress(items, head, hint=5).collect()}
    assert got == {"r": (8, 1, 0, 1, 1, 0, 12), "q": (1, 0, 1, 0, 0, 1, 100), "p": (5, 0, 0, 0, 0, 0, 0)}


def test_runs_over_the_edges_of_blocks(spark):
    names = "aabbaaccaabb"
    df = spark.createDataFrame([(p, b, i) for p in "pq" for i, b in enumerate(names)] + [("hot", "ab"[i // 7 % 2], i) for i in range(4000)], "pv string, bucket string, seq long")
    whole = sorted(map(tuple, buckets.segment_runs(df).collect()))
    assert whole == sorted(map(tuple, buckets.segment_runs(df, block=3).collect())) and len(whole) == df.count()
    hot = buckets.segment_runs(df, block=100).where("pv = 'hot'")
    assert hot.agg(F.max("segment")).first()[0] == 286
    assert df.withColumn("_b", F.floor(F.col("seq") / 100)).groupBy("pv", "_b").count().agg(F.max("count")).first()[0] == 100  # rows of a window's group


def test_medians_of_a_hot_signal(spark):
    rng = np.random.default_rng(1)
    xs = rng.normal(size=3001).round(2).tolist()
    times = np.cumsum(rng.integers(1, 50, 3001)).astype(float)
    row = stats.scalar_stats(frame(spark, xs, times.tolist())).first()
    v = np.array(xs)
    assert row["mad"] == pytest.approx(np.median(np.abs(v - np.median(v)))) and row["median_interval"] == np.median(np.diff(times)) / 1000


def test_headers_fall_back_to_the_first_of_the_set(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# PV name X\n# t0 5\n# Nval 2\n10 1 2\n")
    (tmp_path / "b.txt").write_text("# PV name Y\n10 3 4\n")
    (tmp_path / "c.txt").write_text("10 3 4\n")
    lines, rejects = read_samples(spark, str(tmp_path))
    assert sorted((r.pv, r.t0, r.nval) for r in lines.collect()) == [("X", 5, 2), ("Y", 5, 2)] and [r.reason for r in rejects.collect()] == ["no PV name"]


def test_no_machine_local_folder_on_a_cluster(spark):
    from pulsevault.sources import shared

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getConf": staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *a: None)})), "master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        shared.shared_root(Session)


def test_the_index_of_tokens_sorts_no_texts_of_paths(spark):
    files = spark.range(300).selectExpr("concat('/data/src', id % 3, '/PV-', id, '_2024.pb') AS path")
    listed = spark.range(0, 300, 3).selectExpr("concat('/PV-', id, '_2024') AS token").unionByName(spark.createDataFrame([("src1/",)], "token string"))
    found = catalog.exclude(files, listed, few=20)
    assert sorted(r.path for r in found.collect()) == sorted(f"/data/src{i % 3}/PV-{i}_2024.pb" for i in range(300) if i % 3 == 2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in plan and "_p" not in plan  # pairs of hashes, not parts beside their paths


def test_many_excluded_tokens_are_found_by_an_index(spark):
    """Long and short tokens, tokens in all paths, in none, of the length of a whole path; equal to looking for each."""
    import random

    rng = random.Random(2)
    paths = [f"/data/src{rng.randrange(9)}/PV-{rng.randrange(10**6)}_{rng.choice('abc')}.pb" for _ in range(300)] + ["\\x\\y//z/", "", None]
    tokens = [f"PV-{rng.randrange(10**6)}" for _ in range(300)] + [p[6:-3] for p in paths[:20]] + [paths[40], "src3/", "8_a", "y/z", "longer than any path " * 9, " ", "#src", "# no", "y/z"]
    files = spark.createDataFrame([(p, 1) for p in paths], "path string, size int")
    listed = spark.createDataFrame([(t,) for t in tokens], "token string")
    kept = lambda **kw: sorted(r.path for r in catalog.exclude(files, listed, **kw).collect() if r.path is not None)
    clean = [t.strip() for t in tokens if t.strip() and not t.strip().startswith("#")]
    norm = lambda p: re.sub("/+", "/", p.replace("\\", "/")).rstrip("/") or p
    want = sorted(p for p in paths if p is not None and not any(t in norm(p) for t in clean))
    assert kept(few=5) == kept(few=10_000) == want and 0 < len(want) < 280
    assert kept(few=5, gram=3) == want
    assert sorted(r.path for r in catalog.exclude(files.where("path is not null"), listed.limit(0)).collect()) == sorted(p for p in paths if p is not None)


def test_samples_that_share_a_seq_are_in_one_run(spark):
    """As a running sum by SQL's default frame has it, in which rows that tie count together."""
    rows = [("a", 0), ("a", 1), ("b", 1), ("b", 2), ("a", 3), ("c", 4), ("a", 4), ("c", 5)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame([("p", b, i) for b, i in order], "pv string, bucket string, seq long").repartition(1)
        for block in (1_000_000, 3, 1):
            got = sorted((r.seq, r.bucket, r.segment) for r in buckets.segment_runs(df, block).collect())
            assert got == [(0, "a", 1), (1, "a", 2), (1, "b", 1), (2, "b", 1), (3, "a", 3), (4, "a", 4), (4, "c", 1), (5, "c", 1)]


def test_variances_of_few_differences_are_those_of_the_order_of_arrival(spark):
    rng, rows, want = np.random.default_rng(3), [], {}
    for p in range(200):
        xs = rng.integers(0, 9000, rng.integers(1, 30)) / 100
        rows += [(f"p{p}", "b", i, float(i), NAN if i % 5 == 4 else float(x)) for i, x in enumerate(xs)]
        n, mean, m2 = 0, 0.0, 0.0
        for d in np.diff([x for i, x in enumerate(xs.tolist()) if i % 5 != 4]).tolist():
            n, before = n + 1, mean
            mean += (d - mean) / n
            m2 += (d - mean) * (d - before)
        want[f"p{p}"] = m2 / n if n else None
    df = spark.createDataFrame(rows[::-1], "pv string, bucket string, seq long, offset_ms double, x double")
    assert {r.pv: r.rate_of_change_variance for r in stats.scalar_stats(df).collect()} == want


def test_rounding_is_that_of_sql(spark):
    xs = [32833.2605, 2256.25, 0.0328125, -0.0021875, 47.1678125, -2.5, 1.005, 1234500.0, 17.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1)
    for digits in (-3, 0, 1, 3, 6):
        got = [r[0] for r in df.select(_round("x", {"x": digits})).collect()]
        assert got == [duckdb.execute(f"SELECT round(CAST({x!r} AS DOUBLE), {digits})").fetchall()[0][0] for x in xs]

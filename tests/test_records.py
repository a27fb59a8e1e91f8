"""Archive records of four shapes, committed tables, statistics of hot signals."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsevault.operators import hot_stats, merge, order_stats, records, stats
from pulsevault.plans.record_queries import typed_samples
from pulsevault.sources import commits, readers, writers

T0 = 1704034800000
SAMPLE = "pv string, t0 long, bucket string, seq long, offset_ms double, nval int, value_type string, vals array<double>, txts array<string>"


def samples(spark, rows):
    """rows of (pv, bucket, seq, offset_ms, list of numbers or of texts)"""
    full = [(pv, T0, b, s, float(ms), len(x), "text" if isinstance(x[0], str) else "numeric", None if isinstance(x[0], str) else [float(v) for v in x], x if isinstance(x[0], str) else None) for pv, b, s, ms, x in rows]
    return spark.createDataFrame(full, SAMPLE)


def row(df):
    (found,) = df.collect()
    return found


def test_numeric_scalar_record(spark):
    r = row(records.records_of(samples(spark, [("a", "d1", 3, 2000, [5]), ("a", "d1", 1, 500, [1]), ("a", "d1", 2, 1000, [3]), ("t", "d1", 1, 0, ["x"])]), "numeric_scalar"))
    assert (r.pv, r.date, r.chunk, r.t0, r.Nval, r.length, r.value_type) == ("a", "d1", 1, T0, 1, 3, "numeric")
    assert (r.times, r["values"], r.mean, r.peaks, r.max_interval, r.duration) == ([0.5, 1.0, 2.0], [1, 3, 5], 3, 0, 1.0, 1.5)


def test_numeric_vector_record(spark):
    r = row(records.records_of(samples(spark, [("v", "d1", 2, 1000, [3, 4, float("nan")]), ("v", "d1", 1, 0, [1, 2, 7])]), "numeric_vector"))
    assert (r.times, r.Nval, r.component_names, r.nan_counts) == ([0.0, 1.0], 3, ["v[0]", "v[1]", "v[2]"], [0, 0, 1])
    assert r.values_by_component[:2] == [[1, 3], [2, 4]] and r.values_by_component[2][0] == 7 and math.isnan(r.values_by_component[2][1])
    assert r.mean == [2, 3, 7] and r.length == 2 and r.avg_interval == 1.0


def test_text_records_have_no_statistics(spark):
    rows = samples(spark, [("t", "d1", 2, 9, ["b"]), ("t", "d1", 1, 5, ["a"]), ("w", "d1", 1, 5, ["a", "x"]), ("w", "d1", 2, 9, ["b", ""])])
    one, two = row(records.records_of(rows, "text_scalar")), row(records.records_of(rows, "text_vector"))
    assert one.values_text == ["a", "b"] and two.values_text_by_component == [["a", "b"], ["x", ""]] and two.component_names == ["w[0]", "w[1]"]
    assert "mean" not in one and "median_interval" not in two


@pytest.mark.parametrize("shape", records.SHAPES)
def test_chunks_of_every_shape_merge_to_the_whole(spark, sf_dir, shape):
    all_ = typed_samples(spark, sf_dir, disorder=True)
    whole = records.records_of(all_, shape, ("offset_ms", "seq"))
    chunks = records.records_of(all_, shape, most=200 if shape == "numeric_vector" else 2)
    assert chunks.count() > whole.count()
    merged, rejects = records.merge_records(chunks, shape)
    plain = lambda df: sorted(df.toJSON().collect())
    assert plain(merged) == plain(whole) and rejects.count() == 0


def test_no_chunk_is_too_large(spark):
    rows = samples(spark, [("a", "d1", i * 700_000, i, [i, i]) for i in range(50)] + [("b", "d1", 1, 0, [1, 2])])
    got = records.records_of(rows, "numeric_vector", most=24).select("pv", "chunk", "length", F.col("values_by_component")[0][0].alias("first")).collect()
    assert sorted(tuple(r) for r in got if r.pv == "a") == [("a", k + 1, min(12, 50 - 12 * k), 12.0 * k) for k in range(5)]
    assert [tuple(r) for r in got if r.pv == "b"] == [("b", 1, 1, 1.0)]


def test_older_chunks_hold_matrices(spark):
    old = spark.createDataFrame([("v", "d", 2, T0, 2, "numeric", [3.0], None, [[5.0, 6.0]], 1), ("v", "d", 1, T0, 2, "numeric", [1.0, 2.0], [[1.0, 3.0], [2.0]], None, 2)],
                                "pv string, date string, chunk int, t0 long, Nval long, value_type string, times array<double>, values_by_component array<array<double>>, values_matrix array<array<double>>, length long")
    got, _ = records.merge_records(old, "numeric_vector")
    r = row(got)
    assert r.values_by_component[0] == [1, 3, 5] and r.values_by_component[1][0] == 2 and math.isnan(r.values_by_component[1][1]) and r.values_by_component[1][2] == 6


def test_chunks_that_disagree_are_rejects(spark):
    c = records.records_of(samples(spark, [("a", "d1", i, i, [i]) for i in range(6)] + [("b", "d1", i, i, [i]) for i in range(6)]), "numeric_scalar", most=3)
    c = c.withColumn("t0", F.when((F.col("pv") == "b") & (F.col("chunk") == 2), 0).otherwise(F.col("t0")))
    merged, rejects = records.merge_records(c, "numeric_scalar")
    assert [r.pv for r in merged.collect()] == ["a"] and [(r.pv, r.n_headers) for r in rejects.collect()] == [("b", 2)]


def test_component_names_that_agree_stay(spark):
    c = records.records_of(samples(spark, [(pv, "d1", i, i, [i, i]) for pv in "ab" for i in range(4)]), "numeric_vector", most=4)
    own = F.when((F.col("pv") == "a") | (F.col("chunk") == 1), F.array(F.lit("x"), F.lit("y"))).otherwise(F.array(F.lit("x"), F.lit("z")))
    merged, _ = records.merge_records(c.withColumn("component_names", own), "numeric_vector")
    assert {r.pv: r.component_names for r in merged.collect()} == {"a": ["x", "y"], "b": ["b[0]", "b[1]"]}


def test_archive_of_all_shapes_is_read_and_pruned(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    rows = samples(spark, [("n", "d1", 1, 0, [1]), ("n", "d2", 2, 0, [2]), ("v", "d1", 1, 0, [1, 2]), ("t", "d2", 1, 0, ["a"]), ("w", "d1", 1, 0, ["a", "b"])])
    writers.write_records(records.records(rows), path)
    got = {(r.pv, r.date): r for r in readers.read_archive(spark, path).collect()}
    assert got["n", "d1"].shape == "numeric_scalar" and got["n", "d2"]["values"] == [2] and got["n", "d1"]["mean"] == [1]  # a list where vectors have lists
    assert got["v", "d1"].values_by_component == [[1], [2]] and got["t", "d2"].values_text == ["a"] and got["w", "d1"].values_text_by_component == [["a"], ["b"]]
    plan = readers.read_archive(spark, path).where("date = 'd2'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(date") == 4
    assert readers.read_shape(spark, path, "nothing") is None
    with pytest.raises(FileNotFoundError):
        readers.read_archive(spark, f"{path}/none")


def test_appended_types_are_promoted_when_read(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    commits.append_promoted(spark.createDataFrame([(1, 2)], "k int, v long"), root)
    commits.append_promoted(spark.createDataFrame([(3, [4.5], "new")], "k int, v array<double>, w string"), root)
    assert {r.k: (r.v, r.w) for r in commits.read_table(spark, root).collect()} == {1: ([2.0], None), 3: ([4.5], "new")}
    commits.replace_part(spark.createDataFrame([(9,)], "k int"), root)
    assert [tuple(r) for r in commits.read_table(spark, root).collect()] == [(9,)]


def test_days_are_merged_once_and_a_failure_leaves_the_old_state(spark, tmp_path, monkeypatch):
    source, root = f"file://{tmp_path}/in", f"file://{tmp_path}/days"
    make = lambda rows: writers.write_records({"numeric_scalar": records.records_of(samples(spark, rows), "numeric_scalar")}, source)
    state = lambda: sorted((r.date, r.pv, r["values"]) for r in commits.read_table(spark, root).collect())
    make([("a", "d1", 1, 0, [1]), ("b", "d1", 1, 0, [2]), ("a", "d2", 1, 0, [3])])
    assert commits.merge_days(spark, source, root) == ["d1", "d2"]
    assert commits.merge_days(spark, source, root) == []  # unchanged inputs are skipped on the next run
    before = state()
    make([("b", "d1", 1, 0, [20]), ("c", "d1", 1, 0, [30])])
    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            commits.merge_days(spark, source, root)
    assert state() == before
    assert commits.merge_days(spark, source, root) == ["d1"]  # the other day has no new file
    assert state() == [("d1", "a", [1]), ("d1", "b", [20]), ("d1", "c", [30]), ("d2", "a", [3])]


def test_a_day_is_rewritten_only_in_the_shapes_that_records_come_to_or_leave(spark, tmp_path):
    source, root = f"file://{tmp_path}/in", f"file://{tmp_path}/days"
    make = lambda rows: writers.write_records(records.records(samples(spark, rows)), source)
    state = lambda: sorted((r.date, r.pv, r.shape) for r in commits.read_table(spark, root).collect())
    make([("a", "d1", 1, 0, [1]), ("b", "d1", 1, 0, ["x"]), ("c", "d1", 1, 0, [1, 2]), ("d", "d1", 1, 0, ["x", "y"]), ("a", "d2", 1, 0, [1])])
    commits.merge_days(spark, source, root)
    first = commits.folders(spark, root)
    assert set(first) == {"d1/numeric_scalar", "d1/text_scalar", "d1/numeric_vector", "d1/text_vector", "d2/numeric_scalar"}
    make([("a", "d1", 1, 0, [9]), ("b", "d1", 1, 0, [9])])  # b was text, and no text is left
    assert commits.merge_days(spark, source, root) == ["d1"]
    assert state() == [("d1", "a", "numeric_scalar"), ("d1", "b", "numeric_scalar"), ("d1", "c", "numeric_vector"), ("d1", "d", "text_vector"), ("d2", "a", "numeric_scalar")]
    assert {r.pv: r["values"] for r in commits.read_table(spark, root, ["d1/numeric_scalar"]).collect()} == {"a": [9], "b": [9]}
    now = commits.folders(spark, root)
    assert {p for p in first if now[p] != first[p]} == {"d1/numeric_scalar", "d1/text_scalar"}


def test_last_row_of_a_key_needs_no_sort_after_the_exchange(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id % 7 AS o", "id AS v")
    assert {r.k: (r.o, r.v) for r in merge.last_by(df, ["k"], ["o"]).collect()} == {k: max((i % 7, i) for i in range(1000) if i % 3 == k) for k in range(3)}
    plan = merge.last_by(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


@pytest.mark.parametrize("most", [3, 50, 10_000])
def test_medians(spark, most):
    rng = np.random.default_rng(1)
    groups = {"even": rng.normal(size=2000), "odd": rng.normal(size=2001) ** 9, "one": [4.0], "two": [1.0, 4.0], "same": [7.0] * 900, "halves": [0.0] * 500 + [1.0] * 500, "steps": [float(i // 300) for i in range(1501)], "none": []}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("none", None), ("two", None)], "g string, v double").repartition(3)
    got = {r.g: r.m for r in order_stats.medians(df, ["g"], "v", "m", most, accuracy=200).collect()}
    assert got == {g: statistics.median(map(float, x)) for g, x in groups.items() if len(x)}


@pytest.mark.parametrize("vector", [False, True])
def test_hot_signal_is_spread_evenly_with_equal_results(spark, vector, monkeypatch):
    n = 6000
    x = F.when(F.col("id") % 13 == 0, F.lit(float("nan"))).when((F.col("id") % 17 == 0) & F.lit(vector), F.lit(float("inf"))).otherwise(F.sin(F.col("id") * 1.7) * (F.col("id") % 50))
    hot = (F.col("id") % 2 == 0) | (F.col("id") > n - 50)
    df = spark.range(n).select(F.when(hot, "hot").otherwise(F.concat(F.lit("pv"), F.col("id") % 40)).alias("pv"), F.lit("d").alias("bucket"), F.lit(0).alias("comp"), (F.col("id") * 1000).alias("seq"), (F.col("id") * F.col("id") % 100_000).cast("double").alias("offset_ms"), x.alias("x"))
    df = df if vector else df.drop("comp")
    tables = {}
    kept = hot_stats.stored
    monkeypatch.setattr(hot_stats, "stored", lambda f, label: tables.setdefault(label, kept(f, label)))
    keys = ["pv", "bucket", *["comp"] * vector]
    got = {tuple(r[k] for k in keys): r.asDict() for r in hot_stats.balanced_stats(df, vector, hot=1000, blocks=8, most=100).collect()}
    want = {tuple(r[k] for k in keys): r.asDict() for r in (stats.vector_stats if vector else stats.scalar_stats)(df).collect()}
    assert got.keys() == want.keys() and len(got) == 21
    for k, w in want.items():
        assert got[k].keys() == w.keys()
        assert all(got[k][c] == pytest.approx(w[c], rel=1e-9, nan_ok=True) for c in w if c not in ("pv", "bucket", "comp"))
    sizes = [r["count"] for r in tables["ranges"].groupBy("_p").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes) and len(sizes) > 4


def _files(tmp_path, texts):
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    return f"file://{tmp_path}"


def test_headers_are_carried_within_files(spark, tmp_path):
    path = _files(tmp_path, {
        "a.txt": ["# file x", "# PV name A:1", "# t0 5", "# Nval 2", "", "10 1 2", "  ", "20 3 4"], "b.txt": ["# PV name B", "1 2"], "c.txt": ["# t0 7", "1 9"], "d.txt": ["# PV name D", "# t0 x", "# Nval 3", "5 5", "6 6"], "e.txt": [""],
    })
    lines, rejects = readers.read_samples(spark, path)
    got = [(r.pv, r.t0, r.nval, r.line) for r in lines.orderBy("src", "block", "seq").collect()]
    assert got == [("A:1", 5, 2, "10 1 2"), ("A:1", 5, 2, "20 3 4"), ("B", 5, 2, "1 2"), ("D", 5, 3, "5 5"), ("D", 5, 3, "6 6")]
    assert [(r.src[-5:], r.reason) for r in rejects.collect()] == [("c.txt", "no PV name")]
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("FileScan text") == 1


def test_headers_of_files_with_many_splits(spark, tmp_path):
    path = _files(tmp_path, {f"{k}.txt": [f"# PV name {k}", "# t0 1", *[f"{i} {i * i}" for i in range(n)]] for k, n in (("long", 4000), ("short", 3), ("more", 900))})
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        lines, _ = readers.read_samples(spark, path)
        assert lines.select("src", "block").distinct().count() > 8
        got = {}
        for r in lines.orderBy("src", "block", "seq").collect():
            got.setdefault(r.pv, []).append(r.line)
    finally:
        spark.conf.set(key, before)
    assert got == {k: [f"{i} {i * i}" for i in range(n)] for k, n in (("long", 4000), ("short", 3), ("more", 900))}


def test_events_join_nothing_to_become_samples(spark, sf_dir):
    """Their words come from the rows themselves, so that making records costs no shuffle of the events."""
    from pulsevault.plans.record_queries import typed_samples

    plan = typed_samples(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and typed_samples(spark, sf_dir).where("startswith(pv, 'T')").first().txts[1].startswith("u")

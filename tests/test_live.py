"""Streams with state of their own: open buckets against a plain replay, the live ledger against the batch ledger."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsevault.operators import logs as L
from pulsevault.sources import commits
from pulsevault.sources.shared import shared_path
from pulsevault.streaming import jobs

DAY = 86_400_000


def disordered(n=400, signals=3):
    rng = random.Random(5)
    return [(f"p{i % signals}", i, 0, float((i // 40 - rng.choice([0, 0, 0, 1, 2, 5])) * DAY + rng.choice([0, 1, 1])), float("nan") if i % 9 == 0 else rng.random()) for i in range(n)]


def replay(samples, most):
    """One sample after the other, as they arrive; a row per flush and per bucket left open."""
    out = []
    for pv in sorted({s[0] for s in samples}):
        buffers = {}
        for _, seq, _, ms, x in (s for s in samples if s[0] == pv):
            b = buffers.setdefault(f"d{int(ms // DAY)}", {"opened": seq, "xs": []})
            b["xs"].append(x)
            b["last"] = ms
            if len(buffers) > max(1, most):
                victim = min(buffers, key=lambda k: buffers[k]["last"])  # the first of equal ones
                out.append((pv, victim, buffers[victim]["opened"], len(buffers[victim]["xs"]), False))
                del buffers[victim]
        out += [(pv, k, b["opened"], len(b["xs"]), True) for k, b in buffers.items()]
    return sorted(out)


class Handle:
    """What a processor asks of its state, in memory."""

    def __init__(self):
        self.kept, self.timers = {}, []

    def getMapState(self, *_):
        return self

    def iterator(self):
        return iter(list(self.kept.items()))

    def clear(self):
        self.kept.clear()

    def updateValue(self, k, v):
        self.kept[k] = v

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, t):
        self.timers.remove(t)

    def registerTimer(self, t):
        self.timers.append(t)

    def getCurrentProcessingTimeInMs(self):
        return 1000


def through(samples, most, batch, idle_ms=0):
    handles, rows = {}, []
    for at in range(0, len(samples), batch):
        part = pd.DataFrame(samples[at : at + batch], columns=["pv", "seq", "t0", "at", "x"])
        part["bucket"] = [f"d{int(ms // DAY)}" for ms in part["at"]]
        for pv, own in part.groupby("pv"):
            h = handles.setdefault(pv, Handle())
            p = jobs.OpenBuckets(most, idle_ms)
            p.init(h)
            shuffled = own.sample(frac=1, random_state=at)
            rows += [r for f in p.handleInputRows((pv,), iter([shuffled.iloc[::2], shuffled.iloc[1::2]]), h) for r in f.itertuples(index=False)]
    return rows, handles


@pytest.mark.parametrize("most", [1, 2, 8])
@pytest.mark.parametrize("batch", [1, 37, 1000])
def test_open_buckets_equal_a_replay(most, batch):
    samples = disordered()
    rows, _ = through(samples, most, batch)
    last = {}
    for r in rows:
        last[r.pv, r.bucket, r.opened] = max(last.get((r.pv, r.bucket, r.opened), ()), (r.length, not r.open))
    assert sorted((*k, n, not done) for k, (n, done) in last.items()) == replay(samples, most)


def test_idle_signals_are_flushed_by_a_timer():
    samples = disordered(60, 1)
    rows, handles = through(samples, 4, 60, idle_ms=500)
    h = handles["p0"]
    assert h.timers == [1500] and h.kept
    p = jobs.OpenBuckets(4, 500)
    p.init(h)
    (gone,) = p.handleExpiredTimer(("p0",), h, None)
    assert sorted(gone["bucket"]) == sorted(r.bucket for r in rows if r.open) and not gone["open"].any() and not h.kept


def test_open_buckets_of_a_stream_count_their_values(spark):
    samples = disordered(200, 2)
    src, path = shared_path(spark, "open-in"), shared_path(spark, "open")
    for i in range(3):
        spark.createDataFrame(samples[i * 70 : (i + 1) * 70], jobs.SAMPLE).coalesce(1).write.mode("append").parquet(src)
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        s = jobs.stream_samples(spark, src, files_per_tick=1).withColumn("bucket", F.concat(F.lit("d"), F.floor(F.col("offset_ms") / DAY)))
        jobs.one_shot(jobs.open_buckets(s, 2), path + "-cp", path=path)
    finally:
        spark.conf.set(store, before)
    got = jobs.flushes_of(spark.read.schema(jobs.FLUSH).parquet(path)).collect()
    assert sorted((r.pv, r.bucket, r.opened, r.length, r.open) for r in got) == replay(samples, 2)
    assert sum(r.valid for r in got) == sum(x == x for *_, x in samples)
    assert sum(r.total or 0 for r in got) == pytest.approx(sum(x for *_, x in samples if x == x))


@pytest.mark.parametrize("compact", [1, 2, 100])
def test_live_ledger_equals_the_batch_ledger(spark, compact):
    """A success told by its output is followed by a failure told by its input; chunks come before and after other events of their log,
    in other batches."""
    inputs = spark.createDataFrame([(f"/data/g/PV:{i}.pb",) for i in range(6)], "path string")
    out, src = "/out/g/PV-{}.parquet".format, "/data/g/PV:{}.pb".format
    lines = [
        ("a", f"SAVED: {out(0)}"), ("a", f"FAIL: {src(0)} - broken"), ("a", "SAVED CHUNK: /out/g/PV-1_chunk0001.parquet"), ("a", f"SAVED: {out(1)}"), ("a", f"SAVED: {out(2)}"),
        ("a", "SAVED CHUNK: /out/g/PV-2_chunk0001.parquet"), ("b", "SAVED CHUNK: /out/g/PV-3_chunk0001.parquet"), ("b", f"SKIP: {src(4)} (empty)"), ("a", f"SAVED: {out(4)}"), ("a", f"SAVED: {out(9)}"), ("c", "nothing"),
    ]
    df = spark.createDataFrame([(f, i, t) for i, (f, t) in enumerate(lines)], "file string, line_no long, line string")
    root = shared_path(spark, "ledger")
    each = jobs.live_ledger(spark, root, inputs, "/out", "/data", compact_every=compact)
    for n, at in enumerate(range(0, len(lines), 3)):
        each(df.where(F.col("line_no").between(at, at + 2)), n)
    each(df.where(F.col("line_no").between(0, 2)), 0)  # a batch that is run again
    got = {r.target: (r.status, r.message) for r in jobs.ledger_now(spark, root).collect()}
    want = {r.target: (r.status, r.message) for r in L.last_status(L.resolved_events(L.log_events(df), inputs, "/out", "/data")).collect()}
    assert got == want == {src(0): ("failed", "broken"), src(1): ("success", ""), src(2): ("success", ""), src(3): ("chunked", ""), src(4): ("skipped", "empty")}
    if compact == 1:
        assert len(commits.folders(spark, root)["all"]) == 1


def test_live_ledger_stores_a_row_a_log_and_target_and_no_line(spark, monkeypatch):
    kept, stored = [], L.stored
    monkeypatch.setattr(L, "stored", lambda df, label: kept.append(stored(df, label)) or kept[-1])
    inputs = spark.createDataFrame([("/data/g/PV:1.pb",), ("/data/g/PV:2.pb",)], "path string")
    lines = [("a", i, f"FAIL: /data/g/PV:{1 + i % 2}.pb - broken {i}") for i in range(40)] + [("a", 50, "SAVED CHUNK: /out/g/PV-1_chunk0001.parquet"), ("b", 1, "SAVED CHUNK: /out/g/PV-2_chunk0001.parquet")]
    root = shared_path(spark, "ledger")
    jobs.live_ledger(spark, root, inputs, "/out", "/data")(spark.createDataFrame(lines, "file string, line_no long, line string"), 0)
    assert kept[0].count() == 4
    assert {r.target: (r.status, r.message) for r in jobs.ledger_now(spark, root).collect()} == {"/data/g/PV:1.pb": ("failed", "broken 38"), "/data/g/PV:2.pb": ("chunked", "")}


def test_statistics_that_grow_read_their_own_signals_only(spark):
    """Whatever the batches, the result is that of all samples; a batch that is run again changes nothing."""
    from pulsevault.operators.stats import scalar_stats

    rng = random.Random(3)
    rows = [(f"p{i % 7}", i, 0, float(i * 1000), float("nan") if i % 9 == 0 or i % 7 == 3 else rng.gauss(1e6, 3), f"b{i // 100}") for i in range(300)]
    df = spark.createDataFrame(rows, jobs.SAMPLE + ", bucket string")
    root = shared_path(spark, "grow")
    each = jobs.incremental_stats(spark, root, slots=4)
    batches = [df.where("seq % 3 = 0 and pv in ('p0', 'p1')"), df.where("seq % 3 != 0"), df.where("seq < 0"), df.where("seq % 3 = 0 and pv not in ('p0', 'p1')")]
    for n, b in enumerate(batches):
        each(b, n)
    jobs.incremental_stats(spark, root, slots=4)(batches[3], 3)
    got = {(r.pv, r.bucket): r.asDict() for r in jobs.stats_now(spark, root).collect()}
    want = {(r.pv, r.bucket): r.asDict() for r in scalar_stats(df).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k].keys() == w.keys()
        assert all(got[k][c] == (w[c] if w[c] is None else pytest.approx(w[c], rel=1e-9)) for c in w if c not in ("pv", "bucket"))
    ordered = commits.read_table(spark, f"{root}/ordered")
    assert {r.pv for r in ordered.where("batch = 0").select("pv").distinct().collect()} == {"p0", "p1"}


def test_a_batch_of_one_file_is_written_by_many_tasks_and_keeps_what_adds_up_once(spark):
    rows = [(f"p{i % 50}", i, 0, float(i * 1000), float(i % 13), f"b{i // 250}") for i in range(1000)]
    root = shared_path(spark, "wide")
    jobs.incremental_stats(spark, root, slots=4)(spark.createDataFrame(rows, jobs.SAMPLE + ", bucket string").coalesce(1), 0)
    files = spark.read.parquet(f"{root}/samples").select(F.element_at(F.split("_metadata.file_name", "-"), 2).alias("task")).distinct().count()
    assert files > 1
    assert not set(commits.read_table(spark, f"{root}/ordered").columns) & set(jobs.ADDED_UP)


def test_moments_merge_in_any_order(spark):
    rows = [("p", "b", float(x)) for x in (1, 2, 3, 10, 20)] + [("p", "b", float("nan"))]
    df = spark.createDataFrame(rows, "pv string, bucket string, x double")
    parts = [jobs.part_moments(df.where(c)) for c in ("x < 3", "x >= 3 and x < 20", "x >= 20")]
    nested = jobs.merged_moments(jobs.merged_moments(parts[2].unionByName(parts[0])).unionByName(parts[1]))
    r = jobs.algebraic_stats(nested).first()
    assert (r.length, r.nan_count, r.min, r.max) == (6, 1, 1, 20) and r.mean == pytest.approx(7.2) and r.std == pytest.approx(7.1386273190299)


def test_text_files_over_batches_equal_the_batch_reader(spark, tmp_path):
    from pulsevault.sources import readers

    for i in range(5):
        (tmp_path / f"f{i}.txt").write_text("\n".join([f"# PV name P{i}", *([f"# t0 {i + 1}", "# Nval 1"] if i != 3 else []), *[f"{j} {i}.5" for j in range(20)]]) + "\n")
    out = shared_path(spark, "text")
    jobs.one_shot(jobs.stream_text(spark, f"file://{tmp_path}", files_per_tick=2), out + "-cp", jobs.keep_lines(spark, out))
    jobs.one_shot(jobs.stream_text(spark, f"file://{tmp_path}", files_per_tick=2), out + "-cp", jobs.keep_lines(spark, out))  # nothing new
    cols = ["src", "pv", "t0", "nval", "line"]
    got = sorted(map(tuple, spark.read.parquet(f"{out}/lines").select(*cols).collect()))
    want = sorted(map(tuple, readers.read_samples(spark, f"file://{tmp_path}")[0].select(*cols).collect()))
    assert got == want and len(got) == 100


def test_months_close(spark):
    """A sample so late that its month has been freed is left out; months that are open take late ones."""
    src, path = shared_path(spark, "months-in"), shared_path(spark, "months")
    stamp = lambda m, d: 1704034800000 + int((pd.Timestamp(2024, m, d) - pd.Timestamp(2024, 1, 1)).total_seconds() * 1000)
    for part in ([(1, 5), (1, 20)], [(2, 3)], [(1, 31), (2, 9)], [(5, 2)], [(5, 3)], [(1, 9), (4, 30)]):
        rows = [("p", i, stamp(m, d), 0.0, float(d)) for i, (m, d) in enumerate(part)]
        spark.createDataFrame(rows, jobs.SAMPLE).coalesce(1).write.mode("append").parquet(src)
    stream = jobs.tumbling(jobs.with_time(jobs.stream_samples(spark, src, files_per_tick=1)), "month", 9, "1 day")
    jobs.one_shot(stream, path + "-cp", jobs.keep_updates(path, ["pv", "bucket"], compact_every=3), mode="update")
    got = {r.bucket: (r.length, r["min"], r["max"]) for r in jobs.latest_updates(spark, path, ["pv", "bucket"]).collect()}
    assert got == {"2024_01": (3, 5, 31), "2024_02": (2, 3, 9), "2024_04": (1, 30, 30), "2024_05": (2, 2, 3)}
    assert len(commits.folders(spark, path)["all"]) < 6


class Listed:
    """State of a slot as one list, in memory; counts how often it is written."""

    def __init__(self):
        self.kept, self.writes = [], 0

    def getListState(self, *_):
        return self

    def get(self):
        return iter(self.kept)

    def put(self, rows):
        self.kept, self.writes = list(rows), self.writes + 1


@pytest.mark.parametrize("most", [1, 3])
def test_a_slot_of_signals_is_one_call_a_batch(most):
    samples, h, last, told = disordered(), Listed(), {}, []
    for at in range(0, len(samples), 37):
        part = pd.DataFrame(samples[at : at + 37], columns=["pv", "seq", "t0", "at", "x"])
        part["bucket"] = [f"d{int(ms // DAY)}" for ms in part["at"]]
        p = jobs.SlotBuckets(most)
        p.init(h)
        shuffled = part.sample(frac=1, random_state=at)
        (found,) = p.handleInputRows((0,), iter([shuffled.iloc[::2], shuffled.iloc[1::2]]), None)
        told += found.itertuples(index=False)
    for r in told:
        last[r.pv, r.bucket, r.opened] = max(last.get((r.pv, r.bucket, r.opened), ()), (r.length, not r.open))
    assert sorted((*k, n, not done) for k, (n, done) in last.items()) == replay(samples, most)
    assert h.writes == -(-len(samples) // 37) and len({r.pv for r in told}) > 1


def test_runs_of_a_slot_of_signals():
    h, got = Listed(), []
    for batch in ([("p", "a", 2), ("q", "a", 1), ("p", "b", 3)], [("p", "b", 4), ("p", "a", 1), ("q", "b", 5)], [("p", "a", 9), ("r", "c", 0)]):
        p = jobs.SegmentRuns()
        p.init(h)
        (found,) = p.handleInputRows((0,), iter([pd.DataFrame(batch, columns=["pv", "bucket", "seq"])]), None)
        got += [tuple(r) for r in found.itertuples(index=False)]
    want = [("p", "a", 1, 0, True), ("p", "a", 2, 1, False), ("p", "a", 9, 3, False), ("p", "b", 3, 2, False), ("p", "b", 4, 2, False), ("q", "a", 1, 1, False), ("q", "b", 5, 2, False), ("r", "c", 0, 1, False)]
    assert sorted(got) == want and h.writes == 3

"""Streams give the same whatever the order of files, their times and the number of micro-batches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from pulsevault.plans.io_queries import upserted
from pulsevault.sources.shared import shared_path
from pulsevault.streaming import jobs

SAMPLES = [(f"p{i % 5}", i, 1704034800000, float(i % 40 * 7_200_000), float(i)) for i in range(600)]


def input_files(spark, tmp_path, order, equal_times=False):
    """The samples in seven files, written in the given order."""
    path = str(tmp_path / "in")
    df = spark.createDataFrame(SAMPLES, jobs.SAMPLE)
    for i in order:
        df.where(F.col("seq") % 7 == i).coalesce(1).write.mode("append").parquet(path)
    if equal_times:
        for name in os.listdir(path):
            os.utime(f"{path}/{name}", (1_700_000_000, 1_700_000_000))
    return path


@pytest.mark.parametrize(("files_per_tick", "order", "equal_times"), [(7, range(7), False), (3, range(6, -1, -1), False), (1, [3, 0, 6, 2, 5, 1, 4], False), (1, range(7), True), (3, range(6, -1, -1), True)])
def test_upserts_keep_the_last_sample(spark, tmp_path, files_per_tick, order, equal_times):
    got = {(r.pv, r.date): r.seq for r in upserted(spark, input_files(spark, tmp_path, order, equal_times), files_per_tick).collect()}
    want = {}
    for pv, seq, _, ms, _ in SAMPLES:
        want[pv, f"2024_01_0{1 + int(ms // 86_400_000)}"] = seq
    assert got == want


def test_a_batch_that_is_run_again_changes_nothing(spark):
    path = shared_path(spark, "again")
    rows = lambda a, b: spark.createDataFrame([(f"k{i % 10}", i, "d" + str(i % 2)) for i in range(a, b)], "pv string, seq long, date string")
    each = jobs.upsert_batches(spark, path, "pv", ["seq"], "date")
    for n, (a, b) in enumerate([(0, 30), (30, 60)]):
        each(rows(a, b), n)
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    jobs.upsert_batches(spark, path, "pv", ["seq"], "date")(rows(30, 60), 1)  # a new process
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before and len(before) == 10


def test_months_are_sums_of_days(spark):
    rng = random.Random(0)
    rows = [("p", f"2024_0{1 + i // 20}_{1 + i % 20:02}", [rng.gauss(5, 2) for _ in range(rng.randrange(1, 9))]) for i in range(40)]
    days = [(p, d, len(x), len(x), min(x), max(x), sum(x) / len(x), (sum((v - sum(x) / len(x)) ** 2 for v in x) / len(x)) ** 0.5) for p, d, x in rows]
    got = {r.bucket: r for r in jobs.months_of(spark.createDataFrame(days, "pv string, bucket string, length long, valid long, min double, max double, mean double, std double")).collect()}
    for month in ("2024_01", "2024_02"):
        x = [v for _, d, xs in rows if d.startswith(month) for v in xs]
        mean = sum(x) / len(x)
        assert (got[month].length, got[month].min, got[month].max) == (len(x), min(x), max(x))
        assert got[month].mean == pytest.approx(mean) and got[month].std == pytest.approx((sum((v - mean) ** 2 for v in x) / len(x)) ** 0.5)


def test_nothing_is_set_for_the_session(spark, sf_dir):
    from pulsevault.plans import registry

    before = {r.key: r.value for r in spark.sql("SET").collect()}
    registry.queries()["t03_strict_segments"](spark, sf_dir).count()
    registry.queries()["b09_assign_bundles"](spark, sf_dir).count()
    assert {r.key: r.value for r in spark.sql("SET").collect() if r.key != "spark.sql.streaming.stateStore.providerClass"} == {k: v for k, v in before.items() if k != "spark.sql.streaming.stateStore.providerClass"}

"""The plans that the engine is built around: numbers of exchanges, column pruning, no Python, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from pulsevault.operators import catalog, ledger, stats
from pulsevault.plans import registry
from pulsevault.plans.tables import components, scalar_samples, table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_all_scalar_statistics_share_one_exchange(spark, sf_dir):
    df = stats.scalar_stats(scalar_samples(spark, sf_dir))
    assert exchanges(df) == 1
    assert len(re.findall(r"Sort \[", plan(df))) == 4  # by arrival, value, deviation and interval
    assert not re.search(r"(percentile|median)\(", plan(df))


def test_vector_statistics_share_one_exchange(spark, sf_dir):
    assert exchanges(stats.vector_stats(components(spark, sf_dir))) == 1


def test_unused_columns_are_not_read(spark, sf_dir):
    df = stats.scalar_stats(scalar_samples(spark, sf_dir)).select("pv", "bucket", "mean")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(df))[1]
    assert "props" not in schema and "event_type" not in schema


def test_filters_reach_the_scan(spark, sf_dir):
    df = table(spark, sf_dir, "events").where("event_id < 10 and event_type = 'view'").select("event_id")
    assert "PushedFilters: [IsNotNull(event_id), IsNotNull(event_type), LessThan(event_id,10), EqualTo(event_type,view)]" in plan(df)


def test_candidates_are_an_anti_join(spark):
    cat = spark.range(10).select(F.col("id").cast("string").alias("path"))
    led = cat.withColumn("status", F.lit("success"))
    assert "LeftAnti" in plan(ledger.new_candidates(cat, led))
    assert "Nested" not in plan(catalog.exclude(cat, spark.createDataFrame([("a",)], "token string")))


@pytest.mark.parametrize("name", ["a00_all_scalar_stats", "a21_vector_packing", "b03_segment_runs", "j05_resolve_output_to_input", "l02_last_status", "l04_submission_summary", "m06_union_promote", "m08_upsert_day", "p06_fit_width"])
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


@pytest.mark.parametrize("name", ["l04_submission_summary", "l15_summary_rows", "k05_dashboard_report"])
def test_generated_code_of_log_queries_compiles(name, spark, sf_dir):
    """Code that is too large would be an error, where it is else interpreted."""
    key = "spark.sql.codegen.fallback"
    spark.conf.set(key, "false")
    try:
        assert registry.queries()[name](spark, sf_dir).collect()
    finally:
        spark.conf.unset(key)


def test_facts_of_logs_read_what_is_stored_once(spark, sf_dir):
    from pulsevault.operators import logs as L
    from pulsevault.plans.tables import logs

    df = L.job_facts(logs(spark, sf_dir))
    assert plan(df).count("FileScan") == 1 and exchanges(df) == 1

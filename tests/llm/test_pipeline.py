import pytest

import corpus_pipeline
from pulsevault.llm import decontamination, near_dedup, packing, quality_rules, secrets

from . import test_decontamination, test_near_dedup, test_packing, test_quality_rules
from .helpers import ODD, documents, edited, text


def test_run_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = []
    for i, t in rows:
        c = test_quality_rules.brute(t)
        if c[0] >= 50 and 100 * c[4] <= 50 * c[0]:
            kept.append((i, t))
    alone = {r[0] for r in test_near_dedup.brute(kept, 5, 80) if r[3]}
    kept = [r for r in kept if str(r[0]) in alone]
    bad = {r[0] for r in test_decontamination.brute(kept, items) if r[-1]}
    kept = [(i, secrets.redact(t)) for i, t in kept if str(i) not in bad]
    assert 0 < len(kept) < len(rows)
    test_packing.check(spark, kept, corpus_pipeline.run(spark, sf_dir))


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "decontamination", "secret scan", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert sorted(stage(spark, docs, sf_dir).columns) == sorted(docs.columns)
    assert {quality_rules, near_dedup, decontamination, packing}  # the modules that the stages call


LONG = text(1, 30_000)
ROWS = [*ODD, (20, text(20, 90)), (20, text(20, 90)), (21, edited(text(20, 90), 3, 0.01)), (22, text(22, 60) + " password=hunter2hunter2"), (23, LONG), (None, text(24, 70)), (None, None), (25, text(25, 49))]


@pytest.mark.parametrize("rows", [[], ROWS])
def test_odd_rows_go_through_every_stage(spark, sf_dir, rows):
    """Nulls, empty and very long texts, repeated rows and ids, an empty table and columns with the names used inside."""
    docs = documents(spark, rows, extra=True).selectExpr("*", "'clash' AS _flags", "'clash' AS _host", "'clash' AS _gone", "'clash' AS component_id", "'clash' AS rule")
    want = {
        "quality rules": [(i, t) for i, t in rows if (c := test_quality_rules.brute(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]],
        "decontamination": rows, "secret scan": [(i, secrets.redact(t)) for i, t in rows],
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert sorted(found.columns) == sorted(docs.columns)
        got = [(r.doc_id, r.text) for r in found.collect()]
        if name in want:
            assert sorted(got, key=repr) == sorted(want[name], key=repr), name
        else:
            dropped = [r for r in test_near_dedup.brute(rows, 5, 80) if not r[3]]
            assert {str(i) for i, _ in got} == {str(i) for i, _ in rows} - {r[0] for r in dropped}
            assert [i for i, _ in got].count(20) == (1 if rows else 0) and [i for i, _ in got].count(None) == sum(i is None for i, _ in rows)
    test_packing.check(spark, rows, corpus_pipeline.packing_stage(spark, docs, sf_dir))

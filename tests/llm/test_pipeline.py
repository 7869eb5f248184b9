"""The pipeline's stages take effect one after the other."""

import corpus_pipeline
from tests.conftest import SF01
from tierlake.llm import decontaminate, near_dedup, pii
from tierlake.sources.tables import table


def test_run(spark):
    docs = table(spark, SF01, "documents")
    out = corpus_pipeline.run(spark, SF01)
    assert set(docs.columns) < set(out.columns)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0.6 * docs.count() < len(ids) < docs.count()
    last = out.select(docs.columns)
    assert near_dedup.near_duplicates(last).where("not kept").count() < 0.01 * len(ids)
    assert decontaminate.leaks(last, table(spark, SF01, "benchmark")).count() == 0
    assert pii.spans(last).where("n_email + n_ip + n_phone > 0").count() == 0

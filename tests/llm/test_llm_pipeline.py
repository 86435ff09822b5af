"""The five stages one after the other."""

import corpus_pipeline
import pytest
from llm_cases import docs, empty, rows

from faqspark.llm import packing, pii


@pytest.fixture(scope="module")
def stages():
    return dict(corpus_pipeline.STAGES)


def test_stages_keep_the_columns(spark, sf, stages):
    frame = docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf)
        assert frame.columns == docs(spark).columns, name
        frame = spark.createDataFrame(frame.collect(), frame.schema)
    assert stages["packing"](spark, frame, sf).count() > 0


def test_stages_stand_an_empty_table(spark, sf):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), sf).count() == 0, name


def test_run_packs_clean_text(spark, sf):
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.columns == [c.split()[0] for c in packing.PACKED.split(", ")]
    found = pieces.collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert found and {p.doc_id for p in found} <= ids


def test_redaction_stage_leaves_no_well_formed_spans(spark, sf, stages):
    clean = stages["personal_data"](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert not any(pii.base_spans(r.text or "") for r in clean.collect())
    assert len(rows()) > 0

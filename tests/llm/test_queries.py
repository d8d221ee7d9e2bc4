"""The queries against their SQL, and the pipeline end to end."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from canvass.llm import decontaminate, neardup, queries

from ..oracle import difference


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, sf_dir, name):
    assert difference(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], sf_dir.replace("0.001", "0.01")) == ""


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], folder).cache())
    counts = [k.count() for k in kept]
    assert all(k.columns == docs.columns for k in kept[:-1])
    assert kept[-1].columns == [*docs.columns, "copy"]
    assert counts[0] > counts[1] and counts[1] >= counts[2] > counts[3] > counts[4] > 0
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept[1].select("doc_id").collect()}
    clean = [d for d, t in labels.items() if t == 0]
    assert sum(d in left for d in clean) >= 0.98 * len(clean)
    # near copies: every component of the stage's own input is left with one document
    got = neardup.report(kept[3]).select("component_id").distinct().count()
    assert got == counts[3]
    found = decontaminate.report(kept[4], spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert found.where("contaminated").count() == 0
    for k in kept[1:]:
        k.unpersist()


def test_stages_on_empty_tables_and_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (2, "word " * 30_000, "en", None, 1)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), sf_dir)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() == 0, name
        extra = odd.withColumns({c: F.lit("x") for c in ("score", "row", "spans", "component_id", "c0", "size", "_doc_id")})
        got = stage(spark, extra, sf_dir)
        assert got.columns[: len(extra.columns)] == extra.columns and got.count() <= 3 * odd.count(), name


def test_run_equals_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and out.columns[-1] == "copy"
    assert out.exceptAll(corpus_pipeline.run(spark, sf_dir)).count() == 0

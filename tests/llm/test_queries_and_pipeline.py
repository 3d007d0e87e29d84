"""The registered queries against DuckDB, and the stages of the pipeline against plain models."""

import os
from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from llm.models import contamination, edge_table, near_groups, shingles

from tarnkeep.llm import attention
from tarnkeep.llm.registry import LLM_ORACLES, LLM_QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        table = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{file}'")
    frame = LLM_QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = connection.execute(f"SELECT {listed} FROM ({LLM_ORACLES[name]})").fetchall()
    assert Counter(tuple(r) for r in frame.select(*columns).collect()) == Counter(expected)


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in LLM_QUERIES


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]

    scores = {r.doc_id: r.score for r in attention.op4(docs, labels).collect()}
    kept = {r.doc_id for r in stages["quality"](spark, docs, SF_DIR).collect()}
    assert kept == {i for i, s in scores.items() if s >= attention.THRESHOLD}

    roots = near_groups({i: shingles(t, 5) for i, t in rows.items()})
    kept = {r.doc_id for r in stages["near_dedup"](spark, docs, SF_DIR).collect()}
    assert kept == set(roots.values())

    kept = {r.doc_id for r in stages["decontaminate"](spark, docs, SF_DIR).collect()}
    assert kept == {i for i, t in rows.items() if not contamination(t, items)[1]}

    for name in ("quality", "near_dedup", "decontaminate", "mix"):
        assert stages[name](spark, docs, SF_DIR).columns == docs.columns
    last = stages["shard"](spark, docs, SF_DIR)
    assert last.count() == len(rows) and set(docs.columns) < set(last.columns)


def test_run_is_the_chain_of_stages(spark):
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert ids == {r.doc_id for r in docs.select("doc_id").collect()} and ids


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_and_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    frame = edge_table(spark)
    result = stage(spark, frame, SF_DIR)
    assert set(frame.columns) <= set(result.columns)
    assert 0 < result.count() <= frame.count()
    assert stage(spark, edge_table(spark, []), SF_DIR).count() == 0

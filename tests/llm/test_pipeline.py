"""The pipeline: every stage on what its predecessor kept, and the whole run."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from test_operators import check_packing, empty, odd  # noqa: F401

from eocube.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        tables.append((name, docs))
    return tables


def test_stages_return_the_columns_of_documents(stages):
    columns = stages[0][1].dtypes
    assert all(df.dtypes == columns for _, df in stages[:-1])
    assert [n for n, _ in stages] == ["documents", "quality", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_each_stage_decides_on_its_input(spark, stages):
    tables = {n: sorted((r.doc_id, r.text) for r in df.collect()) for n, df in stages[:-1]}
    accepted = {r.doc_id for r in queries.op3_quality_rules(spark, FOLDER).where("predicted = 1").collect()}
    assert [i for i, _ in tables["quality"]] == sorted(accepted)
    assert [brute_line[-1] for brute_line in brute.line_dedup(tables["quality"])] == [
        brute.line_dedup([d])[0][-1] for d in tables["line_dedup"]
    ]
    parts = brute.components(tables["line_dedup"])
    assert tables["near_dedup"] == [d for d in tables["line_dedup"] if parts[d[0]] == d[0]]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {i for i, _ in set(tables["near_dedup"]) - set(tables["decontamination"])}
    assert {i for i, _ in brute.passages([d for d in tables["near_dedup"] if d[0] in gone], items)} == gone
    bins, least = check_packing(stages[-1][1].collect(), tables["decontamination"])
    assert bins <= least + 2


def test_run_is_the_stages_one_after_the_other(spark, stages):
    got = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[-1][1].collect())


def through(spark, docs, root):
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
    return docs


def test_odd_rows_through_all_stages(spark, odd, tmp_path):  # noqa: F811
    """Null ids and texts, repeated rows, a long text and clashing column names."""
    packed = through(spark, odd, tmp_path)
    kept = spark.read.parquet(str(tmp_path / "decontamination"))
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    check_packing(packed.where("doc_id is not null").collect(), [(r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()])


def test_an_empty_table_through_all_stages(spark, empty, tmp_path):  # noqa: F811
    assert through(spark, empty, tmp_path).count() == 0

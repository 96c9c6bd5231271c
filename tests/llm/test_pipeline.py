"""The corpus pipeline: each stage on all its predecessor kept."""

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from wardline.llm import queries, toxicity
from wardline.llm.text import made, staged


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], small)))
    return out


def test_all_but_the_last_keep_the_columns(stages):
    assert all(x.columns == stages[0].columns for x in stages[:-1])


def test_toxic_documents_go_and_others_stay(spark, small, stages):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(stages[0], labels).collect()}
    assert {r.doc_id for r in stages[1].collect()} == {k for k, p in scores.items() if not p}


def test_line_dedup_and_masking_keep_every_document(stages):
    ids = [{r.doc_id for r in x.collect()} for x in stages[:-1]]
    assert ids[2] == ids[1] and ids[4] == ids[3] and ids[3] <= ids[2]
    for x in (stages[2], stages[4]):
        assert all(r.n_chars == len(r.text) for r in x.collect())
    assert not any("AKIA" in r.text and "[SECRET]" not in r.text for r in stages[4].collect())


def test_packing_covers_what_is_left(stages):
    assert {r.doc_id for r in stages[5].collect()} == {r.doc_id for r in stages[4].collect()}


def test_run_is_the_stages_in_turn(spark, small, stages):
    got = corpus_pipeline.run(spark, small)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[5].collect()))


def test_a_stage_removes_what_the_last_one_made(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = set(made())
    (_, first), (_, second) = corpus_pipeline.STAGES[:2]
    lazy = first(spark, docs, small)
    assert set(made()) - before
    chained = second(spark, lazy, small)  # its documents still read the first stage's tables
    assert chained.count() == lazy.count()
    lazy.write.parquet(f"{tmp_path}/stored")
    second(spark, spark.read.parquet(f"{tmp_path}/stored"), small).write.parquet(f"{tmp_path}/again")
    own = set(corpus_pipeline._LAST)
    assert own
    corpus_pipeline.STAGES[3][1](spark, spark.read.parquet(f"{tmp_path}/again"), small)
    assert not set(made()) & own and spark.read.parquet(f"{tmp_path}/again").count() == lazy.count()


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(queries.oracle_sql()) <= set(names)

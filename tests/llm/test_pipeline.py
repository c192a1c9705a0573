"""The pipeline's stages against plain versions, and the registered queries against their twins."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tidequote.llm import quality
from tidequote.llm.queries import ORACLES, QUERIES
from tidequote.llm.secret_scan import find_spans, masked


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory, sf_dir):
    """A folder with labels for the messy documents' stages."""
    folder = tmp_path_factory.mktemp("tables")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages(spark, documents, sf_dir):
    docs, held = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = corpus_pipeline.land(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert held[name].columns == documents.columns
        docs = held[name]
    params = quality.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality.score_quality(documents, params).where("predicted = 1").collect()}
    assert {r.doc_id for r in held["quality"].collect()} == good
    masked_texts = {r.doc_id: r.text for r in held["secrets"].collect()}
    for r in held["near_duplicates"].collect():
        assert masked_texts[r.doc_id] == masked(r.text)
        assert not any(k == "access" for k, _, _ in find_spans(masked_texts[r.doc_id]))
    mixed = Counter(r.doc_id for r in held["mixing"].collect())
    assert set(mixed) <= set(masked_texts) and max(mixed.values()) <= 2
    packed = Counter(r.doc_id for r in held["packing"].where("piece = 0").collect())
    assert packed == mixed


def test_messy_documents_pass(spark, messy, labels_dir):
    docs = messy
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.land(stage(spark, docs, labels_dir), name)
        if name != "packing":
            assert docs.columns == messy.columns
    assert docs.count() >= 0


def test_empty_documents_pass(spark, nothing, labels_dir):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.land(stage(spark, docs, labels_dir), name)
        assert docs.count() == 0


def test_registered(spark):
    names = contract.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_twins(spark, sf_dir, name):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    want = con.execute(ORACLES[name]).fetchall()
    columns = [d[0] for d in con.description]
    got = QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert Counter(tuple(map(str, r)) for r in got) == Counter(tuple(map(str, r)) for r in want)

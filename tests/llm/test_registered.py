"""Registered operators against SQL, and the pipeline."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from notice_lake.llm.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = compare.connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_operator_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = compare.duck_bag(duck, ORACLE[name])
    assert sorted(df.columns) == sorted(columns)
    assert compare.spark_bag(df) == expected


def test_each_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
        ids.append([r.doc_id for r in docs.collect()])
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    toxic, near, cut, mixed, packed = ids
    assert len(set(near)) == len(near) and set(near) <= set(toxic)
    assert sorted(cut) == sorted(near)
    assert set(mixed) <= set(cut) and max(mixed.count(i) for i in set(mixed)) <= 2
    assert sorted(packed) == sorted(mixed)
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(i in set(toxic) for i in clean) >= 0.98 * len(clean)


def test_pipeline_of_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"odd-{name}")
        ids = [r.doc_id for r in docs.collect()]
        if ids:
            assert {1, 2, 3, 4, 5, 7, None} <= set(ids)
            assert 6 not in ids and 8 not in ids

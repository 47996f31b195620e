"""The stages one after the other, each against its own input."""

import re
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from rainfold.llm import mixing, packing, quality_cnn, secrets, simhash
from rainfold.llm.common import held_out, materialize
from tests.conftest import SF_SMALL
from tests.llm.data import awkward_rows, documents

WORD = re.compile(mixing.WORD)


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF_SMALL}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF_SMALL), name))
    return docs


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_queries_are_registered():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and "pipeline" not in E.oracle_sql()


def test_columns_are_those_of_documents(stages):
    assert all(d.columns == stages[0].columns and d.dtypes == stages[0].dtypes for d in stages[1:5])


def test_quality_keeps_what_the_classifier_predicts(spark, stages):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality_cnn.learn(stages[0], labels, ~held_out("_key", 3, 1))
    good = {r["doc_id"] for r in quality_cnn.classify(stages[0], model).where("predicted = 1").collect()}
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if i in good}


def test_one_document_of_each_group_stays(stages):
    groups = simhash.components(stages[1]).collect()
    assert set(texts(stages[2])) == {r["component_id"] for r in groups}


def test_secrets_are_masked(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert set(before) == set(after)
    for i, t in before.items():
        base = secrets.base_spans(t.encode())
        assert all(t[s:e] not in after[i] for s, _, e in base if e - s >= 16)
        if t == after[i]:
            assert not base
        else:
            assert secrets.MASK in after[i]


def test_mix_takes_its_words(stages):
    plan = mixing.mix(stages[3]).toPandas()
    after = texts(stages[4])
    want = {r.doc_id: r.taken for r in plan.itertuples() if r.taken}
    assert {i: len(WORD.findall(t)) for i, t in after.items()} == want
    shares = plan.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((shares.taken - shares.target).abs() <= 3 * mixing.BLOCK * 2).all()


def test_packing_covers_every_document(stages):
    got = stages[5].toPandas()
    assert set(got.doc_id) == set(texts(stages[4]))
    assert (got.groupby("doc_id")["length"].sum() == got.groupby("doc_id")["doc_tokens"].first()).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= packing.CAPACITY


def test_stages_on_awkward_and_empty_tables(spark):
    for rows in (awkward_rows(), []):
        docs = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = materialize(stage(spark, docs, SF_SMALL), name)
            assert out.columns == docs.columns
            assert Counter(out.columns) == Counter(docs.columns)
            docs = out
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert (packed.count() > 0) == bool(rows)

"""The pipeline's stages on the smallest table: what each takes away and keeps."""

import numpy as np
import pytest

import corpus_pipeline
from starloom.llm import jaccard, kneser_ney, packing, registry, secrets, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[:5])


def test_each_stage_acts_on_all_its_predecessor_kept(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.score_documents(stages[0], labels).where("predicted = 1").collect()}
    assert ids(stages[1]) == ids(stages[0]) - rejected
    rejected = {r.doc_id for r in kneser_ney.classify(stages[1], labels).where("not kept").collect()}
    assert ids(stages[2]) == ids(stages[1]) - rejected and rejected
    lost = {r.doc_id for r in jaccard.jaccard_components(stages[2]).where("component_id < doc_id").collect()}
    assert ids(stages[3]) == ids(stages[2]) - lost and lost
    assert ids(stages[4]) == ids(stages[3])
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = stages[4].collect()
    assert all(r.text == secrets.redact(before[r.doc_id]) and r.n_chars == len(r.text) for r in after)
    assert all(not secrets.base_spans(r.text) for r in after)


def test_packed_sequences(stages):
    out = stages[5].toPandas().sort_values(["sequence_id", "offset"])
    assert set(out.doc_id) == ids(stages[4])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
    assert out.sequence_id.nunique() <= packing.lower_bound(out.length.to_numpy(np.int64), packing.CAPACITY) + 1


def test_run_gives_the_last_stage(spark, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[5])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_registry_has_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in registry.queries()] == list(range(1, 14))

import corpus_pipeline
import pytest
from gridclim.llm import decontaminate, minhash, secrets, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark, docs):
    """Each stage's decision, judged on its own input."""
    frames = [docs.cache()]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
        if name != "sentencepiece":
            assert frames[-1].columns == docs.columns
    ids = [[r.doc_id for r in f.select("doc_id").collect()] for f in frames]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert set(ids[1]) == {i for i, s in scores.items() if s < 0.5}
    groups = {r.id: r.component for r in minhash.duplicates(frames[1]).collect()}
    assert sorted(ids[2]) == sorted(set(groups.values()))
    found = decontaminate.report(frames[2], spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()
    assert set(ids[3]) == set(ids[2]) - {r.doc_id for r in found}
    assert sorted(ids[4]) == sorted(ids[3]) == sorted(ids[5])
    left = secrets.report(frames[4]).where("n_assign + n_access + n_hex > 0")
    assert left.count() == 0 and frames[5].where("NOT round_trip").count() == 0
    assert frames[4].where("n_chars <> char_length(text)").count() == 0


@pytest.mark.parametrize("what", ["edges", "nothing"])
def test_edge_rows(spark, request, what):
    docs = request.getfixturevalue(what)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "sentencepiece":
            assert out.count() == docs.count()
        else:
            assert out.columns == docs.columns
            docs = out
            assert out.where("doc_id = 1").count() == (what == "edges")

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import packing, quality, toxicity
from paperloom.llm.common import text_bytes
from tests.llm.cases import components, near_pairs, shingles
from tests.llm.test_operators import plain_contamination

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(documents before, result) of each stage."""
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def kept(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "packing"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name
        assert before.exceptAll(after).count() == before.count() - after.count(), name


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    model = quality.quality_model(before, spark.read.parquet(f"{SF}/labels.parquet"))
    sizes, w = model.scorer(), np.array(model.weights)
    good = []
    for r in before.collect():
        raw = text_bytes(r["text"])
        g, b = sizes(raw)
        score = 1 / (1 + np.exp(-(quality.features(np.array([g]), np.array([b]), np.array([len(raw)])) @ w)[0]))
        good += [r["doc_id"]] if score >= 0.5 else []
    assert kept(after) == sorted(good)


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    net = toxicity.toxicity_model(before, spark.read.parquet(f"{SF}/labels.parquet"))
    scorer, clean = net.scorer(), []
    for r in before.collect():
        words = toxicity.plain_words(r["text"])
        clean += [r["doc_id"]] if scorer.log_odds(words) < net.thresholds[toxicity.guessed_language(words)] else []
    assert kept(after) == sorted(clean)


def test_near_duplicate_stage(stages):
    before, after = stages["near_duplicates"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    sets = [shingles(t) for _, t in rows]
    root = components(len(rows), near_pairs(sets))
    assert kept(after) == [rows[k][0] for k in range(len(rows)) if root[k] == k]


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert kept(after) == sorted(r["doc_id"] for r in before.collect() if not plain_contamination(r["text"], items)[4])


def test_packing_stage(stages):
    before, after = stages["packing"]
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r["doc_id"]: len(encode(r["text"])) + 1 for r in before.collect()}
    lengths = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == tokens
    fill = after.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert fill.agg(F.max("n")).first()[0] <= packing.CAPACITY


def test_run_is_the_stages_in_turn(spark, stages):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == stages["packing"][1].columns
    assert kept(result) == kept(stages["packing"][1])


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

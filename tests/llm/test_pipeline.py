"""The pipeline's stages against plain versions, each on what the one before left."""

import corpus_pipeline
from beaconlake.llm import mixing, toxicity
from beaconlake.llm.queries import ORACLE, QUERIES

from . import plain


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(ORACLE) <= set(QUERIES)


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, last = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            last = out.toPandas()
            assert set(last.doc_id) == set(before)
            break
        assert out.columns == columns
        after = {r["doc_id"] for r in out.collect()}
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            scores = toxicity.scored(docs, model)
            assert after == {r["doc_id"] for r in scores.where("predicted = 0").collect()}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(" ".join(_normal(before[i])), i)
            assert after == set(first.values())
        elif name == "near_dedup":
            assert after == set(plain.near_components(before.items()).values())
        else:
            drawn = mixing.mixed(docs).where("sampled")
            assert after == {r["doc_id"] for r in drawn.collect()}
        docs = out
    whole = corpus_pipeline.run(spark, sf_dir).toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(whole[names].itertuples(index=False)) == sorted(last[names].itertuples(index=False))
    assert whole.sequence_id.nunique() == last.sequence_id.nunique()


def _normal(text):
    import re

    return re.split(r"[\x20\x09-\x0D]+", text or "")


def test_stages_keep_other_columns_and_take_odd_rows(spark, sf_dir):
    odd = spark.createDataFrame(plain.odd_rows(), plain.ODD_SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        odd = spark.createDataFrame(stage(spark, odd, sf_dir).collect(), plain.ODD_SCHEMA)
    assert odd.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf_dir).count() >= odd.count()

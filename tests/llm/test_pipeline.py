import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    from docloom.llm.decontamination import leaks
    from docloom.llm.jaccard_join import jaccard_classes
    from docloom.llm.quality_rules import op2_quality_rules

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs, columns = [docs], docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, outs[-1], SF)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        outs.append(spark.read.parquet(str(tmp_path / str(k))))
    ids = [{r.doc_id for r in o.select("doc_id").collect()} for o in outs]
    assert ids[1] == {r.doc_id for r in op2_quality_rules(spark, SF).collect() if r.kept}
    assert ids[2] == ids[1]
    assert all(r.n_chars == len(r.text) for r in outs[2].collect())
    assert ids[3] == {r.component_id for r in jaccard_classes(outs[2]).collect()}
    assert ids[4] == ids[3] - {r.doc_id for r in leaks(outs[3], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids[5] == ids[4]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "packing"]

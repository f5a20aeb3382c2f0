"""The pipeline stages take effect, each on what its predecessor kept."""

import corpus_pipeline
from conftest import SF
from corridor.llm import byte_cnn, decontamination, partenum, secrets
from corridor.llm.batches import table


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF))
        assert kept[-1].columns == docs.columns and kept[-1].dtypes == docs.dtypes
    counts = [df.count() for df in kept]
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] and counts[2] < counts[1]
    accepted = {r["doc_id"] for r in byte_cnn.classify(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in kept[1].collect()} == accepted
    groups = partenum.jaccard_components(kept[2]).groupBy("component_id").count()
    assert groups.where("count > 1").count() == 0
    hits = decontamination.contamination(kept[3], table(spark, SF, "benchmark"))
    assert hits.where("contaminated").count() == 0
    assert secrets.scan_secrets(kept[4]).where("n_assign + n_access + n_hex > 0").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {
        r["doc_id"] for r in kept[4].collect()
    }

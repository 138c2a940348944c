import corpus_pipeline
from equiscope.llm import quality, simhash, toxicity

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs, out)
        docs = out
    assert list(seen) == ["quality_rules", "toxicity", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    for name, (before, after) in seen.items():
        if name != "best_fit_packing":
            assert after.columns == DOC_COLUMNS
    ids = {n: ({r.doc_id for r in b.collect()}, {r.doc_id for r in a.collect()}) for n, (b, a) in seen.items()}

    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in quality.quality_report(before).filter("kept").collect()}
    assert ids["quality_rules"][1] == kept and kept < ids["quality_rules"][0]

    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(before, labels)
    good = {r.doc_id for r in toxicity.severity(before, model, keep=["doc_id"]).filter("not toxic").select("row.doc_id").collect()}
    assert ids["toxicity"][1] == good

    before, after = seen["simhash_near_dedup"]
    firsts = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert ids["simhash_near_dedup"][1] == firsts and after.count() == len(firsts)

    before, after = seen["substring_dedup"]
    assert ids["substring_dedup"][0] == ids["substring_dedup"][1]
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = seen["best_fit_packing"]
    assert ids["best_fit_packing"][0] == ids["best_fit_packing"][1]

    run = corpus_pipeline.run(spark, sf)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*key).collect())) == sorted(map(tuple, after.select(*key).collect()))


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0
        docs = out if out.columns == DOC_COLUMNS else docs

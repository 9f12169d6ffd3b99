"""The pipeline: stage by stage on a small table, against the operators' rules."""

import corpus_pipeline
from freqscope.llm import bpe, pii, registry, simhash

SF_SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
        if k < 4:
            assert kept[-1].columns == columns and kept[-1].dtypes == docs.dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "pii", "mixing", "bpe"]
    ids = lambda df: [r["doc_id"] for r in df.collect()]
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    after = set(ids(kept[1]))
    assert all(d in after for d, r in labels.items() if r["quality"] == 1)
    assert after < set(ids(docs))
    found = simhash.near_duplicates(kept[1]).collect()
    assert sorted(ids(kept[2])) == sorted({r["component"] for r in found})
    before = {r["doc_id"]: r["text"] for r in kept[2].collect()}
    for r in kept[3].collect():
        assert r["text"] == pii.redact_text(before[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert set(ids(kept[4])) <= set(ids(kept[3]))
    clean = {r["doc_id"]: r["text"] for r in kept[3].collect()}
    last = kept[5].collect()
    assert sorted(r["doc_id"] for r in last) == sorted(ids(kept[4]))
    coder = bpe.load(bpe.tokenizer_path(None))
    assert all(coder.decode(r["ids"]) == clean[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in last)


def test_run_and_registry(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).columns == ["doc_id", "n_tokens", "ids"]
    names = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert names == list(range(1, 14)) and set(registry.ORACLE) <= set(registry.QUERIES)

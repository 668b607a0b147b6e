"""The pipeline against a plain version, and its contract."""

import corpus_pipeline
from spanloom.llm import bpe, language_id, near_dedup, secret_scan
from spanloom.llm import decontamination as D


def test_stages_equal_a_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    profiles = language_id.learn_profiles(docs.where(language_id.remainder("doc_id", 4) != 2))
    known = {r["doc_id"] for r in language_id.identify(docs, profiles).collect() if r["lang_pred"] != "und"}
    first = docs.where(docs["doc_id"].isin(*known))
    kept = {r["doc_id"] for r in near_dedup.near_duplicates(first).collect() if r["class_id"] == r["doc_id"]}
    dirty = {r["doc_id"] for r in D.find_contamination(docs, bench).collect()}
    model = bpe.load(bpe.tokenizer_path("word_bpe_49k.json"))
    expected = {}
    for d in kept - dirty:
        text = rows[d]["text"] or ""
        masked = secret_scan.redact(text, secret_scan.find(text)[1])
        expected[d] = (masked, rows[d]["lang"], rows[d]["source"], model.library.encode(masked, add_special_tokens=False).ids)
    done = corpus_pipeline.run(spark, sf)
    assert done.columns == [*docs.columns, "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert {r["doc_id"]: (r["text"], r["lang"], r["source"], r["ids"]) for r in done.collect()} == expected


def test_stages_keep_the_columns(spark, sf, odd_docs, tmp_path):
    now = odd_docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == odd_docs.columns, name
            out.write.parquet(f"{tmp_path}/{name}")
            now = spark.read.parquet(f"{tmp_path}/{name}")
    assert now.count() == 4  # one of the cats, the French text, the lonely one and the long one


def test_stages_of_no_rows(spark, sf, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf).count() == 0

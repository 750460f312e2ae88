from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
from marketflow.llm import exact, near, quality, substrings
from marketflow.session import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r["doc_id"] for r in quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("kept").collect()}
    after = stage(corpus_pipeline.quality_rules(spark, docs, SF), "t")
    assert after.columns == columns and {r["doc_id"] for r in after.collect()} == kept
    first = {r["doc_id"] for r in exact.duplicates(after).where("kept").collect()}
    after = stage(corpus_pipeline.exact_dedup(spark, after, SF), "t")
    assert after.columns == columns and {r["doc_id"] for r in after.collect()} == first
    ones = {r["class_id"] for r in near.linked(after).collect()}
    after = stage(corpus_pipeline.near_dedup(spark, after, SF), "t")
    assert after.columns == columns and {r["doc_id"] for r in after.collect()} == ones
    left = Counter()
    for r in substrings.removals(after).collect():
        left[r["doc_id"]] = r["n_words"] - r["n_removed"]
    after = stage(corpus_pipeline.substring_dedup(spark, after, SF), "t")
    assert after.columns == columns and all(len((r["text"] or "").encode().split()) == left[r["doc_id"]] for r in after.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())
    pieces = corpus_pipeline.pack(spark, after, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in after.collect()}


def test_registered(spark):
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert "pipeline" not in entry.oracle_sql()

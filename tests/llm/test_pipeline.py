from __future__ import annotations

import corpus_pipeline
from ordermill.llm import language, quality
from tests.llm.test_simhash import brute_groups, brute_print

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_their_operators_and_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    identified = corpus_pipeline.identify(spark, docs, FOLDER).cache()
    pred = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs)).collect()}
    assert {r["doc_id"] for r in identified.collect()} == {i for i, r in pred.items() if not r["ambiguous"]}
    graded = corpus_pipeline.grade(spark, identified, FOLDER).cache()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = quality.classify(identified, quality.fit(identified, labels)).collect()
    assert {r["doc_id"] for r in graded.collect()} == {r["doc_id"] for r in scores if r["predicted"] == 1}
    assert graded.count() > 0.7 * docs.count()
    single = corpus_pipeline.drop_copies(spark, graded, FOLDER).cache()
    rows = sorted((r["doc_id"], r["text"]) for r in graded.collect())
    group = brute_groups([brute_print(text) for _, text in rows], 4)
    assert sorted(r["doc_id"] for r in single.collect()) == [rows[i][0] for i in sorted(set(group))]
    assert identified.columns == graded.columns == single.columns == columns
    packed = corpus_pipeline.pack(spark, single, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in single.collect()}


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "sequence_id", "offset", "length", "ids"} <= set(found.columns)
    assert found.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near copies", "packing"]

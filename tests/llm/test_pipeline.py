"""The pipeline's stages, each on what its predecessor kept."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language_id, ngram_join, packing, secret_scan


def test_stages_pass_the_columns_on_and_decide(spark, odd, tmp_path):
    docs, sizes = odd, [odd.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == odd.columns
        sizes.append(docs.count())
    # Texts without a letter go, repeated ones lose their lines, of near copies one stays, secrets are blanked.
    assert sizes[1] < sizes[0] and sizes[3] < sizes[1] and sizes[4] == sizes[3]
    assert docs.filter("text like '%abcdefgh12345678%'").count() == 0 and docs.filter("text like '%[secret]%'").count() == 2  # a password, and a long run of hexadecimal digits
    assert docs.filter("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run_equals_its_stages(spark):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in documents.collect()}
    model = language_id.fit_on(documents)
    rejected = {r.doc_id for r in language_id.identified(documents, model).filter("lang_rejected").collect()}
    assert not rejected & {r.doc_id for r in rows}
    lengths = {}
    for r in rows:
        lengths[r.bin] = lengths.get(r.bin, 0) + r.length
    assert max(lengths.values()) <= packing.CAPACITY
    survivors = documents.join(spark.createDataFrame([(i,) for i in {r.doc_id for r in rows}], "doc_id long"), "doc_id", "left_semi")
    exact = survivors.groupBy("text").count().filter("count > 1")
    assert exact.count() == 0 and ngram_join.one_of_each(spark, survivors).count() > 0


def test_documents_of_an_unlabelled_corpus_stay(spark, odd, tmp_path):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, unlabelled, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((r.doc_id, r.text) for r in odd.collect() if any(c.isalpha() for c in r.text or ""))
    assert len(kept) > 20
    assert {(r.lang_pred, r.rejected) for r in language_id.digest(unlabelled).collect()} == {("und", True)}


def test_an_empty_table(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "").count() == 0


def test_columns_with_the_stages_own_names_pass_through(spark, odd, tmp_path):
    docs = odd.filter("text is not null").select(
        "doc_id", "text", "lang", "source", "n_chars", F.col("doc_id").alias("lang_pred"), F.lit("s").alias("lang_score"),
        F.lit(True).alias("lang_rejected"), F.col("doc_id").alias("secret_spans"), F.col("doc_id").alias("text_redacted"),
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    rows = docs.collect()
    assert rows and all(r.lang_pred == r.secret_spans == r.text_redacted == r.doc_id and r.lang_score == "s" and r.lang_rejected for r in rows)


def test_models_are_fitted_in_tasks_and_not_on_the_driver(spark, small, nothing, monkeypatch):
    rows = [(r.text, r.lang) for r in small.orderBy("lang", "doc_id", "text").collect()]
    of_all = language_id.fit([t for t, _ in rows], [lang for _, lang in rows])

    def stopped(*_):
        raise AssertionError("fitted on the driver")

    monkeypatch.setattr(language_id, "_clusters", stopped)
    monkeypatch.setattr(secret_scan, "_train", stopped)
    model = language_id.fit_on(small)
    assert model.languages == of_all.languages and np.allclose(model.centroids, of_all.centroids, atol=1e-5)
    for table in (small, nothing):
        net = secret_scan.train_on(table)
        assert [s[0] for s in secret_scan.find("the key: 'q8Zr2Lx0Vb7Np4Tw' is here", net)] == ["model"]
    assert language_id.fit_on(nothing).languages == []

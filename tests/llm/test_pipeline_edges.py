"""The pipeline over tables without rows, and over texts that are awkward in every stage."""

import random

import corpus_pipeline
from chatnorm.llm import exact_dedup, mixing, near_dup, private_data, secrets, source_divergence, substring_dedup, topk_search, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def written(spark, folder, docs, labels):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_tables_without_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path, [], [])).count() == 0


def test_a_single_document_and_no_labels(spark, tmp_path):
    rows = corpus_pipeline.run(spark, written(spark, tmp_path, [(1, "one two three", "en", "s", 13)], [])).collect()
    assert {r.doc_id for r in rows} == {1}


def test_texts_of_a_million_characters(spark):
    r = random.Random(14)
    long = [" ".join(f"w{r.randrange(5000)}" for _ in range(150_000)), "ab " * 350_000, "é" * 1_000_000, "x y z " * 160_000]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(long)], DOCS)
    assert near_dup.components(docs).count() == 4
    assert exact_dedup.classes(docs).count() == 4
    assert secrets.secret_spans(docs).count() == 4
    assert private_data.find_private(docs).count() == 4
    assert mixing.mix(mixing.sized(docs)).count() == 4
    assert substring_dedup.without_repeats(docs).count() == 4
    assert source_divergence.divergences(docs, least_docs=1).count() > 0
    model = toxicity.Model({}, {"^xyz": 0.9, "^abc": 0.9}, 0.1)
    assert toxicity.score(docs, model).count() == 4


def test_vectors_too_long_for_exact_scores_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (50, [1e300, 1.0]), (1, [0.5, 0.25]), (2, [float("nan"), 1.0]), (3, None), (4, [8e6, -1.0]), (5, [9e6, 0.0])]
    vectors = topk_search.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    index = topk_search.build_index(vectors)
    found = topk_search.search(index, vectors.where("id % 50 = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [
        (0, 1, 4, 256 * 256 * (8_000_000 - 2)), (0, 2, 1, 256 * 256),
    ]

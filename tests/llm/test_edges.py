"""Every operator and every stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillstream.llm import bpe, decontaminate, jaccard_join, language, licenses, mixing, order_minhash, paragraphs, pii, quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["part", "copy", "node", "root", "score", "masked", "spans", "unit", "token", "n", "__text"]
PROSE = "the quick brown fox jumps over the lazy dog and then it sleeps for a while under the old tree near the river bank"
ROWS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, PROSE + " again", "en", None), (4, None, "en", "b"), (5, "", None, "b"),
    (6, " \n\t ", "de", "b"), (7, "word " * 30_000, "en", "a"), (8, "x" * 100_000, "fr", "c"), (9, "ein kleiner Text", "de", "c"),
    (9, "ein kleiner Text", "de", "c"), (None, PROSE, "en", "a"), (11, "123 456", None, None),
]


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in ROWS], SCHEMA)
    return rows.withColumns({c: F.lit("clash") for c in CLASHING}).repartition(3).persist()


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, "jumps over the lazy dog and then it sleeps for a while"), (2, None), (3, ""), (4, "the"), (1, "other words of one id here")]
    return spark.createDataFrame(items, "item_id bigint, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), 0) for i in range(1, 9)] + [(None, 1, None), (2, None, None), (3, 1, 0), (3, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def results(docs, benchmark, labels):
    filters = language.learn(docs)
    model = quality.fit(docs, labels)
    return {
        "licenses": licenses.license_scan(docs),
        "language": language.predict(docs, filters),
        "decontaminate": decontaminate.leaks(docs, benchmark),
        "jaccard": jaccard_join.classes(docs),
        "quality": quality.score(docs, model),
        "paragraphs": paragraphs.repeats(docs),
        "pii": pii.find(docs, mask=True),
        "tokens": bpe.token_counts(docs, vocabulary()),
        "mixing": mixing.mixture(docs),
        "fingerprints": order_minhash.fingerprints(docs, parts=3),
    }


def test_one_row_for_each_document(docs, benchmark, labels):
    found = {k: v.collect() for k, v in results(docs, benchmark, labels).items()}
    for name in ("licenses", "language", "jaccard", "quality", "pii", "tokens", "fingerprints"):
        assert sorted(str(r["doc_id"]) for r in found[name]) == sorted(str(r[0]) for r in ROWS), name
    one = {name: {r["doc_id"]: r for r in rows} for name, rows in found.items()}
    assert [one["tokens"][i]["n_tokens"] for i in (4, 5)] == [0, 0] and one["tokens"][7]["over_limit"]
    assert [one["language"][i]["lang_pred"] for i in (4, 5, 6, 11)] == ["und"] * 4
    assert [one["licenses"][i]["n_words"] for i in (4, 5, 6, 7)] == [0, 0, 0, 30_000]
    assert [one["jaccard"][i]["n_shingles"] for i in (4, 5, 6, 7, 8)] == [0, 0, 0, 1, 1]
    assert [one["jaccard"][i]["component_id"] for i in (1, 2, 3, 4, 5, 9, None)] == [1, 1, 1, 4, 5, 9, 1]
    assert one["quality"][4]["score"] == one["quality"][5]["score"]
    assert one["pii"][4]["masked"] is None and one["pii"][5]["masked"] == ""
    assert all(0 <= r["score"] <= 1 for name in ("licenses", "language", "quality") for r in found[name])
    assert one["fingerprints"][4]["fingerprint"] == one["fingerprints"][5]["fingerprint"]
    assert one["fingerprints"][1]["fingerprint"] == one["fingerprints"][2]["fingerprint"]
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found["decontaminate"]) == [(0, 1), (1, 1), (2, 1), (3, 1)]
    # Repeated within one id only, or without an id: not a passage of several documents.
    assert {r["doc_id"] for r in found["paragraphs"]} <= {1, 2, 3, None}
    assert {r["doc_id"] for r in found["paragraphs"] if r["removed"]} >= {2, 3}
    assert all(0 < r["taken"] <= r["n_tokens"] for r in found["mixing"])


def test_empty_tables(spark, docs, benchmark, labels):
    none = docs.limit(0)
    for name, result in results(none, benchmark, labels).items():
        assert result.count() == 0, name
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    assert quality.score(docs, quality.fit(docs, labels.limit(0))).count() == len(ROWS)


def test_stages_keep_columns_and_effects(spark, tmp_path, docs, benchmark, labels):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            kept = stage(spark, rows, str(tmp_path))
            assert kept.dtypes == rows.dtypes, name
            assert kept.count() <= rows.count()
    assert corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path)).where("doc_id in (2, 3)").count() == 0
    assert corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).where("doc_id in (1, 2, 3)").count() == 0
    assert corpus_pipeline.mixed(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline_runs(spark, sf_dir):
    from tillstream.llm.queries import documents

    taken = corpus_pipeline.run(spark, sf_dir).collect()
    ids = {r["doc_id"] for r in documents(spark, sf_dir).select("doc_id").collect()}
    assert taken and {r["doc_id"] for r in taken} <= ids
    assert len({(r["doc_id"], r["epoch"]) for r in taken}) == len(taken)

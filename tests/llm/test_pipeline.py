"""The pipeline against plain versions of its stages."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.test_operators import BASE, TEXTS, plain_base, plain_classes, plain_contamination, varied

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts = [*TEXTS, "123 456", "Mail a.b@c.org or +49 30 1234567 now", "Some words " + " ".join(BASE[40:60]), varied(BASE, 30)]
    rows = [(i, t, "en" if i % 3 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame([*rows, rows[8]], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(BASE[42:56])), (2, None)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    # a text of one letter, without a label, is like no language: its cosine is 0
    expected = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] and re.search(r"[^\W\d_]", r["text"]) and set(r["text"]) != {"x"}]
    classes = plain_classes(expected)
    texts = dict(expected)
    expected = sorted({c for _, _, c in classes})
    clean = plain_contamination([texts[i] for i in expected], items)
    expected = [i for i, found in zip(expected, clean, strict=True) if not found[1]]
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert sorted(rows) == expected and 9 not in rows
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) and r["lang"] == "en" for r in rows.values())
    for i in expected:
        if not plain_base(texts[i]):
            assert rows[i]["text"] == texts[i]
    mail = len(TEXTS) + 1
    assert rows[mail]["text"] == "Mail [EMAIL] or [PHONE] now" and rows[mail]["n_chars"] == 27


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0).withColumn("ids", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == list(corpus_pipeline.COLUMNS), name
        assert found.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_noise_with_a_few_letters_goes(spark, folder):
    words = "the of and to in is that it was for on are as with his they at be this from".split()
    clean = [(i, " ".join(words[(i * k + k) % 20] for k in range(1, 60)), "en", "s", 0) for i in range(200)]
    noise = [(900, "<<< >>> %% 12 ## w", None, "s", 0), (901, "0x 7q 11 ~~ 9z " * 40, None, "s", 0), (902, "?? " * 9 + "k", None, "s", 0)]
    # short clean texts, with and without a label, stay
    short = [(800, "the", "en", "s", 0), (801, "This was it.", None, "s", 0)]
    docs = spark.createDataFrame([*clean, *noise, *short], SCHEMA)
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, folder).collect()}
    assert set(kept) == {*range(200), 800, 801} and set(kept.values()) == {"en"}


def test_the_floor_follows_from_the_labelled_documents(spark):
    rows = [(0.5 + i / 10_000, "en", True) for i in range(4000)] + [(0.2, "en", True), (0.01, None, True), (0.0, "en", False)]
    scored = spark.createDataFrame(rows, "_cosine_ double, lang string, _letters_ boolean")
    # two in 4001 may lie below; the third lowest is 0.5
    assert corpus_pipeline.language_floor(scored) == 0.25
    assert corpus_pipeline.language_floor(scored.limit(0)) == 0.0

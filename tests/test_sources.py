import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paperlane.functions.text import tokens
from paperlane.operators import tfidf, training
from paperlane.operators.evaluation import metrics, predict
from paperlane.sources import documents, models, tables
from paperlane.streaming import incremental

TEXTS = ['plain', 'with "quotes", commas', "two\nlines"]


def test_csv_corpus_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    tables.write_table(rows, str(tmp_path / "c"), "csv", header=True, escape='"')
    back = tables.read_corpus(spark, str(tmp_path / "c"), "id int, text string")
    assert sorted(r.text for r in back.collect()) == sorted(TEXTS)


def test_tables_append_and_stack(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path)
    tables.append_rows(spark.range(3, 5), path)
    assert tables.read_table(spark, path).count() == 5
    tables.write_table(spark.range(2), str(tmp_path / "chunk_1"))
    tables.write_table(spark.range(2), str(tmp_path / "chunk_2"))
    assert tables.read_many(spark, str(tmp_path / "chunk_*")).count() == 4


def test_table_must_not_replace_its_input(spark, tmp_path, monkeypatch):
    path, other = str(tmp_path / "t"), str(tmp_path / "t2")
    tables.write_table(spark.range(3), path)
    rows = tables.read_table(spark, path).filter("id > 0")
    monkeypatch.chdir(tmp_path)
    for same in (path, f"file://{path}/", "t", "./t", str(tmp_path), f"{path}/inner"):
        with pytest.raises(ValueError):
            tables.write_table(rows, same, replaces=[path])
    tables.write_table(rows, other)
    with pytest.raises(AnalysisException):
        tables.write_table(rows, other)
    tables.write_table(rows.filter("id > 1"), other, replaces=[path])
    assert tables.read_table(spark, other).count() == 1
    assert tables.location("store://b/t") != tables.location("/b/t")


def test_sql_takes_arguments(spark):
    found = tables.read_sql(spark, "SELECT id FROM numbers WHERE id > :low", {"low": 7}, {"numbers": spark.range(10)})
    assert found.count() == 2


def test_sql_leaves_no_views(spark):
    tables.read_sql(spark, "SELECT * FROM gone", views={"gone": spark.range(1)}).count()
    assert not spark.catalog.tableExists("gone")


def test_ocr_results(spark, tmp_path):
    folder = tmp_path / "o c+r"
    lines = [{"BlockType": "PAGE"}, {"BlockType": "LINE", "Text": "a"}, {"BlockType": "WORD", "Text": "a"},
             {"BlockType": "LINE", "Text": "b"}]
    files = {"j1": lines, "j3": "broken", "x/j1": lines[:2], "x/with space+%41": lines[3:]}
    for job, blocks in files.items():
        (folder / f"{job}.json").parent.mkdir(parents=True, exist_ok=True)
        (folder / f"{job}.json").write_text(json.dumps(blocks, indent=1))
    links = spark.createDataFrame(
        [("A", "store://x/j1.json"), ("B", "store://x/j2.json"), ("C", None), ("D", "store://x/j1.json"),
         ("E", "store://x/x/j1.json"), ("F", "store://x/x/with space+%41.json"), ("G", "elsewhere/j1.json"), ("H", "store://x/j3.json")],
        "attachment_id string, ocr_link string",
    )
    rows = documents.read_ocr_blocks(spark, links, str(folder), root="store://x/").collect()
    assert {r.attachment_id: r.text for r in rows} == {
        "A": "a\nb", "B": "", "C": "", "D": "a\nb", "E": "a", "F": "b", "G": "", "H": "",
    }
    assert len(rows) == 8


def test_ocr_blocks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("j", "a\n\nb")], "ocr_job_id string, text string")
    documents.write_ocr_blocks(rows, str(tmp_path / "o"))
    stored = tables.read_table(spark, str(tmp_path / "o")).first()
    assert stored.job_id == "j"
    assert [b["Id"] for b in json.loads(stored.blocks)] == ["line_0", "line_2"]


def test_exports(spark, tmp_path):
    day = tmp_path / "2024_01_02"
    for minute, name in (("0010", "export_data.json"), ("0020", "export_data.json"), ("0020", "log.json"), ("export_7", "data.json")):
        (day / minute).mkdir(parents=True, exist_ok=True)
        messages = [{"messageId": "m1", "attachments": [{"id": "a"}]}, {"messageId": "m2", "attachments": []}]
        (day / minute / name).write_text(json.dumps(messages))
    found = documents.read_exports(spark, str(tmp_path), ["2024_01_02"])
    assert found.count() == 6  # the log is no export, repeated messages count
    assert found.select(F.explode("attachments.id")).count() == 3


def test_exports_of_a_hot_message(spark, tmp_path):
    messages = spark.range(2500, numPartitions=3).select(
        F.lit("m1").alias("messageId"), F.array(F.struct(F.col("id").cast("string").alias("id"))).alias("attachments")
    )
    documents.write_exports(messages, str(tmp_path / "2024_01_02" / "export_1"), rows=100)
    sizes = [len(json.loads(x.read_text())) for x in tmp_path.glob("*/*/part-*")]
    assert max(sizes) <= 100 and sum(sizes) == 2500
    found = documents.read_exports(spark, str(tmp_path), ["2024_01_02"]).select("messageId", F.explode("attachments.id").alias("id"))
    assert found.distinct().count() == found.count() == 2500
    documents.write_exports(messages.limit(0), str(tmp_path / "2024_01_03" / "export_1"))
    assert documents.read_exports(spark, str(tmp_path), ["2024_01_03"]).select(F.explode("attachments")).count() == 0


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(i, f"{'alpha beta' if i % 2 else 'gamma delta'} word{i % 5}", float(i % 2)) for i in range(120)]
    frame = spark.createDataFrame(rows, "key long, text string, label double")
    tokenized = frame.withColumn("tok", tokens(F.col("text")))
    model = tfidf.vectorizer(tfidf.vocabulary(tokenized, "tok"), "tok")
    vectors = training.stratified_split(tfidf.vectorize(model, tokenized), "label", "key")
    return model, vectors.cache()


def test_vocabulary_against_the_formula(spark):
    import math

    frame = spark.createDataFrame([(["a", "a", "b"],), (["a", "c"],), (["b", "a", "rare"],), ([],)], "t array<string>")
    found = {r.term: r for r in tfidf.vocabulary(frame, "t", max_features=2).collect()}
    assert set(found) == {"a", "b"} and found["a"].cf == 4 and found["a"].df == 3
    assert found["b"].idf == pytest.approx(math.log(5 / 3) + 1)
    everywhere = tfidf.vocabulary(frame.filter("size(t) > 0"), "t")
    assert {r.term for r in everywhere.collect()} == {"b"}  # a is in all documents, c and rare in one


def test_document_without_terms_is_the_zero_vector(spark, learned):
    model, _ = learned
    row = tfidf.vectorize(model, spark.createDataFrame([(["zzz"],), (["alpha"],)], "tok array<string>")).collect()
    assert row[0].features.numNonzeros() == 0
    assert row[1].features.norm(2) == pytest.approx(1.0)


def test_features_models_and_scores_are_stored(spark, tmp_path, learned):
    model, vectors = learned
    models.write_features(vectors, str(tmp_path / "f"), "key", "features", "label")
    back = models.read_features(spark, str(tmp_path / "f"))
    assert {(r.key, r.features) for r in back.collect()} == {(r.key, r.features) for r in vectors.collect()}

    models.save_model(model, str(tmp_path / "v"))
    assert models.load_vectorizer(str(tmp_path / "v")).stages[0].vocabulary == model.stages[0].vocabulary

    grown = training.forest(trees=5, max_depth=4).fit(vectors.filter("split = 'train'"))
    models.save_model(grown, str(tmp_path / "m"))
    scored = training.score(models.load_forest(str(tmp_path / "m")), vectors.filter("split = 'test'"))
    assert scored.columns[:1] == ["key"]  # scores stay beside their key
    flagged = predict(scored.withColumn("y_true", F.col("label") == 1), "y_pred_prob")
    result = metrics(flagged, "y_true", "y_pred")
    assert result.first().accuracy > 0.9
    models.write_metrics(result, str(tmp_path / "metrics"))
    models.write_scored(flagged, str(tmp_path / "scored"))
    assert spark.read.json(str(tmp_path / "scored")).count() == 24


def test_split_and_folds(spark, learned):
    _, vectors = learned
    sizes = {(r.split, r.label): r.n_rows for r in training.class_sizes(vectors, "label", "split").collect()}
    assert sizes == {("test", 0.0): 12, ("test", 1.0): 12, ("train", 0.0): 48, ("train", 1.0): 48}
    folds = training.stratified_folds(vectors, "label", "key", 5)
    assert {r["count"] for r in folds.groupBy("label", "fold").count().collect()} == {12}


def test_out_of_fold_scores_cover_all_rows(spark, learned):
    _, vectors = learned
    folds = training.stratified_folds(vectors, "label", "key", 3)
    scored = training.cross_validate(folds, training.forest(trees=3, max_depth=3), "fold", 3)
    assert scored.count() == 120 and scored.select("key").distinct().count() == 120


def test_enrichment_resumes(spark, tmp_path):
    path, seen = str(tmp_path / "out"), []

    def enrich(rows):
        seen.append(rows.count())
        return rows.withColumn("twice", F.col("id") * 2)

    incremental.resume_append(spark, spark.range(5), "id", enrich, path)
    grown = incremental.resume_append(spark, spark.range(8), "id", enrich, path)
    again = incremental.resume_append(spark, spark.range(8), "id", enrich, path)
    assert seen == [5, 3, 0]
    assert grown.count() == again.count() == 8


def test_stream_picks_up_new_files_once(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = incremental.read_stream(spark, source, "id long")
        incremental.stream_append(stream, lambda rows: rows.withColumn("x", F.lit(1)), sink, state)
        return spark.read.parquet(sink).count()

    spark.range(4).write.parquet(source)
    assert [run(), run()] == [4, 4]
    spark.range(4, 6).write.mode("append").parquet(source)
    assert run() == 6


def test_rows_without_a_key_are_set_aside(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "id long, t string")
    for _ in range(3):
        out = incremental.resume_append(spark, rows, "id", lambda r: r, str(tmp_path / "out"))
    assert [r.id for r in out.collect()] == [1]


MESSAGES = [("m1", "2024-01-01 00:10:00"), ("m1", "2024-01-01 00:20:00"), ("m2", "2024-01-01 00:30:00"),
            ("m3", "2024-01-01 01:30:00"), ("m4", "2024-01-02 12:00:00")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
@pytest.mark.parametrize("files", [1, 3])
def test_stream_counts_each_message_once_per_hour(spark, tmp_path, zone, files):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame(MESSAGES, "id string, s string").select("id", F.col("s").cast("timestamp_ntz").alias("t"))
        frame.repartition(files).write.parquet(source)
        for _ in range(2):
            stream = incremental.read_stream(spark, source, frame.schema)
            assert incremental.run_hourly_counts(stream, "id", "t", sink, state, delay="2 hours") == 0
        found = incremental.read_hourly_counts(spark, sink, "2 hours").collect()
        assert sorted((str(r.hour), r.n_messages, r.closed) for r in found) == [
            ("2024-01-01 00:00:00", 2, True), ("2024-01-01 01:00:00", 1, True), ("2024-01-02 12:00:00", 1, False)
        ]
        # one more in the open hour, and one that is too late
        late = spark.createDataFrame([("m5", "2024-01-02 12:30:00"), ("m6", "2024-01-01 01:40:00")], "id string, s string")
        late.select("id", F.col("s").cast("timestamp_ntz").alias("t")).write.mode("append").parquet(source)
        stream = incremental.read_stream(spark, source, frame.schema)
        assert incremental.run_hourly_counts(stream, "id", "t", sink, state, delay="2 hours") == 1
        found = {str(r.hour): r.n_messages for r in incremental.read_hourly_counts(spark, sink, "2 hours").collect()}
        assert found["2024-01-02 12:00:00"] == 2 and found["2024-01-01 01:00:00"] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_queries_over_a_table_that_is_a_folder(spark, tmp_path):
    from paperlane.plans import REGISTRY

    source = "/root/testdata/sf0.001"
    for name in ("events", "pages", "documents", "labels"):
        spark.read.parquet(f"{source}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_hourly", "stream_append", "resume_append"):
        one, many = REGISTRY[name](spark, source), REGISTRY[name](spark, str(tmp_path))
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))

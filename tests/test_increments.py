"""Counts and exports that grow, files read by name, and rows that come too late."""

import json

import pytest
from pyspark.sql import functions as F

from paperlane.operators import tfidf
from paperlane.sources import batches, documents
from paperlane.streaming import exports, incremental


def words(spark, texts):
    return spark.createDataFrame([(t.split(),) for t in texts], "w array<string>")


def test_counts_grow_like_the_corpus(spark, tmp_path):
    texts = ["a b a", "b c", "c d d", "", "a d e", "e e e f", "b"]
    growing = tfidf.GrowingCounts(spark, str(tmp_path))
    assert growing.vocabulary().count() == 0
    for number, (start, end) in enumerate(((0, 2), (2, 2), (2, 5), (5, 7))):
        assert growing.add(words(spark, texts[start:end]), "w", str(number))
        assert not growing.add(words(spark, ["z z z"]), "w", str(number))
        whole = tfidf.vocabulary(words(spark, texts[:end]), "w", 4, 1, 0.9)
        assert sorted(growing.vocabulary(4, 1, 0.9).collect()) == sorted(whole.collect())
    before = sorted(growing.counts().collect())
    assert growing.merge() and growing.merge() is None
    assert sorted(growing.counts().collect()) == before
    # merged: one row per term, and a merged batch is still known
    assert batches.read_committed(spark, str(tmp_path), "terms").count() == len(before)
    assert not growing.add(words(spark, ["z"]), "w", "2")


def test_merged_batches_keep_their_rows(spark, tmp_path):
    root = str(tmp_path)
    batches.append_batch(spark, {"a": spark.range(3), "b": spark.range(2)}, root, "1")
    batches.append_batch(spark, {"a": spark.range(3, 5)}, root, "2")
    batches.merge_batches(spark, root)
    batches.append_batch(spark, {"a": spark.range(5, 6)}, root, "3")
    for _ in range(2):
        assert sorted(r.id for r in batches.read_committed(spark, root, "a").collect()) == list(range(6))
        assert batches.read_committed(spark, root, "b").count() == 2
        batches.merge_batches(spark, root)
    assert batches.live(spark, root).count() == 1 and batches.commits(spark, root).count() == 5


@pytest.fixture
def results(tmp_path):
    for i in range(40):
        folder = tmp_path / "r e+s" / f"job {i}"
        folder.mkdir(parents=True)
        (folder / "out.json").write_text(json.dumps([{"BlockType": "LINE", "Text": f"text {i}"}]))
    return str(tmp_path / "r e+s")


def test_texts_of_named_files(spark, results):
    links = spark.createDataFrame([(f"s://job {i}/out.json",) for i in (3, 3, 17, 99)] + [(None,), ("elsewhere",)], "ocr_link string")
    read = []
    for files in (1, 100):
        found = documents.read_ocr_blocks(spark, links, results, root="s://", files=files)
        rows = sorted(((r.ocr_link, r.text) for r in found.collect()), key=repr)
        read.append(rows)
    assert read[0] == read[1] == sorted(
        [("s://job 3/out.json", "text 3")] * 2 + [("s://job 17/out.json", "text 17"), ("s://job 99/out.json", ""), (None, ""), ("elsewhere", "")], key=repr,
    )


def test_files_that_are_not_named_never_reach_a_task(spark, results):
    wanted = spark.createDataFrame([("job 3/out.json",), ("job 17/out.json",)], "_file string")
    paths = [r["_path"] for r in documents.named_files(spark, wanted, results).collect()]
    assert len(paths) == 2
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        # a task per file
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        whole = spark.read.text(results, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("_path"), "value")
        assert whole.rdd.getNumPartitions() >= 40
        assert whole.filter(F.col("_path").isin(paths)).rdd.getNumPartitions() == 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def export(base, day, time, ids):
    folder = base / day / time
    folder.mkdir(parents=True)
    (folder / "export_data.json").write_text(json.dumps([{"messageId": i, "attachments": []} for i in ids]))


def test_gaps_in_the_schedule(spark, tmp_path):
    base, sink, state = tmp_path / "feed", str(tmp_path / "sink"), str(tmp_path / "state")

    def run():
        stream = exports.read_export_stream(spark, str(base))
        exports.run_export_sessions(stream, sink, state, "10 minutes", "30 minutes")
        return sorted((str(r.last_export)[5:16], str(r.next_export)[5:16], r.n_messages) for r in exports.schedule_gaps(spark, sink).collect())

    for time, ids in (("1200", "ab"), ("1210", "c"), ("1220", "d"), ("1250", "e"), ("1300", "f"), ("9999", "x")):
        export(base, "2024_03_01", time, ids)
    # neither session is complete: the newest export is at 13:00
    assert run() == []
    export(base, "2024_03_01", "1315", "g")
    export(base, "2024_03_02", "0000", "h")
    assert run() == [("03-01 12:20", "03-01 12:50", 2), ("03-01 13:00", "03-01 13:15", 1)]
    export(base, "2024_03_02", "0200", "i")
    assert run()[-1] == ("03-01 13:15", "03-02 00:00", 1)


def test_late_rows_of_all_batches_are_counted(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "1")
    try:
        # a batch leaves out what the watermark of the batch before it makes late
        days = (["05 12"], ["06 12"], ["01 01", "01 02"], ["06 13"], ["05 12"], ["06 14"])
        for number, times in enumerate([f"2024-01-{t}:00:00" for t in some] for some in days):
            rows = spark.createDataFrame([(f"{number}/{t}", t) for t in times], "id string, s string")
            rows.select("id", F.col("s").cast("timestamp_ntz").alias("t")).coalesce(1).write.mode("append").parquet(source)
        schema = spark.read.parquet(source).schema
        stream = incremental.read_stream(spark, source, schema, maxFilesPerTrigger=1)
        assert incremental.run_hourly_counts(stream, "id", "t", str(tmp_path / "out"), state, delay="1 hour") == 3
    finally:
        spark.conf.unset(key)

"""CSV files read by many tasks."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from paperlane.sources import records, tables

SCHEMA = "doc_id bigint, text string, lang string"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def odd_rows(n, seed):
    pick = random.Random(seed)
    parts = ["a", '"', "\n", "\r\n", ",", '""', " x", "\n\n", "é", '",', ',"']
    return [(i, "".join(pick.choice(parts) for _ in range(pick.randint(0, 50))) or None, pick.choice(["en", 'd"e', "a,b", None])) for i in range(n)]


def write_csv(path, rows, end="\n"):
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator=end)
        out.writerow(["doc_id", "text", "lang"])
        out.writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits, end):
    rows = odd_rows(1500, 3)
    write_csv(tmp_path / "a.csv", rows, end)
    path = str(tmp_path / "a.csv")
    found = records.read_split_corpus(spark, path, SCHEMA)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(rows, key=repr)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 5
    assert records.read_records(spark, path).select("block").distinct().count() > 5
    if end == "\n":
        serial = tables.read_corpus(spark, path, SCHEMA)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, serial.collect()), key=repr)


def test_texts_are_shuffled_once(spark, tmp_path):
    write_csv(tmp_path / "a.csv", odd_rows(50, 4))
    found = records.read_split_corpus(spark, str(tmp_path / "a.csv"), SCHEMA)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    # only at the few records that cross splits do texts move again
    assert plan.split("== Initial Plan ==")[0].count("Scan text") == 1


def test_records_longer_than_splits(spark, tmp_path, small_splits):
    rows = [(1, "start", "en"), (2, '"line"\n' * 3000, "de"), (3, "\n" * 9000 + "end", None), (4, "x" * 30_000, "fr")]
    for name in ("one", "two"):
        write_csv(tmp_path / f"{name}.csv", rows)
    found = records.read_split_corpus(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(rows * 2, key=repr)


def test_quotes_inside_unquoted_values_are_text(spark, tmp_path, small_splits):
    lines = ["doc_id,text,lang"]
    rows = []
    for i in range(400):
        lines += [f'{i},5" pipe,en', "", f'{1000 + i},"a ""b"", c\nd",d"e']
        rows += [(i, '5" pipe', "en"), (1000 + i, 'a "b", c\nd', 'd"e')]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    found = records.read_split_corpus(spark, str(tmp_path / "a.csv"), SCHEMA)
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_no_records(spark, tmp_path):
    (tmp_path / "head.csv").write_text("doc_id,text,lang\n")
    (tmp_path / "open.csv").write_text('doc_id,text,lang\n7,"never closed\nend')
    assert records.read_split_corpus(spark, str(tmp_path / "head.csv"), SCHEMA).count() == 0
    assert records.read_records(spark, str(tmp_path / "open.csv")).filter(F.col("number") == 2).first()["record"] == '7,"never closed\nend'

"""Pieces and positions of long texts, against plain versions."""

import random
import re
import time

from pyspark.sql import functions as F

from paperlane.functions import extract, text as tx


def test_running_sums(spark):
    pick = random.Random(1)
    rows = [([pick.randint(-5, 9) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 5, 9, 10, 16, 17, 99, 100, 101, 1000)] + [(None,)]
    df = spark.createDataFrame(rows, "n array<int>")
    for r in df.withColumn("s", tx.running_sums(F.col("n"))).collect():
        assert (r["s"] or []) == [sum(r["n"][: i + 1]) for i in range(len(r["n"] or []))]


def test_pieces_of_a_text_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(tx, "BLOCK", 7)
    text = "aß\U0001f600\n" * 20 + "end"
    cuts = [(s, n) for s in range(0, len(text) + 3, 3) for n in (0, 1, 6, 7, 8, 30, 200)]
    df = spark.createDataFrame([(text, s, n) for s, n in cuts], "t string, s int, n int")
    found = df.select("s", "n", tx.cut_piece(tx.text_blocks(F.col("t")), F.col("s"), F.col("n")).alias("p")).collect()
    assert all(r["p"] == text[r["s"] : r["s"] + r["n"]] for r in found)


def test_marks_and_contexts_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(tx, "BLOCK", 10)
    texts = [" ".join(f"ü{'x' * (i % 23)} {1 + i % 28}.{1 + i % 12}.{1998 + i % 9}" for i in range(n)) for n in (0, 1, 7, 60)] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("s", extract.date_matches(F.col("t"), False))
    for r in df.select("t", "s", tx.mark_spans(F.col("t"), F.col("s")).alias("m"), extract.date_contexts(F.col("t"), F.col("s"), 12).alias("c")).collect():
        if r["t"] is None:
            assert r["m"] is None and r["c"] is None
            continue
        spans = [m.span() for m in re.finditer(r"\b[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}\b", r["t"])]
        assert [(s["start"], s["end"]) for s in r["s"] or []] == spans
        assert r["m"] == re.sub(r"\b([0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})\b", r"[[\1]]", r["t"])
        first = {}
        for a, b in spans:
            first.setdefault(r["t"][a:b], r["t"][max(0, a - 12) : b + 12])
        assert sorted(r["c"] or []) == sorted(first.values())


def test_many_dates_take_linear_time(spark):
    def seconds(n):
        text = " ".join(f"am {1 + i % 28:02}.{1 + i % 12:02}.{2000 + i % 30} ü" for i in range(n))
        df = spark.createDataFrame([(text,)], "t string").withColumn("s", extract.date_matches(F.col("t")))
        found = df.select(tx.mark_spans(F.col("t"), F.col("s")).alias("m"), F.size(extract.date_contexts(F.col("t"), F.col("s"))).alias("c"))
        start = time.perf_counter()
        row = found.first()
        assert row["m"].count("[[") == n and row["c"] > 0
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 8 * seconds(10_000) + 2

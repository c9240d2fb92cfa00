import datetime

import pytest
from pyspark.sql import functions as F

from paperlane.operators import jobs, joins, predictions as op

SCHEMA = "id long, attachment_id string, ticket_uuid long, type string, subtype string, value string, created_at timestamp_ntz"
DAY = datetime.datetime(2024, 1, 2, 3)
PARAMETERS = [("case_id", "100000000001"), ("name", "Max"), ("due_date", "2024-02-01")]
NAMES = op.PredictionNames(classifier="clf")


def table(spark, rows):
    full = [(i, "A1", 1, "clf" if s == "class_prob" else "ext", s, v, DAY) for i, (s, v) in enumerate(rows, 1)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.mark.parametrize(("rows", "positive", "complete"), [
    ([("is_positive", "'True'"), *PARAMETERS], True, True),
    ([("is_positive", "'True'"), *PARAMETERS[:2]], True, False),
    ([("is_positive", "'False'"), ("class_prob", "'0.99'")], False, False),
    ([("class_prob", "'0.95'")], True, False),
    ([("class_prob", "'0.9499'")], False, False),
    ([("class_prob", "n/a")], False, False),
    ([("class_prob", "'nan'")], False, False),
    ([("is_positive", "'True'"), ("case_id", ""), *PARAMETERS[1:]], True, False),
    ([("other", "x")], False, False),
    ([("is_positive", "'False'"), ("is_positive", "'True'")], False, False),
    ([("is_positive", None), ("is_positive", "'True'")], False, False),
    ([("class_prob", "'0.99'"), *PARAMETERS], True, True),
])
def test_decisions(spark, rows, positive, complete):
    row = op.decisions(table(spark, rows), NAMES).first()
    assert (row.is_positive, row.is_complete, row.is_automatic) == (positive, complete, complete)
    assert (row.ticket_uuid, row.day) == (1, DAY.date())


def test_decision_by_flag_alone(spark):
    decided = op.decisions(table(spark, [("class_prob", "'0.99'")]), NAMES, flag_only=True)
    assert decided.first().is_positive is None
    assert op.undecided(decided).first().asDict() == {"n_attachments": 1, "n_undecided": 1}


def test_first_known_value_wins_in_the_pivot(spark):
    rows = table(spark, [("name", None), ("name", "second"), ("name", "third")])
    assert op.pivot_first(rows, ["name"], NAMES).first()["name"] == "second"


def test_flatten_names_missing_parts(spark):
    rows = table(spark, [(None, "v"), ("name", "n")]).unionAll(
        table(spark, [("name", "dropped")]).withColumn("type", F.lit(None).cast("string"))
    )
    for pairs in (None, ["ext__", "ext__name"]):
        wide = op.flatten(rows, ["ticket_uuid"], NAMES, pairs)
        assert [c for c in wide.columns if c.startswith("ext__")] == ["ext__", "ext__name"]
        row = wide.first()
        assert (row["ext__"], row["ext__name"]) == ("v", "n")
    assert op.flatten(rows, ["ticket_uuid"], NAMES, ["ext__name"]).first()["n_other_pairs"] == 1


def test_flatten_keeps_attachments_without_a_pair(spark):
    rows = table(spark, [("name", None)])
    assert op.flatten(rows, ["ticket_uuid"], NAMES).first()["ext__name"] is None


def test_winner_is_the_first_true_class(spark):
    rows = [
        (1, "A1", 1, "t_beta", "class_pred", "True", DAY),  # not in quotes
        (2, "A1", 1, "t_beta", "class_pred", "'True'", DAY),
        (3, "A1", 1, "t_alpha", "class_pred", "'True'", DAY),
        (4, "A1", 1, "t_alpha", "class_prob", "'0.4'", DAY),
        (5, "A2", 1, "t_alpha", "class_pred", "'False'", DAY),
    ]
    found = op.class_summary(spark.createDataFrame(rows, SCHEMA), {"alpha": "t_alpha", "beta": "t_beta"}, NAMES)
    assert {tuple(r) for r in found.collect()} == {("A1", "beta", 0.4, None), ("A2", None, None, None)}


def test_day_without_incoming_has_no_rate(spark):
    decided = spark.createDataFrame([(DAY.date(), True)], "day date, is_automatic boolean")
    incoming = spark.createDataFrame([(datetime.date(2024, 1, 3), 4)], "day date, incoming long")
    found = {r.day.day: (r.incoming, r.automized, r.automation_perc) for r in op.daily_rate(decided, incoming).collect()}
    assert found == {2: (None, 1, None), 3: (4, None, None)}


def test_bands(spark):
    scores = spark.createDataFrame([(0.5,), (0.6,), (0.9,), (1.0,), (float("nan"),), (None,)], "s double")
    found = {r.band: r.n_rows for r in op.band_counts(scores, "s").collect()}
    assert found == {"0.5-0.6": 1, "0.6-0.7": 1, "0.7-0.8": 0, "0.8-0.9": 0, "0.9-1.0": 2}
    empty = op.band_presence(scores.withColumn("f", F.lit("x")), "s", ["f"]).filter("band = '0.7-0.8'").first()
    assert (empty.total, empty.pct) == (0, 0.0)


def test_job_outcomes(spark):
    t0 = datetime.datetime(2024, 1, 1)

    def at(seconds):
        return t0 + datetime.timedelta(seconds=seconds)

    rows = [
        (1, "ok", "SUBMITTED", t0), (2, "ok", "SUCCEEDED", at(100)), (3, "bad", "SUBMITTED", t0),
        (4, "bad", "FAILED", at(5)), (5, "late", "SUBMITTED", t0), (6, "late", "SUCCEEDED", at(101)),
        (7, "open", "SUBMITTED", at(950)), (8, "stray", "SUCCEEDED", t0), (9, "never", "SUBMITTED", t0),
    ]
    events = spark.createDataFrame(rows, "id long, job_id string, status string, created_at timestamp_ntz")
    outcomes = jobs.job_outcomes(events, 100, "2024-01-01 00:16:40")
    assert {r.job_id: r.outcome for r in outcomes.collect()} == {
        "ok": "SUCCEEDED", "bad": "FAILED", "late": "TIMEOUT", "open": "SUBMITTED", "never": "TIMEOUT",
    }
    results = spark.createDataFrame([("ok", "text"), ("late", "too late")], "job_id string, text string")
    texts = {r.job_id: r.text for r in jobs.job_texts(outcomes, results).collect()}
    assert texts == {"ok": "text", "bad": "", "late": "", "open": "", "never": ""}
    assert [r.job_id for r in jobs.lost_jobs(events, "2024-01-08 00:00:01").collect()] == ["never"]


def test_joins_and_missing_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, v int")
    assert sorted(r.v for r in joins.drop_known(left, right, ["k"]).collect()) == [2, 3]
    assert [r.v for r in joins.only_listed(left, right, ["k"]).collect()] == [1]
    flags = {r.v: r.f for r in joins.flag_listed(left, right, ["k"], "f").collect()}
    assert flags == {1: True, 2: False, 3: False}
    assert joins.enrich(left, right.filter("v = 10"), ["k"]).columns == ["k", "v", "v_right"]
    outer = joins.outer_with_parents(right.withColumnRenamed("v", "c"), left, ["k"])
    assert outer.count() == 5  # two children of a, the loose child, the loose parent and b


def test_lookup_prefers_the_first_source(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    first = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("d", None, 3)], "k string, t string, o int")
    second = spark.createDataFrame([("a", "x"), ("b", "backup"), ("d", "y")], "k string, t string")
    found = {r.k: r.t for r in joins.lookup_with_fallback(keys, first, second, "k", "t", "o").collect()}
    assert found["a"] == "new" and found["b"] == "backup" and found["c"] is None


def test_mapping_keeps_unknown_values(one):
    assert one(lambda c: joins.map_values(c, {"ask ": "tbd"}), "ask ") == "tbd"
    assert one(lambda c: joins.map_values(c, {"ask ": "tbd"}), "ask") == "ask"
    assert one(lambda c: joins.map_values(c, {}), "ask") == "ask"

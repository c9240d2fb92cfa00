"""Batches that count as a whole, the index of known keys, and jobs followed event by event."""

import random
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paperlane.sources import batches
from paperlane.sources.key_index import KeyIndex, append_unknown
from paperlane.streaming import incremental, job_state
from paperlane.streaming.job_state import Job


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_batch_counts_once_and_with_all_its_tables(spark, tmp_path):
    root = str(tmp_path)
    assert batches.read_committed(spark, root, "a", "id bigint").count() == 0
    with pytest.raises(ValueError):
        batches.read_committed(spark, root, "a")
    assert batches.append_batch(spark, {"a": spark.range(3), "b": spark.range(1)}, root, "monday/1")
    assert not batches.append_batch(spark, {"a": spark.range(9), "b": spark.range(9)}, root, "monday/1")
    assert batches.append_batch(spark, {"a": spark.range(3, 5)}, root, 'with "quotes"')
    assert ids(batches.read_committed(spark, root, "a")) == [0, 1, 2, 3, 4]
    assert ids(batches.read_committed(spark, root, "b")) == [0]
    assert batches.commits(spark, root).count() == 2
    with pytest.raises(ValueError):
        batches.append_batch(spark, {batches.LOG: spark.range(1)}, root, "x")


def test_a_run_that_was_cut_off_leaves_nothing_to_see(spark, tmp_path):
    root = str(tmp_path)
    batches.append_batch(spark, {"a": spark.range(2)}, root, "1")

    class Stop(Exception):
        pass

    def fails(_):
        raise Stop

    class Broken:
        write = property(fails)

    # the first table is written whole, the second one not at all
    with pytest.raises(Stop):
        batches.append_batch(spark, {"a": spark.range(2, 4), "b": Broken()}, root, "2")
    assert ids(batches.read_committed(spark, root, "a")) == [0, 1]
    assert batches.append_batch(spark, {"a": spark.range(2, 4), "b": spark.range(1)}, root, "2")
    assert ids(batches.read_committed(spark, root, "a")) == [0, 1, 2, 3]


def test_two_runs_of_one_batch_count_once(spark, tmp_path):
    root = str(tmp_path)
    for attempt in ("bb", "aa"):
        batches.write_attempt(spark.range(4), root, "a", attempt)
    for attempt in ("bb", "aa"):
        batches.commit_attempt(spark, root, "1", attempt, ["a"])
        assert ids(batches.read_committed(spark, root, "a")) == [0, 1, 2, 3]


def index_of(spark, root, name, buckets=4):
    return KeyIndex(spark, root, "t", "k", "string", name, buckets)


def keyed(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")


def test_known_keys_are_dropped_and_the_index_follows(spark, tmp_path):
    root = str(tmp_path / "root")
    index = index_of(spark, root, "keys_one")
    assert append_unknown(spark, keyed(spark, ["a", "a", None, "b"]), index, "1")
    assert append_unknown(spark, keyed(spark, ["b", "c", None, "c"]), index, "2")
    assert not append_unknown(spark, keyed(spark, ["z"]), index, "2")
    found = [r["k"] for r in batches.read_committed(spark, root, "t").collect()]
    assert sorted(map(str, found)) == ["None", "None", "a", "a", "b", "c", "c"]
    # a batch that was committed without the index, and another session that opens the same files
    batches.append_batch(spark, {"t": keyed(spark, ["d"])}, root, "elsewhere")
    other = index_of(spark, root, "keys_two")
    assert append_unknown(spark, keyed(spark, ["a", "d", "e"]), other, "3")
    assert other.catch_up() == 1 and other.catch_up() == 0
    assert [r["k"] for r in batches.read_committed(spark, root, "t").filter("k IN ('d', 'e')").orderBy("k").collect()] == ["d", "e"]
    index.close()
    other.close()
    # the files stay, and a name can be given again
    again = index_of(spark, root, "keys_one")
    assert {r["k"] for r in again.keys().collect()} >= {"a", "b", "c", "d"} and again.catch_up() == 0
    again.close()


def test_old_keys_are_not_moved(spark, tmp_path):
    index = index_of(spark, str(tmp_path / "root"), "keys_plan")
    index.add(keyed(spark, [str(i) for i in range(2000)]))
    index.add(keyed(spark, [str(i) for i in range(1000, 3000)]))
    unknown = index.unknown(keyed(spark, ["5", "2999", "3000", "new", None]))
    assert sorted(map(str, (r["k"] for r in unknown.collect()))) == ["3000", "None", "new"]
    plan = unknown._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    scans = [i for i, line in enumerate(plan) if "Bucketed: true" in line]
    assert scans
    for at in scans:
        depth = len(re.match(r"[ :+|-]*", plan[at]).group())
        for line in reversed(plan[:at]):
            indent = len(re.match(r"[ :+|-]*", line).group())
            if indent < depth:
                depth = indent
                # up to the join nothing is exchanged
                assert "Exchange" not in line and "ShuffleQueryStage" not in line
                if "Join" in line:
                    break
    index.close()


# jobs


def plain_outcome(events, now, timeout):
    submitted = [at for _, status, at in events if status == "SUBMITTED"]
    if not submitted:
        return None
    ends = sorted((order, at, status) for order, status, at in events if status in ("SUCCEEDED", "FAILED") and at >= min(submitted))
    if ends and ends[0][1] <= min(submitted) + timeout:
        return ends[0][2]
    return "TIMEOUT" if now > min(submitted) + timeout else "SUBMITTED"


def test_a_job_is_the_same_in_any_order_of_events():
    pick = random.Random(4)
    for _ in range(3000):
        n = pick.randint(1, 7)
        events = [(order, pick.choice(["SUBMITTED", "SUCCEEDED", "FAILED", "IN_PROGRESS"]), pick.randint(0, 12)) for order in pick.sample(range(20), n)]
        job, taken = Job(), []
        for event in events:
            job.take(*event)
            job.thin()
            job = Job(job.kept())
            taken.append(event)
            for now in (3, 9, 30):
                assert job.outcome(now, 4) == plain_outcome(taken, now, 4)
                ended = any(s in ("SUCCEEDED", "FAILED") for _, s, _ in taken)
                assert job.lost(now, 6) == (not ended and min(at for *_, at in taken) < now - 6)


def test_timers_ring_when_something_changes():
    job = Job()
    job.take(1, "SUBMITTED", 10)
    assert job.timers(10, 5, 100) == [15, 110]
    for now, outcome, lost in ((15, "SUBMITTED", False), (16, "TIMEOUT", False), (110, "TIMEOUT", False), (111, "TIMEOUT", True)):
        assert (job.outcome(now, 5), job.lost(now, 100)) == (outcome, lost)
    assert job.timers(111, 5, 100) == []
    job.take(2, "FAILED", 12)
    assert job.outcome(111, 5) == "FAILED" and not job.lost(111, 100)


def test_job_states_over_several_runs(spark, tmp_path):
    schema = "id bigint, job_id string, status string, created_at timestamp_ntz"
    folder, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    runs = [
        [(1, "a", "SUBMITTED", "2024-01-01 10:00:00"), (2, "b", "SUBMITTED", "2024-01-01 10:00:00"), (3, None, "SUBMITTED", "2024-01-01 10:00:00"), (4, "c", "IN_PROGRESS", "2024-01-01 10:00:00")],
        [(5, "a", "SUCCEEDED", "2024-01-01 10:30:00"), (6, "d", "SUBMITTED", "2024-01-01 13:00:00"), (None, "d", "FAILED", "2024-01-01 13:01:00")],
        [(7, "e", "SUBMITTED", "2024-01-09 12:00:00"), (8, "b", "SUCCEEDED", "2024-01-01 10:01:00"), (9, "e", None, None)],
    ]
    told = []
    for rows in runs:
        df = spark.createDataFrame(rows, "id bigint, job_id string, status string, at string")
        df = df.select("id", "job_id", "status", F.col("at").cast("timestamp_ntz").alias("created_at"))
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = incremental.read_stream(spark, folder, df.schema)
        job_state.run_job_states(stream, path, state, 3600, 7, "10 minutes")
        told.append({r["job_id"]: (r["outcome"], r["lost"]) for r in job_state.read_job_states(spark, path).collect()})
    assert schema and told[0]["a"] == ("SUBMITTED", False) and told[0]["c"] == (None, False)
    # the newest event closes the hour of b, but not that of d
    assert told[1]["a"] == ("SUCCEEDED", False) and told[1]["b"] == ("TIMEOUT", False) and told[1]["d"] == ("SUBMITTED", False)
    # the end of b came too late to be read; an end without an order ends d, but not in time
    assert told[2]["b"] == ("TIMEOUT", True) and told[2]["c"] == (None, True) and told[2]["d"] == ("TIMEOUT", False)
    assert told[2]["e"] == ("SUBMITTED", False) and len(told[2]) == 5


def test_missing_paths_are_not_hidden(spark, tmp_path):
    (tmp_path / "commits").mkdir()
    (tmp_path / "commits" / "broken.json").write_text("{]")
    # what is no commit names no batch
    assert batches.commits(spark, str(tmp_path)).filter("batch IS NOT NULL").count() == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(tmp_path / "nowhere"))

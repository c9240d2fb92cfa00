from types import SimpleNamespace

import pytest

from paperlane import session


def session_with(**settings):
    names = {key.replace("_", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: names.get(key, default)))


def test_shared_folder_comes_from_the_session():
    given = session_with(spark_checkpoint_dir="shared://folder/", spark_master="cluster")
    assert session.work_root(given) == "shared://folder"
    assert session.new_work_path(given, "x").startswith("shared://folder/paperlane/x-")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.work_root(session_with(spark_master="cluster"))


def test_only_a_local_master_gets_a_temporary_folder():
    local = session_with(spark_master="local[4]")
    assert session.work_root(local) == session.work_root(local)


def test_written_tables_are_read_back(spark):
    stored = session.materialize(spark.range(5), "numbers")
    assert stored.count() == 5 and all("paperlane/numbers-" in f for f in stored.inputFiles())


def test_runtime_settings(spark):
    session.tune(spark)
    assert all(spark.conf.get(key) == value for key, value in session.RUNTIME_SETTINGS.items())

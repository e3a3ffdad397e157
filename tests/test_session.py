"""The shared folder of intermediate tables."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from pharmavane import session
from pharmavane.operators.skew import stage


def fake(master, folder=None, checkpoint=None):
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: checkpoint, setCheckpointDir=lambda path: None
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError):
        session.shared_dir(fake(master))
    assert session.shared_dir(fake(master, "hdfs://x/y/")) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_gets_one(master):
    assert session.shared_dir(fake(master))


def files(spark):
    base = Path(session.shared_dir(spark))
    return {path for path in base.rglob("*") if path.is_file()}


def test_a_run_leaves_nothing_behind(spark):
    before = files(spark)
    with session.run_scope(spark) as folder:
        rows = stage(spark.range(5), "five")
        with session.run_scope(spark) as inner:
            assert inner == folder
            more = stage(spark.range(3), "three").checkpoint()
        assert (rows.count(), more.count()) == (5, 3)  # the inner scope removed nothing
        assert all(folder in str(path) for path in files(spark) - before)
        assert files(spark) != before
    assert files(spark) == before and not Path(folder).exists()


def test_a_failed_run_leaves_nothing_behind(spark):
    before = files(spark)
    with pytest.raises(ZeroDivisionError):
        with session.run_scope(spark):
            stage(spark.range(5), "five")
            1 / 0
    assert files(spark) == before
    stage(spark.range(1), "one")
    assert len(files(spark) - before) > 0  # outside of a run tables stay


def test_a_folder_that_cannot_be_removed_hides_no_failure(spark, monkeypatch, caplog):
    monkeypatch.setattr(session, "remove_folder", lambda *a: 1 / 0)
    with pytest.raises(KeyError):
        with session.run_scope(spark):
            {}["missing"]
    assert "intermediate tables stay" in caplog.text

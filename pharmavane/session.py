"""Session settings for the jobs, and the shared folder for intermediate tables."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_run_folder: ContextVar[str | None] = ContextVar("pharmavane_run_folder", default=None)


def build_session(app_name: str) -> SparkSession:
    """A session for the command-line jobs.

    The master, memory and shuffle width come from ``spark-submit``; only the
    settings the operators rely on are named here.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a folder of one machine would lose the rows written by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="pharmavane-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that no one else uses: in the folder of the run, or in the shared one outside of any."""
    folder = _run_folder.get() or shared_dir(spark)
    return f"{folder}/pharmavane-{uuid.uuid4().hex}/{name}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it lies; none there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """The owner of all intermediate tables and checkpoints made within, removed at its end.

    They go when the job fails, too; a failure to remove them is logged and hides no other.
    What the job returns must be written elsewhere before. A scope within another one
    leaves its tables to the outer. Only a driver that is killed leaves its folder,
    ``pharmavane-run-*``, behind.
    """
    if _run_folder.get():
        yield _run_folder.get()
        return
    shared = shared_dir(spark)
    folder = f"{shared}/pharmavane-run-{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(folder)
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        try:
            spark.sparkContext.setCheckpointDir(shared)
            remove_folder(spark, folder)
        except Exception:
            logging.getLogger(__name__).exception("intermediate tables stay in %s", folder)

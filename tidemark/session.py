"""Session set-up and the shared folder that jobs may write scratch tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on; everything about sizing is left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Of repeated keys in a posted body the last counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI and AQE on. ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(REQUIRED_CONF)
    settings["spark.sql.adaptive.enabled"] = "true"
    settings["spark.sql.adaptive.skewJoin.enabled"] = "true"
    # Call-site capture for every column expression doubles the time to build a query.
    settings["spark.python.sql.dataFrameDebugging.enabled"] = "false"
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Event times are zone-free UTC; parsing offsets elsewhere would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


def require_repeated_keys(spark: SparkSession) -> None:
    """Posted bodies may repeat a key; without the setting they would be turned away."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys").lower() != "true":
        raise ValueError("set spark.sql.variant.allowDuplicateKeys to true (it can be set in a running session)")


@cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where the setting is absent the session must be a local one, as in tests;
    a machine-local folder would be lost with its executor on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again: computed once, and not again when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Result = TypeVar("Result")


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], Result]], at_once: int = 8) -> dict[str, Result]:
    """Runs Spark jobs that do not need each other at the same time, so that the tail of one does not leave the cluster idle.

    The first failure is raised when all have ended.
    """
    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in started.items()}

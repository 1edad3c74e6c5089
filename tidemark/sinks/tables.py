"""Parquet snapshots, raw views and published tables."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import side_by_side

log = logging.getLogger(__name__)


def write_snapshot(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Writes Parquet; with ``partition_by`` one folder per value.

    Rows are gathered by that value first, or every task would write a file per
    value; a value with very many rows is split again by its size.
    """
    _write(df, path, partition_by)
    return path


def _write(df: DataFrame, path: str, partition_by: str | None = None, counted: Sequence[str] = ()) -> dict[str, int]:
    """Writes as ``write_snapshot`` does; returns the NULLs in the counted columns, seen by the writing tasks themselves."""
    rows = df.hint("rebalance", partition_by) if partition_by else df
    seen = Observation()
    if counted:
        # Last before the write: a task there counts once, however often an earlier stage runs.
        rows = rows.observe(seen, *(F.count_if(F.col(name).isNull()).alias(name) for name in counted))
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return {name: seen.get[name] for name in counted}


def write_snapshots(tables: Mapping[str, Callable[[], DataFrame]], folder: str) -> dict[str, str]:
    """One Parquet folder per table; a table that fails is logged and left out.

    Tables come as functions so that a source that cannot be read fails alone.
    """
    written: dict[str, str] = {}
    for name, load in tables.items():
        path = f"{folder}/{name}"
        try:
            written[name] = write_snapshot(load(), path)
        except Exception as error:
            log.error("table %s was not written: %s", name, error)
    return written


def register_raw(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """Snapshots as views ``raw_<table>``, replacing earlier ones; nothing is copied."""
    names = []
    for table, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(f"raw_{table}")
        names.append(f"raw_{table}")
    return names


# A published table is a folder of versions; a version counts from the moment its mark is there.
VERSION = re.compile(r"v\d{12}")
MARK = "_PUBLISHED"


def files(spark: SparkSession, path: str):
    """(file system, path) by Spark's own reader, which knows every store that tables can lie in."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def _versions(spark: SparkSession, path: str, published: bool = True) -> list[str]:
    fs, there = files(spark, path)
    if not fs.exists(there):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(there) if s.isDirectory()]
    names = sorted(n for n in names if VERSION.fullmatch(n))
    return [n for n in names if fs.exists(files(spark, f"{path}/{n}/{MARK}")[1])] if published else names


@dataclass(frozen=True)
class Staged:
    """A written version of a table that no reader sees until ``release``."""

    name: str
    path: str
    version: str
    rows: DataFrame
    nulls: Mapping[str, int]

    def release(self, keep: int = 2) -> DataFrame:
        """Makes the version the current one and the view of its name; all but the last ``keep`` are removed."""
        spark = self.rows.sparkSession
        fs, mark = files(spark, f"{self.path}/{self.version}/{MARK}")
        fs.create(mark, True).close()
        current = _versions(spark, self.path)[-max(1, keep) :]
        for name in _versions(spark, self.path, published=False):
            if name < current[0]:
                fs.delete(files(spark, f"{self.path}/{name}")[1], True)
        self.rows.createOrReplaceTempView(self.name)
        return self.rows


def stage_mart(
    df: DataFrame, name: str, path: str, partition_by: str | None = None, counted: Sequence[str] = ()
) -> Staged:
    """Writes a new version of the table at ``path`` next to the published ones, counting the NULLs of some columns."""
    spark = df.sparkSession
    taken = _versions(spark, path, published=False)
    version = f"v{int(taken[-1][1:]) + 1 if taken else 1:012d}"
    nulls = _write(df, f"{path}/{version}", partition_by, counted)
    rows = spark.read.schema(df.schema).parquet(f"{path}/{version}").select(df.columns)
    return Staged(name, path, version, rows, nulls)


def stage_all(tables: Mapping[str, DataFrame], folder: str, counted: Mapping[str, Sequence[str]] | None = None) -> dict[str, Staged]:
    """New versions of tables at ``folder``/name, written at the same time."""
    counted = counted or {}

    def job(name: str, df: DataFrame) -> Callable[[], Staged]:
        return lambda: stage_mart(df, name, f"{folder}/{name}", counted=counted.get(name, ()))

    spark = next(iter(tables.values())).sparkSession
    return side_by_side(spark, {name: job(name, df) for name, df in tables.items()})


def materialize_mart(df: DataFrame, name: str, path: str, partition_by: str | None = None) -> DataFrame:
    """Publishes a table at ``path`` as a new version and returns it as read back.

    Readers see the old version until the new one is complete; a failed write leaves the
    old one. One writer at a time.
    """
    return stage_mart(df, name, path, partition_by).release()


# Tables that belong together are released by one file with the version of each.
RELEASES = "_RELEASES"


def _releases(spark: SparkSession, folder: str) -> list[str]:
    fs, there = files(spark, f"{folder}/{RELEASES}")
    names = [s.getPath().getName() for s in fs.listStatus(there)] if fs.exists(there) else []
    return sorted(n for n in names if re.fullmatch(r"\d{12}\.json", n))


def _versions_in(spark: SparkSession, folder: str, release: str) -> dict[str, str]:
    return json.loads("".join(row[0] for row in spark.read.text(f"{folder}/{RELEASES}/{release}").collect()))


def release_all(staged: Mapping[str, Staged], folder: str, keep: int = 2, without: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Makes staged tables, each at ``folder``/name, the current ones together, by one mark.

    A reader has the tables of one release or of the one before, never some of each: the
    mark is written aside and renamed. Tables that are not named keep the version of the
    release before, but for those ``without`` which the new one is. All but the last ``keep`` releases are removed. One writer at a time.
    """
    spark = next(iter(staged.values())).rows.sparkSession
    before = _releases(spark, folder)
    taken_over = _versions_in(spark, folder, before[-1]) if before else {}
    versions = {name: version for name, version in taken_over.items() if name not in without}
    versions |= {name: table.version for name, table in staged.items()}
    number = int(before[-1].split(".")[0]) + 1 if before else 1
    fs, aside = files(spark, f"{folder}/{RELEASES}/_writing")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(versions).encode()))
    out.close()
    if not fs.rename(aside, files(spark, f"{folder}/{RELEASES}/{number:012d}.json")[1]):
        raise RuntimeError(f"release {number} of {folder} could not be marked")
    current = _releases(spark, folder)
    kept = [_versions_in(spark, folder, name) for name in current[-max(1, keep) :]]
    for name in staged:
        oldest = min(v[name] for v in kept if name in v)
        for version in _versions(spark, f"{folder}/{name}", published=False):
            if version < oldest:
                fs.delete(files(spark, f"{folder}/{name}/{version}")[1], True)
    for name in set(taken_over) - set().union(*kept):
        fs.delete(files(spark, f"{folder}/{name}")[1], True)
    for name in current[: -max(1, keep)]:
        fs.delete(files(spark, f"{folder}/{RELEASES}/{name}")[1], True)
    for name, table in staged.items():
        table.rows.createOrReplaceTempView(name)
    return {name: table.rows for name, table in staged.items()}


def read_release(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of the newest release in ``folder``; none if there is no release."""
    releases = _releases(spark, folder)
    versions = _versions_in(spark, folder, releases[-1]) if releases else {}
    return {name: spark.read.parquet(f"{folder}/{name}/{version}") for name, version in versions.items()}


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of a published table, in any session; None if there is none.

    That is the newest version with a mark of its own or in the newest release of its folder.
    """
    folder, name = path.rstrip("/").rsplit("/", 1)
    releases = _releases(spark, folder)
    released = _versions_in(spark, folder, releases[-1]).get(name) if releases else None
    versions = sorted({*_versions(spark, path), *([released] if released else [])})
    return spark.read.parquet(f"{path}/{versions[-1]}") if versions else None

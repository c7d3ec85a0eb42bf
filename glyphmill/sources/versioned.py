"""A partitioned Parquet table whose every write is a readable version.

Layout below the table path::

    write_id=<id>/domain=<d>/ingest_date=<date>/part-*.parquet
    write_id=<id>/quarantined=<true|false>/domain=<d>/...   (a write that sets rows apart)
    _commits/version=<n>/part-*.json
    _profiles/write_id=<id>/part-*.parquet                (optional, of the rows of one write)

A write has a folder of its own and becomes visible only when its commit is
written, after the data. Readers list the folders of visible writes and no
others: files of a failed or unfinished write are never read, and an overwrite
may change the columns and the partitioning without touching older versions. All rows of a
write have one ``domain`` and ``ingest_date``; the mode ``overwrite_partition`` hides the earlier
writes of the same domain and day and no others. One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from glyphmill.params import DomainParams

_COMMIT_SCHEMA = (
    "version int, committed_at timestamp, mode string, n_rows bigint, write_id string, schema string, "
    "n_quarantined bigint, stamp map<string,string>, metrics map<string,double>"
)
_WRITE_ID, _N_ROWS, _N_QUARANTINED = "write_id", "n_rows", "n_quarantined"
_QUARANTINED, MASK = "quarantined", "broken_rules"


@dataclass(frozen=True)
class StagedWrite:
    """Data that is written but not visible yet."""

    path: str
    version: int
    write_id: str
    mode: str
    partition_by: tuple[str, ...]
    schema: StructType
    metrics: dict[str, Any]
    stamp: dict[str, str]
    quarantine: bool = False


def _commit_dir(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def table_history(spark: SparkSession, path: str) -> DataFrame:
    """``version, committed_at, mode, n_rows`` of every write, the first being version 0."""
    return _commits(spark, path).select("version", "committed_at", "mode", "n_rows").orderBy("version")


def _commits(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, _commit_dir(path)):
        return spark.createDataFrame([], _COMMIT_SCHEMA)
    # The quoted pattern names the folders; hidden folders are not listed by default.
    root = _commit_dir(path)
    return spark.read.schema(_COMMIT_SCHEMA).option("basePath", root).json(f"{root}/version=*")


def _string_partitions(schema: StructType, partition_by: tuple[str, ...]) -> StructType:
    data = [item for item in schema.fields if item.name not in partition_by]
    return StructType(data + [StructField(name, StringType()) for name in partition_by])


def _root(path: str, write_id: str) -> str:
    return f"{path.rstrip('/')}/{_WRITE_ID}={write_id}"


def _folder(path: str, commit) -> str:
    """The folder of a commit's rows; those set apart lie beside them."""
    root = _root(path, commit.write_id)
    return root if commit.n_quarantined is None else f"{root}/{_QUARANTINED}=false"


def _read_files(spark: SparkSession, path: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    """Rows of the folders of writes; those with a level of folders for rows set apart are read by themselves."""
    out = spark.createDataFrame([], schema)
    for own in ([_WRITE_ID], [_WRITE_ID, _QUARANTINED]):
        chosen = [folder for folder in folders if (f"/{_QUARANTINED}=" in folder) == (len(own) == 2)]
        if not chosen:
            continue
        # The schema is given: inference would turn the string ingest_date into a date.
        typed = StructType([*schema.fields, *[StructField(name, StringType()) for name in own]])
        found = spark.read.schema(typed).option("basePath", path).parquet(*chosen).drop(*own)
        if len(chosen) == len(folders):
            return found
        out = out.unionByName(found)
    return out


def stage_write(
    rows: DataFrame,
    params: DomainParams,
    ingest_date: str | None = None,
    metrics: Sequence[Column] = (),
    mask: Column | None = None,
) -> StagedWrite:
    """Write ``rows`` with their ``domain`` and ``ingest_date``, invisible to readers.

    With ``mask``, rows where it isn't 0 are set apart, with the mask as
    ``broken_rules``: ``read_quarantine`` has them once the write is committed.

    Files go where their tasks run: the partition values of one write are
    constants, so no shuffle is needed. ``metrics`` are named aggregates over the
    rows as they are written, at no pass of their own; the last stage's tasks
    count once each, also when they are retried.
    """
    spark, target = rows.sparkSession, params.lakehouse
    stamp = {"domain": params.domain, "ingest_date": ingest_date or datetime.now(UTC).strftime("%Y-%m-%d")}
    stamped = rows.withColumns({name: F.lit(value) for name, value in stamp.items()})
    unknown = [name for name in target.partition_by if name not in stamped.columns]
    if unknown:
        raise ValueError(f"partition columns not in the data: {unknown}")
    taken = {_QUARANTINED, MASK} & set(stamped.columns)
    if mask is not None and taken:
        raise ValueError(f"columns that a write with quarantine adds are in the data: {sorted(taken)}")
    schema = _string_partitions(stamped.schema, target.partition_by)
    earlier = _commit_rows(spark, target.path)
    if target.mode != "overwrite" and earlier:
        kept = StructType.fromJson(json.loads(earlier[-1].schema))
        if _shape(kept) != _shape(schema):
            raise ValueError(f"schema of the append differs from {target.path}: {_shape(kept)} / {_shape(schema)}")
    write_id, observed, folders = uuid.uuid4().hex, Observation(), target.partition_by
    counts = [F.count(F.lit(1)).alias(_N_ROWS)]
    if mask is not None:
        stamped = stamped.withColumn(MASK, mask).withColumn(_QUARANTINED, (F.col(MASK) != 0).cast("string"))
        apart = F.count_if(F.col(MASK) != 0)
        counts, folders = [(F.count(F.lit(1)) - apart).alias(_N_ROWS), apart.alias(_N_QUARANTINED)], (_QUARANTINED, *folders)
    measured = stamped.observe(observed, *counts, *metrics)
    measured.write.mode("errorifexists").partitionBy(*folders).parquet(_root(target.path, write_id))
    version = earlier[-1].version + 1 if earlier else 0
    return StagedWrite(
        target.path, version, write_id, target.mode, target.partition_by, schema, observed.get, stamp, mask is not None
    )


def read_staged(spark: SparkSession, staged: StagedWrite) -> DataFrame:
    """The rows a staged write will show."""
    root = _root(staged.path, staged.write_id)
    folders = [root if not staged.quarantine else f"{root}/{_QUARANTINED}=false"]
    if not staged.metrics[_N_ROWS]:
        return spark.createDataFrame([], staged.schema)
    return _read_files(spark, staged.path, staged.schema, folders)


def _profile_dir(path: str, write_id: str) -> str:
    return f"{path.rstrip('/')}/_profiles/{_WRITE_ID}={write_id}"


def save_profile(profile: DataFrame, staged: StagedWrite) -> None:
    """Keep a small table of counts with a write; readers see it once the write is committed."""
    profile.write.mode("errorifexists").parquet(_profile_dir(staged.path, staged.write_id))


def read_profile(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The profiles of all writes a version shows, in union; an error if one of these has none."""
    visible = _visible(spark, path, version)
    folders = {commit.version: _profile_dir(path, commit.write_id) for commit in visible}
    bare = [version for version, folder in folders.items() if not _exists(spark, folder)]
    if bare:
        raise ValueError(f"{path}: no profile was saved with version {bare[0]}")
    return spark.read.option("basePath", f"{path.rstrip('/')}/_profiles").parquet(*folders.values()).drop(_WRITE_ID)


def discard_write(spark: SparkSession, staged: StagedWrite) -> None:
    """Remove the files of a staged write that is not to be committed."""
    for folder in (_root(staged.path, staged.write_id), _profile_dir(staged.path, staged.write_id)):
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def commit_write(spark: SparkSession, staged: StagedWrite, metrics: Mapping[str, float] | None = None) -> int:
    """Make a staged write visible and return its version; ``metrics`` are kept with it.

    Fails if that version exists, i.e. another write was committed since staging.
    """

    def pairs(values: Mapping[str, Any]) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])

    commit = {
        "committed_at": F.lit(datetime.now(UTC)),
        "mode": F.lit(staged.mode),
        _N_ROWS: F.lit(staged.metrics[_N_ROWS]),
        "write_id": F.lit(staged.write_id),
        "schema": F.lit(staged.schema.json()),
        "stamp": pairs(staged.stamp),
    }
    if staged.quarantine:
        commit[_N_QUARANTINED] = F.lit(staged.metrics[_N_QUARANTINED])
    if metrics:
        commit["metrics"] = pairs({name: float(value) for name, value in metrics.items()})
    one = spark.range(0, 1, 1, 1).select(*[value.alias(name) for name, value in commit.items()])
    one.write.mode("errorifexists").json(f"{_commit_dir(staged.path)}/version={staged.version}")
    return staged.version


def write_table(rows: DataFrame, params: DomainParams, ingest_date: str | None = None) -> str:
    """Append to or overwrite the domain's table as one new version; returns the path."""
    commit_write(rows.sparkSession, stage_write(rows, params, ingest_date))
    return params.lakehouse.path


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(item.name, item.dataType.simpleString()) for item in schema.fields]


def _commit_rows(spark: SparkSession, path: str) -> list:
    """All commits in order, on the driver: one row per write, not per datum."""
    if not _exists(spark, _commit_dir(path)):
        return []
    return sorted(_commits(spark, path).collect(), key=lambda commit: commit.version)


def _needed(commits: list) -> list:
    """Of commits in order those the last one shows: back to the latest overwrite, without replaced days."""
    shown: list = []
    for commit in commits:
        if commit.mode == "overwrite":
            shown = []
        elif commit.mode == "overwrite_partition":
            shown = [earlier for earlier in shown if earlier.stamp != commit.stamp]
        shown.append(commit)
    return shown


def _visible(spark: SparkSession, path: str, version: int | None = None) -> list:
    """Commits a version consists of."""
    commits = _commit_rows(spark, path)
    if version is not None:
        if version not in {commit.version for commit in commits}:
            raise ValueError(f"{path} has no version {version}")
        commits = [commit for commit in commits if commit.version <= version]
    if not commits:
        raise ValueError(f"{path} holds no committed version")
    return _needed(commits)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at its newest version, or as of ``version``.

    Partition columns are strings, and filters on them prune folders.
    """
    visible = _visible(spark, path, version)
    gone = [commit.version for commit in visible if not _exists(spark, _root(path, commit.write_id))]
    if gone:
        raise ValueError(f"{path}: data of version {gone[0]} was removed by expire_versions")
    schema = StructType.fromJson(json.loads(visible[-1].schema))
    # a write whose rows are all set apart has no folder of other rows
    folders = [_folder(path, commit) for commit in visible if commit.n_quarantined is None or commit.n_rows]
    return _read_files(spark, path, schema, folders)


def read_quarantine(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows that visible writes set apart, with ``broken_rules``; as of ``version`` if given."""
    visible = _visible(spark, path, version)
    schema = StructType.fromJson(json.loads(visible[-1].schema))
    typed = StructType([*schema.fields, StructField(MASK, LongType())])
    folders = [f"{_root(path, commit.write_id)}/{_QUARANTINED}=true" for commit in visible if commit.n_quarantined]
    return _read_files(spark, path, typed, folders)


def table_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``version, committed_at, mode, metric, value`` of the metrics that were kept with each write."""
    commits = _commits(spark, path)
    return commits.select("version", "committed_at", "mode", F.explode("metrics").alias("metric", "value"))


def expire_versions(
    spark: SparkSession, path: str, keep_last: int, unfinished_after: timedelta = timedelta(days=7)
) -> list[str]:
    """Remove data that the last ``keep_last`` versions don't show; returns the ids of the removed writes.

    Writes that were never committed go if nothing has changed in their folder for
    ``unfinished_after``, which must be longer than any write takes. The
    commits stay: the history is whole, and reading a version whose data is gone is
    an error. Readers of kept versions are not disturbed.
    """
    if keep_last < 1:
        raise ValueError(f"keep_last must be at least 1, got {keep_last}")
    commits = _commit_rows(spark, path)
    kept = {c.write_id for i in range(max(0, len(commits) - keep_last), len(commits)) for c in _needed(commits[: i + 1])}
    known = {commit.write_id for commit in commits}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    oldest = (datetime.now(UTC) - unfinished_after).timestamp() * 1000
    removed = []
    for status in system.listStatus(root) if system.exists(root) else []:
        name = status.getPath().getName()
        if not name.startswith(f"{_WRITE_ID}="):
            continue
        write_id = name.split("=", 1)[1]
        stale = write_id not in kept if write_id in known else _last_change(system, status) < oldest
        if stale:
            system.delete(status.getPath(), True)
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(_profile_dir(path, write_id)), True)
            removed.append(write_id)
    return sorted(removed)


def _last_change(system, status) -> int:
    """Newest modification time of a folder or anything in it."""
    newest = status.getModificationTime()
    if status.isDirectory():
        for below in system.listStatus(status.getPath()):
            newest = max(newest, _last_change(system, below))
    return newest

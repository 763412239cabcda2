"""Session settings and the one place where intermediate results are persisted."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyarrow import ArrowInvalid, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuswave.files import file_system

T = TypeVar("T")

CHECKPOINT_KEY = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}

# Side tables with at most this many rows may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def build_session(app: str = "locuswave", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC; everything else is left to the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stage tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may fall back to a
    temporary folder: on a cluster, executors could not read each other's files there.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="locuswave-")
    return _local_roots[app]


def _run_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/stages-{spark.sparkContext.applicationId}"


def run_path(spark: SparkSession, label: str) -> str:
    """A new folder name in this application's part of the shared folder."""
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Removes all stage tables of this application, for the end of a run: DataFrames made so far are void."""
    system, folder = file_system(_run_folder(spark))
    if system.get_file_info(folder).type == fs.FileType.Directory:
        system.delete_dir(folder)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage (a lost executor costs a re-read, not a re-run of the whole plan) and gives
    later steps column pruning, filter push-down and a known size.
    """
    spark = df.sparkSession
    path = run_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Deletes stage tables of this application that nothing reads any more: DataFrames made from them are void.

    Only folders of stage tables go.  Those on a file system that Python cannot open stay.
    """
    for df in staged:
        stages = _run_folder(df.sparkSession).rsplit("/", 1)[1]
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if folder.split("/")[-2] != stages:
                raise ValueError(f"not a stage table: {folder}")
            try:
                system, path = file_system(folder)
            except (ArrowInvalid, NotImplementedError):
                continue
            system.delete_dir(path)


def tasks_for(staged: DataFrame, rows: int) -> int:
    """Shuffle partitions that give each task about ``rows`` rows of a staged table (counted from its file footers).

    Without a number, adaptive execution fills tasks by shuffled bytes, whatever a task makes of them.
    """
    return max(1, -(-staged.count() // rows))


def together(**steps: Callable[[], T]) -> dict[str, T]:
    """Run independent steps at the same time; small jobs then share the cluster."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = {name: pool.submit(step) for name, step in steps.items()}
        return {name: future.result() for name, future in futures.items()}


def fits_broadcast(staged: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True when a staged table is small enough to broadcast (counted, at most max_rows + 1 rows)."""
    return staged.limit(max_rows + 1).count() <= max_rows


def bounded_side(staged: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row-count check; beyond it the join falls back to a shuffle."""
    return F.broadcast(staged) if fits_broadcast(staged, max_rows) else staged

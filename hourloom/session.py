"""Session helpers and intermediate tables.

A step whose result must stay fixed, or is read more than once, is written as
Parquet to the shared folder named by ``spark.checkpoint.dir`` and read back.
That cuts the lineage, survives the loss of an executor, keeps column pruning,
and gives the optimizer the true size of the table.

``scratch`` owns the tables written inside it and deletes them at its end; a job
that returns finished tables runs inside one. ``settled`` leaves a job's result alone. Outside, they stay for whoever
consumes the returned plan, in the folder that the session names.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "hourloom") -> SparkSession:
    """A one-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", os.environ.get("HOURLOOM_SHUFFLE", "8"))
        .config("spark.checkpoint.dir", os.environ.get("HOURLOOM_SCRATCH") or tempfile.mkdtemp(prefix="hourloom-"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HOURLOOM_MEMORY", "8g"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a private one only on a local master without any."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            folder = tempfile.mkdtemp(prefix="hourloom-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_OWNERS: list[list[str]] = []


@contextmanager
def owned() -> Iterator[list[str]]:
    """The paths of the tables that ``materialise`` writes meanwhile, for whoever deletes them."""
    paths: list[str] = []
    _OWNERS.append(paths)
    try:
        yield paths
    finally:
        _OWNERS.pop()


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder, files = _folder(spark, path)
        files.delete(folder, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what a folder holds; none if there is no such folder."""
    folder, files = _folder(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table's write has ended: its marker comes last."""
    folder, files = _folder(spark, f"{path}/_SUCCESS")
    return files.exists(folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, every table that ``materialise`` writes meanwhile."""
    with owned() as paths:
        try:
            yield
        finally:
            delete_tables(spark, paths)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The written result of ``make``; the tables that it writes on the way are deleted."""
    with owned() as paths:
        result = materialise(make())
    delete_tables(result.sparkSession, paths[:-1])
    if _OWNERS:
        _OWNERS[-1].append(paths[-1])
    return result


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tables/{uuid.uuid4().hex}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

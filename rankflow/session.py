"""Session-level helpers: a tuned local session, the shared folder and what is staged there."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cores: int | str = "*", memory: str = "16g", name: str = "rankflow") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    parallelism = 8 if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parallelism))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


@functools.cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may leave that setting out; on a cluster a
    machine-local folder would be lost with its machine, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _test_folder()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever store the path names."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).exists(named)


_staged: list[str] = []


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Spark settings, by names in which ``__`` stands for a dot, for the jobs inside the block."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def released(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Jobs inside the block delete their shuffle files when they end, not when the driver next collects its garbage.

    For jobs that are done with then, as those that write a table or fetch a number; a frame that is
    collected twice would miss its files.
    """
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def stage(df: DataFrame, label: str = "stage", schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, with ``schema`` where that names the same data otherwise.

    Cuts lineage after costly steps (a model call, say) so that an executor loss or a
    second reader costs a re-read instead of a re-run. The shuffle files of the write are
    deleted with its end; ``unstage`` deletes the folder.
    """
    path = shared_folder(df.sparkSession, label)
    with released(df.sparkSession):
        df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def unstage(spark: SparkSession, since: int = 0) -> None:
    """Delete the folders staged by this process, from the ``since``-th on.

    For callers that have written their results: frames that still read a staged folder
    are of no use afterwards.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while len(_staged) > since:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside the block is deleted at its end."""
    before = len(_staged)
    try:
        yield
    finally:
        unstage(spark, before)

"""Intermediate results written to the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}

_collecting: ContextVar[tuple[list[str], ...]] = ContextVar("collecting", default=())

LOCAL_PATH_OPTION = "spark.lastro.localPathIsShared"


def on_one_machine(spark: SparkSession) -> bool:
    """True only for a session known to run in a single process."""
    master = spark.conf.get("spark.master", "")
    return bool(re.fullmatch(r"local(\[[^\]]*\])?", master))


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder named by ``spark.checkpoint.dir``.

    Without the setting a single-machine session gets a temporary folder. Any
    other session, also one that does not tell its master, is refused: a
    folder of one machine would be lost with it. A scheme-less or ``file:``
    path is taken as named; it must be mounted on every machine.
    ``spark.lastro.localPathIsShared=false`` refuses such paths on a cluster.
    """
    app = spark.conf.get("spark.app.id", "") or "app"
    base = spark.conf.get("spark.checkpoint.dir", "")
    single = on_one_machine(spark)
    if not base:
        if not single:
            raise ValueError(
                "set spark.checkpoint.dir to a folder every executor can reach")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="lastro-")
        base = _local_folders[app]
    elif not single and is_local_path(base) and spark.conf.get(
            LOCAL_PATH_OPTION, "true").lower() == "false":
        raise ValueError(
            f"{base} is a local path, and {LOCAL_PATH_OPTION} is false")
    return f"{base.rstrip('/')}/lastro/{app}"


def is_local_path(path: str) -> bool:
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return scheme is None or scheme[1].lower() == "file"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    for made in _collecting.get():
        made.append(path)
    return path


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths that ``new_path`` gives within the block, in this thread.

    For who runs a computation to its end, and so knows that what it staged is
    needed no more, also where the computation itself had to leave it.
    """
    made: list[str] = []
    token = _collecting.set((*_collecting.get(), made))
    try:
        yield made
    finally:
        _collecting.reset(token)


def stage(df: DataFrame, label: str, path: str = "") -> DataFrame:
    """``df`` computed once, written out, and read back.

    A lost executor then costs a re-read and not the work above the stage, and
    the optimizer plans what follows with the true size on disk.
    """
    path = path or new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder, on whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(folder, True)


class Scratch:
    """Staged results that one computation removes when it needs them no more.

    ``stage`` writes under a label; ``release`` removes labels, or, as a
    context manager, everything that was not handed over by ``keep``.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = new_path(self.spark, label)
        self.release(label)
        self.paths[label] = path
        return stage(df, label, path)

    def keep(self, *labels: str) -> None:
        for label in labels:
            self.paths.pop(label, None)

    def release(self, *labels: str) -> None:
        for label in labels:
            if label in self.paths:
                remove(self.spark, self.paths.pop(label))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.release(*list(self.paths))

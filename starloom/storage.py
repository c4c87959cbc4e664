"""Shared folders for intermediate tables.

Intermediate results are written where every executor can read them again, so
losing an executor costs a re-read and never a result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, which has one machine by definition, may fall back to
    the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.gettempdir()}/starloom"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the stored rows."""
    spark = df.sparkSession
    path = new_path(spark, label)
    for paths in _scratches.get():
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Of the work at hand; loads in other threads have their own.
_scratches: ContextVar[tuple[list[str], ...]] = ContextVar("scratches", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is materialized inside is removed at the end; only for work that is stored elsewhere by then.

    Threads started inside belong to it if they run in a copy of the context.
    """
    paths: list[str] = []
    before = _scratches.set((*_scratches.get(), paths))
    try:
        yield
    finally:
        _scratches.reset(before)
        for path in paths:
            remove(spark, path)


def _at(spark: SparkSession, path: str):
    """The file system that ``path`` is on, and the path in its terms."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and directories in a directory; none if it does not exist."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a directory with all it holds."""
    system, place = _at(spark, path)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name; gives whether it was written.

    Of several that try at once exactly one succeeds, and nobody sees half a file: a
    draft gets the name in one step that fails if the name is taken. That is a link on
    a local disk and a rename elsewhere, which HDFS and the like refuse over an existing
    file. A plain object store has no such step.
    """
    jvm = spark.sparkContext._jvm
    folder, _, name = path.rpartition("/")
    system, place = _at(spark, folder)
    system.mkdirs(place)
    # Where a mounted folder really is decides how a name is taken.
    place = system.resolvePath(place)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new_path_of = jvm.org.apache.hadoop.fs.Path
    target, draft = new_path_of(place, name), new_path_of(place, f".draft-{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    try:
        if system.getScheme() != "file":
            return system.rename(draft, target)
        at = [jvm.java.nio.file.Path.of(each.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)) for each in (target, draft)]
        try:
            jvm.java.nio.file.Files.createLink(*at)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True
    finally:
        system.delete(draft, False)

"""Small files and folders through Hadoop's file system, so any path Spark can reach works.

Only metadata goes this way: a pointer, a high-water mark, the names of partition folders.
"""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders, sorted; empty when the path is absent."""
    if not exists(spark, path):
        return []
    entries = _system(spark, path).listStatus(_path(spark, path))
    return sorted(e.getPath().getName() for e in entries if e.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files, sorted; empty when the path is absent."""
    if not exists(spark, path):
        return []
    entries = _system(spark, path).listStatus(_path(spark, path))
    names = [e.getPath().getName() for e in entries if e.isFile()]
    return sorted(n for n in names if not n.startswith(".") and not n.endswith(".tmp"))


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one."""
    _rename(spark, _draft(spark, path, text), path, "OVERWRITE")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file in one step, unless it is there already: of several writers one gets True."""
    draft = _draft(spark, path, text)
    try:
        _rename(spark, draft, path, "NONE")
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        delete(spark, draft)
        return False
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another name, which must be free."""
    _rename(spark, source, target, "NONE")


def _draft(spark: SparkSession, path: str, text: str) -> str:
    draft = f"{path}.{uuid4().hex}.tmp"
    stream = _system(spark, draft).create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return draft


def _rename(spark: SparkSession, source: str, target: str, how: str) -> None:
    system, draft = _system(spark, source), _path(spark, source)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri() if draft.toUri().getScheme() else system.getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    choice = spark.sparkContext._gateway.new_array(options, 1)
    choice[0] = getattr(options, how)
    context.rename(system.makeQualified(draft), system.makeQualified(_path(spark, target)), choice)


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)

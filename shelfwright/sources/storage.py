"""Files of the shared store, through the file systems that Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it is absent."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    return _system(spark, path).getContentSummary(_path(spark, path)).getLength() if exists(spark, path) else 0


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _system(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename in one step unless the target exists; says whether it did."""
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    option = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(option, 1)
    how[0] = option.NONE
    try:
        files.rename(_path(spark, source), _path(spark, target), how)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True

"""Small file operations on the tables' own file system, whatever it is."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, pattern: str) -> str:
    """The paths that match a pattern, as one text `[a, b]`: a single call, however many there are."""
    place, files = _at(spark, pattern)
    found = files.globStatus(place)
    if not found:
        return "[]"
    jvm = spark._jvm
    paths = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, len(found))
    jvm.java.lang.System.arraycopy(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found), 0, paths, 0, len(found))
    return jvm.java.util.Arrays.toString(paths)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is no such file."""
    place, files = _at(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file under another name and renames it, so that readers see the old or the new one whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place, files = _at(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = files.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)
    context.rename(files.makeQualified(new), files.makeQualified(place), how)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes files or folders; those already gone are no error."""
    for path in paths:
        place, files = _at(spark, path)
        files.delete(place, True)

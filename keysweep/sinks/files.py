"""The few things that must be done to folders, in any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def plain_path(path: str) -> str:
    """``path`` without its scheme, to compare two of them."""
    return "/" + path.split(":", 1)[-1].strip("/")


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in ``path``, by name; none if there is no such folder."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    found = [status.getPath().toString() for status in files.listStatus(place) if status.isDirectory()]
    return sorted(found)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether there are files in the folder ``path`` itself."""
    files, place = _file_system(spark, path)
    return any(status.isFile() for status in files.listStatus(place))


def delete_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)

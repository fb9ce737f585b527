"""File systems as Python workers see them."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

_REMOTE = re.compile(r"^([a-z][a-z0-9+.-]*)://([^/]*)(/.*)$")
_LOCAL = re.compile(r"^file:(//)?(?=/)")


def qualify(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark would read it by; to be called in the driver, before :func:`locate`."""
    plain = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(plain).toString()


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path inside it, for the URI spellings that Spark uses."""
    path = _LOCAL.sub("", path)
    remote = _REMOTE.match(path)
    if not remote:
        return fs.LocalFileSystem(), path
    system, base = fs.FileSystem.from_uri(f"{remote[1]}://{remote[2]}/")
    return system, f"{base.rstrip('/')}{remote[3]}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file, read by the driver without a job."""
    system, place = _file_system(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file that appears whole or not at all; an error if it exists already."""
    system, place = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise FileExistsError(path)


def entries(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Name and time of change (epoch milliseconds) of what a folder holds; none if it is missing."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return [(found.getPath().getName(), found.getModificationTime()) for found in system.listStatus(place)]


def remove(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)

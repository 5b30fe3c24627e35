"""Folders whose content is replaced all at once.

    root/data/<version>/…      whole results, one of each run
    root/published/<number>    small pointer files, each with the name of a version

A run writes a fresh version, and then one pointer with the next number. The pointer of the
highest number counts, so readers see the old version until the pointer is complete, and the
new one from then on. A run that ends early leaves a version without a pointer, or an empty
pointer: neither is ever read. Pointers are created exclusively, so of two runs that build on the
same version only one can publish.
"""

from __future__ import annotations

import time
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Published versions that stay readable, the newest included: running queries may still read the one before.
KEPT_VERSIONS = 2
# Versions without a pointer are taken for abandoned after so many hours.
ABANDONED_HOURS = 72


class Version(NamedTuple):
    number: int
    path: str


class Outdated(RuntimeError):
    """Another run has published since the version that this one builds on."""


def _on(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _on(spark, path)
    return system.exists(place)


def _entries(spark: SparkSession, path: str) -> list:
    system, place = _on(spark, path)
    return list(system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    system, place = _on(spark, path)
    system.delete(place, True)


def _read(spark: SparkSession, path: str) -> str:
    system, place = _on(spark, path)
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, content: str) -> bool:
    """Write a new file; False if there is one."""
    system, place = _on(spark, path)
    try:
        stream = system.create(place, False)
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    return True


def is_versioned(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is such a folder, published or not."""
    return exists(spark, f"{root}/data") or exists(spark, f"{root}/published")


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = (status.getPath().getName() for status in _entries(spark, f"{root}/published"))
    return sorted(int(name) for name in names if name.isdigit())


def _pointer(root: str, number: int) -> str:
    return f"{root}/published/{number:012d}"


def _version(spark: SparkSession, root: str, number: int) -> Version | None:
    name = _read(spark, _pointer(root, number)).strip()
    return Version(number, f"{root}/data/{name}") if name else None


def published(spark: SparkSession, root: str) -> list[Version]:
    """All versions with a complete pointer, oldest first."""
    found = (_version(spark, root, number) for number in _numbers(spark, root))
    return [version for version in found if version]


def current(spark: SparkSession, root: str) -> Version | None:
    """The version in force."""
    for number in reversed(_numbers(spark, root)):
        if version := _version(spark, root, number):
            return version
    return None


def stage(root: str) -> str:
    """A fresh folder for the next version, which nobody reads before :func:`publish`."""
    return f"{root}/data/{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, path: str, after: int | None = None) -> Version:
    """Make a staged folder the version in force.

    ``after`` is the number of the version that it builds on (0 for none): if another one is
    in force by now, nothing is published.
    """
    name = path.removeprefix(f"{root}/data/")
    while True:
        last = max(_numbers(spark, root), default=0)
        in_force = current(spark, root)
        if after is not None and (in_force.number if in_force else 0) != after:
            raise Outdated(f"{root} is at version {in_force.number if in_force else 0}, not {after}")
        if _create(spark, _pointer(root, last + 1), name):
            return Version(last + 1, path)


def drop_old(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS, abandoned_hours: float = ABANDONED_HOURS) -> list[str]:
    """Delete all but the last published versions, and versions left behind without a pointer; returns their folders."""
    versions = published(spark, root)
    kept = {version.path.rsplit("/", 1)[1] for version in versions[-keep:]}
    old = [version for version in versions[:-keep] if version.path.rsplit("/", 1)[1] not in kept]
    for version in versions[:-keep]:
        remove(spark, _pointer(root, version.number))
    known, limit = {version.path.rsplit("/", 1)[1] for version in versions}, (time.time() - 3600 * abandoned_hours) * 1000
    left = [
        f"{root}/data/{status.getPath().getName()}"
        for status in _entries(spark, f"{root}/data")
        if status.getPath().getName() not in known and status.getModificationTime() < limit
    ]
    gone = [version.path for version in old] + left
    for path in gone:
        remove(spark, path)
    return gone

"""Versions of a table, of which readers see the one that a pointer names.

A version is written to a folder of its own that scans of the root skip. The pointer is
switched last, by an atomic rename, so a job that dies before leaves readers on the
version before, and a job that runs again writes its version anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from voxloom.session import _hadoop

VERSIONS = "_versions"
POINTER = "_current"


def publish(spark: SparkSession, root: str, version: str, write: Callable[[str], None]) -> str:
    """Write a version by ``write(folder)`` and point readers to it; returns its folder.

    ``write`` has to replace what an attempt before left there, and to write last what
    makes the version whole.
    """
    folder = version_folder(root, version)
    write(folder)
    _point(spark, root, version)
    return folder


def version_folder(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{VERSIONS}/{version}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see, or null before the first."""
    place, system = _hadoop(spark, f"{root.rstrip('/')}/{POINTER}")
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def published(spark: SparkSession, root: str) -> str:
    """The folder to read: that of the current version, or ``root`` if it was never published to."""
    version = current_version(spark, root)
    return root if version is None else version_folder(root, version)


def prune(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete versions that are not current, but for the ``keep`` latest of them.

    Readers of a version before may still be at work, so one is kept by default. What a
    dead job left counts as a version.
    """
    place, system = _hadoop(spark, f"{root.rstrip('/')}/{VERSIONS}")
    if not system.exists(place):
        return []
    current = current_version(spark, root)
    found = [(s.getModificationTime(), s.getPath().getName(), s.getPath()) for s in system.listStatus(place)]
    others = sorted((x for x in found if x[1] != current), key=lambda x: x[:2], reverse=True)
    for _, _, path in others[keep:]:
        system.delete(path, True)
    return sorted(name for _, name, _ in others[keep:])


def _point(spark: SparkSession, root: str, version: str) -> None:
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    place, system = _hadoop(spark, f"{root.rstrip('/')}/{POINTER}")
    new = jvm.org.apache.hadoop.fs.Path(f"{place.toString()}.{version}")
    stream = system.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    # Unlike FileSystem.rename, this replaces the file in one step.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE
    context.rename(new, place, how)

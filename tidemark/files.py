"""Files of the shared storage, on whichever file system the scheme of a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Gives a folder its final name; one writer per target."""
    place, system = _place(spark, target)
    if system.exists(place):
        raise FileExistsError(target)
    system.mkdirs(place.getParent())
    if not system.rename(_place(spark, source)[0], place):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it does not exist."""
    place, system = _place(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    place, system = _place(spark, path)
    return system.getContentSummary(place).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    place, system = _place(spark, path)
    unfinished = _place(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")[0]
    stream = system.create(unfinished)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.exists(place):
        system.delete(place, True)
    if not system.rename(unfinished, place):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()

"""Small records beside a job's tables, by which a run that was broken off finds out how far it came."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system that Spark has for the path, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def put_record(spark: SparkSession, folder: str, name: str, record: dict[str, Any]) -> None:
    """Writes a record; it is there whole or not at all, and takes the place of one of the same name."""
    files, target = _files(spark, f"{folder}/{name}.json")
    begun = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}.tmp")
    stream = files.create(begun, True)
    stream.write(bytearray(json.dumps(record).encode()))
    stream.close()
    files.delete(target, False)
    if not files.rename(begun, target):
        raise OSError(f"record {name} could not be put into {folder}")


def get_records(spark: SparkSession, folder: str) -> dict[str, dict[str, Any]]:
    """All whole records of a folder by name; none where there is no folder."""
    files, place = _files(spark, folder)
    if not files.exists(place):
        return {}
    found = {}
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("_") or not name.endswith(".json"):
            continue
        stream = files.open(status.getPath())
        found[name.removesuffix(".json")] = json.loads(bytes(stream.readAllBytes()))
        stream.close()
    return found

"""Which version of a table counts: small numbered files, of which the highest is the pointer.

A pointer names a version (a folder), the parts of it that belong to the table, and the columns. It is written beside and then
renamed, so that there is always either the old or the new one; older pointers are removed afterwards.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from monthclose.sources import files

SUFFIX = ".json"


class Pointer(NamedTuple):
    version: str
    parts: tuple[str, ...]
    schema: StructType


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = (n[: -len(SUFFIX)] for n in files.list_names(spark, folder) if n.endswith(SUFFIX))
    return sorted(int(n) for n in names if n.isdigit())


def _path(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}{SUFFIX}"


def current(spark: SparkSession, folder: str) -> Pointer | None:
    """The pointer that counts; None if there is none."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return None
    found = json.loads(files.read_small(spark, _path(folder, numbers[-1])))
    return Pointer(found["version"], tuple(found["parts"]), StructType.fromJson(found["schema"]))


def commit(spark: SparkSession, folder: str, pointer: Pointer) -> None:
    """Make ``pointer`` the one that counts, in one step. Fails if another writer was faster."""
    number = max(_numbers(spark, folder), default=0) + 1
    text = json.dumps({"version": pointer.version, "parts": pointer.parts, "schema": pointer.schema.jsonValue()})
    fresh = f"{folder}/_next-{uuid.uuid4().hex[:12]}"
    files.write_small(spark, fresh, text)
    if files.exists(spark, _path(folder, number)):
        raise OSError(f"{folder} was changed by another writer")
    files.rename(spark, fresh, _path(folder, number))


def forget_older(spark: SparkSession, folder: str) -> None:
    for number in _numbers(spark, folder)[:-1]:
        files.delete(spark, _path(folder, number))

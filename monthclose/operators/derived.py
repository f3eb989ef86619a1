"""Sums over a month table that are kept up as loads come and go.

A load never changes: it is added, or it is dropped. So sums by key are kept for each load of each month, as parts of one
table whose pointer says which loads they were made from. Bringing them up to date adds up the loads that are new, and only
their folders are read; parts of loads that are gone are left out by the same pointer. What is asked for is the sum of the parts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.operators.pointer import Pointer
from monthclose.operators.store import LOAD, PART, YM, MonthStore
from monthclose.sources import files


class KeptSums:
    """``name`` holds sums (alias: SQL expression of a row) by key columns over the month table ``table``."""

    def __init__(self, store: MonthStore, name: str, table: str, keys: Sequence[str], sums: Mapping[str, str]):
        self.store, self.name, self.table = store, name, table
        self.keys, self.sums = list(keys), dict(sums)

    def changed(self) -> DataFrame:
        """The rows of loads that are not yet in the sums, with month and load. Only their folders are listed."""
        return self._rows(self._missing())

    def refresh(self) -> int:
        """Bring the sums up to date; returns the number of loads that were read."""
        wanted, missing = self._loads(), self._missing()
        version = self._version()
        folder = self.store.version(self.name, version)[1]
        for part in missing:  # what a job that died has left
            files.delete(self.store.spark, f"{folder}/{PART}={part}")
        parts = self._by_key(self._rows(missing))
        if missing:
            parts.write.mode("append").partitionBy(PART).parquet(folder)
        self.store.point(self.name, Pointer(version, tuple(sorted(wanted)), parts.drop(PART).schema))
        return len(missing)

    def frame(self) -> DataFrame:
        """The sums by key. Keys are combined map-side, so a key that many loads have is no hot spot."""
        kept = self.store.table(self.name)
        return kept.groupBy(*self.keys).agg(*(F.sum(a).alias(a) for a in self.sums))

    def _by_key(self, rows: DataFrame) -> DataFrame:
        month, load = F.coalesce(YM, F.lit("")), F.col(LOAD)
        part = F.substring(F.sha2(F.concat_ws("/", month, load).cast("binary"), 256), 1, 24)
        grouped = rows.groupBy(*self.keys, part.alias(PART))
        return grouped.agg(*(F.sum(F.expr(e)).alias(a) for a, e in self.sums.items()))

    def _version(self) -> str:
        """Sums of another kind, or over other columns, are another version."""
        what = [self.table.lower(), self.keys, self.sums, self.store.month_schema(self.table).jsonValue()]
        return hashlib.sha256(json.dumps(what).encode()).hexdigest()[:12]

    def _loads(self) -> dict[str, tuple[str | None, str]]:
        """The loads of each month that count, by the name of their part."""
        def part(month: str | None, load: str) -> str:
            return hashlib.sha256(f"{month or ''}/{load}".encode()).hexdigest()[:24]

        return {part(*found): found for found in self.store.loads(self.table)}

    def _missing(self) -> dict[str, tuple[str | None, str]]:
        now = self.store.pointer(self.name)
        kept = set(now.parts) if now and now.version == self._version() else set()
        return {part: found for part, found in self._loads().items() if part not in kept}

    def _rows(self, loads: Mapping[str, tuple[str | None, str]]) -> DataFrame:
        rows = self.store.load_rows(self.table)
        if not loads:
            return rows.where(F.lit(False))
        wanted = (F.col(YM).eqNullSafe(F.lit(month)) & (F.col(LOAD) == load) for month, load in loads.values())
        return rows.where(reduce(lambda a, b: a | b, wanted))

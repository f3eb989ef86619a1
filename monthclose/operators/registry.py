"""Load registry: which file a table was last loaded from, so that a rerun skips it.

The registry only grows; the latest row of a table counts. Finding it is one aggregation with map-side
combining, so a table that was loaded very often is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.operators.store import REGISTRY, MonthStore

SCHEMA = "table_name string, file_name string, row_count bigint, loaded_at timestamp"


def latest_loads(history: DataFrame) -> DataFrame:
    """One row per table: its latest load."""
    newest = F.max(F.struct("loaded_at", "file_name", "row_count"))
    return (
        history.groupBy("table_name")
        .agg(newest.alias("last"))
        .select("table_name", "last.file_name", "last.row_count", "last.loaded_at")
    )


def not_yet_loaded(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates ``(table_name, file_name, …)`` whose table was not last loaded from that file."""
    return candidates.join(
        latest_loads(history).select("table_name", "file_name"),
        ["table_name", "file_name"],
        "left_anti",
    )


class LoadRegistry:
    """The registry of one month store."""

    def __init__(self, store: MonthStore):
        self.store = store
        if not store.exists(REGISTRY):
            empty = store.spark.createDataFrame([], SCHEMA)
            store.append(REGISTRY, empty)

    def history(self) -> DataFrame:
        return self.store.table(REGISTRY)

    def entries(self) -> DataFrame:
        return latest_loads(self.history())

    def loaded_rows(self, table: str, file: str) -> int | None:
        """Rows of the last load if it came from this file, otherwise None."""
        last = latest_loads(self.history().where(F.col("table_name") == table))
        row = last.where(F.col("file_name") == file).head()
        return row["row_count"] if row else None

    def record(self, table: str, file: str, rows: int) -> None:
        one = self.store.spark.createDataFrame(
            [(table, file, rows)], "table_name string, file_name string, row_count bigint"
        )
        self.store.append(REGISTRY, one.withColumn("loaded_at", F.current_timestamp()))

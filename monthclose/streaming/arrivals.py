"""Load extracts as they arrive in a folder.

The checkpoint of the stream does what the load registry does for a run by hand: a file is loaded once. One
file is one micro-batch, and a file is one *arrival*: its rows replace what the same file brought before
and are added to what other files of the month brought. So a batch that is repeated after a failure leaves the same
rows, and no file of a month pushes out another.

What arrived is kept in a ledger: file, batch, rows and time. A batch that is repeated is noted again; the latest note counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from monthclose.operators.store import ARRIVALS, MonthStore


def arrivals(store: MonthStore, table: str) -> DataFrame:
    """One row per file that was loaded into a table: (file_name, batch_id, row_count, loaded_at) of its latest arrival."""
    newest = F.max(F.struct("loaded_at", "batch_id", "row_count")).alias("last")
    noted = store.table(ARRIVALS).where(F.col("table_name") == table).groupBy("file_name").agg(newest)
    return noted.select("file_name", "last.batch_id", "last.row_count", "last.loaded_at")


class MalformedArrival(RuntimeError):
    """A file with malformed lines: nothing of it is stored, and it stays to be read again."""


def load_arrivals(
    store: MonthStore,
    table: str,
    folder: str,
    pattern: str,
    parse: Callable[[DataFrame], DataFrame],
    month_col: str,
    checkpoint: str,
    nested: bool = False,
) -> StreamingQuery:
    """Load the files that are there and not loaded yet, then stop.

    ``parse`` turns lines (``value``, ``file``) into rows. Rows of every month are stored, and rows without one.
    A batch with rows that ``parse`` marks as malformed (column BAD) fails the query, so its file is read
    again by the next run. With ``nested`` files in folders below count too; a file is known by its name, wherever it lies.
    """
    lines = (
        store.spark.readStream.option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", nested)
        .text(folder)
        .select("value", F.col("_metadata.file_name").alias("file"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        first = batch.select("file").head()
        if first is None:
            return  # a file without lines
        name = hashlib.sha256(first["file"].encode()).hexdigest()[:16]
        counted = store.add_load(table, parse(batch), month_col, f"arrival{name}")
        if counted.get("bad"):
            raise MalformedArrival(f"{table}: {counted['bad']} malformed lines in {first['file']}")
        note = store.spark.createDataFrame(
            [(table, first["file"], batch_id, counted["rows"])],
            "table_name string, file_name string, batch_id bigint, row_count bigint")
        store.append(ARRIVALS, note.withColumn("loaded_at", F.current_timestamp()))

    return (
        lines.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

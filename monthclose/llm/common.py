"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.sources.files import work_dir

#: Rows and bytes of one Arrow batch: whole texts stay whole, a worker holds few of them at a time.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
#: A key that more than one of so many rows has is hot; there are fewer hot keys than this.
HOT_ONE_IN = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once. The settings stay: the frame is run after its operator has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends, a lost executor loses nothing."""
    path = f"{work_dir(df.sparkSession, label)}/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` with the one row of ``table`` for their keys, without its ``weight``: how many rows have these keys.

    Hot keys are few and are broadcast, so that their rows stay in their tasks; only rows of the other keys are shuffled. Rows
    without a partner, or with a NULL key, are left out. Both sides are read more than once: store what is costly.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT_ONE_IN > total
    hot, others = F.broadcast(table.where(is_hot).drop(weight)), table.where(~is_hot).drop(weight)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(others, keys))


def without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not among the one column of ``ids``. That column gets a name that ``docs`` does not have."""
    name = "_" + max((c for c in [*docs.columns, "id"]), key=len) + "_"
    gone = ids.select(F.col(ids.columns[0]).alias(name))
    return docs.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col(f"`{name}`")), "left_anti")


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")

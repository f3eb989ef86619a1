"""Checks: counts that must be zero, displayed totals, reconciliations and row counts.

Each check exists as a DataFrame operator, and as a method of ``Checks`` that runs it on a store and
notes the outcome.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose.functions.months import fill_params
from monthclose.operators.compare import largest_first, reconcile
from monthclose.operators.store import MonthStore
from monthclose.sources.files import Folders

log = logging.getLogger("monthclose")

OK, NG, SKIP = "OK", "NG", "SKIP"
BOM = "\ufeff"
SHOWN_DIFFS = 20


def check_value(df: DataFrame, label: str, expect: str | int = "zero") -> DataFrame:
    """Compare the first value of the first row (0 if there is none) with what is expected.

    ``zero``, ``nonzero`` (at least one) or an exact number.
    """
    first = df.select(F.col(f"`{df.columns[0]}`").alias("v")).limit(1)
    one = first.agg(F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    value = F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col("v"))
    if expect == "zero":
        ok = F.col("value") == 0
    elif expect == "nonzero":
        ok = F.col("value") > 0
    else:
        ok = F.col("value") == expect
    return one.select(value.alias("value")).select(
        F.lit(label).alias("label"),
        F.lit(str(expect)).alias("expect"),
        "value",
        F.when(ok, OK).otherwise(NG).alias("status"),
    )


class TableCheck(NamedTuple):
    """An aggregate over a table's rows, or over those for which ``where`` holds, and what is expected of it.

    ``zero``, ``nonzero``, an exact number, or None if it is only shown.
    """

    label: str
    where: str | None = None
    value: str = "count(*)"
    expect: str | int | None = "zero"

    @property
    def expected(self) -> str:
        return "shown" if self.expect is None else str(self.expect)


def table_checks(df: DataFrame, checks: Sequence[TableCheck]) -> DataFrame:
    """All checks of a table as (label, expect, value, status), in one scan: each is a filtered aggregate.

    The value is text; an aggregate over no rows is NULL, which is neither zero nor what was expected.
    """
    if not checks:
        return df.sparkSession.createDataFrame([], "label string, expect string, value string, status string")
    one = df.agg(*(
        F.expr(f"{c.value}{f' FILTER (WHERE {c.where})' if c.where else ''}").alias(f"c{i}") for i, c in enumerate(checks)))
    rows = []
    for i, c in enumerate(checks):
        value = F.col(f"c{i}")
        ok = {"zero": value == 0, "nonzero": value > 0, None: F.lit(True)}.get(c.expect, value == F.lit(c.expect))
        rows += [F.lit(c.label), F.lit(c.expected), value.cast("string"), F.when(ok, OK).otherwise(NG)]
    return one.select(F.stack(F.lit(len(checks)), *rows).alias("label", "expect", "value", "status"))


def show_sums(df: DataFrame, label: str) -> DataFrame:
    """The first row turned into (label, name, value) rows; NULL is shown as ``NULL``."""
    pairs = []
    for name in df.columns:
        pairs += [F.lit(name), F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("NULL"))]
    return df.limit(1).select(
        F.lit(label).alias("label"), F.stack(F.lit(len(df.columns)), *pairs).alias("name", "value")
    )


def grouped_counts(df: DataFrame, keys: Sequence[str] = (), total: str = "total") -> DataFrame:
    """Rows per key as ``(key, cnt)``, and a line with the total, which adds up the groups."""
    if not keys:
        return df.select().groupBy().count().select(
            F.lit(total).alias("key"), F.col("count").alias("cnt")
        )
    key = F.concat_ws(" | ", *[F.coalesce(F.col(k).cast("string"), F.lit("None")) for k in keys])
    groups = df.groupBy(*keys).count().select(key.alias("key"), F.col("count").alias("cnt"))
    return groups.unionAll(
        groups.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("cnt")).select(F.lit(total), "cnt")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def diff_totals(diffs: DataFrame) -> DataFrame:
    """How many differences there are and what they add up to."""
    return diffs.agg(
        F.count(F.lit(1)).alias("diffs"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("val_a", "val_b", "diff")],
    )


def write_csv_with_bom(df: DataFrame, path: str) -> None:
    """CSV parts that spreadsheet programs recognise as UTF-8: each part starts with the mark."""
    first, *rest = df.columns
    marked = df.select(F.col(f"`{first}`").alias(BOM + first), *[f"`{c}`" for c in rest])
    marked.write.mode("overwrite").option("header", True).csv(path)


def diff_name(label: str) -> str:
    return "diff_" + label.replace(" ", "_").replace("/", "_")


#: What a comparison writes: the rows, and a CSV of them.
ROWS, CSV = "_rows", ".csv"


class Checks:
    """Runs checks on one store and keeps (label, expect, value, status)."""

    def __init__(self, store: MonthStore, out: str, params: Mapping[str, object] = {}):
        self.store, self.out, self.params = store, out.rstrip("/"), dict(params)
        self.results: list[tuple[str, str, str, str]] = []
        self._folders = Folders(endings=("", ROWS, CSV))

    def summary(self) -> DataFrame:
        return self.store.spark.createDataFrame(
            self.results, "label string, expect string, value string, status string"
        )

    def require(self, *tables: str) -> bool:
        """Whether all tables exist; each missing one is noted."""
        missing = self.store.missing(*tables)
        for table in missing:
            self._note(table, "exists", "no table", SKIP)
        return not missing

    def check(self, label: str, query: str | DataFrame, expect: str | int = "zero") -> bool:
        df = self._frame(label, query, str(expect))
        if df is None:
            return False
        row = check_value(df, label, expect).head()
        return self._note(label, str(expect), row["value"], row["status"])

    def check_table(self, table: str, checks: Sequence[TableCheck]) -> bool:
        """All checks of one table in one scan; whether all are as expected. A check of a column that does not exist is left out."""
        table = fill_params(table, self.params)
        if not self.store.exists(table):
            for c in checks:
                self._note(c.label, c.expected, "no table", SKIP)
            return False
        filled = [c._replace(value=fill_params(c.value, self.params), where=c.where and fill_params(c.where, self.params))
                  for c in checks]
        df, possible = self.store.table(table), []
        for c in filled:
            try:
                table_checks(df, [c])  # only analysed
                possible.append(c)
            except AnalysisException as error:
                if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                    raise
                self._note(c.label, c.expected, "no column", SKIP)
        found = [self._note(r["label"], r["expect"], r["value"], r["status"]) for r in table_checks(df, possible).collect()]
        return all(found) and len(possible) == len(checks)

    def check_sum(self, label: str, query: str | DataFrame) -> dict[str, str]:
        df = self._frame(label, query, "shown")
        if df is None:
            return {}
        shown = {row["name"]: row["value"] for row in show_sums(df, label).collect()}
        self._note(label, "shown", shown, OK if shown else SKIP)
        return shown

    def check_diff(
        self,
        label: str,
        query_a: str | DataFrame,
        query_b: str | DataFrame,
        keys: Sequence[str],
        value: str,
        threshold: float = 1,
    ) -> bool:
        """Reconcile two results. Differences are written out whole; the largest are logged.

        Labels that stand for the same folder, and a label that is used again, get a folder of their own.

        A missing table is no difference.
        """
        a, b = self._frame(label, query_a, "same"), self._frame(label, query_b, "same")
        if a is None or b is None:
            return True
        path = f"{self.out}/{self._folders.name_of(diff_name(label))}"
        diffs = reconcile(a, b, keys, value, threshold)
        # Written once and read back: the totals, the largest rows and the CSV share one computation.
        diffs.write.mode("overwrite").parquet(path + ROWS)
        diffs = self.store.spark.read.parquet(path + ROWS)
        totals = diff_totals(diffs).head()
        same = totals["diffs"] == 0
        self._note(label, "same", totals["diffs"], OK if same else NG)
        if not same:
            for row in largest_first(diffs, keys).limit(SHOWN_DIFFS).collect():
                log.info("    %s", row.asDict())
            log.info("    total %s", totals.asDict())
            write_csv_with_bom(largest_first(diffs, keys), path + ".csv")
        return same

    def row_count(
        self, table: str, group_by: str | Sequence[str] | None = None, where: str | None = None
    ) -> int:
        table = fill_params(table, self.params)
        if not self.store.exists(table):
            self._note(table, "rows", "no table", SKIP)
            return 0
        df = self.store.table(table)
        if where:
            df = df.where(fill_params(where, self.params))
        if not group_by:
            count = df.count()
            self._note(table, "rows", count, OK)
            return count
        keys = [k.strip() for k in group_by.split(",")] if isinstance(group_by, str) else group_by
        counts = grouped_counts(df, keys)
        total = counts.where("key = 'total'").agg(F.max("cnt")).head()[0]
        for row in counts.orderBy("key").toLocalIterator():  # every group, a partition at a time
            log.info("    %s %s %s", table, row["key"], row["cnt"])
        self._note(table, "rows", total, OK)
        return total

    def _frame(self, label: str, query: str | DataFrame, expect: str) -> DataFrame | None:
        """The result to check, or None (noted) if a table or column does not exist."""
        if isinstance(query, DataFrame):
            return query
        try:
            return self.store.query(query, self.params)
        except AnalysisException as error:
            condition = error.getCondition() or ""
            if condition == "TABLE_OR_VIEW_NOT_FOUND":
                self._note(label, expect, "no table", SKIP)
                return None
            if condition.startswith("UNRESOLVED_COLUMN"):
                self._note(label, expect, "no column", SKIP)
                return None
            raise

    def _note(self, label: str, expect: str, value: object, status: str) -> bool:
        self.results.append((label, expect, str(value), status))
        log.log(
            logging.INFO if status == OK else logging.WARNING, "[%s] %s %s", status, label, value
        )
        return status == OK

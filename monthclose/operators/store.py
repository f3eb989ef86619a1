"""Month stores: one catalog database per closing month.

A table that is loaded month by month lies in ``<name>__months``, partitioned by the month of its
month column and by load; a view ``<name>`` shows its declared columns. A month is replaced by
appending the new rows as a new load and then dropping the older loads of that month, so the data
is written once and nothing is rewritten. The switch is one step: an empty file beside the table names the load that
is being written, which the view leaves out; renaming that file commits it, and from then on the view
leaves out the older loads of the month instead. What a job that died left behind is never shown, and the next
load of the table drops it.

A load that has a name of its own (an arrival) takes the place of what came under that name before by the same step.

A table that is replaced as a whole, or built by a query, is written as a new version; then a pointer file is
renamed into place, and from then on the new version is the table (``pointer.py``). The old version is deleted last, so the query may
read the table it replaces, and a job that dies leaves one of the two. Rows are appended as a new part of the version, by
the same step.

Tables outlive the process: a store registers what lies under its root and its catalog does not know.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthclose.functions.casts import month_text
from monthclose.functions.months import fill_params
from monthclose.operators import pointer as pointers
from monthclose.operators.pointer import Pointer
from monthclose.sources import files
from monthclose.sources.delimited import BAD
from monthclose.sources.encoding import GARBLED, session_settings
from monthclose.sources.jdbc import read_text

MONTHS, VERSION = "__months", "__v"
YM, LOAD, PART = "_ym", "_load", "_part"
PENDING, DONE, NAMED, MERGED = "pending", "done", "named", "merged"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
REGISTRY, ARRIVALS = "load_registry", "arrival_registry"

_CREATE = re.compile(
    r"^\s*create\s+(?P<replace>or\s+replace\s+)?table\s+(?P<keep>if\s+not\s+exists\s+)?"
    r"`?(?P<name>\w+)`?\s+as\s+(?P<query>.*?);?\s*$",
    re.IGNORECASE | re.DOTALL,
)
_HIDDEN = re.compile(rf"{MONTHS}$|{VERSION}[0-9a-f]{{12}}$")
_DROP = re.compile(r"^\s*drop\s+table\s+if\s+exists\s+`?(?P<name>\w+)`?\s*;?\s*$", re.IGNORECASE)

# Settings for the time of a write. A load touches few months, and that many open files per task spare a
# sort of all rows. The JVM leaves larger methods uncompiled, so a wide projection is better off split up.
_WRITE_SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def _new_id() -> str:
    return uuid.uuid4().hex[:12]


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _text(value: str) -> str:
    """A text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _unfit(counted: Mapping[str, int]) -> bool:
    """Whether a write met lines that must not be stored as they were read."""
    return bool(counted.get("bad") or counted.get("garbled"))


class MonthStore:
    """The tables of one month."""

    def __init__(self, spark: SparkSession, root: str, month: str, name: str = "close"):
        self.spark, self.root, self.month, self.name = spark, root.rstrip("/"), month, name
        self.db = self.database_of(month)
        self.aliases: dict[str, str] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.db}` LOCATION '{self.root}/{month}'")
        self._take_over()

    def _take_over(self) -> None:
        """Register the tables that lie under the root but that this session's catalog does not know.

        With a catalog that ends with the process these are the tables of earlier processes.
        """
        for table in files.list_names(self.spark, f"{self.root}/{self.month}/_state"):
            if self.pointer(table) and not table.endswith(MONTHS):
                self._show_version(table)
        known = files.list_names(self.spark, f"{self.root}/{self.month}/_schema")
        for name in sorted({*files.list_names(self.spark, f"{self.root}/{self.month}"), *known}):
            months = name.endswith(MONTHS)
            if self.exists(name) or (_HIDDEN.search(name) and not months) or months and self.pointer(name[: -len(MONTHS)]):
                continue
            path = f"{self.root}/{self.month}/{name}"
            schema = self._stored_schema(name, path)
            if schema is None:
                continue  # a folder without any file: nothing was ever stored there
            parts = f"PARTITIONED BY ({YM}, {LOAD})" if months else ""
            self.spark.sql(f"CREATE TABLE {self._id(name)} ({_columns(schema)}) USING parquet {parts} LOCATION '{path}'")
            if parts:
                self.spark.sql(f"ALTER TABLE {self._id(name)} RECOVER PARTITIONS")
                self._show_months(name[: -len(MONTHS)])

    def _stored_schema(self, name: str, path: str) -> StructType | None:
        """The columns of a table by what is kept beside it, or by its files."""
        kept = f"{self.root}/{self.month}/_schema/{name}"
        if files.exists(self.spark, kept):
            return StructType.fromJson(json.loads(files.read_small(self.spark, kept)))
        try:
            with session_settings(self.spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
                return self.spark.read.parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return None

    def database_of(self, month: str) -> str:
        return f"{self.name}_{month}".lower()

    # -- names ---------------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"`{self.db}`.`{table}`")

    def missing(self, *tables: str) -> list[str]:
        """Those of the tables that do not exist."""
        return [t for t in tables if not self.exists(t)]

    def tables(self) -> list[str]:
        """Names of all tables, in order."""
        names = {t.name for t in self.spark.catalog.listTables(self.db) if not t.isTemporary}
        return sorted(n for n in names if not _HIDDEN.search(n) and n not in (REGISTRY, ARRIVALS))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self._id(table))

    def month_rows(self, table: str, month: str) -> DataFrame:
        """The rows of one month that count, with partition pruning."""
        return self.months_rows(table, month, month)

    def months_rows(self, table: str, first: str, last: str) -> DataFrame:
        """The rows of some months that count; only the folders of these months are listed and read."""
        rows = self.spark.table(self._id(table + MONTHS)).where(F.col(YM).between(first, last))
        for condition in self._conditions(table + MONTHS):
            rows = rows.where(condition)
        return rows.drop(YM, LOAD)

    def _id(self, table: str) -> str:
        return f"`{self.db}`.`{table}`"

    def loads(self, table: str) -> list[tuple[str | None, str]]:
        """(month, load) of all that counts in a month table: names only."""
        self._clean_up(table)
        return self._partitions(table + MONTHS)

    def load_rows(self, table: str) -> DataFrame:
        """All rows of a month table, with the columns of their month and load."""
        return self.spark.table(self._id(table + MONTHS))

    def month_schema(self, table: str) -> StructType:
        """The declared columns of a month table."""
        return StructType([f for f in self.load_rows(table).schema if f.name not in (YM, LOAD)])

    # -- writing -------------------------------------------------------------------------------

    def load_month(
        self,
        table: str,
        df: DataFrame,
        month_col: str,
        month: str | None = None,
        many_months: bool = False,
    ) -> dict[str, int]:
        """Replace a month: drop its old rows and add all rows of ``df``, other months included.

        Rows of other months are added to what is there, and a month with no new rows is emptied.
        Columns are matched by position. Returns what was counted during the write.

        An extract of one month is written by the tasks that read it, without an exchange. With
        ``many_months`` rows are first brought together by month, so that not every task writes a file
        for every month; the rebalancing splits a month that is too large for one task.

        If rows are flagged as malformed or garbled (columns BAD, GARBLED), the new load is taken back and
        nothing is replaced.
        """
        month = month or self.month
        load = _new_id()
        tagged = self._tagged(table, df, month_col, load, many_months)
        return self._add(table, tagged, load, month)

    def add_load(self, table: str, df: DataFrame, month_col: str, load: str) -> dict[str, int]:
        """Add the rows of a named load, in place of what a load of that name stored before.

        Other loads stay, whatever their months. With malformed rows the load is taken back, as above, and what came before stays.
        """
        load = f"{_new_id()}.{quote(load, safe='')}"
        return self._add(table, self._tagged(table, df, month_col, load, many_months=False), load)

    def _add(self, table: str, tagged: DataFrame, load: str, month: str | None = None) -> dict[str, int]:
        """Write a load and commit it, in place of the other loads of ``month``, or else of those of its own name."""
        physical = table + MONTHS
        mark = f"{self._state(physical)}/{PENDING}={load}"
        files.touch(self.spark, mark)
        self._show_months(table)
        counted = self._write(tagged, lambda out: out.write.insertInto(self._id(physical)))
        if not _unfit(counted):
            done = f"{NAMED}={load}" if month is None else f"{DONE}={load}={quote(month, safe='')}"
            files.rename(self.spark, mark, f"{self._state(physical)}/{done}")
            self._leave_versions(table)
            self._show_months(table)
        self._clean_up(table)
        return counted

    def _state(self, physical: str) -> str:
        return f"{self.root}/{self.month}/_state/{physical.lower()}"

    def _clean_up(self, table: str) -> None:
        """Drop what the view leaves out: a load that was not committed, or the loads one has replaced."""
        physical = table + MONTHS
        names = files.list_names(self.spark, self._state(physical))
        for kind, load, *month in (name.split("=") for name in names):
            if kind == PENDING:
                unwanted = self._partitions(physical, LOAD, load)
            elif kind == MERGED:
                months = self._merged_months(physical, load)
                unwanted = [p for p in self._partitions(physical) if p[0] in months and "." not in p[1] and p[1] != load]
            elif kind == NAMED:
                name = load.split(".", 1)[1]
                unwanted = [p for p in self._partitions(physical) if p[1] != load and p[1].split(".", 1)[-1] == name]
            else:
                unwanted = [p for p in self._partitions(physical, YM, unquote(month[0])) if p[1] != load]
            self._drop_partitions(physical, unwanted)
        if names:
            files.delete(self.spark, self._state(physical))
            self._show_months(table)

    def _tagged(self, table, df, month_col, load, many_months) -> DataFrame:
        """Rows with their month and load; the table is made if it is not there."""
        ym = F.substring(month_text(F.col(f"`{month_col}`"), dict(df.dtypes)[month_col]), 1, 6)
        tagged = df.select("*", ym.alias(YM), F.lit(load).alias(LOAD))
        if many_months:
            tagged = tagged.hint("rebalance", YM)
        if self.exists(table + MONTHS) and not self.pointer(table):
            self._clean_up(table)
        else:  # a table of the other kind stays until the first load counts
            self._drop_months(table)
            self._create_months(table, tagged)
        return tagged

    def _create_months(self, table: str, tagged: DataFrame) -> None:
        physical = table + MONTHS
        schema = StructType([f for f in tagged.schema if f.name not in (BAD, GARBLED)])
        files.write_small(self.spark, f"{self.root}/{self.month}/_schema/{physical.lower()}", schema.json())
        self.spark.sql(
            f"CREATE TABLE {self._id(physical)} ({_columns(schema)}) USING parquet "
            f"PARTITIONED BY ({YM}, {LOAD})"
        )
        self._show_months(table)

    def _show_months(self, table: str) -> None:
        """Make the view: the declared columns of all rows but those of loads that do not count."""
        if self.pointer(table):
            return  # not yet, or no longer
        physical = table + MONTHS
        self._drop_plain(table)
        shown = ", ".join(f"`{c}`" for c in self.spark.table(self._id(physical)).columns[:-2])
        conditions = self._conditions(physical)
        where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self._id(table)} AS SELECT {shown} FROM {self._id(physical)}{where}"
        )

    def _conditions(self, physical: str) -> list[str]:
        """What rows must meet to count, while a load is being written or what it replaced is still there."""
        conditions = []
        for name in files.list_names(self.spark, self._state(physical)):
            kind, load, *month = name.split("=")
            other = f"{LOAD} <> '{load}'"
            if kind == NAMED:
                other = f"NOT (substr({LOAD}, 14) = '{load[13:]}' AND {other})"
            elif kind == MERGED:
                months = ", ".join(_text(m) for m in self._merged_months(physical, load))
                other = f"NOT (array_contains(array({months}), coalesce({YM}, '')) AND instr({LOAD}, '.') = 0 AND {other})"
            elif kind == DONE:
                other = f"NOT ({YM} <=> {_text(unquote(month[0]))} AND {other})"
            conditions.append(other)
        return conditions

    def merge_loads(self, table: str, least: int = 2) -> int:
        """Write the loads of each month that has ``least`` or more as one, in place of them; returns how many there were.

        Loads with a name of their own stay, as they can be replaced. The new load counts, and the old ones no longer do, from the
        renaming of one file on. Rows are shared out evenly: a large month is several tasks, a small one a single file.
        """
        physical = table + MONTHS
        self._clean_up(table)
        loads: dict[str, list[str]] = {}
        for month, load in self._partitions(physical):
            if month is not None and "." not in load:
                loads.setdefault(month, []).append(load)
        months = sorted(m for m, found in loads.items() if len(found) >= least)
        if not months:
            return 0
        load = _new_id()
        mark = f"{self._state(physical)}/{PENDING}={load}"
        files.write_small(self.spark, mark, json.dumps(months))
        self._show_months(table)
        old = self.spark.table(self._id(physical)).where(F.col(YM).isin(months) & (F.instr(LOAD, ".") == 0))
        columns = [F.col(f"`{c}`") for c in old.columns if c not in (YM, LOAD)]
        merged = old.where(F.col(LOAD) != load).select(*columns, YM, F.lit(load).alias(LOAD)).hint("rebalance", YM)
        self._write(merged, lambda out: out.write.insertInto(self._id(physical)))
        files.rename(self.spark, mark, f"{self._state(physical)}/{MERGED}={load}")
        self._show_months(table)
        self._clean_up(table)
        return sum(len(loads[m]) for m in months)

    def _merged_months(self, physical: str, load: str) -> list[str]:
        return json.loads(files.read_small(self.spark, f"{self._state(physical)}/{MERGED}={load}"))

    def _partitions(self, physical: str, column: str = "", value: str = "") -> list[tuple[str | None, str]]:
        """Month and load of the partitions, or of those that have a value (names only, a few per month)."""
        which = f"PARTITION ({column}='{value}')" if column else ""
        listed = self.spark.sql(f"SHOW PARTITIONS {self._id(physical)} {which}").collect()
        out = []
        for row in listed:
            month, load = (unquote(part.split("=", 1)[1]) for part in row[0].split("/"))
            out.append((None if month == NO_MONTH else month, load))
        return out

    def _drop_partitions(self, physical: str, partitions: list[tuple[str | None, str]]) -> None:
        for month, load in partitions:
            value = "null" if month is None else "'" + month.replace("'", "\\'") + "'"
            self.spark.sql(
                f"ALTER TABLE {self._id(physical)} DROP IF EXISTS PARTITION "
                f"({YM}={value}, {LOAD}='{load}')"
            )
            # The files of a table that was taken over are not the catalog's to delete.
            folder = f"{YM}={NO_MONTH if month is None else quote(month, safe='')}/{LOAD}={load}"
            files.delete(self.spark, f"{self.root}/{self.month}/{physical.lower()}/{folder}")

    def _pointers(self, table: str) -> str:
        return f"{self.root}/{self.month}/_state/{table.lower()}"

    def pointer(self, table: str) -> Pointer | None:
        """Which version of a table counts; None for one that is loaded by months."""
        return pointers.current(self.spark, self._pointers(table))

    def version(self, table: str, version: str) -> tuple[str, str]:
        """Catalog name and folder of a version."""
        name = f"{table.lower()}{VERSION}{version}"
        return name, f"{self.root}/{self.month}/{name}"

    def replace(self, table: str, df: DataFrame) -> dict[str, int]:
        """Replace a whole table, or create it. With malformed rows (see above) nothing is replaced."""
        version, part = _new_id(), _new_id()
        folder = self.version(table, version)[1]
        counted = self._write(df, lambda out: out.write.parquet(f"{folder}/{PART}={part}"))
        if _unfit(counted):
            files.delete(self.spark, folder)
            return counted
        schema = StructType([f for f in df.schema if f.name not in (BAD, GARBLED)])
        self.point(table, Pointer(version, (part,), schema))
        return counted

    def append(self, table: str, df: DataFrame) -> dict[str, int]:
        """Add rows by position, creating the table if it is not there. With malformed rows nothing is added."""
        now = self.pointer(table)
        if now is None:
            if self.exists(table + MONTHS):
                raise ValueError(f"{table} is loaded by months")
            if self.exists(table):  # laid down without a pointer
                return self.replace(table, self.table(table).union(df))
            return self.replace(table, df)
        names = [c for c in df.columns if c not in (BAD, GARBLED)]
        if len(names) != len(now.schema):
            raise ValueError(f"{table} has {len(now.schema)} columns, not {len(names)}")
        fitted = [F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(names, now.schema, strict=True)]
        out = df.select(*fitted, *(c for c in (BAD, GARBLED) if c in df.columns))
        part, folder = _new_id(), self.version(table, now.version)[1]
        counted = self._write(out, lambda rows: rows.write.parquet(f"{folder}/{PART}={part}"))
        if _unfit(counted):
            files.delete(self.spark, f"{folder}/{PART}={part}")
        else:
            self.point(table, now._replace(parts=(*now.parts, part)))
        return counted

    def point(self, table: str, new: Pointer) -> None:
        """From here on ``new`` is the table; what was written for it must be complete."""
        pointers.commit(self.spark, self._pointers(table), new)
        self._show_version(table)
        self._sweep(table)

    def _show_version(self, table: str) -> None:
        """Make the view of the version that counts."""
        now = self.pointer(table)
        name, folder = self.version(table, now.version)
        if not self.exists(name):
            self.spark.sql(f"CREATE TABLE {self._id(name)} ({_columns(now.schema)}, {PART} string) USING parquet "
                           f"PARTITIONED BY ({PART}) LOCATION '{folder}'")
        self._drop_plain(table)
        known = {row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {self._id(name)}").collect()}
        missing, gone = sorted(set(now.parts) - known), sorted(known - set(now.parts))

        def show(but: list[str]) -> None:
            shown = ", ".join(f"`{f.name}`" for f in now.schema)
            where = f" WHERE {PART} NOT IN ({', '.join(map(_text, but))})" if but else ""
            self.spark.sql(f"CREATE OR REPLACE VIEW {self._id(table)} AS SELECT {shown} FROM {self._id(name)}{where}")

        def alter(action: str, parts: list[str], between: str) -> None:
            if parts:
                listed = between.join(f"PARTITION ({PART}='{part}')" for part in parts)
                self.spark.sql(f"ALTER TABLE {self._id(name)} {action} {listed}")

        if gone and missing:  # all come and go by one view
            show(missing)
        alter("ADD IF NOT EXISTS", missing, " ")
        if gone:
            show(gone)
            alter("DROP IF EXISTS", gone, ", ")
        show([])

    def _sweep(self, table: str) -> None:
        """Delete what does not count any more: older pointers, other versions, parts that were not committed, month loads."""
        now = self.pointer(table)
        pointers.forget_older(self.spark, self._pointers(table))
        self._drop_versions(table, but=now.version)
        folder = self.version(table, now.version)[1]
        for name in files.list_names(self.spark, folder, hidden=True):
            if name.startswith(f"{PART}=") and name.split("=", 1)[1] not in now.parts:
                files.delete(self.spark, f"{folder}/{name}")
        self._drop_months(table)

    def _drop_versions(self, table: str, but: str = "") -> None:
        found = {t.name for t in self.spark.catalog.listTables(self.db)} | {
            *files.list_names(self.spark, f"{self.root}/{self.month}")}
        for name in sorted(found):
            if name[:-12] == f"{table.lower()}{VERSION}" and _HIDDEN.search(name) and name[-12:] != but:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._id(name)}")
                files.delete(self.spark, f"{self.root}/{self.month}/{name}")

    def _leave_versions(self, table: str) -> None:
        """From here on the month loads are the table."""
        if self.pointer(table):
            pointers.forget_older(self.spark, self._pointers(table))
            files.delete(self.spark, self._pointers(table))
            self._show_months(table)
        self._drop_versions(table)

    def _drop_plain(self, table: str) -> None:
        """Drop a table that was laid down without a pointer, so that a view can take its name."""
        if self.exists(table) and self.spark.catalog.getTable(self._id(table)).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {self._id(table)}")
            files.delete(self.spark, f"{self.root}/{self.month}/{table.lower()}")

    def _drop_months(self, table: str) -> None:
        physical = table + MONTHS
        self.spark.sql(f"DROP TABLE IF EXISTS {self._id(physical)}")
        for path in (f"{self.root}/{self.month}/{physical.lower()}", self._state(physical),
                     f"{self.root}/{self.month}/_schema/{physical.lower()}"):
            files.delete(self.spark, path)

    def drop(self, table: str) -> None:
        """Drop a table of either kind, if it is there."""
        files.delete(self.spark, self._pointers(table))
        self._drop_plain(table)
        self.spark.sql(f"DROP VIEW IF EXISTS {self._id(table)}")
        self._drop_months(table)
        self._drop_versions(table)

    def _write(self, df: DataFrame, write) -> dict[str, int]:
        """Run a write, counting rows (and flagged rows) on the way instead of in a second pass."""
        counted = Observation()
        counts = [F.count(F.lit(1)).alias("rows")]
        for name, flag in (("bad", BAD), ("garbled", GARBLED)):
            if flag in df.columns:
                counts.append(F.count_if(flag).alias(name))
        out = df.observe(counted, *counts).drop(BAD, GARBLED)
        with session_settings(self.spark, _WRITE_SETTINGS):
            write(out)
        return counted.get

    # -- queries -------------------------------------------------------------------------------

    def attach(self, aliases: Mapping[str, str]) -> list[str]:
        """Let queries read earlier months as ``ALIAS.table``. Absent months are left out."""
        for alias, month in aliases.items():
            db = self.database_of(month)
            if not self.spark.catalog.databaseExists(db) and files.list_names(self.spark, f"{self.root}/{month}"):
                MonthStore(self.spark, self.root, month, self.name)
            if self.spark.catalog.databaseExists(db):
                self.aliases[alias] = db
        return sorted(self.aliases)

    def detach(self) -> None:
        self.aliases.clear()

    def query(self, text: str, params: Mapping[str, object] = {}) -> DataFrame:
        """A SELECT over this month's tables and the attached ones."""
        with self._as_current():
            return self.spark.sql(self._filled(text, params))

    def sql(self, text: str, params: Mapping[str, object] = {}) -> int | None:
        """Run a statement. Building a table returns its row count."""
        text = self._filled(text, params)
        create, drop = _CREATE.match(text), _DROP.match(text)
        if drop:
            self.drop(drop["name"])
        elif create:
            name = create["name"]
            if self.exists(name) and not create["replace"]:
                if create["keep"]:
                    return self.table(name).count()
                raise ValueError(f"table {name} already exists")
            return self.replace(name, self.query(create["query"]))["rows"]
        else:
            with self._as_current():
                self.spark.sql(text)
        return None

    def sql_file(self, path: str, params: Mapping[str, object] = {}, **extra: object) -> int | None:
        """Run a statement kept in a file; ``extra`` parameters win."""
        return self.sql(read_text(self.spark, path), {**params, **extra})

    def _filled(self, text: str, params: Mapping[str, object]) -> str:
        text = fill_params(text, params)
        for alias, db in self.aliases.items():
            text = re.sub(rf"\b{re.escape(alias)}\.(?=[`\w])", f"`{db}`.", text)
        return text

    @contextmanager
    def _as_current(self):
        before = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(self.db)
        try:
            yield
        finally:
            self.spark.catalog.setCurrentDatabase(before)

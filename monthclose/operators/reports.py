"""Report sets: one dataset per sheet in a versioned folder, with a summary."""

from __future__ import annotations

import logging
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from monthclose.functions.months import fill_month
from monthclose.operators.store import MonthStore
from monthclose.sources import files
from monthclose.sources.encoding import session_settings

log = logging.getLogger("monthclose")

AUTO_PREFIX = "out_"
SUMMARY = "요약"
TOTAL = "합계"
#: Sheets that are written in one scan: their folder, and the column that tells them apart.
TOGETHER, SHEET = "_together", "_sheet"


def sheet_query(
    table: str, config: str | Mapping, month: str, params: Mapping[str, object]
) -> tuple[str, str]:
    """The query and the name of a sheet.

    A string is a sheet name for the whole table. In a dict, ``sql`` wins over ``columns``, ``where``,
    ``order_by`` and ``limit``; ``sheet`` defaults to the table.
    """
    if isinstance(config, str):
        config = {"sheet": config}
    sheet = fill_month(config.get("sheet", table), month, params)
    if "sql" in config:
        text = config["sql"]
    else:
        clauses = [f"SELECT {', '.join(config.get('columns', ['*']))} FROM {table}"]
        for key, word in (("where", "WHERE"), ("order_by", "ORDER BY"), ("limit", "LIMIT")):
            if key in config:
                clauses.append(f"{word} {config[key]}")
        text = " ".join(clauses)
    return fill_month(text, month, params), sheet


def sheet_set(
    sheets: Mapping[str, object], tables: Sequence[str], month: str, params: Mapping[str, object]
) -> list[tuple[str, object]]:
    """All (table, sheet) pairs: those asked for, then the tables with the automatic prefix."""
    named = {fill_month(t, month, params): config for t, config in sheets.items()}
    asked = {t.lower() for t in named}
    for table in tables:
        if table.startswith(AUTO_PREFIX) and table not in asked:
            named[table] = table[len(AUTO_PREFIX):]
    return [
        (table, one)
        for table, config in named.items()
        for one in (config if isinstance(config, list) else [config])
    ]


def next_version(names: DataFrame, prefix: str) -> DataFrame:
    """The next free name after those in ``names(name)``: one row, ``(prefix, version, next)``.

    Only the highest major number counts; its highest minor number goes up by one. A name without a
    minor number has minor 0, and the first version is ``v0.01``.
    """
    pattern = rf"^\Q{prefix}\E_v(?:.*_v)?(\d+)(?:\.(\d+))?(?:\.xlsx)?$"
    major = F.regexp_extract("name", pattern, 1)
    minor = F.regexp_extract("name", pattern, 2)
    numbers = names.where(major != "").select(
        major.cast("int").alias("major"),
        F.when(minor == "", 0).otherwise(minor.try_cast("int")).alias("minor"),
    )
    top = numbers.agg(F.max(F.struct("major", "minor")).alias("top")).select(
        F.coalesce("top.major", F.lit(0)).alias("major"),
        F.coalesce("top.minor", F.lit(0)).alias("minor"),
    )
    number = (F.col("minor") + 1).cast("string")
    version = F.concat(
        F.lit("v"), F.col("major").cast("string"), F.lit("."),
        F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number),
    )
    return top.select(
        F.lit(prefix).alias("prefix"),
        version.alias("version"),
        F.concat(F.lit(prefix + "_"), version).alias("next"),
    )


def with_total(summary: DataFrame) -> DataFrame:
    """The summary ``(no, table, sheet, rows[, …])`` with a closing total of the rows."""
    rest = [c for c in summary.columns if c not in ("no", "table", "sheet", "rows")]
    types = dict(summary.dtypes)
    closing = summary.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows")).select(
        F.lit(None).cast(types["no"]).alias("no"),
        F.lit(TOTAL).alias("table"),
        F.lit(None).cast("string").alias("sheet"),
        "rows",
        *[F.lit(None).cast(types[c]).alias(c) for c in rest],
    )
    return summary.unionByName(closing)


def export_sheets(
    store: MonthStore,
    job: str,
    sheets: Mapping[str, object],
    out: str,
    params: Mapping[str, object] = {},
    format: str = "parquet",
) -> tuple[str, DataFrame]:
    """Write all sheets of a job and their summary into the next version folder.

    Sheets that show the same columns of one table are written in one scan: each row is tagged with the sheets that it belongs
    to. A sheet without rows is left out, and one whose query fails is skipped. Sheets of one name, and one that is called like the
    summary, get folders of their own. Rows are counted while they are
    written.
    """
    spark = store.spark
    out = out.rstrip("/")
    prefix = f"{job}_{store.month}"
    names = spark.createDataFrame([(n,) for n in files.list_names(spark, out)], "name string")
    target = f"{out}/{next_version(names, prefix).head()['next']}"
    written, folders = [], files.Folders(SUMMARY, TOGETHER)
    wanted = [
        (table, config, *sheet_query(table, config, store.month, params))
        for table, config in sheet_set(sheets, store.tables(), store.month, params)]
    paths = [f"{target}/{folders.name_of(sheet.replace('/', '_'))}" for *_, sheet in wanted]
    done = _write_together(store, wanted, paths, f"{target}/{TOGETHER}", params, format)
    for k, (table, _, query, sheet) in enumerate(wanted):
        started, path = time.monotonic(), paths[k]
        try:
            rows, seconds = done[k] if k in done else (_write_counted(store.query(query, params), path, format), 0)
        except Exception as error:  # One bad sheet must not cost the others.
            log.warning("sheet %s skipped: %s", sheet, error)
            continue
        if rows == 0:
            files.delete(spark, path)
            log.info("sheet %s has no rows", sheet)
            continue
        written.append((table, sheet, rows, round(seconds or time.monotonic() - started, 1)))
    summary = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(written, 1)],
        "no int, `table` string, sheet string, rows bigint, seconds double",
    )
    summary = with_total(summary)
    summary.write.format(format).save(f"{target}/{SUMMARY}")
    return target, summary


def _write_together(
    store: MonthStore, wanted: Sequence[tuple], paths: Sequence[str], folder: str, params: Mapping[str, object], format: str
) -> dict[int, tuple[int, float]]:
    """Rows and seconds of the sheets that could be written with others of their table and columns, by their place in ``wanted``.

    Sheets whose rows are sorted, limited or made by a query of their own are left to be written singly, and so are those whose
    condition is not valid.
    """
    groups: dict[tuple, dict[int, str]] = {}
    for k, (table, config, _, _) in enumerate(wanted):
        config = {} if isinstance(config, str) else config
        if {"sql", "order_by", "limit"} & set(config):
            continue
        tag = f"CASE WHEN {config['where']} THEN {k} END" if "where" in config else f"{k}"
        try:
            store.query(fill_month(f"SELECT {tag} FROM {table}", store.month, params), params)  # only analysed
        except Exception as error:
            log.debug("sheet %s is left to itself: %s", wanted[k][3], error)
            continue
        groups.setdefault((table, tuple(config.get("columns", ["*"]))), {})[k] = tag
    done = {}
    for (table, columns), tags in groups.items():
        if len(tags) < 2:
            continue
        started = time.monotonic()
        query = f"SELECT {', '.join(columns)}, array_compact(array({', '.join(tags.values())})) AS `{SHEET}s` FROM {table}"
        try:
            tagged = store.query(fill_month(query, store.month, params), params)
            rows = tagged.select("*", F.explode(f"{SHEET}s").alias(SHEET)).drop(f"{SHEET}s")
            counted = Observation()
            writer = rows.observe(counted, *(F.count_if(F.col(SHEET) == k).alias(str(k)) for k in tags)).write.format(format)
            if format == "csv":
                writer = writer.option("header", True)
            with session_settings(store.spark, {"spark.sql.maxConcurrentOutputFileWriters": str(len(tags) + 1)}):
                writer.partitionBy(SHEET).save(folder)
            for k in tags:
                if counted.get[str(k)]:
                    files.rename(store.spark, f"{folder}/{SHEET}={k}", paths[k])
        except Exception as error:  # One bad table must not cost the others.
            log.warning("sheets of %s are written singly: %s", table, error)
            for k in tags:
                files.delete(store.spark, paths[k])
        else:
            seconds = (time.monotonic() - started) / len(tags)
            done.update({k: (counted.get[str(k)], seconds) for k in tags})
        files.delete(store.spark, folder)
    return done


def _write_counted(df: DataFrame, path: str, format: str) -> int:
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return counted.get["rows"]

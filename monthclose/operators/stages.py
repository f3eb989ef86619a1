"""Read stages of a delimited file: count, all as text, some columns, some columns with casts."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthclose.sources.delimited import auto_names, parse_strict
from monthclose.sources.lines import first_line, raw_lines

CAST_COLUMNS = 5


def read_stages(
    spark: SparkSession, paths: Sequence[str], delimiter: str = "|", columns: int | None = None
) -> dict[str, DataFrame]:
    """The four plans over the same UTF-8 files. The last two need ``columns``."""
    paths = list(paths)
    width = (first_line(spark, paths[0]) or "").count(delimiter) + 1
    names = auto_names(width)
    lines = raw_lines(spark, paths)

    def read(select=(), numeric=()):
        return parse_strict(lines, names, delimiter, width, numeric=numeric, select=select)

    stages = {"count": read().agg(F.count(F.lit(1)).alias("rows")), "all_text": read()}
    if columns and columns < width:
        some = names[:columns]
        stages["some_columns"] = read(select=some)
        stages["some_columns_cast"] = read(select=some, numeric=some[:CAST_COLUMNS])
    return stages


def measure(stages: dict[str, DataFrame]) -> dict[str, float]:
    """Seconds per stage; results are computed in full and thrown away."""
    seconds = {}
    for name, df in stages.items():
        started = time.monotonic()
        df.write.format("noop").mode("overwrite").save()
        seconds[name] = time.monotonic() - started
    return seconds

"""Table specifications: what an extract looks like and how it is loaded.

A specification is plain data. It can be written as a dict, and the column layout also as JSON.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

FIXED, PIPE, CSV, COLUMNAR, DATABASE = "fwf", "pipe", "csv", "parquet", "oracle"
TYPES = (FIXED, PIPE, CSV, COLUMNAR, DATABASE)


class Field(NamedTuple):
    """A fixed-width field: 0-based start, exclusive end."""

    start: int
    end: int
    name: str


@dataclass(frozen=True)
class TableSpec:
    """One table to load."""

    name: str
    type: str
    file: str | None = None
    month_col: str | None = None
    cols: tuple = ()
    numeric: tuple[str, ...] = ()
    bigint: tuple[str, ...] = ()
    select_cols: tuple[str, ...] = ()
    delimiter: str | None = None
    header: bool = False
    encoding: str | None = None
    native: bool = False
    trim: bool = False
    multi: bool = False
    overwrite: bool = False
    many_months: bool = False
    multiline: bool = False
    desc: str = ""
    database: Mapping[str, object] = field(default_factory=dict)

    @property
    def separator(self) -> str:
        return self.delimiter or ("," if self.type == CSV else "|")


_DATABASE_KEYS = (
    "sql", "sql_file", "dsn", "user", "password", "sid", "service_name", "fetch_size",
    "driver", "url", "partition",
)


def table_spec(name: str, settings: Mapping[str, object]) -> TableSpec:
    """Build a specification from a dict of settings."""
    settings = dict(settings)
    kind = settings.pop("type")
    if kind not in TYPES:
        raise ValueError(f"[{name}] unknown type: {kind}")
    if "month_col" not in settings:
        raise KeyError(f"[{name}] month_col is required (None means full replacement)")
    database = {k: settings.pop(k) for k in _DATABASE_KEYS if k in settings}
    cols = settings.pop("cols", ())
    if kind == FIXED:
        cols = tuple(Field(int(s), int(e), n) for (s, e), n in cols)
    for key in ("numeric", "bigint", "select_cols"):
        settings[key] = tuple(settings.get(key) or ())
    # Reading hints that a scan which decodes on the fly does not need.
    for key in ("preconvert", "fast", "timeout"):
        settings.pop(key, None)
    return TableSpec(name=name, type=kind, cols=tuple(cols), database=database, **settings)


def layout_from_json(text: str) -> tuple:
    """A layout from JSON: ``[[[0, 6], "A"], …]`` for fixed width, a list of names otherwise."""
    items: Sequence = json.loads(text)
    if items and not isinstance(items[0], str):
        return tuple(Field(int(s), int(e), n) for (s, e), n in items)
    return tuple(items)

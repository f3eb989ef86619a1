"""Loading a set of tables for a month."""

from __future__ import annotations

import logging
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from monthclose.functions.months import fill_month
from monthclose.operators.registry import LoadRegistry
from monthclose.operators.store import MonthStore
from monthclose.sources import layouts
from monthclose.sources.layouts import TableSpec, table_spec
from monthclose.sources.scan import Extract, file_label, find_files, scan, scan_paths

log = logging.getLogger("monthclose")


@dataclass
class LoadResult:
    """Tables that are up to date (loaded or skipped), those that failed, and rows per loaded table."""

    loaded: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)


def load_set(
    store: MonthStore,
    tables: Mapping[str, Mapping],
    folder: str,
    params: Mapping[str, object] = {},
    force: bool = False,
    only: Collection[str] = (),
) -> LoadResult:
    """Load the tables; one that fails is noted and the next one goes on."""
    registry, result = LoadRegistry(store), LoadResult()
    named = {fill_month(n, store.month, params): settings for n, settings in tables.items()}
    wanted = {fill_month(n, store.month, params) for n in only}
    if wanted - set(named):
        log.warning("unknown tables left out: %s", sorted(wanted - set(named)))
    for name, settings in named.items():
        if wanted and name not in wanted:
            continue
        try:
            load_table(store, registry, table_spec(name, settings), folder, params, force, result)
        except Exception as error:  # One bad extract must not cost the others.
            log.error("loading %s failed: %s", name, error)
            result.failed.append(name)
    return result


def load_table(
    store: MonthStore,
    registry: LoadRegistry,
    spec: TableSpec,
    folder: str,
    params: Mapping[str, object],
    force: bool,
    result: LoadResult,
) -> None:
    """Load one table, unless the registry has the same file already."""
    if spec.type == layouts.DATABASE:
        extract = scan(store.spark, spec, folder, store.month, params)
    else:
        paths = find_files(store.spark, spec, folder, store.month, params)
        label = file_label(paths, spec)
        if not (force or spec.overwrite):
            known = registry.loaded_rows(spec.name, label)
            if known is not None:
                log.info("%s is loaded already from %s (%s rows)", spec.name, label, known)
                result.loaded.append(spec.name)
                result.skipped.append(spec.name)
                return
        extract = scan_paths(store.spark, spec, paths)
    rows, rejected = _store(store, spec, extract)
    registry.record(spec.name, extract.label, rows)
    result.loaded.append(spec.name)
    result.rows[spec.name] = rows
    if rejected:
        result.rejected[spec.name] = rejected


def _store(store: MonthStore, spec: TableSpec, extract: Extract) -> tuple[int, int]:
    """Write the strict reading; if it met a malformed line, write in its place the reading whose quoted fields span lines, if
    there are such, and the lenient one if that is malformed too.

    Malformed lines, and lines that are not of the expected encoding, are counted during the write, so a clean
    extract is read once. Lines that are no rows even then go to ``<table>__rejected``.
    """
    counted = {"garbled": True}
    if extract.hopeful is not None:
        counted = _write(store, spec, extract.hopeful)
    if counted.get("garbled"):
        counted = _write(store, spec, extract.rows)
    if counted.get("bad") and (spanning := extract.spanning()) is not None:
        counted = _write(store, spec, spanning)
    if not counted.get("bad"):
        store.drop(spec.name + "__rejected")
        return counted["rows"], 0
    log.warning("%s: %s malformed lines, read leniently", spec.name, counted["bad"])
    rows, rejected = extract.lenient()
    rejects = store.replace(spec.name + "__rejected", rejected)["rows"]
    return _write(store, spec, rows)["rows"], rejects


def _write(store: MonthStore, spec: TableSpec, rows) -> dict[str, int]:
    if spec.month_col and not spec.multi:
        return store.load_month(spec.name, rows, spec.month_col, many_months=spec.many_months)
    return store.replace(spec.name, rows)

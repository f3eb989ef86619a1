"""A monthly job: prepare, load, build, check, report."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from monthclose.functions.months import fill_params, month_params
from monthclose.operators.checks import Checks
from monthclose.operators.reports import export_sheets
from monthclose.operators.store import MonthStore
from monthclose.plans.load import LoadResult, load_set

log = logging.getLogger("monthclose")

STAGES = ("prejob", "load", "logic", "validate", "export")


@dataclass(frozen=True)
class Job:
    """What a job does in each stage. ``params`` is a dict, or a function of the month."""

    name: str
    desc: str = ""
    tables: Mapping[str, Mapping] = field(default_factory=dict)
    params: Mapping[str, object] | Callable[[str], Mapping[str, object]] | None = None
    prejob: Callable[[str], None] | None = None
    logic: Callable[[MonthStore, dict], None] | None = None
    validate: Callable[[Checks, dict], None] | None = None
    sheets: Mapping[str, object] = field(default_factory=dict)

    def all_params(self, month: str) -> dict[str, object]:
        own = self.params(month) if callable(self.params) else (self.params or {})
        return {**month_params(month), **own}


@dataclass
class JobReport:
    """What came out of a run."""

    load: LoadResult | None = None
    checks: list[tuple[str, str, str, str]] = field(default_factory=list)
    export_path: str | None = None
    summary: DataFrame | None = None
    errors: dict[str, str] = field(default_factory=dict)


def run_job(
    store: MonthStore,
    job: Job,
    folder: str,
    out: str,
    stages: Collection[str] | None = None,
    skip_load: bool = False,
    only: Collection[str] = (),
    force: bool = False,
    attach: Mapping[str, str] = {},
) -> JobReport:
    """Run a job for the month of the store. A stage that fails does not stop the next one.

    ``attach`` maps an alias to a month; months and aliases may hold ``${KEY}``.
    """
    params, report = job.all_params(store.month), JobReport()
    wanted = set(STAGES if stages is None else stages)
    if stages is None and skip_load:
        wanted.discard("load")
    store.attach({alias: fill_params(month, params) for alias, month in attach.items()})
    checks = Checks(store, out, params)

    def load():
        report.load = load_set(store, job.tables, folder, params, force, only)

    def export():
        if job.sheets:
            report.export_path, report.summary = export_sheets(
                store, job.name, job.sheets, out, params
            )

    steps = {
        "prejob": job.prejob and (lambda: job.prejob(store.month)),
        "load": load if job.tables else None,
        "logic": job.logic and (lambda: job.logic(store, params)),
        "validate": job.validate and (lambda: job.validate(checks, params)),
        "export": export,
    }
    try:
        for stage in STAGES:
            if stage in wanted and steps[stage]:
                try:
                    steps[stage]()
                except Exception as error:  # The later stages still run.
                    log.error("[%s] %s failed: %s", job.name, stage, error)
                    report.errors[stage] = str(error)
    finally:
        store.detach()
    report.checks = checks.results
    return report


def run_jobs(
    stores: Sequence[MonthStore], jobs: Sequence[Job], folder: str, out: str, **options
) -> dict[tuple[str, str], JobReport]:
    """All jobs month by month; the extracts of a month lie in a folder of that name."""
    return {
        (store.month, job.name): run_job(
            store, job, f"{folder.rstrip('/')}/{store.month}", out, **options
        )
        for store in stores
        for job in jobs
    }

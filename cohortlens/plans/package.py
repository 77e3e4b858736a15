"""Report catalogue and package: the reports of a model, in their order of presentation."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import reports as rep
from cohortlens.operators.model import Model
from cohortlens.sinks import report_package

SUMMARY = "partner_summary"


def report_catalogue(m: Model, as_of: str) -> dict[str, Callable[[], DataFrame]]:
    """Name -> report in presentation order; a report runs when its entry is called."""
    up, down = (lambda c: F.col(c).asc_nulls_last()), (lambda c: F.col(c).desc_nulls_last())
    return {
        SUMMARY: lambda: rep.order_partner_summary(rep.partner_summary(m)),
        "global_kpis": lambda: rep.global_kpis(m),
        "monthly_evolution": lambda: rep.monthly_evolution(m).orderBy(up("partner"), up("mes")),
        "annual_evolution": lambda: rep.annual_evolution(m).orderBy(up("anio")),
        "users_by_year": lambda: rep.users_by_year_pivot(m).orderBy(up("partner")),
        "hours_by_year": lambda: rep.hours_by_year_pivot(m).orderBy(up("partner")),
        "partner_category": lambda: rep.partner_category(m).orderBy(up("partner"), up("categoria")),
        "partner_version": lambda: rep.partner_version(m).orderBy(up("partner"), up("version"), up("course_name")),
        "category_pass_rate": lambda: rep.category_pass_rate(m).orderBy(down("aprobados"), up("categoria")),
        "top_partners": lambda: rep.top_partners(m),
        "certified_detail": lambda: rep.certified_detail(m).orderBy(up("partner"), up("userid"), up("course_name")),
        "inactive_partners": lambda: rep.inactive_partners(m, as_of).orderBy(down("dias_sin_actividad"), up("partner")),
    }


def write_package(m: Model, as_of: str, out_dir: str, fmt: str = "parquet", reports: dict | None = None) -> DataFrame:
    """Write every report of the catalogue, the summary first; a failing one is skipped.

    The manifest (position, report, path, written) lists all of them and is
    stored beside the reports as ``_manifest``.
    """
    wanted = report_catalogue(m, as_of) if reports is None else reports
    done = report_package(wanted, out_dir, fmt, first=SUMMARY)
    order = done + [n for n in wanted if n not in done]
    rows = [(i, n, os.path.join(out_dir, n) if n in done else None, n in done) for i, n in enumerate(order)]
    manifest = m.snap.spark.createDataFrame(rows, "position int, report string, path string, written boolean")
    manifest.coalesce(1).write.mode("overwrite").parquet(os.path.join(out_dir, "_manifest"))
    return manifest

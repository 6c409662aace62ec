"""Where the tables of a lake lie."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class InputFiles:
    """Names of the two CSV files (or folders of CSV files) in the input folder."""

    snapshots: str = "snapshots.csv"
    periods: str = "periods.csv"


@dataclass(frozen=True)
class Layout:
    """Table folders below the folder of their layer.  Any Hadoop path or URI serves as root."""

    snapshots: str = "snapshots"
    periods: str = "periods"
    rejects: str = "period_rejects"
    report: str = "monthly_report"
    presented: str = "monthly_report_presented"


def inside(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"

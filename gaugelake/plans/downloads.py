"""Report tables as CSV downloads, and the job that writes them all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sinks import tables as sink
from . import reports

Tables = dict[str, DataFrame]

# What can be downloaded: the report, and whether it is one file (a row a station or group) or as many as it takes.
DOWNLOADS: dict[str, tuple[Callable[[Tables, str], DataFrame], bool]] = {
    "station_audit": (lambda t, as_of: reports.network_audit_status(t, as_of), True),
    "groundwater_wells": (lambda t, as_of: reports.gw_wells(t, as_of), True),
    "stations": (lambda t, as_of: reports.station_summary(t), True),
    "coverage": (lambda t, as_of: reports.coverage(t), True),
    "latest_per_series": (lambda t, as_of: reports.latest_per_series(t), True),
    "daily_means": (lambda t, as_of: reports.daily_means(t), False),
}


def report(tables: Tables, name: str, as_of: str) -> DataFrame:
    return DOWNLOADS[name][0](tables, as_of)


def write(tables: Tables, root: str, as_of: str, names: list[str] | None = None) -> dict[str, str]:
    """Write downloads under ``root`` as ``<name>_<date>.csv``; the path of each. An existing one is an error."""
    paths = {}
    for name in names or DOWNLOADS:
        paths[name] = f"{root.rstrip('/')}/{name}_{as_of[:10]}.csv"
        sink.write_csv(report(tables, name, as_of), paths[name], single_file=DOWNLOADS[name][1])
    return paths

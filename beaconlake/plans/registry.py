"""The reports that can be run and exported by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import accounting, exploring, incidents, performance

REPORTS: dict[str, Callable[..., DataFrame]] = {
    "accepted_event_totals": accounting.accepted_event_totals,
    "reconciliation": accounting.reconciliation,
    "device_statistics": performance.device_statistics,
    "technology_statistics": performance.technology_statistics,
    "underperforming_devices": performance.underperforming_devices,
    "provider_technology_cohorts": performance.provider_technology_cohorts,
    "geographic_performance": performance.geographic_performance,
    "connectivity_availability": incidents.connectivity_availability,
    "incident_impact": incidents.incident_impact,
    "late_records": accounting.late_records,
    "duplicate_origin": accounting.duplicate_origin,
    "latest_arrivals": exploring.latest_arrivals,
    "arrival_delay_by_minute": exploring.arrival_delay_by_minute,
    "speed_vs_plan": exploring.speed_vs_plan,
    "reject_reasons": exploring.reject_reasons,
}


def report(name: str) -> Callable[..., DataFrame]:
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; choose one of {', '.join(sorted(REPORTS))}")
    return REPORTS[name]

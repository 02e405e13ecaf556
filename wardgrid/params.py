"""Versioned business parameters, passed explicitly to every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Parameters:
    """Thresholds and limits that change results.

    ``rise_pct`` is kept integral so that "at least 20 % above" can be decided
    with exact integer arithmetic (see ``operators.trends.alert_flag``).
    """

    guide_limit: float = 15  # PM2.5 24 h, guide value (µg/m³)
    standard_limit: float = 50  # PM2.5 24 h, legal standard (µg/m³)
    station_radius_km: float = 10
    min_coverage_pct: float = 50
    rise_pct: int = 20
    trailing_rows: int = 7
    max_rejection_rate: float = 0.20
    max_sensors: int = 20
    local_zone: str = "America/Lima"


DEFAULTS = Parameters()

"""Column names of the sensor log and the fixed values the analysis is defined by."""

from __future__ import annotations

import re

# Logger column name -> column name used here.
COLUMN_NAMES = {
    "TimeStamp": "ts",
    "TMP": "tmp",
    "Permeability TC": "perm_tc",
    "Flux": "flux",
    "01-TIT-01": "temp_c",
    "Mem. retention": "mem_retention",
    "Sys. retention": "sys_retention",
    "Recovery": "recovery",
    "Net recovery": "net_recovery",
    "Specific_power": "specific_power",
    "Vcrossflow": "v_crossflow",
    "Active program number": "program",
    "Chemical timer": "chemical_timer",
}

# Lowest and highest plausible reading, in the order the bands are checked.
BANDS = {
    "tmp": (0.0, 8.0),
    "perm_tc": (0.0, 20.0),
    "mem_retention": (0.0, 50.0),
    "sys_retention": (0.0, 50.0),
    "flux": (0.0, 30.0),
    "temp_c": (-10.0, 30.0),
    "recovery": (0.0, 100.0),
    "net_recovery": (0.0, 100.0),
    "specific_power": (0.0, 0.5),
    "v_crossflow": (0.0, 50.0),
}

# Columns without which no analysis is possible.
REQUIRED = ("ts", "tmp", "perm_tc", "flux", "temp_c")

# Program numbers of the skid.
FILTRATION, BACKWASH, CHEMICAL_CLEANING = 10, 21, 32

# TMP slope limits in bar/h (classification), bar/h (trend chart) and
# permeability decline limits in percent per day.
SLOPE_LIMITS = (0.005, 0.02, 0.05)
CHART_SLOPE_LIMITS = (0.001, 0.005, 0.01)
DECLINE_LIMITS = (0.1, 0.5, 1.0)

# KPI targets and alert limits.
TARGETS = {"recovery": 85.0, "specific_energy": 0.15, "cycle_hours": 1.0, "tmp_max": 6.0}
ALERT_LIMITS = {"tmp_slope": (0.01, 0.05), "permeability_decline": (10.0, 20.0)}
HIGH_TMP = 7.5


def column_name(raw: str) -> str:
    """Name used here for a logger column: a listed name, else snake case."""
    raw = raw.strip()
    if raw in COLUMN_NAMES:
        return COLUMN_NAMES[raw]
    return re.sub(r"[^0-9a-z]+", "_", raw.lower()).strip("_")


def bands_for(columns: list[str]) -> dict[str, tuple[float, float]]:
    return {c: band for c, band in BANDS.items() if c in columns}

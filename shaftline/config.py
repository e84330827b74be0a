"""Schemas, fixed values and the settings object every operator shares."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, thresholds, labels and colours that results are
# compared on.
# ---------------------------------------------------------------------------
KEY = "MachineID"
TIME = "Timestamp"
DATE = "Date"
MEASURES = (
    "VibrationVelocity",
    "BearingTemperature",
    "MotorCurrentDraw",
    "RotationalSpeed",
)
SENTINELS = {"VibrationVelocity": -999.0}

# Vibration zones in mm/s: the highest value that still belongs to a zone.
ZONES = ((1.4, "A"), (2.8, "B"), (4.5, "C"))
ZONE_ABOVE = "D"
RESTRICTED_ZONES = ("C", "D")
DANGER_ZONE = "D"
ZONE_COLOURS = {"A": "#2ecc71", "B": "#f1c40f", "C": "#e67e22", "D": "#e74c3c"}

# Bearing temperature alerts in degrees C: the lowest value that raises one.
ALERTS = ((90.0, "Trip"), (80.0, "Alarm"))
ALERT_BELOW = "Normal"

Z_LIMIT = 3.0
BASELINE_CUTOFF = "2026-01-07"
BASELINE_DAYS = 7
FAULTY_MACHINES = (3, 11, 17)
# ---------------------------------------------------------------------------

READINGS = T.StructType(
    [
        T.StructField(KEY, T.IntegerType()),
        T.StructField(TIME, T.TimestampNTZType()),
        *(T.StructField(name, T.DoubleType()) for name in MEASURES),
        T.StructField("Status", T.StringType()),
    ]
)


@dataclass(frozen=True)
class DailyMeasure:
    """A measure averaged per day: where it comes from and how it is rounded."""

    source: str
    name: str
    decimals: int


VIBRATION = DailyMeasure("VibrationVelocity", "AvgVibration", 3)
TEMPERATURE = DailyMeasure("BearingTemperature", "AvgTemperature", 2)


@dataclass(frozen=True)
class Monitor:
    """Column names, dirt rules and thresholds of one fleet.

    The baseline is each key's own first ``baseline_days`` days, whenever they
    were, unless a calendar ``baseline_cutoff`` is set for the whole fleet.
    ``highlight`` are the keys that charts mark. ``exact_averages=False`` rounds the plain
    double averages instead of the exact ones.
    """

    key: str = KEY
    time: str = TIME
    date: str = DATE
    measures: tuple[str, ...] = MEASURES
    sentinels: Mapping[str, float] = field(default_factory=lambda: dict(SENTINELS))
    vibration: DailyMeasure = VIBRATION
    temperature: DailyMeasure = TEMPERATURE
    exact_averages: bool = True
    zones: tuple[tuple[float, str], ...] = ZONES
    zone_above: str = ZONE_ABOVE
    restricted_zones: tuple[str, ...] = RESTRICTED_ZONES
    danger_zone: str = DANGER_ZONE
    alerts: tuple[tuple[float, str], ...] = ALERTS
    alert_below: str = ALERT_BELOW
    z_limit: float = Z_LIMIT
    baseline_cutoff: str | None = None
    baseline_days: int = BASELINE_DAYS
    highlight: tuple[object, ...] = FAULTY_MACHINES

    @property
    def daily_measures(self) -> tuple[DailyMeasure, ...]:
        return (self.vibration, self.temperature)

    @property
    def baseline_rule(self) -> dict[str, object]:
        """The baseline window, as keyword arguments of the baseline operators."""
        if self.baseline_cutoff is not None:
            return {"cutoff": self.baseline_cutoff}
        return {"first_days": self.baseline_days}


DEFAULT = Monitor()

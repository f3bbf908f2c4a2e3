"""Parameters of every operator, with the ranges a caller may choose from."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Rectangle:
    """Latitude/longitude box, inclusive on all four edges."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def vertices(self) -> tuple[tuple[float, float], ...]:
        """Corners as (lon, lat), counter-clockwise."""
        return (
            (self.lon_min, self.lat_min),
            (self.lon_max, self.lat_min),
            (self.lon_max, self.lat_max),
            (self.lon_min, self.lat_max),
        )


# Harbour geofence, its centre, and the area positions are taken from.
HARBOUR = Rectangle(28.10, 28.18, -15.45, -15.39)
HARBOUR_CENTRE = (28.14, -15.42)
FEED_AREA = Rectangle(27.00, 29.50, -18.50, -13.00)

# Accepted range per tunable parameter (inclusive).
PARAMETER_RANGES: dict[str, tuple[float, float]] = {
    "min_speed_kn": (0.0, 35.0),
    "max_distance_km": (1.0, 100.0),
    "max_rows": (20, 500),
    "speed_high_kn": (5.0, 25.0),
    "near_port_km": (0.5, 20.0),
    "stopped_near_port_km": (0.5, 20.0),
    "history_hours": (1, 48),
}
BUCKET_CHOICES = (5, 10, 15, 30)


@dataclass(frozen=True)
class Settings:
    """Every threshold used by the operators. Immutable; derive variants with ``but``."""

    harbour: Rectangle = HARBOUR
    harbour_centre: tuple[float, float] = HARBOUR_CENTRE
    feed_area: Rectangle = FEED_AREA

    vessel_key: str = "ship_name"

    stale_warn_sec: float = 60
    stale_bad_sec: float = 180
    moving_kn: float = 0.5
    stopped_kn: float = 0.2

    min_speed_kn: float = 0.0
    max_distance_km: float = 100.0
    max_rows: int = 120
    top_speed_rows: int = 10
    worst_rows: int = 25
    histogram_bins: int = 18

    speed_high_kn: float = 10.0
    near_port_km: float = 5.0
    stopped_near_port_km: float = 3.0

    history_hours: int = 24
    bucket_minutes: int = 10

    def __post_init__(self) -> None:
        for name, (low, high) in PARAMETER_RANGES.items():
            value = getattr(self, name)
            if not low <= value <= high:
                raise ValueError(f"{name} must be between {low} and {high}, not {value}")
        if self.bucket_minutes not in BUCKET_CHOICES:
            raise ValueError(f"bucket_minutes must be one of {BUCKET_CHOICES}")
        if self.stale_warn_sec > self.stale_bad_sec:
            raise ValueError("stale_warn_sec must not exceed stale_bad_sec")

    def but(self, **changes) -> Settings:
        """A copy with some values changed."""
        known = {f.name for f in fields(self)}
        unknown = set(changes) - known
        if unknown:
            raise TypeError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **changes)


DEFAULTS = Settings()

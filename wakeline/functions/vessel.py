"""Classification and display expressions for one vessel position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.config import Settings

# Display label, marker colour and size per category.
STATUS_LABELS = {"moving": "En movimiento", "stopped": "Parado/Fondeado", "port": "En puerto"}
STATUS_COLOURS = {
    "moving": (16, 185, 129, 190),
    "stopped": (239, 68, 68, 190),
    "port": (59, 130, 246, 200),
}
OTHER_COLOUR = (148, 163, 184, 190)
ALERT_COLOUR = (245, 158, 11, 220)
ALERT_RADIUS = 900
SIZE_PER_KNOT, SIZE_MIN, SIZE_MAX = 220, 280.0, 1200.0

# Score of a fresh, an ageing and a stale position.
SCORE_FRESH, SCORE_AGEING, SCORE_STALE = 100, 60, 20


def not_nan(value: Column) -> Column:
    """NaN sorts above every number in Spark, so it is treated as missing."""
    return F.nanvl(value, F.lit(None).cast("double"))


def one_decimal(value: Column) -> Column:
    """Text with one decimal, rounded by the exact binary value, ties to even (0.25
    gives 0.2), unlike ``format_string``, which rounds the decimal text up."""
    return F.call_function("format_number", value, F.lit("0.0"))


def status_category(in_port: Column, speed: Column, s: Settings) -> Column:
    """port, then moving, else stopped; a missing speed counts as stopped."""
    return F.when(in_port, "port").when(speed > s.moving_kn, "moving").otherwise("stopped")


def freshness_band(age_sec: Column, s: Settings) -> Column:
    return (
        F.when(age_sec <= s.stale_warn_sec, "fresh")
        .when(age_sec <= s.stale_bad_sec, "warning")
        .otherwise("stale")
    )


def quality_score(age_sec: Column, s: Settings) -> Column:
    return (
        F.when(age_sec <= s.stale_warn_sec, SCORE_FRESH)
        .when(age_sec <= s.stale_bad_sec, SCORE_AGEING)
        .otherwise(SCORE_STALE)
    )


def rgba(values: tuple[int, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def marker_colour(category: Column) -> Column:
    chain = F.when(category == "moving", rgba(STATUS_COLOURS["moving"]))
    for name in ("stopped", "port"):
        chain = chain.when(category == name, rgba(STATUS_COLOURS[name]))
    return chain.otherwise(rgba(OTHER_COLOUR))


def marker_size(speed: Column) -> Column:
    """Proportional to speed within limits; the smallest size when speed is missing."""
    return F.least(F.lit(SIZE_MAX), F.greatest(F.lit(SIZE_MIN), not_nan(speed) * SIZE_PER_KNOT))


def status_label(category: Column) -> Column:
    pairs = [F.lit(x) for pair in STATUS_LABELS.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[category], category)

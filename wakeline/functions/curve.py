"""Place of a position on a Hilbert curve: rows near on the curve are near on the map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.functions.vessel import not_nan

BITS = 18


def _steps(value: Column, low: float, span: float, bits: int) -> Column:
    """``value`` in 2 ** bits equal steps; values beyond the range count as its ends, null as the upper one."""
    step = F.floor((not_nan(value) - F.lit(low)) * F.lit(2.0**bits / span))
    return F.greatest(F.lit(0), F.least(F.lit(2**bits - 1), step)).cast("long")


def hilbert_key(lat: Column, lon: Column, bits: int = BITS) -> Column:
    """A number from 0 to 4 ** bits - 1 (150 m steps with 18 bits); null without a position.

    One bit of both coordinates, from the highest on, gives two bits of the key. Which way the
    curve runs through the next smaller square is kept as two marks: coordinates
    swapped, and both mirrored.
    """
    y, x = _steps(lat, -90.0, 180.0, bits), _steps(lon, -180.0, 360.0, bits)
    zero = F.lit(0).cast("long")
    start = F.struct(y.alias("y"), x.alias("x"), zero.alias("key"), zero.alias("mirror"), zero.alias("swap"))

    def bit(value: Column, at: Column) -> Column:
        return F.call_function("shiftright", value, at).bitwiseAND(F.lit(1).cast("long"))

    def descend(state: Column, at: Column) -> Column:
        swapped = state["swap"] == 1
        y_bit, x_bit = bit(state["y"], at), bit(state["x"], at)
        a = F.when(swapped, y_bit).otherwise(x_bit).bitwiseXOR(state["mirror"])
        b = F.when(swapped, x_bit).otherwise(y_bit).bitwiseXOR(state["mirror"])
        turns = F.lit(1).cast("long") - b
        return F.struct(
            state["y"].alias("y"),
            state["x"].alias("x"),
            (state["key"] * 4 + (a * 3).bitwiseXOR(b)).alias("key"),
            state["mirror"].bitwiseXOR(turns * a).alias("mirror"),
            state["swap"].bitwiseXOR(turns).alias("swap"),
        )

    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    key = F.aggregate(levels, start, descend, lambda state: state["key"])
    return F.when(not_nan(lat).isNotNull() & not_nan(lon).isNotNull(), key)

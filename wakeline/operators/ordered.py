"""Previous/next row per key when one key may hold most of the rows.

A plain ``lag`` puts a whole key into one task. Rows are therefore cut into slices
of time: the neighbour is found inside each (key, slice), and only the first and
last row of each slice, and the rows that are kept anyway, go through a second window
per key that joins the slices up. A slice is a function of the row alone, so there
is one plan for every size of input and no count is needed to choose it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDGE = -1
SLICE_HOURS = 24

Keep = Callable[[Column], Column]


def time_slice(time: Column, slice_hours: int = SLICE_HOURS) -> Column:
    """Number of the slice that ``time`` falls into, from 0 on."""
    return F.pmod(F.floor(F.unix_seconds(time) / F.lit(slice_hours * 3600)), F.lit(2**40)).cast("long")


def with_neighbour(
    rows: DataFrame,
    key: str,
    time: str,
    values: Sequence[str],
    name: str,
    forward: bool = False,
    keep: Keep | None = None,
    slice_hours: int = SLICE_HOURS,
) -> DataFrame:
    """Add ``name``: a struct of ``values`` from the previous row of the same key by
    ``time`` (the next one if ``forward``), null where there is none.

    (key, time) must be unique. ``keep`` maps the neighbour to a predicate on the
    row; rows failing it are removed.
    """
    near, far = (F.lead, F.lag) if forward else (F.lag, F.lead)
    payload = F.struct(*values)

    inside = Window.partitionBy(key, "_slice").orderBy(time)
    local = rows.withColumn("_slice", time_slice(F.col(time), slice_hours)).withColumns(
        {"_near": near(payload).over(inside), "_far": far(F.lit(True)).over(inside)}
    )
    unknown = F.col("_near").isNull()
    local = local.withColumn("_edge", unknown | F.col("_far").isNull())
    if keep is not None:
        local = local.filter(F.col("_edge") | keep(F.col("_near")))

    across = Window.partitionBy(
        key, F.when(F.col("_edge"), F.lit(EDGE)).otherwise(F.col("_slice"))
    ).orderBy(time)
    found = local.withColumn("_over", near(payload).over(across)).withColumn(
        name, F.when(unknown, F.col("_over")).otherwise(F.col("_near"))
    )
    if keep is not None:
        found = found.filter(keep(F.col(name)))
    return found.drop("_slice", "_near", "_far", "_edge", "_over")

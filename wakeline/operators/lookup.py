"""Left joins against a lookup table whose size is checked, not assumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
SALTS = 64


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    condition: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    small: bool | None = None,
) -> DataFrame:
    """``rows`` left-joined with ``lookup`` (aliased ``r`` and ``l``) on equal ``on``
    columns, null being equal to null, and ``condition``.

    The lookup is broadcast only if counting finds at most ``broadcast_rows``
    rows. Otherwise both sides shuffle on (key, salt): rows of one key spread
    over ``salts`` tasks and each lookup row is repeated once per salt, so the
    answer is the same. A caller that has measured the lookup says so by ``small``.
    """
    on = list(on)
    if small is None:
        small = lookup.limit(broadcast_rows + 1).count() <= broadcast_rows
    if small:
        lookup = F.broadcast(lookup)
    else:
        # The input partition is part of the salt so that identical rows spread as
        # well; a row gets the same salt again if its task is run again.
        salt = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(salts))
        rows = rows.withColumn("_salt", salt)
        lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append("_salt")
    match = F.lit(True) if condition is None else condition
    for name in on:
        match = match & F.col(f"r.{name}").eqNullSafe(F.col(f"l.{name}"))
    return rows.alias("r").join(lookup.alias("l"), match, "left")

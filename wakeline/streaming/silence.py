"""Notices of vessels that stopped reporting, raised by timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wakeline.config import DEFAULTS
from wakeline.session import package_on_workers
from wakeline.streaming.stateful import save_version, start, state_on_disk

MEMORY = "settled LONG, noticed BOOLEAN, pending ARRAY<LONG>"


def _settle(settled: int | None, noticed: bool, pending: list[int], limit: int, watermark: int) -> tuple[int | None, bool, list[int], list[int]]:
    """Goes on from the last settled report: (settled, noticed, pending, silences begun), times in microseconds.

    The next report within the limit is settled at once, as nothing that comes in between makes a
    silence of it. A longer gap is one only when the watermark has passed its limit.
    """
    found, times = [], sorted(set(pending))
    if settled is None and times:
        settled, noticed = times[0], False
    times = [t for t in times if t > settled] if settled is not None else []
    while settled is not None:
        if times and times[0] - settled <= limit:
            settled, noticed = times.pop(0), False
            continue
        if watermark <= settled + limit:
            break
        if not noticed:
            found.append(settled)
            noticed = True
        if not times:
            break
        settled, noticed = times.pop(0), False
    return settled, noticed, times, found


def start_silence_notices(
    silver: DataFrame, root: str, checkpoint: str, limit_sec: int, lateness_sec: int, key: str = DEFAULTS.vessel_key,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """``key, silent_since, due_at``: a notice under ``root`` for every vessel not heard from for longer than
    ``limit_sec``, once per silence.

    The timer is event time: a notice falls due when the newest report of any vessel is ``lateness_sec`` past
    the limit, and needs no report of the silent vessel. Reports later than that are left to the
    batch form. State is one row per vessel: its last report and those within the lateness.
    """
    if not 0 <= lateness_sec <= limit_sec:
        raise ValueError("the lateness must not exceed the limit")
    kind = silver.schema[key]
    output = T.StructType([T.StructField(key, kind.dataType), T.StructField("silent_since", T.TimestampType()), T.StructField("due_at", T.TimestampType())])
    limit = limit_sec * 1_000_000

    def judge(vessel: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        settled, noticed, pending = state.get if state.exists else (None, False, [])
        pending = list(pending or [])
        if not state.hasTimedOut:
            for frame in frames:
                pending += frame["timestamp"].astype("datetime64[us]").astype("int64").tolist()
        watermark = max(0, state.getCurrentWatermarkMs()) * 1000
        settled, noticed, pending, found = _settle(settled, bool(noticed), pending, limit, watermark)
        state.update((settled, noticed, pending))
        if not noticed:
            state.setTimeoutTimestamp((settled + limit) // 1000 + 1)
        if found:
            begun = pd.to_datetime(pd.Series(found), unit="us")
            yield pd.DataFrame({key: [vessel[0]] * len(found), "silent_since": begun, "due_at": begun + pd.Timedelta(seconds=limit_sec)})

    package_on_workers(silver.sparkSession)
    reports = silver.select(key, "timestamp").filter("timestamp IS NOT NULL").withWatermark("timestamp", f"{lateness_sec} seconds")
    notices = reports.groupBy(key).applyInPandasWithState(judge, output, T.StructType.fromDDL(MEMORY), "append", GroupStateTimeout.EventTimeTimeout)
    with state_on_disk(silver.sparkSession):
        return start(notices, lambda batch, version: save_version(batch, root, version), checkpoint, "append", every)

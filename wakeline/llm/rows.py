"""Columns computed from a text column inside Arrow map tasks, with the row left as it is."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wakeline.llm import textscan

#: Text worked on at once; its arrays take some twenty times as much.
SLICE_BYTES = 1 << 20


def append(
    docs: DataFrame,
    text: str,
    columns: str,
    make: Callable[[], Callable[[pa.RecordBatch, pa.Array], list[pa.Array]]],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``docs`` with new ``columns`` (DDL) that replace columns of the same names.

    ``make`` runs once per task; what it returns is called with pieces of the rows
    that hold about ``slice_bytes`` of text, and with their texts, and gives the new columns in
    order. Columns to be replaced, of which ``text`` may be one, are still there in a piece.
    Every column goes to the worker once, and back if it is not replaced.
    """
    new = T.StructType.fromDDL(columns)
    rest = [n for n in docs.columns if n not in new.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in textscan.slices(batch, text, slice_bytes):
                kept = [piece.column(n) for n in rest]
                yield pa.RecordBatch.from_arrays(kept + work(piece, piece.column(text)), names=rest + new.names)

    return docs.mapInArrow(run, T.StructType([docs.schema[n] for n in rest] + new.fields))

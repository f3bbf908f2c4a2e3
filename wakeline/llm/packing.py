"""Packing of token runs into sequences of one length, by rounds of best fit.

Every task packs its own pieces, largest first, each into the open sequence that it leaves
least room in. Nearly full sequences are done. The others become items of the next round, in
which several tasks' leftovers meet in one, until one task has seen the last of them. A
sequence carries its pieces along, so that no round joins anything.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from wakeline.llm import textscan
from wakeline.llm.ordered import written

SIZE = 2048
#: A sequence with at most one part in so many free is nearly full.
NEARLY = 256
#: Leftovers of so many tasks meet in one task of the next round.
FAN_IN = 8
#: Pieces packed together; a task with more packs them in several lots.
LOT = 100_000
#: Another round is worth it while it leaves fewer open sequences than this share of those it was given.
PROGRESS = 0.99

PIECE = "piece int, start long, length long, ids_crc32 long"

# How the vocabulary file writes bytes. Printable ones stand for themselves, the
# others for the characters from 256 on, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts by a byte-level vocabulary file of the tokenizers library (its text).

    The file's vocabulary is given to tiktoken, whose ids are the same at a quarter of the time;
    a text that its pattern cannot be run on (very long white space) goes to tokenizers.
    Strings of special tokens become their ids, as in that library.
    """

    def __init__(self, vocabulary: str, pattern: str):
        self.vocabulary = vocabulary
        parsed = json.loads(vocabulary)
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(map(byte_of.__getitem__, w)): i for w, i in parsed["model"]["vocab"].items() if w not in special}
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.slow: Tokenizer | None = None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            self.slow = self.slow or Tokenizer.from_str(self.vocabulary)
            return self.slow.encode(text, add_special_tokens=False).ids


def cut(length: int, size: int) -> np.ndarray:
    """Bounds of the pieces of a run: all of ``size`` but the first, which may be shorter."""
    return np.concatenate([[0], np.arange((length - 1) % size + 1, length + 1, size)])


def pieces(
    docs: DataFrame, vocabulary: str, pattern: str, end_id: int = 0, size: int = SIZE, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """One row per piece: the columns ``keep`` and ``piece`` (from 0), ``start`` (the document's ids
    before it), ``length`` and ``ids_crc32`` (of its ids as little-endian 32-bit numbers).

    ``vocabulary`` is the text of the vocabulary file. A document is the ids of its whole text and
    ``end_id``; null is an empty text. Only documents longer than ``size`` are cut. Columns to keep that have
    names of the new ones are left out. Equal rows stay as many rows as there are.
    """
    new = T.StructType.fromDDL(PIECE)
    kept = [c for c in keep if c not in new.names]
    source = docs.select(*kept, F.col(text).alias("__text") if text in kept else F.col(text))
    body = "__text" if text in kept else text
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            for part in textscan.slices(batch, body):
                rows, number, start, length, crc = [], [], [], [], []
                for row, value in enumerate(part.column(body)):
                    ids = np.array([*encoder.ids(value.as_py() or ""), end_id], "<u4")
                    bounds = cut(len(ids), size).tolist()
                    for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        rows.append(row)
                        number.append(i)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                at = pa.array(rows, pa.int64())
                made = [pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.RecordBatch.from_arrays([part.column(c).take(at) for c in kept] + made, names=kept + new.names)

    return source.mapInArrow(run, T.StructType([source.schema[c] for c in kept] + new.fields))


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Items put together: the longest first, each where it leaves least room."""
    rooms: list[list[int]] = [[] for _ in range(size + 1)]
    some = 0  # bit r is set while a sequence with room for r is open
    made: list[list[int]] = []
    order = np.argsort(-lengths, kind="stable")
    for item, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = some >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
            made[at].append(item)
        else:
            room, at = size, len(made)
            made.append([item])
        if room > length:
            rooms[room - length].append(at)
            some |= 1 << (room - length)
    return made


def _together(items: pa.Table, size: int, schema: pa.Schema) -> pa.RecordBatch:
    """Items (``used`` and the list ``members``) put together to sequences of the same columns."""
    made = best_fit(items.column("used").to_numpy(), size)
    bounds = np.cumsum([0, *map(len, made)])
    members = items.column("members").combine_chunks().take(pa.array([i for one in made for i in one], pa.int64()))
    inner = members.offsets.to_numpy()[bounds]
    flat = members.values
    ends = np.cumsum(flat.field("length").to_numpy())
    begin = np.concatenate([[0], ends])
    used = np.diff(begin[inner])
    offset = begin[:-1] - np.repeat(begin[inner[:-1]], np.diff(inner))
    columns = {f.name: flat.field(f.name) for f in schema.field("members").type.value_type}
    columns["offset"] = pa.array(offset, pa.int64())
    packed = pa.StructArray.from_arrays(list(columns.values()), fields=list(schema.field("members").type.value_type))
    lists = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), packed, type=schema.field("members").type)
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(size - used > size // NEARLY), lists], schema=schema)


def _round(items: DataFrame, size: int, lot: int) -> DataFrame:
    """Best fit within each task; ``open`` marks sequences with room to speak of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0

        def packed() -> pa.RecordBatch:
            items = pa.Table.from_batches(waiting)
            members = items.schema.field("members")
            fields = [pa.field("used", pa.int64()), pa.field("open", pa.bool_()), members]
            return _together(items, size, pa.schema(fields))

        for batch in batches:
            waiting.append(batch)
            n += len(batch.column("members").flatten())
            if n >= lot:
                yield packed()
                waiting, n = [], 0
        if n:
            yield packed()

    plain = T.StructType([T.StructField("used", T.LongType()), T.StructField("open", T.BooleanType()), items.schema["members"]])
    return items.select("used", "members").mapInArrow(run, plain)


def pack(runs: DataFrame, size: int = SIZE, lot: int = LOT) -> DataFrame:
    """``runs`` with ``sequence_id`` and ``offset``: in which sequence and where in it each row
    lies. Rows have a ``length`` from 1 to ``size``; the offsets of a sequence have no gaps.

    A round is over when its sequences are written. The next one has an eighth of its tasks, or as many
    as give each no more than ``lot`` pieces. It ends with a round in one task, or when a
    round put next to nothing together: then hardly any two of the open sequences fit into one, and a
    task is never given more of them. No rows give no rows; columns named as the new ones are replaced.
    """
    columns = [c for c in runs.columns if c not in ("sequence_id", "offset")]
    member = F.struct(*columns, F.lit(0).cast("long").alias("offset"))
    items = written(runs.select(F.col("length").cast("long").alias("used"), F.array(member).alias("members")), "pieces")
    # a task's lot should be large: the more pieces to choose from, the fuller the sequences
    items = items.coalesce(math.ceil(items.count() / max(1, lot // 4)) or 1)
    tasks, given, done = None, math.inf, []
    while True:
        table = written(_round(items, size, lot), "packing")
        left = table.filter("open")
        n, held = left.agg(F.count("*"), F.coalesce(F.sum(F.size("members")), F.lit(0))).first()
        if tasks == 1 or n < 2 or (tasks is not None and n > PROGRESS * given):
            done.append(table)
            break
        done.append(table.filter("NOT open"))
        tasks, given = max(1, math.ceil((tasks or table.rdd.getNumPartitions()) / FAN_IN), math.ceil(held / lot)), n
        items = left.repartition(tasks, F.xxhash64("members")) if tasks > 1 else left.repartition(1)
    whole = done[0]
    for table in done[1:]:
        whole = whole.unionAll(table)
    numbered = whole.withColumn("sequence_id", F.monotonically_increasing_id())
    placed = numbered.select("sequence_id", F.explode("members").alias("member"))
    return placed.select(*[F.col("member")[c].alias(c) for c in columns], "sequence_id", F.col("member")["offset"].alias("offset"))

"""Byte-level BPE by overlapping chunks.

A text is cut into chunks that overlap. Chunks are pre-tokenised on their own, in
parallel; a chunk that begins inside a pre-token goes wrong at first and then falls in
step with its predecessor. Where both have the same boundary they agree from there on, because
the pattern never looks back: the text is stitched there. Where an overlap holds no
common boundary, the predecessor reads on. The stitched pre-tokens are encoded one
by one; decoding puts the tokens' bytes one after the other.

A text of one chunk needs no stitching and is never shuffled. The chunks of longer
texts are shuffled by the text's digest, equal texts once.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import rows

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 512
#: The longest look of the pattern past the end of a pre-token.
_LOOK = 3
#: Pre-tokens and units kept by a worker, twice: those of late and those before.
_CACHED = 100_000
_FEW = 48
_BLANK_BEFORE_SPACE = re.compile(r"\s ")


def read_ranks(path: str) -> bytes:
    """The rank file; read on the driver, it is a few megabytes at most."""
    with open(path, "rb") as file:
        return file.read()


class _Remembering(dict):
    """Works out a missing value and keeps it; what was not used for long is forgotten."""

    def __init__(self, work):
        super().__init__()
        self.work, self.older = work, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.work(key)
        if len(key) <= 64:
            if len(self) >= _CACHED:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


class Codec:
    """``pieces`` maps a pre-token, ``units`` what lies between two spaces with the space
    before it, to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.none = 1 + max(self.tokens)
        self.find = regex.compile(pattern)
        self.pieces = _Remembering(self._piece)
        self.units = _Remembering(self._unit)
        # a rank for every two bytes, so that a merge begins without cutting the text up
        self.twos = [self.ranks.get(bytes((a, b)), self.none) for a in range(256) for b in range(256)]

    def _unit(self, unit: str) -> bytes:
        found = self.find.findall(unit)
        # most are one pre-token, which need not be remembered twice
        return self._piece(found[0]) if len(found) == 1 else self.encode(found)

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        ids = [rank] if rank is not None else self._merge_few(raw) if len(raw) <= _FEW else self._merge(raw)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge_few(self, raw: bytes) -> list[int]:
        """The same merges as ``_merge`` by looking at all pairs each time."""
        get, none, twos = self.ranks.get, self.none, self.twos
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [twos[a << 8 | b] for a, b in zip(raw, raw[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            part = parts[i] = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + part, none)
            if i < len(pairs):
                pairs[i] = get(part + parts[i + 1], none)
        return [self.ranks[part] for part in parts]

    def _merge(self, raw: bytes) -> list[int]:
        """Merges the neighbours of lowest rank, leftmost first, until none is known."""
        ends = list(range(1, len(raw) + 1))
        after = list(range(1, len(raw) + 1))
        before = list(range(-1, len(raw) - 1))
        queue = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(raw):
                rank = self.ranks.get(raw[left : ends[right]])
                if rank is not None:
                    heapq.heappush(queue, (rank, left, ends[right]))

        for i in range(len(raw) - 1):
            offer(i)
        while queue:
            _, left, end = heapq.heappop(queue)
            right = after[left] if ends[left] else len(raw)
            if right >= len(raw) or ends[right] != end:
                continue  # one of the two has been merged meanwhile
            ends[left], ends[right] = end, 0
            after[left] = after[right]
            if after[left] < len(raw):
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        out, at = [], 0
        while at < len(raw):
            out.append(self.ranks[raw[at : ends[at]]])
            at = after[at]
        return out

    def encode(self, pieces) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode_text(self, text: str) -> bytes:
        """A space after anything but white space begins a pre-token, so a text without
        other white space before a space can be looked up by such units."""
        if "\0" in text or _BLANK_BEFORE_SPACE.search(text):
            return self.encode(self.find.findall(text))
        return b"".join(map(self.units.__getitem__, text.replace(" ", "\0 ").split("\0")))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def boundaries(self, text: str, start: int, final: bool) -> np.ndarray:
        """Where pre-tokens begin or end, in the whole text; of a chunk that is cut off
        only those that what follows cannot change."""
        ends = np.fromiter((m.end() for m in self.find.finditer(text)), np.int64)
        if not final:
            ends = ends[ends <= len(text) - _LOOK]
        return np.concatenate([[0], ends]) + start


@lru_cache(maxsize=2)
def codec_of(ranks: bytes, pattern: str) -> Codec:
    """One codec for all tasks of a worker, with what it remembers."""
    return Codec(ranks, pattern)


def stitch(codec: Codec, chunks: list[tuple[int, str, np.ndarray]], chunk: int) -> list[str]:
    """Pre-tokens of the whole text from (start, text, boundaries) of its chunks in order."""
    text = "".join(part[:chunk] if i + 1 < len(chunks) else part for i, (_, part, _) in enumerate(chunks))
    # `own` begins at a sure boundary and holds the current chunk's from there on
    done, own, i, reach = [], chunks[0][2], 0, 1
    while i + 1 < len(chunks):
        start, _, found = chunks[i + 1]
        common = np.intersect1d(own[own >= start], found)
        if len(common):
            done.append(own[own < common[0]])
            own = found[found >= common[0]]
            i, reach = i + 1, 1
            continue
        # no common boundary: read on from the last sure one, twice as far each time
        last = min(i + 1 + reach, len(chunks)) - 1
        end = chunks[last][0] + len(chunks[last][1])
        sure = int(own[-1])
        own = np.concatenate([own[:-1], codec.boundaries(text[sure:end], sure, last + 1 == len(chunks))])
        i, reach = last, reach * 2
    cuts = np.concatenate([*done, own]).tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_NEW = "ids binary, n_tokens long, decoded binary"


def encode(
    docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS
) -> DataFrame:
    """Every row of ``docs`` with ``ids`` (little-endian unsigned 32-bit), ``n_tokens`` and
    ``decoded``, the bytes that the ids stand for.

    ``ranks`` is the content of a rank file, ``pattern`` splits a text into pre-tokens,
    which are encoded separately and without special tokens. The pattern must not look
    back, nor more than three characters ahead, and no pre-token but white space may hold
    a space after its first character. Null is encoded as the empty
    text: no ids, no bytes. Columns of the same names are replaced.
    """
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("an overlap is shorter than a chunk")
    known = docs.sparkSession.sparkContext.broadcast(ranks)
    long = F.coalesce(F.length(text), F.lit(0)) > chunk_chars
    docs = docs.drop("ids", "n_tokens", "decoded")

    def make():
        codec = codec_of(known.value, pattern)

        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            ids = [codec.encode_text(x or "") for x in texts.to_pylist()]
            return [
                pa.array(ids, pa.binary()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([codec.decode(x) for x in ids], pa.binary()),
            ]

        return work

    short = rows.append(docs.filter(~long), text, _NEW, make)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(known.value, pattern)
        for batch in batches:
            key, number, start, part, final = (batch.column(i).to_pylist() for i in range(5))
            found = [codec.boundaries(p, s, f).astype("<i8").tobytes() for p, s, f in zip(part, start, final, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(found, pa.binary())],
                names=["key", "number", "start", "part", "found"],
            )

    def joined(table: pa.Table) -> pa.Table:
        codec = codec_of(known.value, pattern)
        parts = sorted(table.to_pylist(), key=lambda r: r["number"])
        ids = codec.encode(stitch(codec, [(r["start"], r["part"], np.frombuffer(r["found"], "<i8")) for r in parts], chunk_chars))
        return pa.table({"key": [parts[0]["key"]], "ids": pa.array([ids], pa.binary()), "n_tokens": pa.array([len(ids) // 4], pa.int64()), "decoded": pa.array([codec.decode(ids)], pa.binary())})

    keyed = docs.filter(long).withColumn("__key", F.sha2(text, 256))
    distinct = keyed.select(F.col("__key").alias("key"), F.col(text).alias("body")).groupBy("key").agg(F.first("body").alias("body"))
    last = F.ceil(F.length("body") / F.lit(chunk_chars)).cast("int") - 1
    chunks = distinct.select("key", "body", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("number")).select(
        "key",
        "number",
        (F.col("number").cast("long") * chunk_chars).alias("start"),
        F.substring("body", F.col("number") * chunk_chars + 1, F.lit(chunk_chars + overlap_chars)).alias("part"),
        (F.col("number") == F.col("last")).alias("final"),
    )
    found = chunks.mapInArrow(cut, "key string, number int, start long, part string, found binary")
    whole = found.groupBy("key").applyInArrow(joined, f"key string, {_NEW}")
    stitched = keyed.join(whole.withColumnRenamed("key", "__key"), "__key").drop("__key")
    return short.unionByName(stitched)

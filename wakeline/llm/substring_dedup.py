"""Removal of word runs that also occur elsewhere, by fixed-block anchors.

Every text is cut into non-overlapping reference blocks; the blocks are the
index. Every rolling window of a block's length probes it. A run of
``window >= 2 * block - 1`` words always holds one whole block of each of its
copies, so a repeated run is hit wherever it is. Hits are then extended: all
windows of ``window`` words around a hit are compared by a 96-bit hash, and
neighbouring repeated windows join to maximal repeats. Nothing is done pair by
pair, so a passage in a third of all texts costs as much per copy as any other.

Equal texts are reduced to one with a count before anything is compared. Block
hashes meet in shards whose number follows the size of the input; a map task
decides on its own what repeats within its slice and sends one witness of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import textscan

WINDOW = 35
BLOCK = 18
#: Characters of text whose probes meet in one shard, about 4 million probes.
SHARD_CHARS = 24_000_000

_SENT = "shard int, entries binary, marks binary, keys binary, counts binary, places binary"
_TOLD = "bucket int, keys binary, counts binary, places binary"
_HITS = "key binary, hits binary"
_KEY = 16


def _widths(gaps: np.ndarray) -> bytes:
    wide = len(gaps) and gaps.max() > 0xFFFF
    return (b"\x04" if wide else b"\x02") + gaps.astype("<u4" if wide else "<u2").tobytes()


def _unwidths(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4" if data[0] == 4 else "<u2", offset=1).astype(np.int64)


def _located(keys: np.ndarray, text: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Texts (in order) with the number and the places of their entries, as differences."""
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    counts = np.diff(begins, append=len(text))
    gaps = np.diff(place, prepend=0)
    gaps[begins] = place[begins]
    return keys[text[begins]].tobytes(), counts.astype("<u4").tobytes(), _widths(gaps)


class _Packer:
    """Packs what one slice of texts sends to the shards and what it has decided itself."""

    def __init__(self, shards: int, kept_bytes: int):
        self.shards, self.kept = shards, kept_bytes

    def pack(self, keys, weight, value, text, place, mark) -> Iterator[tuple]:
        """``value``: uint64, or a pair of them. Entries are in order of text and
        place. ``mark``: the entry is a reference block. Live: a value with a mark
        and at least two entries, copies of equal texts counted."""
        if not len(text):
            return
        high = value[0] if isinstance(value, tuple) else value
        order = np.argsort(high, kind="stable")
        new = np.diff(high[order], prepend=high[order[0]] ^ np.uint64(1)) != 0
        if isinstance(value, tuple):
            order = np.lexsort((value[1], value[0]))
            new = (np.diff(value[0][order], prepend=~value[0][order[0]]) != 0) | (
                np.diff(value[1][order], prepend=~value[1][order[0]]) != 0
            )
        group = np.cumsum(new) - 1
        begins = np.flatnonzero(new)
        total = np.add.reduceat(np.minimum(weight[text[order]], 2), begins)
        marked = np.add.reduceat(mark[order].astype(np.int64), begins) > 0
        live = np.empty(len(order), dtype=bool)
        live[order] = (marked & (total >= 2))[group]
        shard = ((high >> np.uint64(40)) * np.uint64(self.shards) >> np.uint64(24)).astype(np.int64)
        entries = self._entries(value)

        witness = order[begins[marked & (total >= 2)]]
        yield from self._witnesses(shard[witness], entries[witness])
        rest = np.flatnonzero(~live)
        yield from self._asking(keys, shard[rest], entries[rest], text[rest], place[rest], mark[rest])
        known = np.flatnonzero(live)
        if len(known):
            # spread over as many pass-through groups as there are shards
            to = self.shards + int(high[known[0]] % np.uint64(self.shards))
            yield (to, b"", b"", *_located(keys, text[known], place[known]))

    def _entries(self, value) -> np.ndarray:
        if isinstance(value, tuple):
            both = np.empty((len(value[0]), 2), "<u8")
            both[:, 0], both[:, 1] = value
            return both.view(np.uint8).reshape(len(value[0]), 16)[:, : self.kept].copy()
        return value.astype("<u8").view(np.uint8).reshape(len(value), 8)[:, : self.kept].copy()

    @staticmethod
    def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard, kind="stable")
        ordered = shard[order]
        for ids in np.split(order, np.flatnonzero(np.diff(ordered)) + 1):
            if len(ids):
                yield int(shard[ids[0]]), ids

    def _witnesses(self, shard, entries) -> Iterator[tuple]:
        for to, ids in self._by_shard(shard):
            yield to, entries[ids].tobytes(), b"", b"", b"", b""

    def _asking(self, keys, shard, entries, text, place, mark) -> Iterator[tuple]:
        for to, ids in self._by_shard(shard):
            marks = np.packbits(mark[ids]).tobytes()
            yield (to, entries[ids].tobytes(), marks, *_located(keys, text[ids], place[ids]))


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


_SENT_ARROW = pa.schema([("shard", pa.int32())] + [(c, pa.binary()) for c in ("entries", "marks", "keys", "counts", "places")])
_TOLD_ARROW = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("keys", "counts", "places")])
_HITS_ARROW = pa.schema([("key", pa.binary()), ("hits", pa.binary())])


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("key").to_pylist()), dtype=f"V{_KEY}")


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("copies").to_numpy(zero_copy_only=False).astype(np.int64)


def _probing(shards: int, window: int, block: int):
    """Every rolling window of ``block`` words, the aligned ones marked as index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(shards, 4)
        for batch in batches:
            for piece in textscan.slices(batch, "text"):
                words = textscan.scan(piece.column("text"))
                value = textscan.windows(textscan.hashes(words), block)
                text, place = words.text[: len(value)], words.position[: len(value)]
                use = np.flatnonzero(textscan.inside_one_text(words, block) & (words.count[text] >= window))
                place = place[use]
                rows = list(packer.pack(_keys(piece), _weights(piece), value[use], text[use], place, place % block == 0))
                if rows:
                    yield _record(rows, _SENT_ARROW)

    return run


def _around(hits: np.ndarray, n_windows: int, reach: int) -> np.ndarray:
    """Windows that hold the probe at any of ``hits``."""
    step = np.zeros(n_windows + 1, np.int64)
    np.add.at(step, np.maximum(hits - reach, 0), 1)
    np.add.at(step, np.minimum(hits + 1, n_windows), -1)
    return np.cumsum(step[:-1]) > 0


def _extending(shards: int, window: int, block: int):
    """The windows around each hit, to be compared in full."""
    overlap = window - block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(shards, 12)
        for batch in batches:
            for piece in textscan.slices(batch, "text"):
                words = textscan.scan(piece.column("text"))
                first, second = (textscan.windows(textscan.hashes(words, seed), window) for seed in (1, 2))
                near = np.zeros(len(first), bool)
                for i, hits in enumerate(piece.column("hits").to_pylist()):
                    at, n = words.first[i], words.first[i + 1] - words.first[i] - window + 1
                    if n > 0:
                        found = np.frombuffer(hits, "<u4").astype(np.int64)
                        near[at : at + n] = _around(found, n, overlap)
                use = np.flatnonzero(near)
                everywhere = np.ones(len(use), bool)
                rows = list(packer.pack(_keys(piece), _weights(piece), (first[use], second[use]), words.text[use], words.position[use], everywhere))
                if rows:
                    yield _record(rows, _SENT_ARROW)

    return run


def _answering(kept_bytes: int, buckets: int):
    """Within a shard: which entries are live, told to the texts they came from. Texts
    are told in buckets, so that rows do not multiply with the shards."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        entries = np.frombuffer(b"".join(r["entries"] for r in rows), dtype=np.uint8).reshape(-1, kept_bytes)
        total = np.zeros(0, bool)
        if len(entries):
            if kept_bytes == 4:
                value = entries.copy().view("<u4").ravel()
            else:
                value = entries.copy().view(f"V{kept_bytes}").ravel()
                high, low = entries[:, :8].copy().view("<u8").ravel(), entries[:, 8:].copy().view("<u4").ravel()
                order = np.lexsort((low, high))
                new = (np.diff(high[order], prepend=~high[order[0]]) != 0) | (np.diff(low[order], prepend=~low[order[0]]) != 0)
            if kept_bytes == 4:
                order = np.argsort(value, kind="stable")
                new = np.diff(value[order], prepend=~value[order[0]]) != 0
            weight, mark = [], []
            for r in rows:
                n = len(r["entries"]) // kept_bytes
                asks = bool(r["counts"])
                weight.append(np.full(n, 1 if asks else 2))
                mark.append(np.unpackbits(np.frombuffer(r["marks"], np.uint8), count=n).astype(bool) if asks else np.ones(n, bool))
            begins = np.flatnonzero(new)
            good = (np.add.reduceat(np.concatenate(weight)[order], begins) >= 2) & (
                np.add.reduceat(np.concatenate(mark)[order].astype(np.int64), begins) > 0
            )
            total = np.empty(len(order), bool)
            total[order] = good[np.cumsum(new) - 1]
        out, at = [], 0
        for r in rows:
            n = len(r["entries"]) // kept_bytes
            if r["counts"]:
                out += _told(r, total[at : at + n] if n else None)
            at += n
        return pa.Table.from_batches([_record(_bucketed(out, buckets), _TOLD_ARROW)])

    return run


def _bucketed(told: list[tuple[bytes, bytes]], buckets: int) -> list[tuple]:
    by_bucket: dict[int, list[tuple[bytes, bytes]]] = {}
    for key, places in told:
        by_bucket.setdefault(int.from_bytes(key[:4], "little") % buckets, []).append((key, places))
    return [
        (to, b"".join(k for k, _ in own), np.array([len(p) for _, p in own], "<u4").tobytes(), b"".join(p for _, p in own))
        for to, own in by_bucket.items()
    ]


def _gathering(table: pa.Table) -> pa.Table:
    """All places told to each text of a bucket."""
    hits: dict[bytes, list[bytes]] = {}
    for row in table.to_pylist():
        at = 0
        for i, size in enumerate(np.frombuffer(row["counts"], "<u4").tolist()):
            hits.setdefault(row["keys"][_KEY * i : _KEY * (i + 1)], []).append(row["places"][at : at + size])
            at += size
    return pa.Table.from_batches([_record([(key, b"".join(places)) for key, places in hits.items()], _HITS_ARROW)])


def _told(row: dict, live: np.ndarray | None) -> list[tuple[bytes, bytes]]:
    """(text key, places) of the live entries of one packed row; all of them for None."""
    counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
    place = np.cumsum(_unwidths(row["places"]))
    ends = np.cumsum(counts)
    begins = ends - counts
    place = place - np.repeat(np.concatenate([[0], place[ends[:-1] - 1]]), counts)
    out = []
    found = np.ones(len(counts), bool) if live is None else np.add.reduceat(live.astype(np.int64), begins) > 0
    for i in np.flatnonzero(found):
        here = place[begins[i] : ends[i]]
        if live is not None:
            here = here[live[begins[i] : ends[i]]]
        out.append((row["keys"][_KEY * i : _KEY * (i + 1)], here.astype("<u4").tobytes()))
    return out


_RESULT = "key binary, n_words long, n_removed long, kept_runs array<struct<start:long,end:long>>, kept_sha256 string"
_RESULT_ARROW = pa.schema([("key", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_runs", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string())])


def _removing(window: int):
    """What is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in textscan.slices(batch, "text"):
                rows = zip(*(piece.column(c).to_pylist() for c in ("key", "text", "hits")), strict=True)
                yield _record([(key, *_left_over(text.encode().split(), places, window)) for key, text, places in rows], _RESULT_ARROW)

    return run


def _left_over(words: list[bytes], places: bytes | None, window: int) -> tuple:
    step = np.zeros(len(words) + 1, np.int64)
    if places:
        at = np.frombuffer(places, "<u4").astype(np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
    kept = np.cumsum(step[:-1]) == 0
    edges = np.flatnonzero(np.diff(kept.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
    text = b" ".join(b" ".join(words[a:b]) for a, b in edges)
    runs = [{"start": a, "end": b} for a, b in edges]
    return len(words), len(words) - int(kept.sum()), runs, hashlib.sha256(text).hexdigest()


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_removed``, ``kept_runs``, ``kept_sha256``
    and ``kept_text``.

    Words are the longest runs of anything but space, tab, line breaks, vertical
    tab and form feed. A word goes if it lies in ``window`` consecutive words that
    also start anywhere else, in another row or the same text. ``kept_runs`` are the
    maximal runs of kept words, numbered from 0, ends excluded; ``kept_text`` joins
    the kept words by single spaces, ``kept_sha256`` is its digest. Null and empty
    texts have no words and keep "". Equal rows are copies of each other. Other
    columns are left as they are, columns of the same names are replaced.
    """
    if window < 3:
        raise ValueError("windows of at least three words are needed")
    block = (window + 1) // 2
    body = F.coalesce(F.col(text), F.lit(""))
    # never null, so that no join adds a filter: all uses of `distinct` then share one shuffle
    keyed = docs.withColumn("__key", F.coalesce(F.unhex(F.md5(body)), F.lit(b"")))
    distinct = (
        keyed.select(F.col("__key").alias("key"), body.alias("text"))
        .groupBy("key")
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    )
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))

    def answered(sent: DataFrame, kept_bytes: int) -> DataFrame:
        told = sent.groupBy("shard").applyInArrow(_answering(kept_bytes, shards), _TOLD)
        return told.groupBy("bucket").applyInArrow(_gathering, _HITS)

    hits = answered(distinct.mapInArrow(_probing(shards, window, block), _SENT), 4)
    around = distinct.join(hits, "key").mapInArrow(_extending(shards, window, block), _SENT)
    repeats = answered(around, 12)
    result = distinct.join(repeats, "key", "left").mapInArrow(_removing(window), _RESULT)
    new = [c for c in result.columns if c != "key"]
    words = F.regexp_extract_all(F.col("__body"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    kept = F.transform("kept_runs", lambda r: F.slice(words, r["start"].cast("int") + 1, (r["end"] - r["start"]).cast("int")))
    # the text itself meets the result only where the kept text is asked for
    return (
        keyed.withColumn("__body", body)
        .drop(*new, "kept_text")
        .join(result.withColumnRenamed("key", "__key"), "__key")
        .withColumn("kept_text", F.array_join(F.flatten(kept), " "))
        .drop("__key", "__body")
    )

"""Benchmark passages in documents, by Wu-Manber search over words.

The patterns are the windows of the benchmark items. For every pair of words a
shift table tells how far the search may jump, because no pattern can end
sooner; where it may not jump, the pair's hash selects the patterns that end
in it, and these are compared with the text word for word. All texts of a slice
are searched side by side, one position each per step.

The benchmark is read in blocks of bounded size, each sent to the workers on its
own; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm import rows, textscan

WINDOW = 10
#: Text of the benchmark items searched for in one pass, some tens of MB of patterns; more
#: items take more passes.
BLOCK_CHARS = 500_000
_LANE = 256


class _Group:
    """Patterns of one length with their shift table and suffix buckets."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str | None]]):
        self.length, self.pair = length, min(2, length)
        self.texts = list(patterns)
        self.items = [sorted(i for i in ids if i is not None) for ids in patterns.values()]
        flat = pa.array([b" ".join(words).decode() for words in self.texts])
        self.words = textscan.hashes(textscan.scan(flat, textscan.ALPHANUMERIC)).reshape(-1, length)
        blocks = self._blocks(self.words)
        self.slots = np.uint64((1 << max(12, int(blocks.size * 16).bit_length())) - 1)
        self.shift = np.full(int(self.slots) + 1, length - self.pair + 1, np.int64)
        for at in range(blocks.shape[1]):
            np.minimum.at(self.shift, (blocks[:, at] & self.slots).astype(np.int64), blocks.shape[1] - 1 - at)
        self.order = np.argsort(blocks[:, -1], kind="stable")
        self.suffix = blocks[self.order, -1]

    def _blocks(self, words: np.ndarray) -> np.ndarray:
        return words if self.pair == 1 else textscan.join(words[..., :-1], words[..., 1:])

    def search(self, words: textscan.Words, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence."""
        reach = self.length - 1
        starts, ends = words.first[:-1] + reach, words.first[1:]
        lanes = np.maximum(0, -(-(ends - starts) // _LANE))
        lane = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(starts, lanes) + lane * _LANE
        to = np.minimum(at + _LANE, np.repeat(ends, lanes))
        stops, found = [], []
        while len(at):
            block = hashed[at] if self.pair == 1 else textscan.join(hashed[at - 1], hashed[at])
            jump = self.shift[(block & self.slots).astype(np.int64)]
            stop = jump == 0
            stops.append(at[stop])
            found.append(block[stop])
            at = at + np.maximum(jump, 1)
            going = at < to
            at, to = at[going], to[going]
        if not stops:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, block = np.concatenate(stops), np.concatenate(found)
        low, high = np.searchsorted(self.suffix, block), np.searchsorted(self.suffix, block, side="right")
        n = high - low
        at = np.repeat(at, n) - reach
        pattern = self.order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
        for word in range(self.length):
            same = hashed[at + word] == self.words[pattern, word]
            at, pattern = at[same], pattern[same]
        same = [self._equal(words, a, self.texts[p]) for a, p in zip(at, pattern, strict=True)]
        return at[same], pattern[same]

    @staticmethod
    def _equal(words: textscan.Words, at: int, pattern: tuple[bytes, ...]) -> bool:
        return all(words.data[words.start[at + i] : words.end[at + i]].tobytes() == w for i, w in enumerate(pattern))


def _patterns(items: list[tuple[str | None, str | None]], window: int) -> list[_Group]:
    words = textscan.scan(pa.array([text for _, text in items], pa.string()), textscan.ALPHANUMERIC, lower=True)
    by_length: dict[int, dict[tuple[bytes, ...], set[str | None]]] = {}
    for i, (item, _) in enumerate(items):
        own = [words.data[words.start[k] : words.end[k]].tobytes() for k in range(words.first[i], words.first[i + 1])]
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            by_length.setdefault(size, {}).setdefault(tuple(own[at : at + size]), set()).add(item)
    return [_Group(size, patterns) for size, patterns in sorted(by_length.items())]


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list]:
    block, size = [], 0
    for row in benchmark.select(F.col(item).cast("string"), F.col(text)).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "") + 50
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_NEW = "n_words long, n_hit long, item_ids array<string>, hit_runs array<struct<start:long,end:long>>"


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit``, ``item_ids`` and ``hit_runs``.

    Words are runs of letters and digits of ASCII, lower-cased, and of everything
    beyond ASCII. An item's windows are its runs of ``window`` words; an item of
    fewer words, but not none, is one window. A word inside any occurrence of a
    window is hit; ``item_ids`` are the sorted ids, as text, of the items with
    occurring windows, each once; ``hit_runs`` are the maximal runs of hit words.
    Null and empty texts have no words. An item without id hits words but is not
    listed. Columns of the same names are replaced.
    """
    context = docs.sparkSession.sparkContext
    found = rows.append(docs, text, _NEW, lambda: _no_hits)
    for block in _blocks(benchmark, item, item_text, block_chars):
        groups = context.broadcast(_patterns(block, window))
        found = _marked(found, text, groups)
    return found


def _no_hits(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
    words = textscan.scan(texts, textscan.ALPHANUMERIC, lower=True)
    nothing = [[] for _ in range(piece.num_rows)]
    return [
        pa.array(words.count, pa.int64()),
        pa.array(np.zeros(piece.num_rows), pa.int64()),
        pa.array(nothing, pa.list_(pa.string())),
        pa.array(nothing, _RUNS),
    ]


def _marked(docs: DataFrame, text: str, groups) -> DataFrame:
    def make():
        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            words = textscan.scan(texts, textscan.ALPHANUMERIC, lower=True)
            hashed = textscan.hashes(words)
            step = np.zeros(len(words.start) + 1, np.int64)
            items = [set(x) for x in piece.column("item_ids").to_pylist()]
            for i, runs in enumerate(piece.column("hit_runs").to_pylist()):
                for r in runs:
                    step[words.first[i] + r["start"]] += 1
                    step[words.first[i] + r["end"]] -= 1
            for group in groups.value:
                at, pattern = group.search(words, hashed)
                np.add.at(step, at, 1)
                np.add.at(step, at + group.length, -1)
                pairs = set(zip((np.searchsorted(words.first, at, side="right") - 1).tolist(), pattern.tolist(), strict=True))
                for row, p in pairs:
                    items[row].update(group.items[p])
            hit = np.cumsum(step[:-1]) > 0
            n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])
            runs = [[] for _ in items]
            for i in np.flatnonzero(n_hit):
                own = hit[words.first[i] : words.first[i + 1]].astype(np.int8)
                edges = np.flatnonzero(np.diff(own, prepend=0, append=0)).reshape(-1, 2)
                runs[i] = [{"start": int(a), "end": int(b)} for a, b in edges]
            return [
                pa.array(words.count, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                pa.array(runs, _RUNS),
            ]

        return work

    return rows.append(docs, text, _NEW, make)


def clean_of(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no passage of the benchmark occurs, unchanged."""
    names = docs.columns
    if not set(names) & {"n_words", "n_hit", "item_ids", "hit_runs"}:
        return find_passages(docs, benchmark, **options).filter(F.col("n_hit") == 0).select(*names)
    marked = find_passages(docs.select(F.struct(*names).alias("row"), "text"), benchmark, **options)
    return marked.filter(F.col("n_hit") == 0).select("row.*")

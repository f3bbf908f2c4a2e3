"""Language of a text by words first, then by ever shorter character runs.

Known words score by their log frequency in each language. An unseen word is read
from left to right: at each place the longest known run of characters counts, from
four down to one; their mean is the word's score.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm import rows, textscan
from wakeline.llm.ordered import written

#: Size of the model: the most frequent words and runs that are kept, counted over all training texts.
MAX_WORDS = 200_000
MAX_RUNS = 100_000
MIN_COUNT = 2
LONGEST_RUN = 4
#: Longer words are never known ones; their runs count.
MAX_WORD_CHARS = 40
UNKNOWN = "und"

_FLUSH = 150_000
#: What a worker keeps of unseen words.
_UNSEEN_BYTES = 4 << 20
#: Log frequencies are whole numbers of this part, so that sums do not depend on their order.
_ONE = 1 << 20


def _words_only(texts: pa.Array) -> pa.Array:
    """Lower-cased letters, everything else a space."""
    return pc.replace_substring_regex(pc.utf8_lower(texts.fill_null("")), r"[^\p{L}]+", " ")


def _runs(word: str) -> Iterator[str]:
    padded = f" {word} "
    for n in range(1, LONGEST_RUN + 1):
        for i in range(len(padded) - n + 1):
            yield padded[i : i + n]


_COUNTS = "lang string, unit string, n long"


def _table(counts: dict[str, Counter]) -> pa.RecordBatch:
    langs = [lang for lang, own in counts.items() for _ in own]
    units = [unit for own in counts.values() for unit in own]
    n = [n for own in counts.values() for n in own.values()]
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(units, pa.string()), pa.array(n, pa.int64())], names=["lang", "unit", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for piece in textscan.slices(batch, "text"):
            for lang, text in zip(piece.column("lang").to_pylist(), _words_only(piece.column("text")).to_pylist(), strict=True):
                counts[lang].update(text.split())
            if sum(map(len, counts.values())) >= _FLUSH:
                yield _table(counts)
                counts.clear()
    yield _table(counts)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "unit", "n")), strict=True):
            own = counts[lang]
            for run in _runs(word):
                own[run] += n
        if sum(map(len, counts.values())) >= _FLUSH:
            yield _table(counts)
            counts.clear()
    yield _table(counts)


class Model:
    """``langs`` in order; hashes of the known words, sorted, and of the known runs a
    row number; one row of log frequencies for each."""

    def __init__(self, langs: list[str], words: list[str], runs: list[str], counts: np.ndarray):
        self.langs = langs
        values = np.empty_like(counts)
        for part in (slice(0, len(words)), slice(len(words), None)):
            smooth = counts[part] + 0.5
            values[part] = np.log(smooth / smooth.sum(axis=0)) if len(smooth) else smooth
        values = np.rint(values * _ONE).astype(np.int64)
        hashed = textscan.hashes(textscan.scan(pa.array(words, pa.string())))
        order = np.argsort(hashed)
        self.known, self.word_values = hashed[order], values[: len(words)][order]
        self.runs, self.run_values = {run: i for i, run in enumerate(runs)}, values[len(words) :]


def _most_frequent(counts: DataFrame, langs: list[str], limit: int, least: int) -> tuple[list[str], np.ndarray]:
    """Units by count, at most ``limit`` of them: all from some count upwards, with their counts
    by language. The count is read off a histogram, so that no more than the
    chosen rows go to the driver, as columns."""
    own = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)]
    by_unit = counts.groupBy("unit").agg(F.sum("n").alias("total"), *own).filter(F.col("total") >= least)
    level = F.floor(F.log2("total") * 32).cast("int")
    kept, room = [], limit
    for row in sorted(by_unit.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        room -= row["n"]
        if room < 0:
            break
        kept.append(row["level"])
    if not kept:
        return [], np.zeros((0, len(langs)))
    table = by_unit.filter(level >= min(kept)).drop("total").toArrow().sort_by("unit")
    columns = [table.column(f"n{i}").to_numpy() for i in range(len(langs))]
    return table.column("unit").to_pylist(), np.stack(columns, axis=1).astype(np.float64)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, max_runs: int = MAX_RUNS) -> Model:
    """A model of all rows of ``labelled`` that have a text and a language.

    Words and runs are counted over all of them; the most frequent words (of those found
    twice) and runs are the model, down to a count at which there are at most
    ``max_words`` and ``max_runs``. No more rows go to the driver and the workers.
    """
    used = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    words = written(used.mapInArrow(_count_words, _COUNTS).groupBy("lang", "unit").agg(F.sum("n").alias("n")), "words")
    runs = written(words.mapInArrow(_count_runs, _COUNTS).groupBy("lang", "unit").agg(F.sum("n").alias("n")), "runs")
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    top_words, of_words = _most_frequent(words.filter(F.length("unit") <= MAX_WORD_CHARS), langs, max_words, MIN_COUNT)
    top_runs, of_runs = _most_frequent(runs, langs, max_runs, 1)
    return Model(langs, top_words, top_runs, np.concatenate([of_words, of_runs]))


class Reader:
    """Scores texts; what unseen words amount to is kept for a while."""

    def __init__(self, model: Model):
        self.model = model
        # a row number for each unseen word, in a table of fixed size; an entry of the map takes some 150 bytes
        self.unseen: dict[int, int] = {}
        self.kept = np.zeros((max(1, _UNSEEN_BYTES // (150 + 8 * max(1, len(model.langs)))), len(model.langs)), np.int64)

    def longest(self, word: str) -> list[int]:
        """Rows of the longest known run at each place of the word."""
        padded, runs, found = f" {word} ", self.model.runs, []
        for i in range(len(padded)):
            for n in range(min(LONGEST_RUN, len(padded) - i), 0, -1):
                at = runs.get(padded[i : i + n])
                if at is not None:
                    found.append(at)
                    break
        return found

    def _backoff(self, words: textscan.Words, hashed: np.ndarray, at: np.ndarray) -> np.ndarray:
        values = np.zeros((len(at), len(self.model.langs)), np.int64)
        for k, (i, key) in enumerate(zip(at.tolist(), hashed[at].tolist(), strict=True)):
            row = self.unseen.get(key)
            if row is None:
                found = self.longest(words.data[words.start[i] : words.end[i]].tobytes().decode())
                if len(self.unseen) >= len(self.kept):
                    self.unseen.clear()
                row = self.unseen[key] = len(self.unseen)
                self.kept[row] = self.model.run_values[found].sum(axis=0) // max(1, len(found))
            values[k] = self.kept[row]
        return values

    def judge(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        model, n = self.model, len(texts)
        words = textscan.scan(_words_only(texts))
        if not model.langs or not len(words.start):
            return [UNKNOWN] * n, [0.0] * n
        hashed = textscan.hashes(words)
        values = np.zeros((len(hashed), len(model.langs)), np.int64)
        known = np.zeros(len(hashed), bool)
        if len(model.known):
            at = np.minimum(np.searchsorted(model.known, hashed), len(model.known) - 1)
            known = model.known[at] == hashed
            values[known] = model.word_values[at[known]]
        rest = np.flatnonzero(~known)
        if len(rest):
            _, first, inverse = np.unique(hashed[rest], return_index=True, return_inverse=True)
            values[rest] = self._backoff(words, hashed, rest[first])[inverse]
        sums = np.concatenate([np.zeros((1, len(model.langs)), np.int64), np.cumsum(values, axis=0)])[words.first]
        total = np.diff(sums, axis=0)
        best = total.argmax(axis=1)
        lead = (total - total.max(axis=1, keepdims=True)) / _ONE
        score = 1 / np.exp(lead).sum(axis=1)
        some = words.count > 0
        return (
            [model.langs[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)],
            np.where(some, score, 0.0).tolist(),
        )


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the best language in the
    probabilities of all.

    A text that is null or has no letter, and any text if the model has learned nothing, is
    ``und`` with score 0. Equal scores go to the first language by name. Columns of
    the same names are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        reader = Reader(known.value)

        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            langs, scores = reader.judge(texts)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return work

    return rows.append(docs, text, "lang_pred string, score double", make)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a row without an id is one of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))

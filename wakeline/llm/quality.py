"""Quality rules: counts per text and a likelihood ratio against the raw corpus.

The verdict of the method: runs of four bytes are hashed into a fixed number of
buckets; the buckets' counts over all documents and over trusted ones are two
multinomials. A text's score is the mean log ratio of the two over its runs.
Counts are summed in integers and logs are rounded once, so a text's score does not
depend on how texts are grouped into tasks.

A few toxic words do not move a mean over a whole text. They have a ratio of their own: of
words and pairs of words, by 64-bit hashes, over the texts of toxic and of trusted rows
that hold them; a text has the greatest ratio of any of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm import rows, textscan

GRAM = 4
BUCKET_BITS = 16
#: At most this many labelled rows of each kind are used.
LABELLED_ROWS = 20_000
MIN_WORDS = 50
MOST_REPEATED = 0.5
#: Pseudo-counts, as a share of one run per bucket, that pull the trusted counts to the raw ones.
SMOOTHING = 1.0

#: A word or pair tells toxic texts only if as many toxic rows hold it and its ratio is as high.
TOXIC_ROWS = 5
LEAST_TOXIC_RATIO = 1.0

_ONE = 1 << 20
_SYMBOLS = np.zeros(256, dtype=np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the run at each byte, and whether it ends in the same text."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    run = np.zeros(n, np.uint64)
    for i in range(GRAM):
        run |= data[i : n + i].astype(np.uint64) << np.uint64(8 * i)
    bucket = (textscan.mix(run) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    whole = np.ones(n, bool)
    for end in offsets[1:-1]:
        whole[max(0, end - GRAM + 1) : end] = False
    return bucket, whole


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, trusted = (np.zeros(1 << BUCKET_BITS, np.int64) for _ in range(2))
    for batch in batches:
        for piece in textscan.slices(batch, "text"):
            data, offsets = textscan.text_bytes(piece.column("text"))
            bucket, whole = _grams(data, offsets)
            raw += np.bincount(bucket[whole], minlength=len(raw))
            chosen = piece.column("use").fill_null("").to_numpy(zero_copy_only=False) == "target"
            if chosen.any():
                own = whole & np.repeat(chosen, np.diff(offsets))[: len(whole)]
                trusted += np.bincount(bucket[own], minlength=len(raw))
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": seen, "raw": raw[seen], "trusted": trusted[seen]})


def _sampled(labels: DataFrame, doc_id: str, limit: int) -> DataFrame:
    """Of trusted rows one half is the target and one half sets the threshold."""
    own = labels.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    trusted, bad = F.expr("quality = 1 AND coalesce(toxic, 0) = 0"), F.expr("quality = 0")
    counts = own.agg(F.count_if(trusted), F.count_if(bad)).first()

    def share(n: int):
        # a little under the limit, so that chance does not carry the choice over it
        part = min(1.0, 0.95 * limit / n) if n > limit else 1.0
        return F.pmod(F.xxhash64(F.lit(7), doc_id), F.lit(1 << 30)) < int(part * (1 << 30))

    good, poor = own.filter(trusted & share(counts[0])), own.filter(bad & share(counts[1]))
    half = F.when(F.pmod(F.xxhash64(F.lit(8), doc_id), F.lit(2)) == 0, "target").otherwise("good")
    return good.select(doc_id, half.alias("use")).unionByName(poor.select(doc_id, F.lit("poor").alias("use")))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LABELLED_ROWS) -> tuple[np.ndarray, float]:
    """Log ratio per bucket (integers, 2**20 to the nat) and the least mean that is kept.

    The raw counts cover all of ``docs``. ``labels`` (``doc_id``, ``quality``,
    ``toxic``) gives at most ``limit`` trusted rows (quality 1, not toxic) and as many
    poor ones, chosen by hash. The threshold lies half way between the trusted rows'
    first and the poor rows' last percentile; without poor rows, at the former;
    without trusted rows all ratios are zero and everything is kept.
    """
    # broadcast: at most 2 * limit ids
    used = F.broadcast(_sampled(labels, doc_id, limit))
    marked = docs.select(doc_id, F.col(text).alias("text")).join(used, doc_id, "left")
    counted = marked.select("text", "use").mapInArrow(_counting, "bucket long, raw long, trusted long")
    # one row per bucket: 2 ** BUCKET_BITS at most
    sums = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("trusted")).collect()
    raw, trusted = (np.zeros(1 << BUCKET_BITS) for _ in range(2))
    for bucket, n, m in sums:
        raw[bucket], trusted[bucket] = n, m
    if not trusted.sum():
        return np.zeros(len(raw), np.int64), -np.inf
    prior = SMOOTHING * len(raw) * raw / raw.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.log((trusted + prior) / (trusted.sum() + prior.sum())) - np.log(raw / raw.sum())
    ratio = np.rint(np.where(raw > 0, ratio, 0) * _ONE).astype(np.int64)
    judged = _scored(marked.filter("use IN ('good', 'poor')"), "text", ratio).groupBy("use")
    cuts = {r[0]: r[1:] for r in judged.agg(F.expr("percentile(llr, 0.01)"), F.expr("percentile(llr, 0.99)")).collect()}
    if "good" not in cuts:
        return ratio, -np.inf
    low = cuts["good"][0]
    return ratio, (low + min(low, cuts["poor"][1])) / 2 if "poor" in cuts else low


def _scored(docs: DataFrame, text: str, ratio: np.ndarray) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast(ratio)

    def make():
        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            data, offsets = textscan.text_bytes(texts)
            bucket, whole = _grams(data, offsets)
            value = np.zeros(len(data), np.int64)
            value[: len(bucket)] = np.where(whole, table.value[bucket], 0)
            total = np.diff(np.concatenate([[0], np.cumsum(value)])[offsets])
            n = np.maximum(np.diff(offsets) - GRAM + 1, 0)
            mean = total / np.maximum(n, 1) / _ONE
            return [pa.array(n, pa.int64()), pa.array(mean, pa.float64())]

        return work

    return rows.append(docs, text, "n_grams long, llr double", make)


def _word_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words and pairs of all texts, and the text of each."""
    words = textscan.scan(texts, lower=True)
    single = textscan.hashes(words)
    pairs = textscan.windows(single, 2)
    whole = np.flatnonzero(textscan.inside_one_text(words, 2)) if len(pairs) else np.zeros(0, np.int64)
    value, text = np.concatenate([single, pairs[whole]]), np.concatenate([words.text, words.text[whole]])
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[first].view(np.int64), text[first]


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in textscan.slices(batch, "text"):
            value, text = _word_grams(piece.column("text"))
            toxic = (piece.column("use").to_numpy(zero_copy_only=False) == "toxic")[text]
            grams, at = np.unique(value, return_inverse=True)
            n = np.bincount(at[toxic], minlength=len(grams))
            yield pa.RecordBatch.from_pydict({"gram": grams, "toxic": n, "trusted": np.bincount(at, minlength=len(grams)) - n})


def fit_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LABELLED_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes of words and pairs that tell toxic texts, sorted, the log ratio of each, and the
    greatest that is kept.

    Learned from at most ``limit`` toxic rows of either quality and as many trusted ones,
    chosen by hash; the limit is the last percentile of the half of the trusted ones that is held
    back. Without toxic or trusted rows nothing is learned and everything is kept.
    """
    own = labels.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    toxic = own.filter("toxic = 1")
    part = min(1.0, 0.95 * limit / max(1, toxic.count()))
    toxic = toxic.filter(F.pmod(F.xxhash64(F.lit(7), doc_id), F.lit(1 << 30)) < int(part * (1 << 30)))
    trusted = _sampled(labels, doc_id, limit).filter("use IN ('target', 'good')")
    # broadcast: at most 2 * limit ids
    used = F.broadcast(toxic.select(doc_id, F.lit("toxic").alias("use")).unionByName(trusted))
    marked = docs.select(doc_id, F.col(text).alias("text")).join(used, doc_id)
    sizes = dict(marked.groupBy("use").count().collect())
    nothing = np.zeros(0, np.int64), np.zeros(0), np.inf
    if not sizes.get("toxic") or not sizes.get("target"):
        return nothing
    held = marked.filter("use <> 'good'").select("text", "use").mapInArrow(_holding, "gram long, toxic long, trusted long")
    sums = held.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("trusted").alias("trusted"))
    ratio = F.log((F.col("toxic") + 1) / (sizes["toxic"] + 2.0)) - F.log((F.col("trusted") + 1) / (sizes["target"] + 2.0))
    # what many labelled toxic rows share: bounded by their number
    told = sums.filter(F.col("toxic") >= TOXIC_ROWS).select("gram", ratio.alias("ratio")).filter(F.col("ratio") >= LEAST_TOXIC_RATIO).orderBy("gram").collect()
    if not told:
        return nothing
    grams, ratios = np.array([t[0] for t in told], np.int64), np.array([t[1] for t in told])
    good = _toxicity(marked.filter("use = 'good'"), "text", grams, ratios).agg(F.expr("percentile(toxic_ratio, 0.99)")).first()[0]
    return grams, ratios, 0.0 if good is None else good


def _toxicity(docs: DataFrame, text: str, grams: np.ndarray, ratios: np.ndarray) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast((grams, ratios))

    def make():
        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            known, ratio = table.value
            most = np.zeros(piece.num_rows)
            if len(known):
                value, own = _word_grams(texts)
                at = np.minimum(np.searchsorted(known, value), len(known) - 1)
                hit = known[at] == value
                np.maximum.at(most, own[hit], ratio[at[hit]])
            return [pa.array(most, pa.float64())]

        return work

    return rows.append(docs, text, "toxic_ratio double", make)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and
    ``n_repeat_words``; all zero for null and empty texts.

    Words are runs of anything but white space of ASCII; ``word_chars`` are their
    code points. Lines count as duplicates if they hold a word and equal an earlier
    line of the text. A word is repeated if it lies in three words found twice or more
    in the text.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.append(docs, text, ", ".join(f"{n} long" for n in names), lambda: _measured)


def _measured(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
    words = textscan.scan(texts)

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values)])[words.offsets])

    points = ((words.data & 0xC0) != 0x80) & textscan.SPACED[words.data]
    lines = []
    for text in texts.to_pylist():
        filled = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        lines.append(len(filled) - len(set(filled)))
    step = np.zeros(len(words.start) + 1, np.int64)
    runs = textscan.windows(textscan.hashes(words), 3)
    at = np.flatnonzero(textscan.inside_one_text(words, 3)) if len(runs) else np.zeros(0, np.int64)
    if len(at):
        own = textscan.join(runs[at], words.text[at].astype(np.uint64))
        _, group, times = np.unique(own, return_inverse=True, return_counts=True)
        again = at[times[group] > 1]
        np.add.at(step, again, 1)
        np.add.at(step, again + 3, -1)
    repeated = np.diff(np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])[words.first])
    columns = (words.count, per_text(points), per_text(_SYMBOLS[words.data]), np.array(lines), repeated)
    return [pa.array(c, pa.int64()) for c in columns]


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LABELLED_ROWS) -> DataFrame:
    """``docs`` with the columns of ``measure``, ``n_grams``, ``llr``, ``toxic_ratio``, ``base_failed`` and
    ``kept``.

    ``base_failed``: under 50 words, or more than half of them repeated. ``kept``:
    not failed, ``llr`` at least the threshold of ``fit`` and ``toxic_ratio`` at most that of
    ``fit_toxic``. A text of fewer than four
    bytes has ratio zero. Columns of the same names are replaced.
    """
    ratio, least = fit(docs, labels, text, doc_id, limit)
    grams, ratios, most = fit_toxic(docs, labels, text, doc_id, limit)
    scored = _toxicity(_scored(measure(docs, text), text, ratio), text, grams, ratios)
    failed: Column = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(float(least))) & (F.col("toxic_ratio") <= F.lit(float(most))))

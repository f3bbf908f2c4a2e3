"""Near copies by SimHash, compared at the anchors of a covering code.

Two fingerprints of 64 bits with at most three differing bits have at most one in one of
their halves. In each half the anchors are the words of the perfect Hamming code of
31 bits with one free bit: every half lies within one bit of an anchor, its home. A
fingerprint is sent to every anchor within covering radius plus threshold, 1 + 1 bits, so it
meets there each one whose home that is and whose half differs in at most one bit.
(On all 64 bits at once the same would take more than ten thousand copies of each.)

Fingerprints are made distinct before they are sent. At an anchor only links that join
what was apart are kept, so that links do not grow with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm import rows
from wakeline.llm.components import components
from wakeline.llm.ordered import written

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Shingles whose bits are counted at once.
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        some = zip(starts[at : at + _AT_ONCE], ends[at : at + _AT_ONCE], strict=True)
        hashed = np.array([digest(plain[a:b], SEED) for a, b in some], "<u8")
        ones += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``bits``: the fingerprint as a signed 64-bit integer."""

    def make():
        def work(piece: pa.RecordBatch, texts: pa.Array) -> list[pa.Array]:
            own = np.array([fingerprint(x, shingle) for x in texts.to_pylist()], np.uint64)
            return [pa.array(own.view(np.int64), pa.int64())]

        return work

    return rows.append(docs, text, "bits long", make)


#: For each of the five check bits, the positions (1 to 31) whose number has it.
_CHECKS = [sum(1 << (p - 1) for p in range(1, 32) if p >> bit & 1) for bit in range(5)]
_FREE = 1 << 31


def _syndrome(half: Column) -> Column:
    """The position whose change makes the lower 31 bits a code word, or 0."""
    bits = [F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))) % 2 * (1 << i) for i, mask in enumerate(_CHECKS)]
    return sum(bits[1:], bits[0]).cast("int")


def _flips() -> list[list[int]]:
    """By syndrome: what to change to reach each anchor within two bits, the home first."""
    out = []
    for s in range(32):
        home = 1 << (s - 1) if s else 0
        pairs = [(1 << (p - 1)) | (1 << ((p ^ s) - 1)) for p in range(1, 32) if p < p ^ s and p ^ s] if s else []
        out.append([home, home | _FREE, *pairs])
    return out


def _replicas(prints: DataFrame) -> DataFrame:
    halves = prints.select(
        "bits",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("bits").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")),
                F.struct(F.lit(1).alias("side"), F.shiftrightunsigned("bits", 32).alias("half")),
            )
        ).alias("x"),
    ).select("bits", "x.side", "x.half")
    table = F.array(*[F.array(*[F.lit(f).cast("long") for f in row]) for row in _flips()])
    sent = halves.withColumn("flips", F.get(table, _syndrome(F.col("half"))))
    return sent.select("bits", "side", "half", F.posexplode("flips").alias("n", "flip")).select(
        (F.shiftleft(F.col("half").bitwiseXOR(F.col("flip")), 1) + F.col("side")).alias("anchor"), "bits", (F.col("n") == 0).alias("home")
    )


def _linked(bits: np.ndarray, home: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between fingerprints of one anchor that join what was apart."""
    group = np.arange(len(bits))
    # unsigned: of negative numbers numpy counts the bits of the absolute value
    prints = bits.view(np.uint64)
    out = []
    for i in np.flatnonzero(home):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= threshold)
        labels, first = np.unique(group[near], return_index=True)
        if len(labels) > 1:
            out += [(i, int(near[k])) for label, k in zip(labels, first, strict=True) if label != group[i]]
            group[np.isin(group, labels)] = labels[0]
    return out


def _comparing(threshold: int):
    """Partitions come sorted by anchor; a group may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, bits, home = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

        def flush(upto: int) -> pa.RecordBatch:
            begins = np.flatnonzero(np.diff(anchor[:upto], prepend=~anchor[0]))
            sizes = np.diff(begins, append=upto)
            pairs = []
            for at, n in zip(begins[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                own, at_home = bits[at : at + n], home[at : at + n]
                if at_home.any():
                    pairs += [(own[a], own[b]) for a, b in _linked(own, at_home, threshold)]
            both = np.array(pairs, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_pydict({"src": both[:, 0], "dst": both[:, 1]})

        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            anchor, bits, home = (np.concatenate(x) for x in zip((anchor, bits, home), new, strict=True))
            if len(anchor):
                upto = int(np.searchsorted(anchor, anchor[-1]))
                if upto:
                    yield flush(upto)
                    anchor, bits, home = anchor[upto:], bits[upto:], home[upto:]
        if len(anchor):
            yield flush(len(anchor))

    return run


def links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``src`` and ``dst``: links between different ``bits`` that connect the same classes as
    all pairs with at most ``threshold`` (up to 3) differing bits do."""
    if not 0 <= threshold <= THRESHOLD:
        raise ValueError("the anchors cover up to three differing bits")
    sent = _replicas(prints.select("bits").distinct())
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = sent.repartition(partitions, "anchor").sortWithinPartitions("anchor").select("anchor", "bits", "home")
    return met.mapInArrow(_comparing(threshold), "src long, dst long")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``bits`` and ``component_id``.

    Words are runs of anything but white space of ASCII, A-Z lower-cased; a
    fingerprint counts every shingle as often as it occurs. Fewer words than a shingle
    are one; no words (null, empty) give fingerprint zero, which links like any other.
    ``component_id`` is the smallest document id among all rows that can be reached
    over links; null only where no such row has an id. Equal texts are linked.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = written(fingerprints(given, "text", shingle).select("doc_id", "bits"), "fingerprints")
    smallest = marked.groupBy("bits").agg(F.min("doc_id").alias("least"))
    roots = components(links(smallest, threshold))
    known = smallest.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(known.join(ids, "root").select("bits", "component_id"), "bits")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row of every class, unchanged: that of the smallest document id (null last), then
    of the smallest digest of the text; of equal rows any one."""
    key = F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit(""))
    keyed = docs.withColumn("__key", key).withColumn("__digest", F.md5(F.coalesce(F.col(text), F.lit(""))))
    place = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("__key").alias("key"), F.col("__digest").alias("digest"))
    marked = fingerprints(keyed.select(place.alias("place"), F.col(text).alias("body")), "body", shingle).select("place", "bits")
    marked = written(marked, "fingerprints")
    smallest = marked.groupBy("bits").agg(F.min("place").alias("least"))
    roots = components(links(smallest, threshold))
    known = smallest.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    chosen = known.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.key").alias("__key"), F.col("least.digest").alias("__digest"))
    kept = keyed.join(chosen, ["__key", "__digest"], "left_semi")
    number = F.row_number().over(Window.partitionBy("__key", "__digest").orderBy("__key"))
    return kept.withColumn("__number", number).filter("__number = 1").select(*docs.columns)

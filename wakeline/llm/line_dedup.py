"""Removal of repeated line runs, by a suffix array over line ids.

The ids of a document's lines are a sequence; all its suffixes are ranked by prefix
doubling: by their first line, then by pairs of ranks 1, 2, 4, ... lines apart.
Suffixes of equal rank at a depth are an interval of the suffix array whose longest
common prefix reaches that depth. A repeated run counts from ``min_lines`` lines on,
so the doubling ends there: the intervals of that depth hold every repeated run, and
their members next to each other in a document join to maximal runs.

Suffixes that are alone at some depth begin no repeated run and are dropped there.
Ranks are running counts over blocks of the sorted distinct keys, joined back to
the lines; a line that makes up a third of all of them is one key with a count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.ordered import blocks, written

MIN_LINES = 2
LONG_LINE_CHARS = 120

_WORD = r"[^\x20\x09-\x0D]"


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """The ``suffixes`` whose ``keys`` others have too, with ``rank``: how many of these
    have smaller keys."""
    groups = suffixes.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    cut = blocks(groups, *keys)
    within = Window.partitionBy("block").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # one row per block
    totals = cut.groupBy("block").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("carried"))
    ranks = cut.withColumn("here", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(carried), "block")
    ranks = ranks.select(*keys, (F.col("here") + F.col("carried")).alias("rank"))
    return suffixes.drop("rank").join(ranks, keys)


def _later(suffixes: DataFrame) -> DataFrame:
    """Without the first one of each rank, in document order."""
    first = suffixes.groupBy("rank").agg(F.min("place").alias("first"))
    return suffixes.join(first, "rank").filter(F.col("place") > F.col("first")).drop("first")


def _lines(docs: DataFrame, doc_id: str, text: str, long_line_chars: int) -> DataFrame:
    """Lines with a word: document, number among these, number among all, digest."""
    numbered = F.expr("transform(split(body, '\n', -1), (x, i) -> struct(i AS pos, x AS line))")
    own = docs.filter(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.unhex(F.md5(text)).alias("digest"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("body")
    )
    filled = own.select("id", "digest", "row", F.posexplode(F.filter(numbered, lambda x: x["line"].rlike(_WORD))).alias("seq", "at"))
    return filled.select(
        "id", "digest", "row", "seq", F.col("at.pos").alias("pos"), F.unhex(F.md5("at.line")).alias("line"), (F.length("at.line") >= long_line_chars).alias("long")
    )


def _runs(lines: DataFrame, min_lines: int) -> DataFrame:
    """Maximal runs of removed lines: ``id``, ``digest``, ``row``, ``start``, ``end``."""
    place = F.struct(F.col("id").isNull().alias("none"), "id", "digest", "row", "seq")
    repeated = _ranked(lines.withColumn("place", place).select("place", "pos", "line", "long"), ["line"]).drop("line")
    again = _later(repeated.filter("long")).select("place")
    own = Window.partitionBy("place.row").orderBy("place.seq")
    suffixes, depth = repeated, 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        # a suffix whose other half is alone, or beyond the end, is alone itself
        tail = F.when(F.lead("place.seq", step).over(own) == F.col("place.seq") + step, F.lead("rank", step).over(own))
        pairs = suffixes.withColumn("head", F.col("rank")).withColumn("tail", tail).filter("tail IS NOT NULL")
        depth += step
        suffixes = _ranked(pairs, ["head", "tail"]).drop("head", "tail")
    starts = _later(suffixes).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(min_lines - 1)), lambda i: F.struct(F.col("place.row").alias("row"), (F.col("place.seq") + i).alias("seq")))).alias("x"))
    gone = starts.select("x.row", "x.seq").union(again.select("place.row", "place.seq")).distinct()
    removed = repeated.select("place.id", "place.digest", "place.row", "place.seq", "pos").join(gone, ["row", "seq"])
    island = Window.partitionBy("row").orderBy("pos")
    return (
        removed.withColumn("island", F.col("pos") - F.row_number().over(island))
        .groupBy("id", "digest", "row", "island")
        .agg(F.min("pos").cast("long").alias("start"), (F.max("pos") + 1).cast("long").alias("end"))
        .drop("island")
    )


def _key(doc_id: Column) -> Column:
    """Never null, so that rows without an id meet too."""
    return F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit(""))


_NEW = ("n_lines", "n_removed", "removed_runs", "kept_text")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, long_line_chars: int = LONG_LINE_CHARS
) -> DataFrame:
    """Every row of ``docs`` with ``n_lines``, ``n_removed``, ``removed_runs`` and ``kept_text``.

    Lines are separated by ``\\n`` and compared exactly; lines without a word are kept
    and skipped over by runs. A line is removed if it lies in ``min_lines`` consecutive lines
    that occur earlier, or has ``long_line_chars`` characters and occurs earlier. Earlier:
    in a smaller document id (null last; then by the text's digest; equal rows in the
    order they are read) or further up in the same text. ``removed_runs`` are the maximal
    runs of removed lines by number from 0, ends excluded. Null texts have no lines and
    stay null; an empty text is one line. Other columns are left as they are, columns
    of the same names are replaced.
    """
    lines = written(_lines(docs, doc_id, text, long_line_chars), "lines")
    runs = _runs(lines, min_lines).groupBy("id", "digest", "row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))
    # of rows equal in id and text the first loses what occurs in other rows, the others are alike
    first = lines.groupBy("id", "digest").agg(F.min("row").alias("first"), F.max("row").alias("last")).filter("first < last")
    runs = runs.join(first.select(F.col("id").alias("of"), F.col("digest").alias("with"), "first"), F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("with")), "left")
    is_first = F.coalesce(F.col("row") == F.col("first"), F.lit(True))
    runs = runs.groupBy(_key(F.col("id")).alias("__key"), F.col("digest").alias("__digest")).agg(
        F.first(F.when(is_first, F.col("runs")), ignorenulls=True).alias("__first"),
        F.first(F.when(~is_first, F.col("runs")), ignorenulls=True).alias("__copy"),
    )
    keyed = docs.drop(*_NEW).withColumn("__key", _key(F.col(doc_id))).withColumn("__digest", F.coalesce(F.unhex(F.md5(text)), F.lit(b"")))
    copy = F.row_number().over(Window.partitionBy("__key", "__digest").orderBy("__key"))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint>>")
    joined = keyed.withColumn("__number", copy).join(runs, ["__key", "__digest"], "left")
    joined = joined.withColumn("removed_runs", F.coalesce(F.when(F.col("__number") == 1, F.col("__first")).otherwise(F.col("__copy")), nothing))
    parts = F.split(F.col(text), "\n", -1)
    kept = F.filter(parts, lambda x, i: ~F.exists("removed_runs", lambda r: (i >= r["start"]) & (i < r["end"])))
    return (
        joined.withColumn("n_lines", F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long"))
        .withColumn("n_removed", F.aggregate("removed_runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"]))
        .withColumn("kept_text", F.when(F.col("n_removed") == 0, F.col(text)).otherwise(F.array_join(kept, "\n")))
        .select(*[c for c in docs.columns if c not in _NEW], *_NEW)
    )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the kept text in place of ``text``, without the rows whose every line with
    a word was removed."""
    names = docs.columns
    cut = remove_repeats(docs.select(doc_id, text, F.struct(*names).alias("__row")), doc_id, text, **options)
    stays = (F.col("n_removed") == 0) | F.coalesce(F.col("kept_text").rlike(_WORD), F.lit(True))
    return cut.filter(stays).select(*[F.col("kept_text").alias(c) if c == text else F.col("__row")[c].alias(c) for c in names])

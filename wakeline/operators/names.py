"""Search of vessel names through an inverted index of their trigrams.

A name can only contain a text whose trigrams it all has. The index narrows a search to such names, by
reading a few posting lists; the search itself is then run on these.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.config import DEFAULTS
from wakeline.operators.fleet import name_matches

GRAM = 3
INDEX = "trigram STRING, name STRING"
_QUANTIFIERS = "*?+{"


def trigrams(text: Column) -> Column:
    """The different runs of three characters, lower-cased; none for shorter texts."""
    folded = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(folded) - (GRAM - 1))
    cut = F.transform(starts, lambda i: F.substring(folded, i, F.lit(GRAM)))
    return F.when(F.length(folded) >= GRAM, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def name_index(positions: DataFrame, key: str = DEFAULTS.vessel_key) -> DataFrame:
    """``trigram, name``, one row per pair, from all names of ``positions``."""
    names = positions.select(F.col(key).cast("string").alias("name")).distinct()
    return names.select(F.explode(trigrams(F.col("name"))).alias("trigram"), "name")


def write_index(index: DataFrame, path: str) -> None:
    """In order of trigrams, so that a scan for a few of them passes over most of the table."""
    index.repartitionByRange("trigram").sortWithinPartitions("trigram").write.mode("overwrite").parquet(path)


def _closing(pattern: str, start: int, opening: str, closing: str) -> int:
    """Place after the bracket that closes the one at ``start``; the end if there is none."""
    depth, i = 0, start
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 2
            continue
        depth += (pattern[i] == opening) - (pattern[i] == closing)
        i += 1
        if not depth:
            return i
    return i


def required_runs(pattern: str, literal: bool = False) -> list[str]:
    """Texts that every match contains, lower-cased; empty if the pattern does not tell.

    Of a regular expression only plain characters outside of groups and classes are looked at, and
    nothing at all if it has alternatives or quotes.
    """
    if literal:
        return [pattern.lower()] if len(pattern) >= GRAM else []
    if "|" in pattern or "\\Q" in pattern or not pattern.isascii():
        return []
    runs, run, i = [], "", 0
    while i <= len(pattern):
        char = pattern[i : i + 1]
        if char == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            char, size = pattern[i + 1], 2
        elif char and char not in "\\.^$[](){}*+?":
            size = 1
        else:
            runs.append(run)
            run = ""
            if char == "[":
                # a bracket that comes first in a class is part of it
                first = i + 1 + (pattern[i + 1 : i + 2] == "^")
                i = _closing(pattern, first + 1, "", "]") if pattern[first : first + 1] == "]" else _closing(pattern, i, "[", "]")
            elif char == "(":
                i = _closing(pattern, i, "(", ")")
            elif char == "{":
                i = _closing(pattern, i, "{", "}")
            else:
                i += 2 if char == "\\" else 1
            continue
        following = pattern[i + size : i + size + 1]
        i += size
        if following and following in _QUANTIFIERS:
            # the character may be missing, or come again: what is before and after it need not meet
            runs.append(run + char if following == "+" else run)
            run = ""
        else:
            run += char
    return [r.lower() for r in runs if len(r) >= GRAM]


def candidates(index: DataFrame, runs: Iterable[str]) -> DataFrame:
    """Names that have all trigrams of ``runs``, of which there is at least one."""
    wanted = sorted({run[i : i + GRAM] for run in runs for i in range(len(run) - GRAM + 1)})
    found = index.filter(F.col("trigram").isin(wanted)).groupBy("name").agg(F.count("*").alias("n"))
    return found.filter(F.col("n") == len(wanted)).select("name")


def search_names(index: DataFrame, names: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """The names (column ``name``) that the search finds. Where the pattern does not tell what a name must
    contain, all of ``names`` are looked at."""
    runs = required_runs(pattern, literal)
    narrowed = candidates(index, runs) if runs else names.select("name").distinct()
    return narrowed.filter(name_matches(F.col("name"), pattern, literal))


def search_positions(
    positions: DataFrame, index: DataFrame, pattern: str, literal: bool = False, key: str = DEFAULTS.vessel_key
) -> DataFrame:
    """Rows of the vessels that the search finds."""
    names = search_names(index, positions.select(F.col(key).alias("name")), pattern, literal)
    return positions.join(names.withColumnRenamed("name", key), key, "left_semi")

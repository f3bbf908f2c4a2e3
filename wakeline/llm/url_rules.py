"""Allow and block rules for URLs, by a sort-merge range join.

A rule's host is turned round (``example.org`` becomes ``org.example.``), so the
host and its subdomains are the keys in one interval, and so are the paths that
start with the rule's. Intervals of prefixes are nested or apart: sorted together
with the URLs' keys, a sweep keeps the stack of rules that are open at each place.

The sweep runs in blocks of the sorted keys. What is open where a block begins is
the stack after the last rule border of the blocks before it, one row per block.
Two sweeps are made: over hosts, then over the paths below each open host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.ordered import blocks

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after every text that a key can go on with.
_LAST = "\U0010ffff"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased. Null, or
    no ``://``: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``. Null, or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from last to first, each ended by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(prefixes: DataFrame) -> DataFrame:
    """Each ``prefix`` with the prefixes among ``prefixes`` that it starts with, shortest
    first, itself last."""
    heads = prefixes.select("prefix", F.explode(F.expr("transform(sequence(1, length(prefix)), n -> left(prefix, n))")).alias("head"))
    nested = heads.join(prefixes.select(F.col("prefix").alias("head")), "head")
    return nested.groupBy("prefix").agg(F.expr("transform(array_sort(collect_list(struct(length(head) AS n, head))), x -> x.head)").alias("stack"))


def sweep(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``keys`` (one column ``key``, no repeats) with ``stack``: the ``prefixes`` (one
    column ``prefix``, no repeats) that it starts with, shortest first."""
    rules = _stacks(prefixes)
    nothing = F.array().cast("array<string>")
    opened = rules.select(F.col("prefix").alias("key"), F.lit(1).alias("kind"), "stack")
    closed = rules.select(
        F.concat("prefix", F.lit(_LAST)).alias("key"), F.lit(0).alias("kind"), F.expr("slice(stack, 1, size(stack) - 1)").alias("stack")
    )
    asked = keys.select("key", F.lit(2).alias("kind"), F.lit(None).cast("array<string>").alias("stack"))
    events = blocks(asked.unionByName(opened).unionByName(closed), "key", "kind")
    order = Window.partitionBy("block").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = events.filter("kind < 2").groupBy("block").agg(F.max_by("stack", F.struct("key", "kind")).alias("open"))
    # one row per block: no more than there are partitions
    all_blocks = events.select("block").distinct().join(ends, "block", "left")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = all_blocks.select("block", F.last("open", ignorenulls=True).over(earlier).alias("carried"))
    swept = events.withColumn("open", F.last("stack", ignorenulls=True).over(order)).filter("kind = 2")
    return swept.join(F.broadcast(carried), "block").select("key", F.coalesce("open", "carried", nothing).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all
    subdomains where the URL's path starts with the rule's. The longest host
    wins, then the longest path; of equal rules, the greatest verdict as text.
    Without a fitting rule ``rule`` is null and the verdict ``otherwise``. Null
    URLs and those without ``://`` have an empty host and path; rules with a null
    or empty host fit nothing. Equal URLs are looked up once. Columns of the same
    names are replaced.
    """
    given = rules.filter("host <> ''").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    given = given.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    # the zero character ends the host, so that a path prefix cannot reach into another host
    given = given.select(host_key(F.col("host")).alias("rule_host"), F.concat("host", "path").alias("rule"), "path", "verdict")
    given = given.withColumn("prefix", F.concat("rule_host", F.lit("\0"), "path"))
    parted = pages.drop("host", "path", "rule", "verdict").withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    urls = parted.select("host", "path").distinct().withColumn("key", host_key(F.col("host")))

    hosts = sweep(urls.select("key").distinct(), given.select(F.col("rule_host").alias("prefix")).distinct())
    below = urls.join(hosts.withColumn("rule_host", F.explode("stack")).select("key", "rule_host"), "key")
    below = below.withColumn("below", F.concat("rule_host", F.lit("\0"), "path"))
    paths = sweep(below.select(F.col("below").alias("key")).distinct(), given.select("prefix"))
    fitting = below.join(paths.select(F.col("key").alias("below"), F.try_element_at("stack", F.lit(-1)).alias("prefix")).filter("prefix IS NOT NULL"), "below")
    best = fitting.groupBy("host", "path").agg(F.max_by("prefix", F.length("rule_host")).alias("prefix"))
    verdicts = best.join(given.select("prefix", "rule", "verdict"), "prefix").drop("prefix")
    return parted.join(verdicts, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(otherwise)))

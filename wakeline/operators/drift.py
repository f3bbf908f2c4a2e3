"""Fields that the schema does not foresee, kept as they came."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.functions.times import parse_utc
from wakeline.operators.once import evaluate_once

_FIELDS = "map<string,variant>"


def parse_with_extra(records: DataFrame) -> DataFrame:
    """``parse_events`` with a VARIANT column ``extra``: an object of the fields that the schema does not
    have, and of those whose value does not fit their type; null if there are none.

    A JSON value that is no object is kept whole. Text that is no JSON has no ``extra``; the quarantine keeps it.
    """
    text = records.select(F.col("value").cast("string").alias("value"))
    both = F.struct(F.from_json("value", schemas.WIRE_EVENT).alias("event"), F.try_parse_json("value").alias("raw"))
    parsed = evaluate_once(text, both, "parsed").select("parsed.*")
    flat = parsed.select("event.*", "raw").withColumn("timestamp", parse_utc(F.col("timestamp")))
    names = schemas.POSITION_COLUMNS
    fields = F.try_variant_get("raw", "$", _FIELDS)

    def left_over(name, value):
        understood = reduce(lambda a, b: a | b, [(name == n) & F.col(n).isNotNull() for n in names])
        # a null says nothing, whatever its field
        return ~understood & ~F.is_variant_null(value)

    odd = F.map_filter(fields, left_over)
    extra = F.when(fields.isNull(), F.col("raw")).when(F.size(odd) > 0, F.to_variant_object(odd))
    return flat.withColumn("extra", extra).select(*names, "extra")


def drifted_fields(rows: DataFrame) -> DataFrame:
    """``field, records``: how often each field was left over."""
    names = F.map_keys(F.try_variant_get("extra", "$", _FIELDS))
    return rows.select(F.explode(names).alias("field")).groupBy("field").agg(F.count("*").alias("records"))

"""Cleaning jobs: JSON log lines to typed, masked, partitioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions import columns as c
from coursemill.plans.specs import Field, LogSpec
from coursemill.plans.warehouse import Warehouse
from coursemill.sources.lines import json_fields, read_lines

RULES = {
    "source_label": lambda col: c.label(col, c.REGISTER_SOURCES, c.REGISTER_SOURCE_OTHER),
    "mask_name": c.mask_name,
    "mask_phone": c.mask_phone,
    "redact": lambda col: F.lit(c.REDACTED),
}


def _typed(field: Field) -> Column:
    raw = F.col(field.key)
    if field.rule:
        out = RULES[field.rule](raw if field.rule != "redact" else None)
    elif field.kind == "*":
        out = c.int_or_zero(raw)
    elif field.kind == "^":
        out = c.score_1dp(raw)
    elif field.kind == "?":
        out = c.whole_number(raw)
    elif field.kind == "$":
        out = c.decimal_number(raw, 10, 4)
    elif field.kind:
        out = raw.try_cast(field.type)
    else:
        out = raw
    return out.alias(field.name)


def clean(lines: DataFrame, spec: LogSpec) -> DataFrame:
    """Typed rows of a log's JSON lines; works on batch and streaming frames."""
    return json_fields(lines, spec.keys).select(*[_typed(f) for f in spec.fields])


def load(spark: SparkSession, warehouse: Warehouse, spec: LogSpec, ods: str) -> None:
    """Read ``<ods>/<log>.log``, clean it and write its table."""
    rows = clean(read_lines(spark, f"{ods.rstrip('/')}/{spec.log}.log"), spec)
    if spec.mode == "bucketed":
        warehouse.append_bucketed(rows, f"dwd.{spec.table}", "orderid", spec.partition_by)
    else:
        warehouse.write(rows, f"dwd.{spec.table}", spec.partition_by, overwrite=spec.mode == "overwrite", compact=True)

"""Text-line sources: JSON objects and tab-separated records, for batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARK = "_line_mark"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def json_fields(lines: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Named fields of each line as strings; lines that are not one JSON object, and nothing after it, are dropped.

    A JSON parser stops at the end of the first value. Each line is therefore parsed as the only item of a list that is followed by
    a list with a mark of that line: whatever stands behind the object changes the lists' lengths, breaks them, or ends
    the parse before the mark. The parsed value goes through a one-element ``explode`` so that the validity filter cannot be
    pushed below it: pushed down, it would carry its own copies of ``from_json`` and each line would be parsed again per copy.
    Only the asked-for fields are materialised by the parser. Lines that do not end in a brace are no object either and never
    reach it, as a failed parse costs an exception.
    """
    schema = "array<array<struct<" + ", ".join(f"`{name}`: string" for name in [*fields, _MARK]) + ">>>"
    braced = F.ltrim("value", F.lit(" \t\r")).startswith("{") & F.rtrim("value", F.lit(" \t\r\n")).endswith("}")
    mark = F.xxhash64("value").cast("string")
    whole = F.concat(F.lit("[["), "value", F.lit('],[{"' + _MARK + '":"'), mark, F.lit('"}]]'))
    parsed = lines.where(braced).select(
        *keep, mark.alias(_MARK), F.explode(F.array(F.from_json(whole, schema, {"allowUnquotedFieldNames": "true"}))).alias("j")
    )
    line = F.get(F.get("j", F.lit(0)), F.lit(0))
    alone = (F.size("j") == 2) & (F.size(F.get("j", F.lit(0))) == 1) & (F.get(F.get("j", F.lit(1)), F.lit(0))[_MARK] == F.col(_MARK))
    good = parsed.where(alone & line.isNotNull())
    return good.select(*keep, *[line[name].alias(name) for name in fields])


def tsv_fields(lines: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Fields of tab-separated lines that have exactly that many; trailing empty fields do not count."""
    parts = F.split(F.rtrim("value", F.lit("\t")), "\t")
    cut = lines.select(*keep, F.explode(F.array(parts)).alias("p")).where(F.size("p") == len(fields))
    return cut.select(*keep, *[F.get("p", F.lit(i)).alias(name) for i, name in enumerate(fields)])

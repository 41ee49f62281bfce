"""Writers of the public artifacts (SNK-1, SNK-4, SNK-5, SNK-7, SNK-10, SNK-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsontext import sanitized_json
from ..functions.text import is_forbidden_key, sanitized


def public_columns(rows: DataFrame) -> list[Column]:
    """PRD-10 for whole rows: columns with forbidden names go, texts are redacted, and so is what structs, arrays, maps and variants hold at any depth."""
    out = []
    for field in rows.schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if is_forbidden_key(field.name):
            continue
        if isinstance(kind, T.StringType):
            column = sanitized(column)
        elif isinstance(kind, T.VariantType):
            column = F.parse_json(sanitized_json(F.to_json(column)))
        elif isinstance(kind, T.StructType | T.ArrayType | T.MapType):
            column = F.from_json(sanitized_json(F.to_json(column)), kind)
        out.append(column.alias(field.name))
    return out


def write_collections(episodes: DataFrame, folder: str) -> None:
    """SNK-1: one folder of JSON lines for each collection, rows in files sorted by sequence; sanitized at any depth."""
    ordered = episodes.select(*public_columns(episodes)).repartitionByRange("collection", "sequence").sortWithinPartitions("collection", "sequence")
    ordered.write.partitionBy("collection").mode("overwrite").json(folder)


def write_lines(rows: DataFrame, path: str, *order: str) -> None:
    """SNK-4: JSON lines in files that follow each other by ``order``; nulls are written."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """SNK-5, SNK-7, SNK-10, SNK-11: a report or a manifest, replaced as a whole, in one file: it has a bounded number of rows."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)

"""Conversion of a table by a map of source warehouse types."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.functions.arrays import array_of

# Source type name -> Spark type. DECIMAL keeps its own precision and scale.
TYPE_MAP = {
    "VARCHAR": "string",
    "CHAR": "string",
    "INTEGER": "bigint",
    "DECIMAL": "decimal",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "BYTEINT": "bigint",
    "SMALLINT": "bigint",
    "BIGINT": "bigint",
    "FLOAT": "double",
}
DEFAULT_DECIMAL = "(38,9)"


def spark_type(source_type: str) -> str:
    """The Spark type for a source type such as `VARCHAR(20)` or `DECIMAL(18,2)`."""
    found = re.fullmatch(r"\s*([A-Za-z]+)\s*(\([\d\s,]+\))?\s*", source_type)
    name = found.group(1).upper() if found else None
    if name not in TYPE_MAP:
        raise ValueError(f"no conversion for type {source_type!r}")
    if name == "DECIMAL":
        return "decimal" + (found.group(2) or DEFAULT_DECIMAL).replace(" ", "")
    return TYPE_MAP[name]


def _converted(column: str, source_type: str) -> Column:
    value = F.col(column)
    if source_type.strip().upper().startswith("CHAR"):
        value = F.rtrim(value.cast("string"))
    return value.try_cast(spark_type(source_type))


def convert_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast each listed column; `failed_casts` names the columns whose value could not be converted.

    A row with a failed cast keeps NULL in that cell. `split_converted` parts such rows from the rest.
    """
    failed = array_of(*[(F.col(c).isNotNull() & _converted(c, t).isNull(), F.lit(c)) for c, t in types.items()])
    return df.select(*[_converted(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns],
                     failed.alias("failed_casts"))


def split_converted(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(converted rows, original rows that have a value which does not convert)."""
    bad = F.lit(False)
    for c, t in types.items():
        bad = bad | (F.col(c).isNotNull() & _converted(c, t).isNull())
    good = df.where(~bad).select(*[_converted(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    return good, df.where(bad)

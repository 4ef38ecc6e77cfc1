"""Column type rules between source databases, the warehouse and the reporting database."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The first fragment found in the source type decides. "=date" means the whole name,
# "*" keeps the source type, "()" keeps its length arguments.
WAREHOUSE_RULES = {
    "mysql": (
        ("char", "string"),
        ("text", "string"),
        ("=date", "date"),
        ("bigint", "bigint"),
        ("time", "string"),
        ("blob", "binary"),
        ("binary", "string"),
        ("double", "decimal(17,4)"),
        ("float", "decimal(17,4)"),
        ("int", "int"),
        ("decimal", "*"),
    ),
    "oracle": (
        ("char", "string"),
        ("text", "string"),
        ("=date", "timestamp"),
        ("time", "string"),
        ("blob", "binary"),
        ("binary", "string"),
        ("double", "decimal(17,4)"),
        ("float", "decimal(17,4)"),
        ("bigint", "bigint"),
        ("int", "int"),
        ("decimal", "*"),
        ("number", "decimal()"),
    ),
}

REPORT_RULES = {
    "mysql": (
        ("char", "text"),
        ("text", "text"),
        ("blob", "bytea"),
        ("datetime", "timestamp"),
        ("timestamp", "timestamp"),
        ("date", "date"),
        ("double", "numeric(15,2)"),
        ("float", "numeric()"),
        ("time", "time"),
        ("smallint", "int2"),
        ("tinyint", "int2"),
        ("bigint", "int8"),
        ("int", "int4"),
        ("decimal", "numeric()"),
        ("varbinary", "text"),
    ),
    "oracle": (
        ("char", "text"),
        ("text", "text"),
        ("blob", "bytea"),
        ("datetime", "timestamp"),
        ("timestamp", "timestamp"),
        ("date", "timestamp"),
        ("double", "numeric(15,2)"),
        ("float", "numeric()"),
        ("time", "time"),
        ("smallint", "int2"),
        ("tinyint", "int2"),
        ("bigint", "int8"),
        ("int", "int4"),
        ("decimal", "numeric()"),
        ("number", "decimal()"),
        ("varbinary", "text"),
    ),
}

# The Spark type that holds each reporting type.
REPORT_TO_SPARK = {
    "text": "string",
    "bytea": "binary",
    "timestamp": "timestamp_ntz",
    "date": "date",
    "time": "string",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "numeric": "decimal(38,18)",
    "decimal": "decimal(38,18)",
}

# Holds a number without declared digits; Spark's bare decimal would cut its fraction.
WIDE = "decimal(38,18)"


def _by_rule(rules: tuple[tuple[str, str], ...], source_type: str) -> str:
    name = source_type.strip().lower()
    for fragment, result in rules:
        if (fragment[1:] == name) if fragment.startswith("=") else (fragment in name):
            if result == "*":
                return name
            return result.replace("()", name[name.index("(") :].replace("*", "38") if "(" in name else "")
    raise ValueError(f"no rule for source type {source_type!r}")


def _spelled(name: str) -> str:
    """A decimal as Spark declares it: digits rounded before the point become whole ones, a scale beyond the digits widens."""
    found = re.fullmatch(r"decimal\(\s*(\d+)\s*,\s*(-?\d+)\s*\)", name)
    if not found:
        return name
    digits, scale = int(found[1]), int(found[2])
    return f"decimal({min(max(digits - min(scale, 0), scale), 38)},{min(max(scale, 0), 38)})"


def warehouse_type(source_type: str, database: str) -> str:
    name = _by_rule(WAREHOUSE_RULES[database], source_type)
    return WIDE if name == "decimal" else _spelled(name)


def report_type(source_type: str, database: str) -> str:
    return _by_rule(REPORT_RULES[database], source_type)


def report_spark_type(source_type: str, database: str) -> str:
    name = report_type(source_type, database)
    return REPORT_TO_SPARK.get(name, _spelled(name.replace("numeric", "decimal")))


def cast_types(df: DataFrame, source_types: Mapping[str, str], database: str) -> DataFrame:
    """Cast columns to the warehouse types their source types call for."""
    return apply_type_overrides(df, {c: warehouse_type(t, database) for c, t in source_types.items()})


def cast_report_types(df: DataFrame, source_types: Mapping[str, str], database: str) -> DataFrame:
    """Cast columns to what the reporting database stores."""
    return apply_type_overrides(df, {c: report_spark_type(t, database) for c, t in source_types.items()})


def report_column_types(source_types: Mapping[str, str], database: str) -> str:
    """The column list a reporting table is created with."""
    return ", ".join(f"{c} {report_type(t, database)}" for c, t in source_types.items())


def apply_type_overrides(df: DataFrame, overrides: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in overrides.items()})

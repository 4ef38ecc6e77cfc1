"""Text expressions: key texts, delimiters, markers, names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FIELD_DELIMITER, NULL_MARKER

# The escaped tokens configs and logs carry, and what they stand for.
ESCAPED_TOKENS = {"&lt;": "<", "&gt;": ">", "&eq;": "="}


def composite_key(*columns: str | Column) -> Column:
    """The key text a change log carries: values joined by commas, NULL if any part is NULL."""
    parts: list[Column] = []
    for c in columns:
        if parts:
            parts.append(F.lit(","))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.concat(*parts)


def key_label(columns: Sequence[str]) -> Column:
    """`[a=1][b=2]`: a key as it appears in reports."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.lit(f"[{name}="), F.col(name).cast("string"), F.lit("]")]
    return F.concat(*parts)


def first_non_null(*columns: Column) -> Column:
    return F.coalesce(*columns)


def has_prefix(c: Column, prefix: str) -> Column:
    return c.startswith(prefix)


def ends_with(c: Column, suffix: str) -> Column:
    return F.endswith(c, F.lit(suffix))


def count_matches(c: Column, pattern: str, ignore_case: bool = True) -> Column:
    """How often the pattern occurs in the text."""
    return F.regexp_count(c, F.lit(f"(?i){pattern}" if ignore_case else pattern))


def unescape(c: Column) -> Column:
    for token, plain in ESCAPED_TOKENS.items():
        c = F.replace(c, F.lit(token), F.lit(plain))
    return c


def strip_suffix(c: Column, suffixes: Sequence[str]) -> Column:
    """Remove the first of the suffixes the text ends with."""
    longest_first = sorted(suffixes, key=len, reverse=True)
    return F.regexp_replace(c, "(" + "|".join(map(re.escape, longest_first)) + ")$", "")


def threshold_text(low: Column, high: Column) -> Column:
    return F.format_string("[%.2f , %.2f]", low, high)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def scrub_delimiters(df: DataFrame) -> DataFrame:
    """Blank out line and field delimiters inside strings before a delimited write."""
    hidden = "\n\r" + FIELD_DELIMITER
    return df.withColumns({c: F.translate(F.col(c), hidden, " " * len(hidden)) for c in string_columns(df)})


def encode_nulls(df: DataFrame) -> DataFrame:
    """Every column as text, NULL written as the marker."""
    return df.select(
        *[F.coalesce(F.col(f.name).cast("string"), F.lit(NULL_MARKER)).alias(f.name) for f in df.schema.fields]
    )


def decode_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The reverse of `encode_nulls`; text that does not fit its type becomes NULL."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit(NULL_MARKER)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )

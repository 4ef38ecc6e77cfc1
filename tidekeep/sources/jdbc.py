"""Database sources and targets, through Spark's own JDBC reader and writer."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from ..config import TaskConfig, day_of, validate_window
from ..operators.project import apply_filters
from .extract import boundaries, extract_incremental, extract_with_history, window_predicate


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    type_overrides: Mapping[str, str] | None = None,
) -> DataFrame:
    """One reader. Filters and columns applied afterwards are pushed into the source's query."""
    options = dict(properties or {})
    if type_overrides:
        options["customSchema"] = ", ".join(f"{c} {t}" for c, t in type_overrides.items())
    return spark.read.jdbc(url, table, properties=options)


# How each database spells the literals of a slice. {} is the value as text.
LITERALS = {
    "mysql": {"time": "'{}'", "date": "'{}'"},
    "oracle": {
        "time": "TO_TIMESTAMP('{}', 'YYYY-MM-DD HH24:MI:SS.FF6')",
        "date": "TO_DATE('{}', 'YYYY-MM-DD')",
    },
    "db2": {"time": "TIMESTAMP('{}')", "date": "DATE('{}')"},
    "postgresql": {"time": "TIMESTAMP '{}'", "date": "DATE '{}'"},
}


def dialect_of(url: str) -> str:
    """The database a JDBC address names; an unknown one gets quoted literals without a type."""
    name = url.partition("jdbc:")[2].partition(":")[0].lower()
    return name if name in LITERALS else "mysql"


def literal(value: object, dialect: str = "mysql") -> str:
    """A boundary as the database reads it: numbers bare, texts quoted, times and dates typed."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no slice boundary: {value!r}")
    if isinstance(value, datetime):
        return LITERALS[dialect]["time"].format(value.isoformat(sep=" ", timespec="microseconds" if dialect == "oracle" else "auto"))
    if isinstance(value, date):
        return LITERALS[dialect]["date"].format(value.isoformat())
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def slice_predicates(column: str, bounds: Sequence[object], dialect: str = "mysql") -> list[str]:
    """Half-open slices over the bounds; the last one includes its end."""
    slices = list(zip(bounds, bounds[1:]))
    return [
        f"{column} >= {literal(lo, dialect)} AND {column} {'<=' if i == len(slices) - 1 else '<'} {literal(hi, dialect)}"
        for i, (lo, hi) in enumerate(slices)
    ]


def _text(value: datetime) -> str:
    return value.isoformat(sep=" ")


def slice_bounds(lo: object, hi: object, n: int, time_type: str = "timestamp") -> list[object]:
    """Up to n + 1 ascending cut points of equal width, first and last being the boundaries themselves.

    Times give times as text, yyyyMMdd texts are cut between days, whole numbers between numbers; cuts that fall together are
    one.
    """
    if n < 1:
        raise ValueError("at least one reader is needed")
    if time_type == "str":
        first, last = (datetime.strptime(str(v)[:8], "%Y%m%d") for v in (lo, hi))
        inner = [(first + timedelta(days=(last - first).days * i // n)).strftime("%Y%m%d") for i in range(1, n)]
    elif isinstance(lo, datetime):
        step = (hi - lo) / n
        return [_text(cut) for cut in (*[lo + step * i for i in range(n)], hi)]
    elif isinstance(lo, date):
        inner = [lo + timedelta(days=(hi - lo).days * i // n) for i in range(1, n)]
    elif isinstance(lo, int):
        inner = [lo + (hi - lo) * i // n for i in range(1, n)]
    else:
        inner = [lo + (hi - lo) / n * i for i in range(1, n)]
    return [lo, *[c for c in dict.fromkeys(inner) if lo < c < hi], hi]


def read_jdbc_sliced(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lo: object,
    hi: object,
    n: int,
    properties: Mapping[str, str] | None = None,
    time_type: str = "timestamp",
) -> DataFrame:
    """n readers, each fetching one slice of the split column: a time, a date, a yyyyMMdd text or a number."""
    bounds = slice_bounds(lo, hi, n, time_type)
    if isinstance(lo, datetime):
        bounds = [datetime.fromisoformat(b) for b in bounds]
    predicates = slice_predicates(column, bounds, dialect_of(url))
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties or {}))


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    writers: int,
    properties: Mapping[str, str] | None = None,
    column_types: str | None = None,
) -> None:
    """Truncate the table, then insert over at most `writers` connections; a failed truncate aborts.

    The stages before stay as wide as they are: rows are evened out by one shuffle, and only what reads that shuffle is merged
    into as many tasks as there may be connections. A target that cannot truncate in place is emptied by its dialect's rule.
    """
    even = df.hint("rebalance").write.mode("overwrite")
    writer = even.option("truncate", "true").option("numPartitions", str(writers))
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, properties=dict(properties or {}))


def extract_jdbc_sliced(
    spark: SparkSession,
    url: str,
    table: str,
    cfg: TaskConfig,
    begin: datetime,
    end: datetime,
    readers: int,
    properties: Mapping[str, str] | None = None,
    history_table: str | None = None,
    flagged_days: Collection[int] = (),
    split_column: str | None = None,
) -> DataFrame:
    """One window read by several connections, cut by the split column (the time column unless another is named).

    The boundary query reads that column of the window only. An empty window needs one reader, and so does a window that the
    history table takes part in.
    """
    validate_window(begin, end)
    whole = read_jdbc(spark, url, table, properties)
    if history_table is not None and day_of(begin) in flagged_days:
        history = read_jdbc(spark, url, history_table, properties)
        return extract_with_history(whole, history, cfg, flagged_days, begin, end)
    column = split_column or cfg.sync_time_column
    window = whole.where(window_predicate(whole, cfg, begin, end))
    lo, hi = boundaries(apply_filters(window, cfg.filters), column).first()
    if readers == 1 or lo is None or lo == hi:
        return extract_incremental(whole, cfg, begin, end)
    kind = cfg.time_type if column == cfg.sync_time_column else "timestamp"
    sliced = read_jdbc_sliced(spark, url, table, column, lo, hi, readers, properties, kind)
    return extract_incremental(sliced, cfg, begin, end)

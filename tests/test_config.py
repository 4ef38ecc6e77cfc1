from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidekeep.config import (
    day_of,
    end_day,
    export_span,
    lookback_months,
    months_between,
    shift_months,
    validate_window,
)
from tidekeep.session import shuffle_settings


def test_months_clamp_to_the_last_day():
    assert shift_months(datetime(2024, 1, 31, 5), 1) == datetime(2024, 2, 29, 5)
    assert shift_months(datetime(2023, 3, 31), -1) == datetime(2023, 2, 28)
    assert shift_months(datetime(2024, 2, 29), -12) == datetime(2023, 2, 28)


@given(st.datetimes(datetime(1971, 1, 1), datetime(2099, 1, 1)), st.integers(-600, 600))
def test_shift_months_moves_by_exactly_that_many(when, n):
    moved = shift_months(when, n)
    assert (moved.year * 12 + moved.month) - (when.year * 12 + when.month) == n
    assert moved.time() == when.time()


def test_midnight_belongs_to_the_day_before():
    assert end_day(datetime(2024, 3, 1)) == 20240229
    assert end_day(datetime(2024, 3, 1, 0, 0, 1)) == 20240301


def test_lookback_range():
    assert lookback_months(datetime(2024, 3, 31), datetime(2024, 4, 1), 1) == (202402, 202404)
    assert lookback_months(datetime(2024, 1, 5), datetime(2024, 1, 6)) == (202301, 202401)


def test_months_between_crosses_years():
    assert months_between(202311, 202402) == [202311, 202312, 202401, 202402]
    assert months_between(202402, 202401) == []


def test_export_span_by_grain():
    assert export_span(datetime(2024, 3, 10, 7), 30) == (20240209, 20240310)
    assert export_span(datetime(2024, 3, 10, 7), 30, "month") == (202402, 202403)


def test_window_guard():
    validate_window(datetime(2024, 1, 1), datetime(2024, 1, 2))
    with pytest.raises(ValueError):
        validate_window(datetime(2024, 1, 1), datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        validate_window(datetime(2024, 1, 1), datetime(2024, 1, 2, 0, 0, 1))
    assert day_of(datetime(2024, 1, 2)) == 20240102


def test_shuffle_partitions_follow_the_bytes():
    assert shuffle_settings(1 << 40, 100) == {"spark.sql.shuffle.partitions": "8192"}
    assert shuffle_settings(1, 100) == {"spark.sql.shuffle.partitions": "200"}

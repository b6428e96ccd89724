"""Trailing figures of every month against the job for a single day."""

import calendar
import datetime
import random
from dataclasses import replace
from decimal import Decimal

import pytest

from storeledger import Rules
from storeledger.operators import activity, periods, sales
from storeledger.sources.tables import tables_from_rows
from test_jobs import SHOP

SALE = Rules().statuses[0]


def _shop(spark, days):
    orders = [(i, i % 7 if i % 5 else 1, d, SALE if i % 11 else Rules().excluded_statuses[0]) for i, d in enumerate(days, 1)]
    lines = [(i, i, 1, 1 + i % 3, Decimal("10.00")) for i in range(1, len(days) + 1) if i % 13]
    return tables_from_rows(spark, SHOP | {"orders": orders, "order_lines": lines})


@pytest.mark.parametrize("months", [12, 1])
def test_equals_the_single_day_job(spark, months):
    rng, rules = random.Random(months), replace(Rules(), active_months=months)
    days = [datetime.date(2023, 11, 1) + datetime.timedelta(days=rng.randrange(300)) for _ in range(40)]
    # Leap day, the ends of long months, and a gap of two years.
    days += [datetime.date(2024, 2, 29)] * 3 + [datetime.date(2024, 1, d) for d in (28, 29, 30, 31)] + [datetime.date(2026, 9, 30)]
    shop = _shop(spark, days)
    found = {r.month: r for r in activity.active_customers_by_month(shop, rules).collect()}
    first, last = min(found), max(found)
    assert len(found) == (int(last[:4]) - int(first[:4])) * 12 + int(last[5:]) - int(first[5:]) + 1
    for month in ["2023-11", "2024-01", "2024-02", "2024-03", "2025-01", "2025-02", "2025-03", "2026-02", "2026-09"]:
        year, number = int(month[:4]), int(month[5:])
        day = datetime.date(year, number, calendar.monthrange(year, number)[1])
        want = sales.active_customers_window(shop, rules, day).first()
        assert tuple(found[month])[1:] == tuple(want), month


def test_calendar_has_no_gaps_and_growth_compares_neighbours(spark):
    shop = _shop(spark, [datetime.date(2024, 3, 1), datetime.date(2024, 8, 1), datetime.date(2025, 8, 1), datetime.date(2026, 1, 1)])
    months = [tuple(r) for r in periods.monthly_calendar(shop, Rules()).collect()]
    assert [m[0] for m in months] == [f"{y}-{m:02d}" for y in (2024, 2025, 2026) for m in range(1, 13)][2:25]
    assert months[1] == ("2024-04", 0, Decimal("0.00"), None) and months[0][1] == 1
    halves = [tuple(r) for r in periods.semester_calendar(shop, Rules()).collect()]
    first, second = Rules().semester_labels
    assert [(h[0], h[1]) for h in halves] == [
        (f"2024 - {first}", 1), (f"2024 - {second}", 1), (f"2025 - {first}", 0), (f"2025 - {second}", 1), (f"2026 - {first}", 1)
    ]
    growth = {r.semester: r.revenue_growth_pct for r in periods.semester_growth(shop, Rules()).collect()}
    assert list(growth) == [h[0] for h in halves if h[1]]
    assert growth[f"2025 - {second}"] is None and growth[f"2024 - {second}"] is not None and growth[f"2026 - {first}"] is not None

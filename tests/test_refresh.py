"""Refresh of touched months against a full rebuild."""

import datetime
import random
import re
from decimal import Decimal

import pytest

from storeledger import Rules
from storeledger.operators import maintain, refresh
from storeledger.operators.grains import order_amounts
from storeledger.operators.periods import monthly_revenue
from storeledger.sources.schema import ALL_TABLES
from storeledger.sources.tables import MONTH_FOLDER, read_tables, tables_from_rows
from test_jobs import SHOP

RULES = Rules()
SALE, CANCELLED = RULES.statuses[0], RULES.excluded_statuses[0]


def _shop(spark, orders, lines):
    rows = SHOP | {"orders": [(k, *v) for k, v in orders.items()], "order_lines": [(i, *line) for i, line in enumerate(lines)]}
    return tables_from_rows(spark, rows)


def _start(rng):
    orders = {k: (rng.randint(1, 4), _day(rng), rng.choice(RULES.statuses)) for k in range(1, 40)}
    orders[1] = (1, datetime.date(2023, 12, 5), SALE)  # alone in its month
    return orders, [(rng.randint(1, 45), rng.randint(1, 5), rng.randint(1, 4), Decimal("9.50")) for _ in range(80)] + [(1, 1, 1, Decimal("1.00"))]


def _day(rng):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=rng.randrange(500))


def _changed(rng, orders, lines):
    """New orders, late lines, lines taken back, cancellations, orders removed and moved; and the dates they touch."""
    orders, lines, days = dict(orders), list(lines), []
    for key in rng.sample(sorted(orders), 4) + [1]:
        days.append(orders[key][1])
        what = rng.choice(["cancel", "remove", "move", "line", "lines gone"]) if key != 1 else "move"
        if what == "cancel":
            orders[key] = (*orders[key][:2], CANCELLED)
        elif what == "remove":
            del orders[key]
        elif what == "move":
            orders[key] = (orders[key][0], _day(rng), SALE)
            days.append(orders[key][1])
        elif what == "line":
            lines.append((key, 2, 3, Decimal("100.00")))
        else:
            lines = [line for line in lines if line[0] != key]
    new = max(orders) + 1
    orders[new] = (2, datetime.date(2026, 1, 31), SALE)
    lines.append((new, 1, 1, Decimal("5.00")))
    return orders, lines, [*days, orders[new][1]]


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_refresh_equals_a_full_rebuild(spark, seed):
    rng, prefix = random.Random(seed), f"refresh_test_{seed}_"
    orders, lines = _start(rng)
    maintain.refresh_snapshots(_shop(spark, orders, lines), RULES, prefix, by_month=True)
    for _ in range(2):
        orders, lines, days = _changed(rng, orders, lines)
        shop = _shop(spark, orders, lines)
        changed = spark.createDataFrame([(d,) for d in days], "order_date date")
        fresh = refresh.refresh_months(shop, RULES, changed, prefix)
        whole = _rows(order_amounts(shop, RULES), "*")
        assert _rows(fresh.order_amounts, "order_id", "customer_id", "order_date", "status", "total") == whole
        months = _rows(monthly_revenue(shop, RULES), "*")
        assert _rows(fresh.monthly_revenue, "*") == months
        assert _rows(spark.table(f"{prefix}monthly_summary"), "*") == months
        stored = {r[0] for r in spark.sql(f"SHOW PARTITIONS {prefix}order_amounts").collect()}
        assert len(stored) == len(months)  # a month without orders has no folder


def test_orders_without_a_date_are_a_month_of_their_own(spark):
    schemas = {s.name: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.schema) for s in ALL_TABLES}

    def shop(orders):
        rows = SHOP | {"orders": orders, "order_lines": [(i, i, 1, 1, Decimal("2.00")) for i in range(1, 4)]}
        return tables_from_rows(spark, {}).replaced(**{n: spark.createDataFrame(rows[n], schemas[n]) for n in schemas})

    day = datetime.date(2024, 5, 5)
    maintain.refresh_snapshots(shop([(1, 1, day, SALE), (2, 1, None, SALE)]), RULES, "refresh_null_", by_month=True)
    for orders in ([(1, 1, day, SALE), (2, 1, None, SALE), (3, 2, None, SALE)], [(1, 1, day, SALE)]):
        now = shop(orders)
        fresh = refresh.refresh_months(now, RULES, spark.createDataFrame([(None,)], "order_date date"), "refresh_null_")
        assert _rows(fresh.order_amounts, "order_id", "order_date", "total") == _rows(order_amounts(now, RULES), "order_id", "order_date", "total")
        assert _rows(fresh.monthly_revenue, "*") == _rows(monthly_revenue(now, RULES), "*")


def test_only_touched_folders_are_read_and_written(spark, tmp_path):
    rng, prefix = random.Random(9), "refresh_plan_"
    orders, lines = _start(rng)
    shop = maintain.store_tables(_shop(spark, orders, lines), RULES, str(tmp_path))
    maintain.refresh_snapshots(shop, RULES, prefix, by_month=True)
    before = set(spark.table(f"{prefix}order_amounts").inputFiles())
    day = datetime.date(2024, 7, 9)
    month = day.replace(day=1)
    fresh = refresh.refresh_months(shop, RULES, spark.createDataFrame([(day,)], "order_date date"), prefix)
    after = set(fresh.order_amounts.inputFiles())
    touched = f"{MONTH_FOLDER}={month}"
    assert {f for f in before ^ after if touched not in f} == set()
    assert {f for f in after if touched in f}.isdisjoint(before)

    read = fresh.order_amounts.filter(refresh.in_folders([month]))
    assert all(touched in f for f in read.inputFiles())
    assert MONTH_FOLDER in re.search(r"PartitionFilters: \[(.*?)\]", read._jdf.queryExecution().executedPlan().toString()).group(1)
    base = read_tables(spark, str(tmp_path)).orders.filter(refresh.dated_in("order_date", [month, datetime.date(2024, 8, 1), datetime.date(2024, 12, 1)]))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = base._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*)\], ReadSchema", plan).group(1)
    assert "2024-07-01" in pushed and "2024-09-01" in pushed and "2025-01-01" in pushed and "2024-08-01" not in pushed


def test_nothing_changed(spark):
    prefix = "refresh_none_"
    shop = tables_from_rows(spark, SHOP)
    maintain.refresh_snapshots(shop, RULES, prefix, by_month=True)
    before = set(spark.table(f"{prefix}order_amounts").inputFiles())
    fresh = refresh.refresh_months(shop, RULES, shop.orders.limit(0), prefix)
    assert set(fresh.order_amounts.inputFiles()) == before

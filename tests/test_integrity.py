"""Constraint checks, maintenance and sinks on small broken or changing tables."""

import datetime
import unicodedata
from decimal import Decimal
from fractions import Fraction
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storeledger import Rules, Tables
from storeledger.functions.measures import ratio
from storeledger.operators import baskets, discounts, explore, integrity, maintain, periods, products, sales
from storeledger.operators.grains import order_amounts
from storeledger.plans.jobs import JOBS, run
from storeledger.sources.schema import ALL_TABLES, CUSTOMERS, PRODUCTS, Minimum
from storeledger.sources.sinks import CSV, export_result, shared_folder, write_table
from storeledger.sources.tables import read_tables, tables_from_rows
from test_jobs import SHOP

RULES = Rules()
DAY = datetime.date(2025, 1, 1)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def broken(spark):
    """One violation of each kind."""
    schemas = {s.name: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.schema) for s in ALL_TABLES}
    long_name = "é" * 51
    data = {
        "customers": [
            (1, "A", "B", "same@example.com", "Paris", DAY),
            (1, long_name, "B", "same@example.com", "Paris", DAY),
            (2, None, "B", None, "Paris", DAY),
            (3, "é" * 50, "B", None, "Paris", DAY),
        ],
        "products": [(1, "p", "c", Decimal("-0.01"), 0), (2, "q", "c", Decimal("0.00"), -1), (3, "r", "c", None, None)],
        "orders": [
            (1, 1, DAY, "payée"),
            (2, 99, DAY, "perdue"),
            (3, None, DAY, None),
            (4, 99, DAY, unicodedata.normalize("NFD", "annulée")),
            (5, 1, DAY, "annulee"),
        ],
        "order_lines": [(1, 1, 1, 0, Decimal("1.00")), (2, 77, 1, 1, Decimal("-1.00")), (3, 1, 55, 2, Decimal("1.00"))],
    }
    return Tables(**{name: spark.createDataFrame(data[name], schemas[name]) for name in schemas})


def test_each_check(broken):
    customers, products, orders, lines = broken.customers, broken.products, broken.orders, broken.order_lines
    assert rows(integrity.check_not_null(customers, ["id", "last_name", "email"])) == [
        ("email", 2),
        ("id", 0),
        ("last_name", 1),
    ]
    assert rows(integrity.check_primary_key(customers, "id")) == [(1, 2)]
    assert rows(integrity.check_unique(customers, "email")) == [("same@example.com", 2)]
    assert rows(integrity.check_foreign_key(orders, "customer_id", customers)) == [(99, 2)]
    assert [r[0] for r in rows(integrity.check_range(products, Minimum("price", 0)))] == [1]
    assert [r[0] for r in rows(integrity.check_range(lines, Minimum("quantity", 0, inclusive=False)))] == [1]
    assert len(rows(integrity.check_domain(orders, "status", RULES.statuses))) == 3
    assert [r[0] for r in rows(integrity.check_length(customers, "last_name", 50))] == [1]


def test_encoding_check_names_the_intended_status(broken):
    found = integrity.check_encoding(broken.orders, "status", RULES.statuses).collect()
    assert {unicodedata.normalize("NFC", r.status): r.canonical for r in found} == {
        "perdue": None,
        "annulée": "annulée",
        "annulee": None,
    }


def test_constraint_report(broken):
    report = {(r.table_name, r.column_name, r.constraint): r.violations for r in integrity.constraint_report(broken).collect()}
    failed = {key: count for key, count in report.items() if count}
    assert failed == {
        ("customers", "last_name", "not null"): 1,
        ("customers", "email", "not null"): 2,
        ("customers", "last_name", "length"): 1,
        ("customers", "id", "primary key"): 1,
        ("customers", "email", "unique"): 1,
        ("products", "price", "not null"): 1,
        ("products", "stock", "not null"): 1,
        ("products", "price", "minimum"): 1,
        ("products", "stock", "minimum"): 1,
        ("orders", "customer_id", "not null"): 1,
        ("orders", "status", "not null"): 1,
        ("orders", "status", "domain"): 3,
        ("orders", "customer_id", "reference"): 1,
        ("order_lines", "quantity", "minimum"): 1,
        ("order_lines", "unit_price", "minimum"): 1,
        ("order_lines", "order_id", "reference"): 1,
        ("order_lines", "product_id", "reference"): 1,
    }
    assert len(report) == 20 + 7 + 4 + 1 + 4 + 1 + 3


def test_temporal_order(spark):
    spans = spark.createDataFrame([(1, 5, 4), (2, 4, 4), (3, 4, None)], "id int, start int, finish int")
    assert rows(integrity.check_temporal_order(spans, "start", "finish")) == [(1, 5, 4)]


def test_defaults_fill_absent_columns_only(spark):
    short = spark.createDataFrame([(1, "p")], "id bigint, name string")
    assert rows(maintain.apply_defaults(short, PRODUCTS)) == [(1, "p", 0)]
    given_null = spark.createDataFrame([(1, None)], "id bigint, stock int")
    assert rows(maintain.apply_defaults(given_null, PRODUCTS)) == [(1, None)]


def test_deletes(spark):
    shop = tables_from_rows(spark, SHOP)
    doomed = shop.orders.filter(F.col("id").isin(13, 14))
    orders, lines = maintain.delete_cascade(shop.orders, shop.order_lines, doomed, "order_id")
    assert [r[0] for r in rows(orders)] == [10, 11, 12, 15]
    assert [r[0] for r in rows(lines)] == [100, 101, 102, 103]
    assert lines.columns == shop.order_lines.columns
    doomed = shop.customers.filter(F.col("id").isin(1, 4))
    assert rows(maintain.delete_restrict_blockers(doomed, shop.orders, "customer_id")) == [(1, 3)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_ids_continue_without_gap_or_repeat(spark, partitions):
    existing = spark.createDataFrame([(3,), (41,)], "id bigint")
    incoming = spark.range(1000).selectExpr("CAST(id % 10 AS STRING) AS name").repartition(partitions)
    numbered = maintain.assign_ids(incoming, existing)
    assert numbered.columns == ["id", "name"]
    assert sorted(r.id for r in numbered.collect()) == list(range(42, 1042))
    assert numbered.groupBy("name").count().filter("count = 100").count() == 10
    assert sorted(r.id for r in maintain.assign_ids(incoming, existing.limit(0)).collect()) == list(range(1, 1001))


def test_snapshots_are_read_instead_of_recomputed_and_can_be_rebuilt(spark):
    shop = tables_from_rows(spark, SHOP)
    stored = maintain.refresh_snapshots(shop, RULES, prefix="t_")
    jobs = [order_amounts, periods.monthly_revenue, baskets.basket_class_summary, sales.sales_kpis, products.stock_cover]
    for job in jobs:
        assert rows(job(stored, RULES)) == rows(job(shop, RULES))
    assert "t_order_amounts" in stored.order_amounts._jdf.queryExecution().optimizedPlan().toString()
    again = maintain.refresh_snapshots(stored, RULES, prefix="t_")
    assert rows(again.order_amounts) == rows(order_amounts(shop, RULES))
    assert rows(spark.table("t_monthly_summary")) == rows(periods.monthly_revenue(shop, RULES))


def test_partitioned_and_bucketed_tables(spark):
    shop = tables_from_rows(spark, SHOP)
    months = order_amounts(shop, RULES).withColumn("month", F.date_format("order_date", "yyyy-MM"))
    table = write_table(months, "t_amounts_by_month", partition_by=["month"])
    assert table.filter("month = '2025-01'").count() == 2
    assert "PartitionFilters: [isnotnull(month" in table.filter("month = '2025-01'")._jdf.queryExecution().toString()

    lines = write_table(shop.order_lines, "t_lines", bucket_by=(4, "order_id"))
    orders = write_table(
        shop.orders.withColumnRenamed("id", "order_id"), "t_orders", bucket_by=(4, "order_id")
    ).withColumnRenamed("order_id", "id")
    co_located = shop.replaced(order_lines=lines, orders=orders)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        amounts = order_amounts(co_located, RULES)
        assert rows(amounts) == rows(order_amounts(shop, RULES))
        assert "Exchange" not in amounts._jdf.queryExecution().executedPlan().toString().replace("ResultQueryStage", "")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_export_replaces_the_previous_one(spark, tmp_path):
    report = sales.revenue_by_category(tables_from_rows(spark, SHOP), RULES)
    for _ in range(2):
        export_result(report, f"{tmp_path}/csv", "csv")
    assert rows(spark.read.schema(report.schema).options(**CSV).csv(f"{tmp_path}/csv")) == rows(report)
    export_result(report, f"{tmp_path}/by_category", partition_by=["category"])
    back = spark.read.parquet(f"{tmp_path}/by_category").select(*report.columns)
    assert rows(back) == rows(report)


def _half_away(value, digits):
    scaled = abs(value) * 10**digits
    whole = int(scaled + Fraction(1, 2))
    return Decimal(whole if value >= 0 else -whole).scaleb(-digits)


cents = st.integers(-(10**18), 10**18)


@settings(max_examples=8, deadline=None)
@given(pairs=st.lists(st.tuples(cents, st.integers(-(10**12), 10**12)), min_size=40, max_size=40))
def test_ratio_is_exact(spark, pairs):
    # The last pair rounds up if the quotient is first cut to nine decimals.
    pairs = pairs + [(1, 0), (0, 5), (5, 1000), (-5, 1000), (100500, 100000), (10**17 * 2 + 1, 4 * 10**17), (99999999999, 2 * 10**13)]
    for digits in (0, 1, 2):
        df = spark.createDataFrame(
            [(i, Decimal(n).scaleb(-2), Decimal(d).scaleb(-2)) for i, (n, d) in enumerate(pairs)],
            "i int, n decimal(38,2), d decimal(38,2)",
        ).select("i", ratio(F.col("n"), F.col("d"), digits).alias("r"))
        got = {row.i: row.r for row in df.collect()}
        for i, (n, d) in enumerate(pairs):
            want = None if d == 0 else _half_away(Fraction(n, d), digits)
            assert got[i] == want


def test_exported_text_reads_back_whole(spark, tmp_path):
    texts = ['say "hi", twice', "a,b", "", None, "  spaced  ", "back\\slash", "é", "two\nlines", "two\r\nlines", '"', "\n", " "]
    customers = [(i, text, "f", f"{i}@example.com", "Paris", DAY) for i, text in enumerate(texts)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CUSTOMERS.schema)
    shop = tables_from_rows(spark, {}).replaced(customers=spark.createDataFrame(customers, schema))
    for spec in ALL_TABLES:
        export_result(getattr(shop, spec.name), f"{tmp_path}/{spec.name}", "csv")
    back = read_tables(spark, str(tmp_path), "csv")
    assert rows(back.customers) == rows(shop.customers)
    assert rows(integrity.check_not_null(back.customers, ["last_name"])) == [("last_name", 1)]


def test_shared_folder_is_the_one_the_cluster_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(configured + "/")
    assert shared_folder(spark) != shared_folder(spark)

    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(unset)
    assert shared_folder(unset, "/shared").startswith("/shared/")


def test_ids_leave_every_other_column(spark):
    existing = spark.createDataFrame([(9,)], "id bigint")
    columns = ["_source", "_part", "_position", "__part", "a b", "id", "x.y"]
    incoming = spark.createDataFrame([("s", 1, 2, 3, "t", 4, 5.0)] * 6, "`_source` string, `_part` int, `_position` int, `__part` int, `a b` string, id int, `x.y` double")
    numbered = maintain.assign_ids(incoming.repartition(3), existing)
    assert numbered.columns == ["id", *[c for c in columns if c != "id"]]
    assert {tuple(r)[1:] for r in numbered.collect()} == {("s", 1, 2, 3, "t", 5.0)}
    assert sorted(r.id for r in numbered.collect()) == list(range(10, 16))


def test_growth_over_a_nearly_empty_semester(spark):
    months = spark.createDataFrame(
        [("2024-02", 1, Decimal("0.01")), ("2024-08", 3, Decimal("1000000000000000.00"))],
        "month string, orders bigint, revenue decimal(38,2)",
    )
    shop = tables_from_rows(spark, {}).replaced(monthly_revenue=months)
    growth = {r.semester: r for r in periods.semester_growth(shop, RULES).collect()}
    second = growth["2024 - 2e semestre"]
    assert second.revenue_growth_pct == (Decimal(10) ** 17 - 1) * 100
    assert second.average_basket_growth_pct == _half_away(Fraction(10**17, 3) * 100 - 100, 1)


def test_a_ratio_too_large_stops_the_job(spark):
    df = spark.createDataFrame([(Decimal("1e35"), Decimal("0.01"))], "n decimal(38,2), d decimal(38,2)")
    with pytest.raises(Exception, match="(?i)overflow|out_of_range|cannot be represented"):
        df.select(ratio(F.col("n"), F.col("d"), 2)).collect()


def test_extreme_discount_rates(spark):
    sale = {
        "customers": SHOP["customers"][:1],
        "products": [(1, "p", "c", Decimal("0.01"), 1)],
        "orders": [(1, SHOP["customers"][0][0], DAY, "payée")],
        "order_lines": [(1, 1, 1, 1, Decimal("9999999.99"))],
    }
    shop = tables_from_rows(spark, sale)
    assert [r.discount_pct for r in discounts.discount_by_rate(shop, RULES).collect()] == [-99999999800]
    assert discounts.discount_rate_shares(shop, RULES).first().lines_pct == 100


def _store(shop, folder, **replaced):
    for spec in ALL_TABLES:
        replaced.get(spec.name, getattr(shop, spec.name)).write.parquet(f"{folder}/{spec.name}")


def test_absent_columns_are_filled_or_refused(spark, tmp_path):
    shop = tables_from_rows(spark, SHOP)
    _store(shop, tmp_path / "a", products=shop.products.drop("stock"))
    read = read_tables(spark, f"{tmp_path}/a").products
    assert {r.stock for r in read.collect()} == {0} and read.columns == PRODUCTS.schema.names
    _store(shop, tmp_path / "b", products=shop.products.withColumnRenamed("price", "prize"))
    with pytest.raises(ValueError, match="price"):
        read_tables(spark, f"{tmp_path}/b")


def test_run_writes_every_job_and_again(spark, tmp_path):
    shop = tables_from_rows(spark, SHOP)
    wanted = ["revenue_by_category", "order_totals", "stock_cover", "semester_growth"]
    first = run(shop, RULES, f"{tmp_path}/out", names=wanted)
    held = {f: rows(spark.read.parquet(f)) for f in first}
    assert run(shop, RULES, f"{tmp_path}/out", names=wanted) == first
    assert {f: rows(spark.read.parquet(f)) for f in first} == held
    assert held[f"{tmp_path}/out/order_totals"] == rows(explore.order_totals(shop, RULES))
    assert len(run(shop, RULES, f"{tmp_path}/all")) == len(JOBS)

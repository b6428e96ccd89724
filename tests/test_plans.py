"""Shapes of the physical plans, and skew: one key with a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from storeledger.plans.catalog import build_queries
from star_fixtures import EDGES, write_star
from storeledger import Rules, Tables
from storeledger.operators import discounts, explore, loading, maintain, products, quality, removal, sales
from storeledger.operators.grains import valid_lines
from storeledger.sources.schema import ALL_TABLES
from storeledger.sources.sinks import write_table
from storeledger.sources.star import STAR_RULES, star_tables
from storeledger.sources.tables import read_tables

QUERIES = build_queries()


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    return str(write_star(spark, tmp_path_factory.mktemp("plans"), EDGES))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"write_table", "export_result", "assign_ids", "read_tables", "apply_defaults", "refresh_months", "checked_load"}))
def test_no_python_and_no_pairwise_join(spark, root, name):
    plan = _plan(QUERIES[name](spark, root))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name",
    ["customers_without_orders", "products_never_ordered", "products_never_validly_sold", "unsold_stock_value"],
)
def test_absence_is_an_anti_join_on_distinct_keys(spark, root, name):
    plan = _plan(QUERIES[name](spark, root))
    assert "LeftAnti" in plan
    assert "HashAggregate(keys=[id" in plan


def test_filter_and_columns_reach_the_scan(spark, root):
    plan = _plan(QUERIES["cancellation_rate"](spark, root))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan
    plan = _plan(QUERIES["top_products_by_quantity"](spark, root))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "TakeOrderedAndProject" in plan


def test_quantity_jobs_do_not_price_the_lines(spark, root):
    for name in ("top_products_by_quantity", "products_never_ordered", "row_count_order_lines"):
        assert "l_discount" not in _plan(QUERIES[name](spark, root))


@pytest.mark.parametrize("name", ["revenue_by_city", "category_shares", "basket_class_shares", "discount_rate_shares"])
def test_shares_read_the_facts_once(spark, root, name):
    result = QUERIES[name](spark, root)
    result.collect()
    # Only operators that ran carry a code generation stage; a reused shuffle has none below it.
    executed = re.findall(r"\*\(\d+\) ColumnarToRow\n.*FileScan parquet \[(l_orderkey|o_orderkey)", _plan(result))
    assert sorted(executed) == ["l_orderkey", "o_orderkey"]


def test_unordered_rules_drop_the_final_sort(spark, root):
    shop = star_tables(spark, root)
    for job in (explore.line_amounts, explore.orders_with_customer, sales.revenue_by_category):
        assert "rangepartitioning" in _plan(job(shop, STAR_RULES))
        assert "rangepartitioning" not in _plan(job(shop, STAR_RULES.unordered()))


# A third of the lines on one product and on one order, a third of the orders on one customer.
ROWS = 60_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    n = F.col("id")
    hot = n % 3 == 0
    frames = {
        "customers": spark.range(600).selectExpr(
            "id",
            "concat('c', id) AS last_name",
            "'x' AS first_name",
            "concat(id, '@example.com') AS email",
            "concat('CITY_', id % 7) AS city",
            "DATE'2024-06-01' AS signup_date",
        ),
        "products": spark.range(2000).selectExpr(
            "id",
            "concat('p', id) AS name",
            "concat('CAT_', id % 5) AS category",
            "CAST(100 + id AS DECIMAL(10,2)) AS price",
            "CAST(id % 50 AS INT) AS stock",
        ),
        "orders": spark.range(ROWS // 3).select(
            "id",
            F.when(hot, 7).otherwise(n % 500).cast("bigint").alias("customer_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), (n % 360).cast("int")).alias("order_date"),
            F.when(n % 10 == 9, "P").otherwise("F").alias("status"),
        ),
        "order_lines": spark.range(ROWS).select(
            "id",
            F.when(hot, 42).otherwise(n % (ROWS // 3)).cast("bigint").alias("order_id"),
            F.when(n % 3 == 1, 11).otherwise(n % 2000).cast("bigint").alias("product_id"),
            (n % 4 + 1).cast("int").alias("quantity"),
            (100 + n % 2000 - n % 3).cast("decimal(10,2)").alias("unit_price"),
        ),
    }
    for name, df in frames.items():
        df.repartition(8).write.parquet(f"{folder}/{name}")
    return Tables(**{name: spark.read.parquet(f"{folder}/{name}") for name in frames})


@pytest.fixture
def shuffled_joins(spark):
    """Sizes of a large cluster in miniature: no side small enough to broadcast, skew split from a few kilobytes."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def _final_plan(df):
    df.collect()
    return _plan(df)


@pytest.mark.parametrize(
    "job",
    [
        explore.orders_with_customer,
        products.stock_cover,
        valid_lines,
        sales.revenue_by_category,
        discounts.discount_overview,
        quality.orders_before_signup,
    ],
    ids=lambda job: job.__name__,
)
def test_hot_keys_are_split_by_the_join(spark, skewed, shuffled_joins, job):
    assert "skew=true" in _final_plan(job(skewed, STAR_RULES))


def test_hot_order_is_split_in_a_period_and_in_a_delete(spark, skewed, shuffled_joins):
    quarter = skewed.in_period("2024-01-01", "2024-03-31")
    assert "skew=true" in _final_plan(valid_lines(quarter, STAR_RULES))
    assert "skew=true" in _final_plan(quarter.order_lines)
    _, lines = maintain.delete_cascade(
        skewed.orders, skewed.order_lines, skewed.orders.filter("status = 'P'"), "order_id"
    )
    assert "skew=true" in _final_plan(lines)


def test_hot_order_is_split_in_deletes_over_all_tables_and_under_new_ids(spark, skewed, shuffled_joins):
    # Every other order goes, so that the lines meet enough keys to be dealt out.
    deleted = removal.delete_rows(skewed, "orders", skewed.orders.filter("id % 2 = 1"))
    assert "skew=true" in _final_plan(deleted.remaining["order_lines"])
    assert "skew=true" in _final_plan(loading.remap_ids(skewed, skewed).order_lines)


@pytest.mark.parametrize(
    "job",
    [
        sales.customer_spend,
        explore.order_totals,
        sales.top_customers,
        quality.customers_without_orders,
        quality.anomalies_per_customer,
    ],
    ids=lambda job: job.__name__,
)
def test_hot_keys_are_counted_before_the_join(spark, skewed, shuffled_joins, job):
    """Rows are aggregated below the first shuffle, so no join has a hot partition left to split."""
    plan = _final_plan(job(skewed, STAR_RULES))
    assert "skew=true" not in plan
    executed = plan.split("== Initial Plan ==")[0]
    facts = r"HashAggregate\(keys=\[(order_id|customer_id|id)#\d+L?\], functions=\[(partial_|\])"
    assert re.search(facts, executed)


def test_hot_partition_value_is_written_as_several_files(spark, skewed, shuffled_joins, tmp_path):
    months = skewed.orders.withColumn("month", F.when(F.col("id") % 3 == 0, 99).otherwise(F.col("id") % 4))
    written = write_table(months, "orders_by_month", partition_by=["month"], path=str(tmp_path / "orders"))
    assert len(list((tmp_path / "orders" / "month=99").glob("*.parquet"))) > 1
    assert written.count() == months.count()


def test_skewed_results_are_whole(spark, skewed, shuffled_joins):
    lines, orders = skewed.order_lines.toPandas(), skewed.orders.toPandas()
    valid = lines.merge(orders[orders.status != "P"], left_on="order_id", right_on="id", suffixes=("", "_order"))
    valid["amount"] = valid.quantity * valid.unit_price
    catalogue = skewed.products.toPandas().set_index("id")

    by_category = valid.groupby(valid.product_id.map(catalogue.category)).agg(
        revenue=("amount", "sum"), units=("quantity", "sum")
    )
    ours = {r.category: (r.revenue, r.units) for r in sales.revenue_by_category(skewed, STAR_RULES).collect()}
    assert ours == {c: (row.revenue, row.units) for c, row in by_category.iterrows()}

    overview = discounts.discount_overview(skewed, STAR_RULES).first()
    price = valid.product_id.map(catalogue.price)
    assert overview.lines == len(valid)
    assert overview.discounted_lines == (valid.unit_price < price).sum()
    assert overview.discount == (valid.quantity * (price - valid.unit_price)).sum()

    assert explore.orders_with_customer(skewed, STAR_RULES).count() == len(orders)


def test_both_spellings_of_a_status_reach_the_scan(spark, skewed, tmp_path):
    for spec in ALL_TABLES:
        getattr(skewed, spec.name).limit(10).write.parquet(f"{tmp_path}/{spec.name}")
    shop = read_tables(spark, str(tmp_path))
    plan = _plan(sales.basket_kpis(shop, Rules()))
    assert re.search(r"PushedFilters: \[[^\]]*Not\(In\(status, \[annul.*e,annul.*e\]\)\)", plan)


@pytest.mark.parametrize("name", ["stock_cover", "risk_class_counts", "constraint_report"])
def test_lines_meet_parts_once(spark, root, name):
    """Lines are priced at most once, and no line looks up a part for its key alone."""
    plan = _plan(QUERIES[name](spark, root))
    priced = [line for line in plan.splitlines() if "Join [l_partkey" in line and "LeftOuter" in line]
    assert len(priced) == (0 if name == "risk_class_counts" else 1)
    keys_only = [line for line in plan.splitlines() if "ReadSchema: struct<p_partkey:bigint>" in line]
    assert len(keys_only) <= 2 * (name == "constraint_report")  # there the products' key and the lines' reference to it


def test_a_period_reads_its_months_only(spark, root):
    shop = maintain.refresh_snapshots(star_tables(spark, root), STAR_RULES, prefix="p_", by_month=True)
    quarter = shop.in_period("1996-01-15", "1996-03-31")
    plan = quarter.order_amounts._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*order_month[^\]]* >= 1996-01-01", plan)
    plain = star_tables(spark, root).in_period("1996-01-15", "1996-03-31")
    assert sales.basket_kpis(quarter, STAR_RULES).collect() == sales.basket_kpis(plain, STAR_RULES).collect()

"""Checked loads and new keys for whole batches."""

import datetime
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storeledger import Rules, Tables
from storeledger.operators import integrity, loading
from storeledger.sources.schema import ALL_TABLES
from storeledger.sources.tables import tables_from_rows
from test_jobs import SHOP

DAY = datetime.date(2025, 1, 1)
SALE = Rules().statuses[0]
SCHEMAS = {s.name: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.schema) for s in ALL_TABLES}


def _tables(spark, rows):
    return Tables(**{name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in SCHEMAS})


def _random(rng):
    def one(*values):
        return rng.choice(values)

    return {
        "customers": [(one(i, i, i, 3, None), one("A", "é" * 51, None), "B", one(f"{i}@x", f"{i}@x", "same@x", None), "Paris", DAY) for i in range(20)],
        "products": [(i, "p", "c", one(Decimal("1.00"), Decimal("1.00"), Decimal("-0.01"), None), one(0, 1, 2, -1)) for i in range(15)],
        "orders": [(one(i, i, i, 5), one(rng.randrange(25), rng.randrange(20), None), DAY, one(SALE, SALE, "perdue")) for i in range(40)],
        "order_lines": [(i, one(rng.randrange(40), rng.randrange(40), 77), one(rng.randrange(15), 99), one(1, 2, 0), Decimal("1.00")) for i in range(120)],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_every_row_is_accepted_or_has_its_reasons(spark, tmp_path, seed):
    given = _random(random.Random(seed))
    tables = _tables(spark, given)
    loaded = loading.checked_load(tables, str(tmp_path))
    accepted = {n: [tuple(r) for r in getattr(loaded.accepted, n).collect()] for n in SCHEMAS}
    rejected = {n: [tuple(r) for r in loaded.rejected[n].collect()] for n in SCHEMAS}
    for name in SCHEMAS:
        assert Counter(accepted[name]) + Counter(r[:-1] for r in rejected[name]) == Counter(given[name])
        assert all(r[-1] for r in rejected[name])
        assert getattr(loaded.accepted, name).columns == getattr(tables, name).columns

    # The same rules as the report's: rows for row rules, offending keys for key rules.
    key_rules = {"primary key", "unique", "reference"}
    counts = Counter()
    for name in SCHEMAS:
        columns = getattr(tables, name).columns
        seen = {(rule, row[columns.index(rule.split("|")[0])]) if rule.split("|")[1] in key_rules else (rule, i) for i, row in enumerate(rejected[name]) for rule in row[-1]}
        counts.update((name, rule) for rule, _ in seen if not rule.endswith("parent rejected"))
    report = {(r.table_name, f"{r.column_name}|{r.constraint}"): r.violations for r in integrity.constraint_report(tables).collect()}
    assert {k: v for k, v in report.items() if v} == dict(counts)
    assert integrity.constraint_report(loaded.accepted).filter("violations > 0").count() == 0

    # A child whose parent is there but was rejected.
    good = {r[0] for r in accepted["customers"]}
    there = {r[0] for r in given["customers"]} - {None}
    for row in rejected["orders"]:
        assert ("customer_id|parent rejected" in row[-1]) == (row[1] in there - good)
        assert ("customer_id|reference" in row[-1]) == (row[1] is not None and row[1] not in there)


def test_sound_and_empty_tables(spark, tmp_path):
    shop = tables_from_rows(spark, SHOP)
    loaded = loading.checked_load(shop, str(tmp_path / "a"))
    assert all(df.count() == 0 for df in loaded.rejected.values())
    assert all(getattr(loaded.accepted, n).count() == len(SHOP[n]) for n in SHOP)
    loaded = loading.checked_load(tables_from_rows(spark, {}), str(tmp_path / "b"))
    assert all(getattr(loaded.accepted, n).count() == 0 for n in SHOP)
    extra = shop.replaced(orders=shop.orders.withColumns({"rows": F.lit(1), "verdict": F.lit("x"), "__verdict_0x": F.lit(2)}))
    loaded = loading.checked_load(extra, str(tmp_path / "c"))
    assert loaded.accepted.orders.columns == extra.orders.columns and loaded.accepted.orders.count() == 6
    with pytest.raises(ValueError, match="reasons"):
        loading.checked_load(shop.replaced(products=shop.products.withColumn("reasons", F.lit(1))), str(tmp_path / "d"))


def test_hot_keys_are_split(spark, tmp_path):
    """A third of the orders on one rejected customer: the orders meet the verdicts in a join that adaptive execution splits."""
    rows = spark.range(240_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("customer_id"),
        F.lit(DAY).alias("order_date"),
        F.lit(SALE).alias("status"),
    )
    customers = spark.range(500).select(
        "id", F.lit("A").alias("last_name"), F.lit("B").alias("first_name"), F.concat("id", F.lit("@x")).alias("email"),
        F.when(F.col("id") % 2 == 0, "Paris").alias("city"), F.lit(DAY).alias("signup_date"),
    )
    rows.repartition(6).write.parquet(str(tmp_path / "orders"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        parents = {"customers": customers.withColumn("accepted", F.col("city").isNotNull())}
        tagged = loading.tagged_rows(spark.read.parquet(str(tmp_path / "orders")), ALL_TABLES[2], parents, str(tmp_path / "keys"))
        tagged.write.format("noop").mode("overwrite").save()
        tagged.collect()
        assert "skew=true" in tagged._jdf.queryExecution().executedPlan().toString()
        assert tagged.filter(F.array_contains("reasons", "customer_id|parent rejected")).count() == 160_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def _joined(tables):
    lines, orders, customers, products = tables.order_lines, tables.orders, tables.customers, tables.products
    return sorted(
        tuple(r)
        for r in lines.join(orders.withColumnRenamed("id", "o"), F.col("order_id") == F.col("o"))
        .join(customers.withColumnRenamed("id", "c"), F.col("customer_id") == F.col("c"))
        .join(products.withColumnRenamed("id", "p"), F.col("product_id") == F.col("p"))
        .select("email", "order_date", "status", "name", "quantity", "unit_price")
        .collect()
    )


def test_new_ids_keep_the_joins(spark, tmp_path):
    incoming = tables_from_rows(spark, SHOP)
    incoming = incoming.replaced(orders=incoming.orders.repartition(3).withColumn("note", F.concat(F.lit("n"), "id")))
    found = loading.remap_ids(incoming, tables_from_rows(spark, SHOP), folder=str(tmp_path))
    assert _joined(found) == _joined(incoming) != []
    for name, last in (("customers", 4), ("products", 5), ("orders", 15), ("order_lines", 107)):
        ids = sorted(r.id for r in getattr(found, name).select("id").collect())
        assert ids == list(range(last + 1, last + 1 + len(SHOP[name])))
        assert getattr(found, name).columns == getattr(incoming, name).columns
    assert sorted(r.note for r in found.orders.collect()) == sorted(f"n{o[0]}" for o in SHOP["orders"])
    # What is read a second time, as by a task run again, is the same.
    assert sorted(map(tuple, found.order_lines.collect())) == sorted(map(tuple, found.order_lines.repartition(5).collect()))


def test_orphans_and_shared_provisional_keys(spark, tmp_path):
    rows = {
        "customers": [(1, "A", "B", "a@x", "Paris", DAY), (1, "C", "D", "c@x", "Lyon", DAY)],
        "products": [],
        "orders": [(1, 1, DAY, SALE), (2, 9, DAY, SALE), (3, None, DAY, SALE)],
        "order_lines": [(1, 1, 5, 1, Decimal("1.00"))],
    }
    incoming = _tables(spark, rows)
    found = loading.remap_ids(incoming, _tables(spark, {n: [] for n in SCHEMAS}), folder=str(tmp_path))
    firsts = {r.order_date: None for r in found.orders.collect()}
    assert len(firsts) == 1
    assert sorted((r.customer_id for r in found.orders.collect()), key=repr) == [1, None, None]
    assert [r.product_id for r in found.order_lines.collect()] == [None]
    assert [r.order_id for r in found.order_lines.collect()] == [r.id for r in found.orders.collect() if r.customer_id == 1]

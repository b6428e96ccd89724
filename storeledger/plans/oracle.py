"""Independent SQL for the registered queries, for an engine that sees the same star tables.

Written row by row from the definitions: line-level joins and COUNT(DISTINCT), none of the subtotals the jobs use.
"""

from __future__ import annotations

_BASE = """
WITH s_customers AS (
    SELECT c_custkey AS id, c_name AS last_name, c_mktsegment AS first_name,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email, n_name AS city,
           CASE WHEN c_acctbal >= 0 THEN DATE '1995-01-01' + CAST(floor(c_acctbal / 5) AS INTEGER) END AS signup_date
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
), s_products AS (
    SELECT p_partkey AS id, p_name AS name, p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
           p_size AS stock
    FROM part
), s_orders AS (
    SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status
    FROM orders
), s_lines AS (
    SELECT CAST(l_linenumber AS BIGINT) AS id, l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(ROUND(price * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(10,2)) AS unit_price
    FROM lineitem LEFT JOIN s_products p ON p.id = l_partkey
), s_sales AS (
    SELECT o.id AS order_id, o.customer_id, o.order_date, o.status, l.product_id, l.quantity, l.unit_price,
           l.quantity * l.unit_price AS amount
    FROM s_orders o JOIN s_lines l ON l.order_id = o.id WHERE o.status <> 'P'
), s_amounts AS (
    SELECT order_id, customer_id, order_date, status, CAST(SUM(amount) AS DECIMAL(38,2)) AS total
    FROM s_sales GROUP BY ALL
), s_quarter AS (
    SELECT * FROM s_orders WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'
), s_early AS (
    SELECT o.id AS order_id, customer_id, order_date, signup_date, CAST(signup_date - order_date AS INTEGER) AS days_early,
           status
    FROM s_orders o JOIN s_customers c ON c.id = o.customer_id WHERE order_date < signup_date
)
"""


def _money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,2))"


def _count(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    """Rounded half away from zero in whole numbers; this engine's own division is binary floating point."""
    n = f"CAST(({numerator}) * 100 AS HUGEINT)"
    d = f"NULLIF(CAST(({denominator}) * 100 AS HUGEINT), 0)"
    sign = f"CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    magnitude = f"((abs({n}) * {2 * 10**digits} + abs({d})) // (2 * abs({d})))"
    unit = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    return f"CAST(CAST({sign} * {magnitude} AS DECIMAL(36,0)) * {unit} AS DECIMAL(38,{digits}))"


def _percent(part: str, whole: str, digits: int) -> str:
    return _ratio(f"100 * ({part})", whole, digits)


_REVENUE = _money("SUM(amount)")
_ORDERS = "COUNT(DISTINCT order_id)"

_MONTHS = f"""SELECT strftime(order_date, '%Y-%m') AS month, {_ORDERS} AS orders, {_REVENUE} AS revenue,
    {_ratio("SUM(amount)", _ORDERS, 2)} AS average_basket
FROM s_sales GROUP BY 1"""

_SEMESTERS = f"""SELECT CAST(year(order_date) AS VARCHAR) || ' - ' || CASE WHEN month(order_date) < 7
        THEN '1er semestre' ELSE '2e semestre' END AS semester, {_ORDERS} AS orders, {_REVENUE} AS revenue
FROM s_sales GROUP BY 1"""

_CLASS = """CASE WHEN total >= 100000 THEN 'Gros panier' WHEN total >= 50000 THEN 'Panier moyen'
    WHEN total IS NOT NULL THEN 'Petit panier' ELSE 'Non calculable' END"""

_CLASSES = f"""SELECT {_CLASS} AS basket_class, COUNT(*) AS orders, {_money("SUM(total)")} AS revenue
FROM s_amounts GROUP BY 1"""

_KPIS = f"""SELECT {_REVENUE} AS revenue, {_ORDERS} AS orders, {_ratio("SUM(amount)", _ORDERS, 2)} AS average_basket,
    COUNT(DISTINCT customer_id) AS active_customers
FROM s_sales"""

_COVER = f"""SELECT p.id, p.name, p.category, p.stock, {_count("SUM(s.quantity)")} AS units,
    {_ratio("SUM(s.quantity)", "80", 1)} AS units_per_month,
    {_ratio("p.stock * 80", "SUM(s.quantity)", 1)} AS months_of_cover,
    {_percent("COALESCE(SUM(s.quantity) FILTER (WHERE a.total >= 100000), 0)", "SUM(s.quantity)", 1)} AS big_basket_pct,
    CASE WHEN COALESCE(p.stock * 80 >= 3 * SUM(s.quantity), TRUE) THEN 'Stock suffisant'
        WHEN p.stock * 80 >= SUM(s.quantity) THEN 'À surveiller' ELSE 'Risque élevé' END AS risk_class
FROM s_sales s JOIN s_amounts a ON a.order_id = s.order_id JOIN s_products p ON p.id = s.product_id
GROUP BY p.id, p.name, p.category, p.stock"""

_PRICED = "s_sales s JOIN s_products p ON p.id = s.product_id"
_DISCOUNT = _money("SUM(quantity * (price - unit_price))")
_DISCOUNTED = "SUM(CAST(COALESCE(unit_price < price, FALSE) AS INTEGER))"
_CANCELLED = "SUM(CAST(COALESCE(status = 'P', FALSE) AS INTEGER))"

_RATES = f"""SELECT CAST({_percent("price - unit_price", "price", 0)} AS BIGINT) AS discount_pct, COUNT(*) AS lines,
    {_count("SUM(quantity)")} AS units, {_ratio("SUM(quantity)", "COUNT(*)", 2)} AS units_per_line,
    {_money("SUM(quantity * unit_price)")} AS revenue, {_DISCOUNT} AS discount
FROM {_PRICED} GROUP BY 1"""

_TOP_CUSTOMERS = f"""SELECT c.id AS customer_id, last_name, first_name, city, {_ORDERS} AS orders, {_REVENUE} AS revenue,
    {_ratio("SUM(amount)", _ORDERS, 2)} AS average_basket
FROM s_sales s JOIN s_customers c ON c.id = s.customer_id GROUP BY c.id, last_name, first_name, city
ORDER BY revenue DESC NULLS FIRST, c.id LIMIT 10"""

_CATEGORIES = f"""SELECT category, {_REVENUE} AS revenue, {_count("SUM(quantity)")} AS units
FROM {_PRICED} GROUP BY category"""

_PRODUCT_LIST = "SELECT name, category, price, stock FROM s_products"
_NEVER = "NOT EXISTS (SELECT 1 FROM s_lines l {join} WHERE l.product_id = s_products.id)"
_NEVER_ORDERED = _NEVER.format(join="")
_NEVER_SOLD = _NEVER.format(join="JOIN s_orders o ON o.id = l.order_id AND o.status <> 'P'")
_NEVER_IN_QUARTER = _NEVER.format(join="JOIN s_quarter o ON o.id = l.order_id")
_NEVER_SOLD_IN_QUARTER = _NEVER.format(join="JOIN s_quarter o ON o.id = l.order_id AND o.status <> 'P'")
_STOCK_VALUE = f"SELECT COUNT(*) AS products, {_money('SUM(price * stock)')} AS stock_value FROM s_products"
_IDLE = "SELECT id, last_name, first_name, email FROM s_customers WHERE id NOT IN (SELECT customer_id FROM {orders})"


def _missing(table: str, columns: list[str], blanks: tuple[str, ...] = ()) -> str:
    def condition(column: str) -> str:
        return f"{column} IS NULL OR trim({column}) = ''" if column in blanks else f"{column} IS NULL"

    counts = [f"COUNT(*) FILTER (WHERE {condition(c)}) AS {c}_missing" for c in columns]
    return f"SELECT {', '.join(counts)} FROM {table}"


def _violations(table: str, column: str, rule: str, condition: str) -> str:
    counted = f"DISTINCT {column}" if rule == "reference" else "*"
    return f"""SELECT '{table[2:]}' AS table_name, '{column}' AS column_name, '{rule}' AS "constraint",
    COUNT({counted}) AS violations FROM {table} WHERE {condition}"""


def _constraint_report() -> str:
    columns = {
        "s_customers": ["id", "last_name", "first_name", "email", "city", "signup_date"],
        "s_products": ["id", "name", "category", "price", "stock"],
        "s_orders": ["id", "customer_id", "order_date", "status"],
        "s_lines": ["id", "order_id", "product_id", "quantity", "unit_price"],
    }
    lengths = {
        "s_customers": {"last_name": 50, "first_name": 50, "email": 100, "city": 100},
        "s_products": {"name": 100, "category": 100},
        "s_orders": {"status": 20},
    }
    parts = [_violations(t, c, "not null", f"{c} IS NULL") for t, names in columns.items() for c in names]
    parts += [_violations(t, c, "length", f"length({c}) > {n}") for t, sizes in lengths.items() for c, n in sizes.items()]
    parts += [
        _violations("s_products", "price", "minimum", "price < 0"),
        _violations("s_products", "stock", "minimum", "stock < 0"),
        _violations("s_lines", "quantity", "minimum", "quantity <= 0"),
        _violations("s_lines", "unit_price", "minimum", "unit_price < 0"),
        _violations("s_orders", "status", "domain", "status NOT IN ('F', 'O', 'P')"),
        _violations("s_orders", "customer_id", "reference", "customer_id NOT IN (SELECT id FROM s_customers)"),
        _violations("s_lines", "order_id", "reference", "order_id NOT IN (SELECT id FROM s_orders)"),
        _violations("s_lines", "product_id", "reference", "product_id NOT IN (SELECT id FROM s_products)"),
    ]
    keys = [(t, "id", "primary key") for t in columns] + [("s_customers", "email", "unique")]
    parts += [
        f"""SELECT '{t[2:]}', '{c}', '{rule}', COUNT(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING COUNT(*) > 1)"""
        for t, c, rule in keys
    ]
    union = " UNION ALL ".join(parts)
    return f"""SELECT CASE table_name WHEN 'lines' THEN 'order_lines' ELSE table_name END AS table_name, column_name,
    "constraint", violations FROM ({union})"""


def _profile(name: str, table: str, key: str, measure: str) -> str:
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS rows, MAX({key}) AS max_key,
    {_money(f"SUM({measure})")} AS measure FROM {table}"""


_HALF = "date_trunc('year', order_date) + CASE WHEN month(order_date) < 7 THEN INTERVAL 0 MONTH ELSE INTERVAL 6 MONTH END"
_HALVES = f"SELECT CAST({_HALF} AS DATE) AS start, {_ORDERS} AS orders, {_REVENUE} AS revenue FROM s_sales GROUP BY 1"
_HALF_NAME = "strftime({0}, '%Y') || ' - ' || CASE WHEN month({0}) < 7 THEN '1er semestre' ELSE '2e semestre' END"


def _spine(step: str, months: int) -> str:
    """Every month or half-year from the first sale to the last."""
    return f"""SELECT CAST(unnest(generate_series(MIN({step}), MAX({step}), INTERVAL {months} MONTH)) AS DATE) AS start
        FROM s_sales"""


def _windows() -> str:
    """Each calendar month with the sales of the year up to its last day."""
    return f"""SELECT strftime(start, '%Y-%m') AS month, {_REVENUE} AS revenue, {_ORDERS} AS orders,
        {_ratio("SUM(amount)", _ORDERS, 2)} AS average_basket, COUNT(DISTINCT customer_id) AS active_customers
    FROM ({_spine("date_trunc('month', order_date)", 1)}) LEFT JOIN s_sales
        ON order_date <= last_day(start) AND order_date > last_day(start) - INTERVAL 12 MONTH
    GROUP BY start"""


def _verdicts() -> str:
    """Every row with the rules it breaks, parents first."""

    def tagged(name: str, table: str, reasons: dict[str, str]) -> str:
        cases = ", ".join(f"CASE WHEN {condition} THEN '{reason}' END" for reason, condition in reasons.items())
        return f"{name} AS (SELECT *, list_filter([{cases}], lambda x: x IS NOT NULL) AS reasons FROM {table})"

    def repeated(table: str, column: str) -> str:
        return f"{column} IN (SELECT {column} FROM {table} GROUP BY {column} HAVING COUNT(*) > 1)"

    def missing(column: str, parent: str, tag: str) -> dict[str, str]:
        known, sound = f"(SELECT id FROM {parent})", f"(SELECT id FROM {tag} WHERE len(reasons) = 0)"
        return {
            f"{column}|reference": f"{column} NOT IN {known}",
            f"{column}|parent rejected": f"{column} IN {known} AND {column} NOT IN {sound}",
        }

    def plain(columns: list[str], lengths: dict[str, int]) -> dict[str, str]:
        rules = {f"{c}|not null": f"{c} IS NULL" for c in columns}
        return rules | {f"{c}|length": f"length({c}) > {n}" for c, n in lengths.items()}

    names = {"last_name": 50, "first_name": 50, "email": 100, "city": 100}
    customers = plain(["id", *names, "signup_date"], names)
    customers |= {"id|primary key": repeated("s_customers", "id"), "email|unique": repeated("s_customers", "email")}
    products = plain(["id", "name", "category", "price", "stock"], {"name": 100, "category": 100})
    products |= {"price|minimum": "price < 0", "stock|minimum": "stock < 0", "id|primary key": repeated("s_products", "id")}
    orders = plain(["id", "customer_id", "order_date", "status"], {"status": 20})
    orders |= {"status|domain": "status NOT IN ('F', 'O')", "id|primary key": repeated("s_orders", "id")}
    orders |= missing("customer_id", "s_customers", "t_customers")
    lines = plain(["id", "order_id", "product_id", "quantity", "unit_price"], {})
    lines |= {"quantity|minimum": "quantity <= 0", "unit_price|minimum": "unit_price < 0", "id|primary key": repeated("keyed", "id")}
    lines |= missing("order_id", "s_orders", "t_orders") | missing("product_id", "s_products", "t_products")
    tables = {"customers": "t_customers", "products": "t_products", "orders": "t_orders", "order_lines": "t_lines"}
    verdicts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, unnest(CASE WHEN len(reasons) = 0 THEN ['accepted'] ELSE reasons END) AS verdict FROM {tag}"
        for name, tag in tables.items()
    )
    return f"""SELECT table_name, verdict, COUNT(*) AS rows FROM (
        WITH keyed AS (SELECT * REPLACE (order_id * 10 + id AS id) FROM s_lines), {tagged("t_customers", "s_customers", customers)},
        {tagged("t_products", "s_products", products)}, {tagged("t_orders", "s_orders", orders)},
        {tagged("t_lines", "keyed", lines)} {verdicts}) GROUP BY ALL"""


def _remaining(plan: str, kept: dict[str, str]) -> list[str]:
    tables = {"customers": "s_customers", "products": "s_products", "orders": "s_orders", "order_lines": "s_lines"}
    return [
        f"""SELECT '{plan}' AS deleted_from, '{name}' AS table_name, COUNT(*) AS rows, CAST(SUM(id) AS DECIMAL(38,0)) AS id_sum
        FROM {table} WHERE {kept.get(name, "TRUE")}"""
        for name, table in tables.items()
    ]


def _loaded_again(name: str, table: str, matched: str) -> str:
    return f"""SELECT '{name}' AS table_name, n AS rows, CASE WHEN n > 0 THEN last + 1 END AS first_id,
        CASE WHEN n > 0 THEN last + n END AS last_id, CAST({matched} AS BIGINT) AS matched
        FROM (SELECT COUNT(*) AS n, MAX(id) AS last FROM {table})"""


_CANCELLED_ORDERS = "(SELECT id FROM s_orders WHERE status = 'P')"

_QUERIES = {
    "product_catalog": f"{_PRODUCT_LIST} ORDER BY category, name",
    "products_above_price": f"{_PRODUCT_LIST} WHERE price > 950 ORDER BY price DESC",
    "customers_in_city": "SELECT * FROM s_customers WHERE city = 'NATION_7' ORDER BY last_name, first_name",
    "customers_per_city": "SELECT city, COUNT(*) AS customers FROM s_customers GROUP BY city ORDER BY 2 DESC, 1",
    "orders_with_customer": """SELECT o.id AS order_id, order_date, status, c.id AS customer_id, last_name, first_name, email,
        city, signup_date FROM s_orders o JOIN s_customers c ON c.id = o.customer_id ORDER BY order_date, o.id""",
    "line_amounts": f"""SELECT id, order_id, product_id, quantity, unit_price, {_money("quantity * unit_price")} AS amount
        FROM s_lines ORDER BY order_id, id""",
    "order_totals": f"""SELECT o.id, order_date, status, {_money("COALESCE(SUM(quantity * unit_price), 0)")} AS total
        FROM s_orders o LEFT JOIN s_lines l ON l.order_id = o.id GROUP BY o.id, order_date, status ORDER BY o.id""",
    "revenue_by_category": f"{_CATEGORIES} ORDER BY revenue DESC",
    "category_shares": f"""SELECT category, revenue, {_percent("revenue", "(SELECT SUM(amount) FROM s_sales)", 1)}
        AS revenue_pct FROM ({_CATEGORIES})""",
    "top_products_by_quantity": f"""SELECT p.id, name, category, {_count("SUM(quantity)")} AS units
        FROM {_PRICED} GROUP BY p.id, name, category ORDER BY units DESC NULLS FIRST, p.id LIMIT 10""",
    "products_by_revenue": f"""SELECT p.id, name, category, {_REVENUE} AS revenue
        FROM {_PRICED} GROUP BY p.id, name, category ORDER BY revenue DESC, p.id""",
    "customer_spend": f"""SELECT c.id, last_name, first_name, COUNT(DISTINCT o.id) AS orders,
        {_money("COALESCE(SUM(quantity * unit_price) FILTER (WHERE o.status <> 'P'), 0)")} AS spend
        FROM s_customers c LEFT JOIN s_orders o ON o.customer_id = c.id LEFT JOIN s_lines l ON l.order_id = o.id
        GROUP BY c.id, last_name, first_name ORDER BY spend DESC, c.id""",
    "customers_without_orders": _IDLE.format(orders="s_orders"),
    "customers_without_orders_in_quarter": _IDLE.format(orders="s_quarter"),
    "basket_kpis": f"""SELECT {_money("SUM(total)")} AS revenue, COUNT(*) AS orders,
        {_ratio("SUM(total)", "COUNT(total)", 2)} AS average_basket FROM s_amounts""",
    "basket_by_month": f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS orders,
        {_money("SUM(total)")} AS revenue, {_ratio("SUM(total)", "COUNT(total)", 2)} AS average_basket
        FROM s_amounts GROUP BY 1 ORDER BY 1""",
    "order_amounts": "SELECT * FROM s_amounts",
    "classify_baskets": f"""SELECT order_id, order_date, status, total, {_CLASS} AS basket_class FROM s_amounts
        ORDER BY total DESC, order_id""",
    "basket_class_summary": f"{_CLASSES} ORDER BY revenue DESC",
    "basket_class_shares": f"""SELECT basket_class, orders, revenue,
        {_percent("orders", "(SELECT COUNT(*) FROM s_amounts)", 1)} AS orders_pct,
        {_percent("revenue", "(SELECT SUM(total) FROM s_amounts)", 1)} AS revenue_pct FROM ({_CLASSES})""",
    "monthly_revenue": _MONTHS,
    "monthly_revenue_chrono": f"{_MONTHS} ORDER BY month",
    "best_months": f"SELECT month, revenue, orders FROM ({_MONTHS}) ORDER BY revenue DESC NULLS FIRST, month LIMIT 6",
    "worst_months": f"SELECT month, revenue, orders FROM ({_MONTHS}) ORDER BY revenue, month LIMIT 6",
    "semester_summary": f"{_SEMESTERS} ORDER BY semester",
    "semester_growth": f"""SELECT {_HALF_NAME.format("now.start")} AS semester, now.orders, now.revenue,
        {_ratio("now.revenue", "now.orders", 2)} AS average_basket,
        {_percent("now.revenue - ago.revenue", "ago.revenue", 1)} AS revenue_growth_pct,
        {_percent("now.revenue * ago.orders - ago.revenue * now.orders", "ago.revenue * now.orders", 1)}
            AS average_basket_growth_pct
        FROM ({_HALVES}) AS now LEFT JOIN ({_HALVES}) AS ago ON ago.start = now.start - INTERVAL 6 MONTH""",
    "monthly_calendar": f"""SELECT strftime(start, '%Y-%m') AS month, COALESCE(orders, 0) AS orders,
        CAST(CASE WHEN orders IS NULL THEN 0 ELSE revenue END AS DECIMAL(38,2)) AS revenue, average_basket
        FROM ({_spine("date_trunc('month', order_date)", 1)}) LEFT JOIN ({_MONTHS}) ON month = strftime(start, '%Y-%m')""",
    "semester_calendar": f"""SELECT {_HALF_NAME.format("s.start")} AS semester, COALESCE(orders, 0) AS orders,
        CAST(CASE WHEN orders IS NULL THEN 0 ELSE revenue END AS DECIMAL(38,2)) AS revenue
        FROM ({_spine(_HALF, 6)}) AS s LEFT JOIN ({_HALVES}) AS h ON h.start = s.start""",
    "active_customers_by_month": _windows(),
    "refresh_months": "SELECT * FROM s_amounts",
    "checked_load": _verdicts(),
    "delete_rows": " UNION ALL ".join(
        [
            *_remaining(
                "orders",
                {
                    "orders": "status <> 'P' OR status IS NULL",
                    "order_lines": f"order_id IS NULL OR order_id NOT IN {_CANCELLED_ORDERS}",
                },
            ),
            *_remaining("products", {"products": f"stock >= 10 OR stock IS NULL OR NOT ({_NEVER_ORDERED})"}),
        ]
    ),
    "delete_rows_blockers": """SELECT p.id AS deleted_id, 'order_lines' AS table_name, 'product_id' AS column_name,
        p.id AS key, COUNT(*) AS rows FROM s_products p JOIN s_lines l ON l.product_id = p.id WHERE stock < 10 GROUP BY p.id""",
    "batch_orphans": """SELECT order_id, COUNT(*) AS rows FROM s_lines l
        WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.id = order_id AND status <> 'P') GROUP BY order_id""",
    "check_misdecoded": """SELECT 'last_name' AS column_name, CASE WHEN id % 4 = 0 THEN last_name || ' pay' || chr(195) || chr(131) ||
        chr(194) || chr(169) || 'e' ELSE last_name || ' pay' || chr(195) || chr(169) || 'e' END AS value,
        last_name || ' payée' AS repaired, COUNT(*) AS rows
        FROM s_customers WHERE id % 2 = 0 AND last_name IS NOT NULL GROUP BY ALL""",
    "repair_text": "SELECT * REPLACE (last_name || ' payée' AS last_name) FROM s_customers",
    "remap_ids": " UNION ALL ".join(
        [
            _loaded_again("customers", "s_customers", "0"),
            _loaded_again("products", "s_products", "0"),
            _loaded_again("orders", "s_orders", "(SELECT COUNT(*) FROM s_orders o JOIN s_customers c ON c.id = customer_id)"),
            _loaded_again(
                "order_lines",
                "s_lines",
                """(SELECT COUNT(*) FROM s_lines l JOIN s_orders o ON o.id = order_id)
                + (SELECT COUNT(*) FROM s_lines l JOIN s_products p ON p.id = product_id)""",
            ),
        ]
    ),
    "remap_ids_revenue": _CATEGORIES,
    "sales_kpis": _KPIS,
    "active_customers_window": f"{_KPIS} WHERE order_date > DATE '1999-12-31' AND order_date <= DATE '2000-12-31'",
    "cancellation_rate": f"""SELECT COUNT(*) AS orders, {_count(_CANCELLED)} AS cancelled_orders,
        {_percent(_CANCELLED, "COUNT(*)", 2)} AS cancelled_pct FROM s_orders""",
    "top_customers": _TOP_CUSTOMERS,
    "top_customer_cities": f"SELECT city, COUNT(*) AS customers FROM ({_TOP_CUSTOMERS}) GROUP BY city",
    "monthly_summary": _MONTHS,
    "monthly_summary_chrono": f"{_MONTHS} ORDER BY month",
    "orders_before_signup": "SELECT * FROM s_early ORDER BY days_early DESC",
    "orders_before_signup_count": "SELECT COUNT(*) AS anomalies FROM s_early",
    "anomalies_per_customer": "SELECT customer_id, COUNT(*) AS early_orders FROM s_early GROUP BY customer_id",
    "anomaly_gap_range": "SELECT MIN(days_early) AS min_days_early, MAX(days_early) AS max_days_early FROM s_early",
    "products_never_ordered": f"{_PRODUCT_LIST} WHERE {_NEVER_ORDERED}",
    "products_never_ordered_in_quarter": f"{_PRODUCT_LIST} WHERE {_NEVER_IN_QUARTER}",
    "products_never_validly_sold": f"{_PRODUCT_LIST} WHERE {_NEVER_SOLD} ORDER BY category, name",
    "products_never_validly_sold_in_quarter": f"{_PRODUCT_LIST} WHERE {_NEVER_SOLD_IN_QUARTER} ORDER BY category, name",
    "unsold_stock_value": f"{_STOCK_VALUE} WHERE {_NEVER_ORDERED}",
    "unsold_stock_value_in_quarter": f"{_STOCK_VALUE} WHERE {_NEVER_IN_QUARTER}",
    "table_row_counts": """SELECT 'customers' AS table_name, COUNT(*) AS rows FROM customer
        UNION ALL SELECT 'products', COUNT(*) FROM part UNION ALL SELECT 'orders', COUNT(*) FROM orders
        UNION ALL SELECT 'order_lines', COUNT(*) FROM lineitem""",
    "row_count_customers": "SELECT COUNT(*) AS customers FROM customer",
    "row_count_products": "SELECT COUNT(*) AS products FROM part",
    "row_count_orders": "SELECT COUNT(*) AS orders FROM orders",
    "row_count_order_lines": "SELECT COUNT(*) AS order_lines FROM lineitem",
    "missing_customers": _missing(
        "s_customers",
        ["last_name", "first_name", "email", "city", "signup_date"],
        ("last_name", "first_name", "email", "city"),
    ),
    "missing_products": _missing("s_products", ["name", "category", "price", "stock"], ("name", "category")),
    "missing_orders": _missing("s_orders", ["customer_id", "order_date", "status"]),
    "missing_order_lines": _missing("s_lines", ["order_id", "product_id", "quantity", "unit_price"]),
    "stock_cover": f"{_COVER} ORDER BY months_of_cover, p.id LIMIT 15",
    "risk_class_counts": f"SELECT risk_class, COUNT(*) AS products FROM ({_COVER}) GROUP BY risk_class",
    "discount_overview": f"""SELECT COUNT(*) AS lines, {_count(_DISCOUNTED)} AS discounted_lines,
        {_percent(_DISCOUNTED, "COUNT(*)", 1)} AS discounted_pct, {_money("SUM(quantity * price)")} AS catalogue_revenue,
        {_money("SUM(quantity * unit_price)")} AS revenue, {_DISCOUNT} AS discount FROM {_PRICED}""",
    "discount_by_rate": f"{_RATES} ORDER BY discount_pct",
    "discount_rate_shares": f"""SELECT discount_pct, lines,
        {_percent("lines", f"(SELECT COUNT(*) FROM {_PRICED})", 1)} AS lines_pct FROM ({_RATES})""",
    "discount_by_category": f"""SELECT category, COUNT(*) AS lines, {_percent(_DISCOUNTED, "COUNT(*)", 1)} AS discounted_pct,
        {_DISCOUNT} AS discount FROM {_PRICED} GROUP BY category ORDER BY discount DESC""",
    "discount_cost_pct": f"""SELECT {_money("SUM(quantity * price)")} AS catalogue_revenue, {_DISCOUNT} AS discount,
        {_percent(_DISCOUNT, "SUM(quantity * price)", 1)} AS discount_cost_pct FROM {_PRICED}""",
    "lines_above_catalogue": f"SELECT COUNT(*) AS lines FROM {_PRICED} WHERE unit_price > price",
    "revenue_by_city": f"""SELECT city, COUNT(DISTINCT c.id) AS customers, COUNT(*) AS orders,
        {_money("SUM(total)")} AS revenue, {_ratio("SUM(total)", "COUNT(total)", 2)} AS average_basket,
        {_ratio("SUM(total)", "COUNT(DISTINCT c.id)", 2)} AS revenue_per_customer,
        {_percent("SUM(total)", "(SELECT SUM(total) FROM s_amounts)", 1)} AS revenue_pct
        FROM s_customers c JOIN s_amounts a ON a.customer_id = c.id GROUP BY city ORDER BY revenue DESC""",
    "read_tables": " UNION ALL ".join(
        [
            _profile("customers", "s_customers", "id", "id"),
            _profile("products", "s_products", "id", "price"),
            _profile("orders", "s_orders", "id", "customer_id"),
            _profile("order_lines", "s_lines", "order_id", "unit_price"),
        ]
    ),
    "write_table": _CLASSES,
    "export_result": _CATEGORIES,
    "check_not_null": """SELECT column_name, violations FROM (UNPIVOT (SELECT COUNT(*) - COUNT(id) AS id,
        COUNT(*) - COUNT(last_name) AS last_name, COUNT(*) - COUNT(first_name) AS first_name,
        COUNT(*) - COUNT(email) AS email, COUNT(*) - COUNT(city) AS city, COUNT(*) - COUNT(signup_date) AS signup_date
        FROM s_customers) ON COLUMNS(*) INTO NAME column_name VALUE violations)""",
    "check_primary_key": "SELECT order_id, id, COUNT(*) AS rows FROM s_lines GROUP BY order_id, id HAVING COUNT(*) > 1",
    "check_unique": "SELECT name, COUNT(*) AS rows FROM s_products GROUP BY name HAVING COUNT(*) > 1",
    "check_unique_email": "SELECT email, COUNT(*) AS rows FROM s_customers GROUP BY email HAVING COUNT(*) > 1",
    "check_foreign_key": """SELECT order_id, COUNT(*) AS rows FROM s_lines
        WHERE order_id NOT IN (SELECT id FROM s_orders WHERE status <> 'P') GROUP BY order_id""",
    "check_range": "SELECT * FROM s_products WHERE stock < 10",
    "check_domain": "SELECT status, COUNT(*) AS rows FROM s_orders WHERE status NOT IN ('F', 'O') GROUP BY status",
    "check_length": "SELECT * FROM s_products WHERE length(name) > 10",
    "constraint_report": _constraint_report(),
    "apply_defaults": "SELECT id, name, category, price, 0 AS stock FROM s_products",
    "check_temporal_order": """SELECT CAST(l_linenumber AS BIGINT) AS id, l_orderkey AS order_id, order_date,
        CAST(l_shipdate AS DATE) AS ship_date FROM lineitem JOIN s_orders o ON o.id = l_orderkey
        WHERE CAST(l_shipdate AS DATE) < order_date""",
    "delete_cascade": """SELECT id, order_id, product_id, quantity FROM s_lines
        WHERE order_id NOT IN (SELECT id FROM s_orders WHERE status = 'P')""",
    "delete_cascade_parents": "SELECT * FROM s_orders WHERE status <> 'P' OR status IS NULL",
    "delete_restrict_blockers": """SELECT c.id, COUNT(*) AS children FROM s_customers c
        JOIN s_orders o ON o.customer_id = c.id WHERE city = 'NATION_7' GROUP BY c.id""",
    "assign_ids": """SELECT n AS rows, last + 1 AS first_id, last + n AS last_id,
        CAST(n * last + n * (n + 1) // 2 AS DECIMAL(38,0)) AS id_sum, units, order_id_sum, product_id_sum
        FROM (SELECT COUNT(*) AS n, MAX(id) AS last, CAST(SUM(quantity) AS BIGINT) AS units,
            CAST(SUM(order_id) AS DECIMAL(38,0)) AS order_id_sum, CAST(SUM(product_id) AS DECIMAL(38,0)) AS product_id_sum
            FROM s_lines)""",
    "check_encoding": """SELECT status, COUNT(*) AS rows, CAST(NULL AS VARCHAR) AS canonical FROM s_orders
        WHERE status NOT IN ('F', 'O', 'p') GROUP BY status""",
}


def build_oracle() -> dict[str, str]:
    return {name: f"{_BASE}{body}" for name, body in _QUERIES.items()}

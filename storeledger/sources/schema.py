"""The four base tables: types, lengths, keys and value rules, declared once for readers and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from storeledger.config import Rules


def _text(name: str, length: int) -> T.StructField:
    return T.StructField(name, T.StringType(), False, {"max_length": length})


def _required(name: str, data_type: T.DataType) -> T.StructField:
    return T.StructField(name, data_type, False)


KEY = T.LongType()  # ids outgrow 32 bits long before 100 TB
PRICE = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Reference:
    column: str
    parent: str
    on_delete: str  # "restrict" or "cascade"


@dataclass(frozen=True)
class Minimum:
    column: str
    bound: int
    inclusive: bool = True


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: str = "id"
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    minimums: tuple[Minimum, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def max_lengths(self) -> dict[str, int]:
        return {f.name: f.metadata["max_length"] for f in self.schema if "max_length" in f.metadata}

    @property
    def text_columns(self) -> list[str]:
        return [f.name for f in self.schema if isinstance(f.dataType, T.StringType)]


CUSTOMERS = TableSpec(
    name="customers",
    schema=T.StructType(
        [
            _required("id", KEY),
            _text("last_name", 50),
            _text("first_name", 50),
            _text("email", 100),
            _text("city", 100),
            _required("signup_date", T.DateType()),
        ]
    ),
    unique=("email",),
)

PRODUCTS = TableSpec(
    name="products",
    schema=T.StructType(
        [
            _required("id", KEY),
            _text("name", 100),
            _text("category", 100),
            _required("price", PRICE),
            _required("stock", T.IntegerType()),
        ]
    ),
    minimums=(Minimum("price", 0), Minimum("stock", 0)),
    defaults={"stock": 0},
)

ORDERS = TableSpec(
    name="orders",
    schema=T.StructType(
        [
            _required("id", KEY),
            _required("customer_id", KEY),
            _required("order_date", T.DateType()),
            _text("status", 20),
        ]
    ),
    references=(Reference("customer_id", "customers", "restrict"),),
    domains={"status": Rules().statuses},
)

ORDER_LINES = TableSpec(
    name="order_lines",
    schema=T.StructType(
        [
            _required("id", KEY),
            _required("order_id", KEY),
            _required("product_id", KEY),
            _required("quantity", T.IntegerType()),
            _required("unit_price", PRICE),
        ]
    ),
    references=(Reference("order_id", "orders", "cascade"), Reference("product_id", "products", "restrict")),
    minimums=(Minimum("quantity", 0, inclusive=False), Minimum("unit_price", 0)),
)

# Parents before children: the order in which tables are loaded and checked.
ALL_TABLES = (CUSTOMERS, PRODUCTS, ORDERS, ORDER_LINES)

# Table and column names of a shop database kept in French.
FRENCH_NAMES = {
    "customers": "client",
    "customers.last_name": "nom",
    "customers.first_name": "prenom",
    "customers.city": "ville",
    "customers.signup_date": "date_inscription",
    "products": "produit",
    "products.name": "nom",
    "products.category": "categorie",
    "products.price": "prix",
    "orders": "commande",
    "orders.customer_id": "client_id",
    "orders.order_date": "date_commande",
    "orders.status": "statut",
    "order_lines": "ligne_commande",
    "order_lines.order_id": "commande_id",
    "order_lines.product_id": "produit_id",
    "order_lines.quantity": "quantite",
    "order_lines.unit_price": "prix_unitaire",
}

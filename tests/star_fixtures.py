"""Small star schemas written to Parquet: one with every edge case, one empty."""

from datetime import datetime
from pathlib import Path

from storeledger.sources.star import SCHEMAS


def _day(text):
    return datetime.fromisoformat(text)


EDGES = {
    # The third nation has no customer.
    "nation": [(0, "NATION_7"), (1, "NATION_1"), (2, "NATION_2")],
    # Customer 4 never ordered, 5 only cancelled; 6 has no known nation; 7 and 8 share a name; 9 has none.
    "customer": [
        (1, "Customer#1", 0, 1900.0, "BUILDING"),  # signs up on 1996-01-16
        (2, "Customer#2", 0, 2730.0, "MACHINERY"),  # on 1996-06-30
        (3, "Customer#3", 1, -0.01, "BUILDING"),
        (4, "Customer#4", 1, 10.0, ""),
        (5, "Customer#5", 0, 4.99, "   "),
        (6, "Customer#6", 77, 0.0, "BUILDING"),
        (7, "Twin", 1, 9999.99, "A"),
        (8, "Twin", 1, 700.0, "B"),  # signs up on 1995-05-21, the day of an order and a day after another
        (9, None, 1, None, "C"),
    ],
    # Part 5 sells only in a cancelled order, 6 never; 2 is free; 8 and 9 sit on the bounds of the stock cover classes.
    "part": [
        (1, "lamp", "HOME", 50, 1000.00),
        (2, "free cable", "IT", 5, 0.00),
        (3, "desk", "HOME", 20, 950.00),
        (4, "chair with arms", "HOME", 9, 950.01),
        (5, "mouse", "IT", 10, 980.55),
        (6, "keyboard", "IT", 3, 961.30),
        (7, "screen", "IT", 0, 999.99),
        (8, "plug", "IT", 1, 900.10),
        (9, "strap", "SPORT", 3, 900.30),
        (10, "lamp", "HOME", None, 910.70),
    ],
    "orders": [
        (1, 1, "F", _day("1996-01-15")),  # total exactly on the lower bound
        (2, 1, "O", _day("1996-06-30")),  # total exactly on the upper bound
        (3, 1, "F", _day("1995-12-31")),  # no line
        (4, 2, "O", _day("1995-01-01")),  # before the customer signed up
        (5, 2, "F", _day("1996-07-01")),
        (6, 3, "P", _day("1996-02-01")),
        (7, 3, "F", _day("2000-12-31")),
        (8, 3, "F", _day("1999-12-31")),
        (9, 5, "P", _day("1996-03-31")),
        (10, 6, "O", _day("2000-01-01")),
        (11, 99, "F", _day("2000-05-05")),  # unknown customer
        (12, 2, "F", _day("2001-01-01")),  # only an unknown part: no computable total
        (13, 7, None, _day("1997-01-01")),
        (14, 8, "X", _day("1997-02-01")),
        (15, 8, "O", _day("1995-05-20")),
        (16, 8, "O", _day("1995-05-21")),
    ],
    "lineitem": [
        (1, 1, 1, 50.0, 0.00, _day("1996-01-20")),
        (2, 1, 1, 50.0, 0.00, _day("1996-06-01")),
        (2, 1, 2, 50.0, 0.00, _day("1996-07-10")),
        (4, 3, 1, 10.0, 0.05, _day("1995-01-01")),
        (4, 8, 1, 40.0, 0.05, _day("1994-12-31")),  # same line number twice; half a cent
        (5, 8, 1, 40.0, 0.00, _day("1996-07-02")),
        (5, 9, 2, 80.0, 0.10, _day("1996-07-02")),
        (5, 2, 3, 4.0, 0.10, _day("1996-07-02")),
        (6, 4, 1, 7.0, 0.00, _day("1996-02-02")),
        (7, 4, 1, 1.0, 0.01, _day("2001-01-02")),
        (8, 7, 1, 3.0, 0.07, _day("2000-01-02")),
        (9, 5, 1, 9.0, 0.00, _day("1996-04-02")),
        (10, 10, 1, 2.0, 0.03, _day("2000-01-02")),
        (11, 3, 1, 5.0, 0.00, _day("2000-05-06")),
        (12, 404, 1, 5.0, 0.00, _day("2001-01-06")),
        (13, 1, 1, 5.0, 0.00, _day("1997-01-06")),
        (14, 1, 1, 5.0, 0.00, _day("1997-02-06")),
        (15, 4, 1, 1.0, 0.02, _day("1995-05-25")),
        (16, 4, 1, 1.0, 0.02, _day("1995-05-26")),
        (777, 4, 1, 6.0, 0.02, _day("1995-05-26")),  # unknown order
    ],
}

EMPTY = {table: [] for table in SCHEMAS}


def write_star(spark, root: Path, rows) -> Path:
    for table, schema in SCHEMAS.items():
        spark.createDataFrame(rows[table], schema).coalesce(1).write.parquet(f"{root}/{table}.parquet")
    return root

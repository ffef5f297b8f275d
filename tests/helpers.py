"""A small hand-made shop with every awkward case, and what tests share."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime
from decimal import Decimal


def ts(text: str | None):
    return datetime.fromisoformat(text) if text else None


def dec(text: str | None):
    return Decimal(text) if text else None


ORDERS = [
    # late by a day; bought at 23:59 and delivered two minutes later, a day on
    ("o1", "c1", "delivered", "2017-01-31 23:59:00", "2017-02-01 00:01:00", "2017-01-31 12:00:00"),
    # on time
    ("o2", "c2", "delivered", "2017-02-10 10:00:00", "2017-02-20 09:00:00", "2017-02-25 00:00:00"),
    # never delivered
    ("o3", "c3", "shipped", "2017-02-15 10:00:00", None, "2017-03-01 00:00:00"),
    # delivered exactly at the estimate
    ("o4", "c1", "delivered", "2017-03-01 08:00:00", "2017-03-05 08:00:00", "2017-03-05 08:00:00"),
    # no estimate
    ("o5", "c2", "invoiced", "2017-03-02 08:00:00", "2017-03-09 08:00:00", None),
    # delivered before it was bought, with a state outside the list
    ("o6", "c4", "lost", "2017-03-10 08:00:00", "2017-03-08 20:00:00", "2017-03-20 00:00:00"),
    # no state and no customer row
    ("o7", "c9", None, "2017-03-11 08:00:00", None, "2017-03-20 00:00:00"),
]

SHOP = {
    "geolocation": [
        ("01037", -23.5, -46.6, "sao paulo", "SP"),
        ("01037", -23.5, -46.6, "sao paulo", "SP"),
        ("01037", -23.2, -46.0, "São Paulo", "SP"),
        ("20000", -22.9, -43.2, "rio de janeiro", "RJ"),
        (None, 1.0, 2.0, "nowhere", "XX"),
    ],
    "customers": [
        ("c1", "u1", "01037", "sao paulo", "SP"),
        ("c2", "u2", "20000", "rio de janeiro", "RJ"),
        ("c3", "u1", "99999", "manaus", "AM"),  # prefix without coordinates
        ("c4", "u4", None, "manaus", "AM"),
    ],
    "sellers": [
        ("s1", "01037", "sao paulo", "SP"),
        ("s2", "88888", "curitiba", "PR"),
    ],
    "products": [
        ("p1", "beleza", 10, 100, 1, 200, 20, 10, 15),
        ("p2", "sem_traducao", 11, None, None, None, None, None, None),
        ("p3", None, None, None, None, 300, 30, 20, 10),
    ],
    "product_category_name_translation": [("beleza", "beauty"), ("moveis", "furniture")],
    "orders": [
        (o, c, s, ts(bought), None, None, ts(got), ts(due)) for o, c, s, bought, got, due in ORDERS
    ],
    "order_items": [
        ("o1", 1, "p1", "s1", dec("10.00"), dec("1.50")),
        ("o1", 2, "p2", "s2", dec("20.00"), dec("2.00")),
        ("o2", 1, "p1", "s1", dec("30.00"), None),
        ("o3", 1, "p3", "s9", dec("5.00"), dec("0.50")),  # unknown seller
        ("o4", 1, "p9", "s1", dec("7.25"), dec("0.25")),  # unknown product
        ("o6", 1, "p1", "s2", dec("10.00"), dec("1.50")),
        ("o7", 1, "p1", "s1", dec("1.00"), dec("1.00")),
        ("zz", 1, "p1", "s1", dec("99.00"), dec("9.00")),  # order is missing
    ],
    "order_payments": [
        ("o1", 1, "credit_card", 2, dec("20.00")),
        ("o1", 2, "voucher", 1, dec("13.50")),
        ("o2", 1, "boleto", 1, dec("30.00")),
        ("o4", 1, "credit_card", 1, dec("7.50")),
        ("zz", 1, "boleto", 1, dec("108.00")),  # order is missing
        ("o6", 1, None, 1, dec("11.50")),
    ],
    "order_reviews": [("o1", 5), ("o1", 2), ("o2", 4), ("o6", 1), ("zz", 3)],
}


def tuples(df, *columns):
    """Rows as a sorted list; ``None`` sorts first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


@contextmanager
def settings(spark, **values):
    """Session settings for the length of a block; ``__`` stands for a dot."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def final_plan(df) -> str:
    """Physical plan after adaptive execution ran it."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()

"""Hand-made raw tables in the marketplace schema.

Cases (see FIXTURES.md): padded text with tab and no-break space; rows equal
only after trimming; a category without translation and a product without
category; deliveries 1 h early, 23 h late, 25 h late, estimate not at
midnight, no delivery date, no estimate; a delivered order without payment;
a payment of a cancelled order; an order with several payments; an order
whose items all cost 0; two items sharing the top price; one person with
several customer ids; orders on 31 Dec and 1 Jan; two reviews of one order
with different scores; a review id reused with different text.
"""

from __future__ import annotations

from datetime import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from souk.sources.schemas import TABLES

NBSP = " "


def _df(spark: SparkSession, table: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, TABLES[table].struct(include_derived=False))


def raw_fixture(spark: SparkSession) -> dict[str, DataFrame]:
    translation = [
        ("beleza_saude", "health_beauty"),
        ("informatica", "computers"),
        ("esporte", "sports"),
        ("esporte", "sports"),  # exact duplicate row
    ]
    customers = [
        ("c1", "p1", "01001", "sao paulo", "SP"),
        ("c2", "p1", "01001", "sao paulo", "SP"),
        ("c3", "p2", "20000", "rio", "RJ"),
        ("c4", "p3", "30000", "belo horizonte", "MG"),
        ("c5", "p4", "01002", "sao paulo", "SP"),
        ("c6", "p5", "20001", "rio", "RJ"),
        ("c7", "p6", "01003", "campinas", "SP"),
        ("c7", " p6\t", "01003", f"campinas{NBSP}", "SP"),  # equal to the row above once trimmed
        ("c8", "p2", "20000", "rio", "RJ"),
    ]
    sellers = [("s1", "01001", "sao paulo", "SP"), ("s2", "20000", "rio", "RJ")]
    geolocation = [
        ("01001", -23.5, -46.6, "sao paulo", "SP"),
        ("01001", -23.5, -46.6, "sao paulo", "SP"),
        ("20000", -22.9, -43.2, "rio", "RJ"),
    ]
    products = [
        ("pA", "beleza_saude", None, 40, 300, 1, 500.0, 10.0, 10.0, 10.0),
        ("pB", "informatica", None, 35, 200, 2, 900.0, 20.0, 5.0, 15.0),
        ("pC", "beleza_saude", None, 20, 100, 1, 100.0, 5.0, 5.0, 5.0),
        ("pD", "esporte", None, 25, 150, 3, 1500.0, 30.0, 10.0, 20.0),
        ("pE", None, None, None, None, None, None, None, None, None),
        ("pF", " pc_gamer ", None, 30, 120, 1, 2500.0, 40.0, 20.0, 30.0),
    ]
    orders = [
        # 1 h early
        ("o1", "c1", "delivered", dt(2017, 12, 31, 10), dt(2017, 12, 31, 11), dt(2018, 1, 2),
         dt(2018, 1, 10, 10), dt(2018, 1, 10, 11)),
        # 23 h late -> floor 0 -> on time
        ("o2", "c2", "delivered", dt(2018, 1, 1, 9), dt(2018, 1, 1, 10), dt(2018, 1, 3),
         dt(2018, 1, 21, 10), dt(2018, 1, 20, 11)),
        # 25 h late -> 1 day late
        ("o3", "c3", "delivered", dt(2018, 1, 15), dt(2018, 1, 15, 1), dt(2018, 1, 17),
         dt(2018, 2, 5, 12), dt(2018, 2, 4, 11)),
        # delivered status without delivery date
        ("o4", "c4", "delivered", dt(2018, 2, 1), dt(2018, 2, 1, 2), None, None, dt(2018, 2, 20)),
        ("o5", "c5", "canceled", dt(2018, 2, 10), None, None, None, dt(2018, 3, 1)),
        # delivered, no payment, 4 days early
        ("o6", "c6", "delivered", dt(2018, 2, 20), dt(2018, 2, 20, 3), dt(2018, 2, 22),
         dt(2018, 3, 1), dt(2018, 3, 5)),
        # all items cost 0, no estimate
        ("o7", "c7", "delivered", dt(2018, 3, 5), dt(2018, 3, 5, 1), dt(2018, 3, 7), dt(2018, 3, 20), None),
        ("o8", "c8", "delivered", dt(2018, 3, 31, 23), dt(2018, 4, 1), dt(2018, 4, 2),
         dt(2018, 4, 10), dt(2018, 4, 9)),
    ]
    items = [
        ("o1", 1, "pA", "s1", dt(2018, 1, 2), 100.0, 10.0),
        ("o1", 2, "pB", "s1", dt(2018, 1, 2), 50.0, 5.0),
        ("o2", 1, "pA", "s2", dt(2018, 1, 3), 30.0, 3.0),
        ("o3", 1, "pC", "s1", dt(2018, 1, 17), 80.0, 8.0),
        ("o3", 2, "pD", "s2", dt(2018, 1, 17), 80.0, 8.0),  # tie on the top price
        ("o4", 1, "pB", "s1", dt(2018, 2, 2), 20.0, 2.0),
        ("o5", 1, "pA", "s1", dt(2018, 2, 11), 40.0, 4.0),
        ("o6", 1, "pE", "s2", dt(2018, 2, 21), 60.0, 6.0),
        ("o7", 1, "pA", "s1", dt(2018, 3, 6), 0.0, 0.0),
        ("o7", 2, "pB", "s1", dt(2018, 3, 6), 0.0, 0.0),
        ("o8", 1, "pF", "s1", dt(2018, 4, 1), 25.0, 2.5),
    ]
    payments = [
        ("o1", 1, "credit_card", 3, 120.0),
        ("o1", 2, "voucher", 1, 45.5),
        ("o2", 1, "credit_card", 10, 30.0),
        ("o3", 1, "boleto", 1, 170.25),
        ("o4", 1, "credit_card", 2, 21.0),
        ("o5", 1, "credit_card", 1, 40.0),
        ("o7", 1, "debit_card", 1, 10.0),
        ("o8", 1, "credit_card", 4, 26.0),
    ]
    reviews = [
        ("r1", "o1", 5, None, "great", dt(2018, 1, 11), dt(2018, 1, 12)),
        ("r2", "o2", 4, None, None, dt(2018, 1, 22), dt(2018, 1, 23)),
        ("r3", "o3", 1, "late", "too late", dt(2018, 2, 6), dt(2018, 2, 7)),
        ("r3", "o3", 2, "late", "still late, edited", dt(2018, 2, 8), dt(2018, 2, 9)),
        ("r4", "o4", 3, None, None, dt(2018, 2, 21), None),
        ("r6", "o6", 5, None, "ok", dt(2018, 3, 2), dt(2018, 3, 3)),
        ("r7", "o7", 2, None, "free?", dt(2018, 3, 21), dt(2018, 3, 22)),
        ("r8", "o8", 1, "bad", None, dt(2018, 4, 11), dt(2018, 4, 12)),
    ]
    return {
        "product_category_translation": _df(spark, "product_category_translation", translation),
        "customers": _df(spark, "customers", customers),
        "sellers": _df(spark, "sellers", sellers),
        "geolocation": _df(spark, "geolocation", geolocation),
        "products": _df(spark, "products", [r[:2] + r[3:] for r in products]),
        "orders": _df(spark, "orders", orders),
        "order_items": _df(spark, "order_items", items),
        "order_payments": _df(spark, "order_payments", payments),
        "order_reviews": _df(spark, "order_reviews", reviews),
    }

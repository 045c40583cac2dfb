"""Repeatable synthetic facts, one per row of a given table of ids.

Draws hash (id, purpose, seed), so they do not depend on the partitioning as
``rand`` would.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Day = dt.date | str


def ids(spark: SparkSession, n: int, start: int = 1) -> DataFrame:
    return spark.range(start, start + n)


def draw(purpose: str, seed: int, low: Column | int, high: Column | int) -> Column:
    """A whole number in low..high (both included), fixed by the id, the purpose and the seed."""
    text = F.concat_ws(":", F.col("id").cast("string"), F.lit(purpose), F.lit(str(seed)))
    word = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")
    low, high = (x if isinstance(x, Column) else F.lit(x).cast("bigint") for x in (low, high))
    return low + word % (high - low + 1)


def _day(purpose: str, seed: int, first: Day, last: Day) -> Column:
    first, last = F.lit(first).cast("date"), F.lit(last).cast("date")
    return F.date_add(first, draw(purpose, seed, 0, F.datediff(last, first).cast("bigint")).cast("int"))


def _money(purpose: str, seed: int, low: int, high: int) -> Column:
    return (draw(purpose, seed, low * 100, high * 100).cast("decimal(15,0)") / 100).cast("decimal(15,2)")


def synth_inventory(
    base: DataFrame, as_of: Day, seed: int = 42, n_products: int = 46, n_warehouses: int = 18
) -> DataFrame:
    """Stock of 10..999 with 10-90 % of it reserved; (product, warehouse, date) may repeat."""
    on_hand = draw("on_hand", seed, 10, 999)
    reserved = draw(
        "reserved", seed, F.floor(F.col("quantity_on_hand") / 10), F.floor(F.col("quantity_on_hand") * 9 / 10)
    )
    return (
        base.select(
            "id",
            draw("product", seed, 1, n_products).alias("product_id"),
            draw("warehouse", seed, 1, n_warehouses).alias("warehouse_id"),
            on_hand.alias("quantity_on_hand"),
            _day("snapshot", seed, "2020-01-01", as_of).alias("snapshot_date"),
        )
        .withColumn("quantity_reserved", reserved)
        .drop("id")
        .select("product_id", "warehouse_id", "quantity_on_hand", "quantity_reserved", "snapshot_date")
    )


def synth_orders(base: DataFrame, as_of: Day, seed: int = 42, n_suppliers: int = 30) -> DataFrame:
    """Orders since 2024; about half delivered, the rest Pending or In Transit without a delivery date."""
    delivered = draw("delivered", seed, 0, 1) == 1
    open_status = F.when(draw("open", seed, 0, 1) == 1, "Pending").otherwise("In Transit")
    return (
        base.select("id", _day("order", seed, "2024-01-01", as_of).alias("order_date"))
        .select(
            F.col("id").alias("order_id"),
            "order_date",
            draw("supplier", seed, 1, n_suppliers).alias("supplier_id"),
            draw("quantity", seed, 1, 10_000).alias("order_quantity"),
            _money("cost", seed, 2_000, 300_000).alias("order_cost"),
            F.date_add("order_date", draw("expected", seed, 30, 1000).cast("int")).alias("expected_delivery_date"),
            F.when(delivered, F.date_add("order_date", draw("actual", seed, 1, 1000).cast("int"))).alias(
                "actual_delivery_date"
            ),
            F.when(delivered, "Delivered").otherwise(open_status).alias("delivery_status"),
        )
    )


def synth_sales(
    base: DataFrame, as_of: Day, seed: int = 42, n_products: int = 46, n_warehouses: int = 18
) -> DataFrame:
    """Sales since 2024 of 1..300 units and 700..10,000 in revenue."""
    return base.select(
        F.col("id").alias("sale_id"),
        _day("sale", seed, "2024-01-01", as_of).alias("sale_date"),
        draw("product", seed, 1, n_products).alias("product_id"),
        draw("warehouse", seed, 1, n_warehouses).alias("warehouse_id"),
        draw("quantity", seed, 1, 300).alias("quantity_sold"),
        _money("revenue", seed, 700, 10_000).alias("revenue"),
    )

"""Bound tables with gaps, text dates, shifted keys and values out of range.

The test tables hold no NULL and no orphan; these forms of them do, over all
their rows, so that every check has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline import bindings as B


def gappy_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity and revenue with NULLs; ``full_*`` keep the values as sort keys."""
    q = F.col("quantity_sold")
    return B.sales(spark, sf).select(
        "sale_date",
        "sale_id",
        "product_id",
        "warehouse_id",
        q.alias("full_quantity"),
        F.col("revenue").alias("full_revenue"),
        F.nullif(q, F.lit(13)).alias("quantity_sold"),
        F.when(q % 7 != 0, F.col("revenue")).alias("revenue"),
    )


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as text in two formats and with junk."""
    text = (
        F.when(F.col("order_quantity") % 7 == 0, F.date_format("order_date", "dd/MM/yyyy"))
        .when(F.col("order_quantity") % 11 == 0, F.lit("n/a"))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd"))
    )
    return B.orders(spark, sf).select(
        "order_id", "supplier_id", "order_quantity", text.alias("order_date"), "expected_delivery_date"
    )


def shifted_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Keys moved past the end of the parent tables, some NULL."""
    return B.sales(spark, sf).withColumns(
        {
            "product_id": F.when(F.col("quantity_sold") != 21, F.col("product_id") + 7),
            "warehouse_id": F.col("warehouse_id") + 3,
        }
    )


def low_products(spark: SparkSession, sf: str) -> DataFrame:
    return B.products(spark, sf).withColumns(
        {"unit_cost": (F.col("unit_cost") - 950).cast("decimal(10,2)"), "reorder_level": F.col("reorder_level") - 5}
    )


def low_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return B.inventory(spark, sf).withColumn("quantity_on_hand", F.col("quantity_on_hand") - 30)


def low_orders(spark: SparkSession, sf: str) -> DataFrame:
    return B.orders(spark, sf).withColumn("order_quantity", F.col("order_quantity") - 5)


def low_sales(spark: SparkSession, sf: str) -> DataFrame:
    return gappy_sales(spark, sf).withColumn("quantity_sold", F.col("quantity_sold") - 5)


def sale_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A narrow projection with many copies."""
    return B.sales(spark, sf).select("product_id", "warehouse_id", "quantity_sold")


VIEWS = {
    "v_gappy_sales": """
        select sale_date, sale_id, product_id, warehouse_id, quantity_sold full_quantity, revenue full_revenue,
               nullif(quantity_sold, 13) quantity_sold,
               case when quantity_sold % 7 <> 0 then revenue end revenue
        from v_sales""",
    "v_raw_orders": """
        select order_id, supplier_id, order_quantity,
               case when order_quantity % 7 = 0 then strftime(order_date, '%d/%m/%Y')
                    when order_quantity % 11 = 0 then 'n/a' else strftime(order_date, '%Y-%m-%d') end order_date,
               expected_delivery_date
        from v_orders""",
    "v_shifted_sales": """
        select * replace (case when quantity_sold <> 21 then product_id + 7 end as product_id,
                          warehouse_id + 3 as warehouse_id) from v_sales""",
    "v_low_products": """
        select * replace (cast(unit_cost - 950 as decimal(10,2)) as unit_cost, reorder_level - 5 as reorder_level) from v_products""",
    "v_low_inventory": "select * replace (quantity_on_hand - 30 as quantity_on_hand) from v_inventory",
    "v_low_orders": "select * replace (order_quantity - 5 as order_quantity) from v_orders",
    "v_low_sales": "select * replace (quantity_sold - 5 as quantity_sold) from v_gappy_sales",
    "v_sale_cells": "select product_id, warehouse_id, quantity_sold from v_sales",
    "v_done_orders": """
        select *, cast(actual_delivery_date - expected_delivery_date as int) delivery_delay_days,
               coalesce(actual_delivery_date > expected_delivery_date, false) is_late
        from v_orders""",
}

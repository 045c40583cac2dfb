"""Inventory health, supplier scorecard and rolling sales.

All joins here meet one row per key: facts are aggregated by their key first
(partly map-side), so a product or supplier that owns most of the fact rows
costs the join no more than any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wharfline.functions.global_order import with_percent_rank, with_row_number
from wharfline.functions.scalars import ratio, rounded, stock_health, supply_days

Day = dt.date | str


def _since(column: str, as_of: Day, days: int):
    return F.col(column) >= F.date_sub(F.lit(as_of).cast("date"), days)


def latest_snapshot(inventory: DataFrame, date_column: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot; the date is a scalar subquery, evaluated once."""
    newest = inventory.select(F.max(date_column)).scalar()
    return inventory.where(F.col(date_column) == newest)


def _stock_and_sales(products: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    stock = latest_snapshot(inventory).groupBy("product_id").agg(F.sum("quantity_on_hand").alias("stock"))
    sold = sales.groupBy("product_id").agg(
        F.count("*").alias("n_sales"),
        F.avg("quantity_sold").alias("avg_daily_sales"),
        F.max("sale_date").alias("last_sale_date"),
    )
    names = products.select("product_id", "product_name")
    return names.join(stock, "product_id").join(sold, "product_id", "left")


def _ranked_health(stats: DataFrame) -> DataFrame:
    ranked = with_row_number(stats, [F.col("total_stock").desc(), "product_id"], "stock_rank")
    ranked = with_percent_rank(ranked, "avg_daily_sales", ["product_id"], "sales_share")
    days = supply_days(F.col("total_stock"), F.col("avg_daily_sales"))
    return ranked.select(
        "product_id",
        "product_name",
        "total_stock",
        "avg_daily_sales",
        rounded(days, 2).alias("days_of_supply"),
        stock_health(days).alias("stock_health"),
        "stock_rank",
        rounded(F.col("sales_share") * 100, 2).alias("sales_percentile"),
    )


def inventory_health(products: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """Stock health per product as the source procedure reports it.

    The procedure joins inventory rows with sales rows before summing, which
    multiplies the stock by the number of sales rows of the product.  The same
    figures follow from the two aggregates without building that join.
    """
    stats = _stock_and_sales(products, inventory, sales).withColumn(
        "total_stock", F.col("stock") * F.greatest(F.coalesce("n_sales", F.lit(1)), F.lit(1))
    )
    return _ranked_health(stats)


def inventory_health_true_stock(products: DataFrame, inventory: DataFrame, sales: DataFrame) -> DataFrame:
    """As ``inventory_health`` with the stock counted once."""
    return _ranked_health(_stock_and_sales(products, inventory, sales).withColumnRenamed("stock", "total_stock"))


def supplier_delivery(suppliers: DataFrame, orders: DataFrame, as_of: Day, days: int = 180) -> DataFrame:
    """On-time share and mean delay per supplier; an undelivered order counts as not on time."""
    on_time = F.col("actual_delivery_date") <= F.col("expected_delivery_date")
    delay = F.datediff("actual_delivery_date", "expected_delivery_date")
    per_supplier = (
        orders.where(_since("order_date", as_of, days))
        .groupBy("supplier_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_if(on_time).alias("on_time_orders"),
            F.avg(delay).alias("delay"),
        )
        .where("total_orders > 0")
    )
    return suppliers.join(per_supplier, "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "total_orders",
        "on_time_orders",
        rounded(ratio(F.col("on_time_orders") * 100, F.col("total_orders")), 2).alias("on_time_pct"),
        rounded(F.col("delay"), 2).alias("avg_days_late"),
        "reliability_score",
    )


def daily_sales(sales: DataFrame, as_of: Day | None = None, history_days: int = 365) -> DataFrame:
    """Quantity and revenue per day and product."""
    if as_of is not None:
        sales = sales.where(_since("sale_date", as_of, history_days))
    return sales.groupBy("sale_date", "product_id").agg(
        F.sum("quantity_sold").alias("daily_quantity"), F.sum("revenue").alias("daily_revenue")
    )


def sales_rolling(
    sales: DataFrame, as_of: Day, history_days: int = 365, output_days: int = 90, uplift: float = 1.2
) -> DataFrame:
    """Moving averages, volatility and forecast; frames count days with sales, not calendar days.

    The window runs over daily rows, so a product contributes one row per day of
    the history at most.  The output filter follows the window: applied earlier
    it would shorten the frames.
    """
    by_product = W.partitionBy("product_id").orderBy("sale_date")
    last30, last90 = by_product.rowsBetween(-29, 0), by_product.rowsBetween(-89, 0)
    rolled = daily_sales(sales, as_of, history_days).select(
        "sale_date",
        "product_id",
        "daily_quantity",
        "daily_revenue",
        F.avg("daily_quantity").over(last30).alias("moving_avg_30day"),
        F.avg("daily_quantity").over(last90).alias("moving_avg_90day"),
        F.stddev_pop("daily_quantity").over(last90).alias("volatility_90day"),
    )
    return rolled.where(_since("sale_date", as_of, output_days)).withColumn(
        "conservative_forecast", rounded(F.col("moving_avg_30day") * uplift, 0)
    )


# The order in which the three reports are shown, ties broken by key.
REPORT_ORDER = {
    "inventory_health": (("stock_rank", True),),
    "supplier_delivery": (("on_time_pct", False), ("supplier_id", True)),
    "sales_rolling": (("product_id", True), ("sale_date", False)),
}


def report_order(report: str) -> list[Column]:
    return [F.col(c).asc() if rising else F.col(c).desc() for c, rising in REPORT_ORDER[report]]


def in_report_order(df: DataFrame, report: str) -> DataFrame:
    """The rows of a report as they are shown: a presentation step, as a stored table has no order."""
    return df.orderBy(*report_order(report))


def order_status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("delivery_status").agg(F.count("*").alias("total_orders"))


def sales_range(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count("*").alias("total_sales"),
        F.min("sale_date").alias("min_sale_date"),
        F.max("sale_date").alias("max_sale_date"),
    )

"""Registered queries: analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from wharfline import bindings as B
from wharfline.functions.global_order import with_row_number
from wharfline.functions.scalars import rounded
from wharfline.plans import analytics as A
from wharfline.session import cut
from wharfline.suite.oracle import rnd, with_views

AS_OF = "2001-11-05"  # the day after the last sale in the test tables
ORDERS_AS_OF = "2001-08-02"  # the day after the last order date


def _sparse_sales(spark, sf):
    """All sales, but those of products with an odd id go to the product before: half of the products have none."""
    return B.sales(spark, sf).withColumn("product_id", F.col("product_id") - F.col("product_id") % 2)


def _shown(report, make):
    """The rows with their place in the order of the report."""
    return lambda spark, sf: with_row_number(make(spark, sf), A.report_order(report), "position")


def _health(spark, sf, plan, sales=B.sales):
    stock = cut(B.inventory(spark, sf), "bound")  # derived from the sales: once, as two scans read it
    out = plan(B.products(spark, sf), stock, sales(spark, sf))
    return out.withColumn("avg_daily_sales", rounded(F.col("avg_daily_sales"), 6))


def _rolling(spark, sf):
    out = A.sales_rolling(B.sales(spark, sf), AS_OF)
    return out.select(
        *[
            rounded(F.col(c), 6).alias(c) if c in ("moving_avg_30day", "moving_avg_90day", "volatility_90day") else c
            for c in out.columns
        ]
    )


QUERIES = {
    "supplier_delivery": lambda spark, sf: A.supplier_delivery(
        B.suppliers(spark, sf), B.orders(spark, sf), ORDERS_AS_OF
    ),
    "inventory_health": lambda spark, sf: _health(spark, sf, A.inventory_health),
    "inventory_health_sparse": lambda spark, sf: _health(spark, sf, A.inventory_health, _sparse_sales),
    "inventory_health_true_stock": lambda spark, sf: _health(spark, sf, A.inventory_health_true_stock),
    "sales_rolling": _rolling,
    "daily_sales": lambda spark, sf: A.daily_sales(B.sales(spark, sf)),
    "latest_snapshot": lambda spark, sf: A.latest_snapshot(B.inventory(spark, sf)),
    "order_status_counts": lambda spark, sf: A.order_status_counts(B.orders(spark, sf)),
    "sales_range": lambda spark, sf: A.sales_range(B.sales(spark, sf)),
}

_STATS_TAIL = f"""
    select product_id, product_name, total_stock, {rnd('avg_daily_sales', 6)} avg_daily_sales,
           {rnd('total_stock / need', 2)} days_of_supply,
           case when total_stock / need < 7 then 'CRITICAL' when total_stock / need < 30 then 'LOW'
                when total_stock / need < 90 then 'OPTIMAL' else 'EXCESS' end stock_health,
           stock_rank, {rnd('share * 100', 2)} sales_percentile
    from (select *, case when avg_daily_sales is not null then greatest(avg_daily_sales, 1) end need,
                 row_number() over (order by total_stock desc, product_id) stock_rank,
                 percent_rank() over (order by avg_daily_sales nulls first) share
          from stats)"""


def _fan_out(sales: str) -> str:
    return with_views(
        f"""with stats as (
        select p.product_id, p.product_name, cast(sum(i.quantity_on_hand) as bigint) total_stock,
               avg(s.quantity_sold) avg_daily_sales
        from v_products p join v_inventory i on p.product_id = i.product_id
             left join {sales} s on p.product_id = s.product_id
        where i.snapshot_date = (select max(snapshot_date) from v_inventory)
        group by 1, 2) {_STATS_TAIL}"""
    )


ORACLE = {
    "supplier_delivery": with_views(
        f"""select s.supplier_id, s.supplier_name, count(o.order_id) total_orders,
               cast(sum(case when o.actual_delivery_date <= o.expected_delivery_date then 1 else 0 end) as bigint)
                 on_time_orders,
               {rnd('sum(case when o.actual_delivery_date <= o.expected_delivery_date then 1 else 0 end) * 100.0'
                    ' / count(o.order_id)', 2)} on_time_pct,
               {rnd('avg(o.actual_delivery_date - o.expected_delivery_date)', 2)} avg_days_late,
               s.reliability_score
            from v_suppliers s left join v_orders o on s.supplier_id = o.supplier_id
            where o.order_date >= date '{ORDERS_AS_OF}' - 180
            group by s.supplier_id, s.supplier_name, s.reliability_score
            having count(o.order_id) > 0"""
    ),
    "inventory_health": _fan_out("v_sales"),
    "inventory_health_sparse": _fan_out("(select * replace (product_id - product_id % 2 as product_id) from v_sales)"),
    "inventory_health_true_stock": with_views(
        f"""with stats as (
        select p.product_id, p.product_name, i.total_stock, s.avg_daily_sales
        from v_products p
             join (select product_id, cast(sum(quantity_on_hand) as bigint) total_stock from v_inventory
                   where snapshot_date = (select max(snapshot_date) from v_inventory) group by 1) i
               on p.product_id = i.product_id
             left join (select product_id, avg(quantity_sold) avg_daily_sales from v_sales group by 1) s
               on p.product_id = s.product_id) {_STATS_TAIL}"""
    ),
    "sales_rolling": with_views(
        f"""with daily as (
        select sale_date, product_id, cast(sum(quantity_sold) as bigint) daily_quantity,
               sum(revenue) daily_revenue
        from v_sales where sale_date >= date '{AS_OF}' - 365 group by 1, 2),
        rolled as (
        select *, avg(daily_quantity) over w30 ma30, avg(daily_quantity) over w90 ma90,
               stddev_pop(daily_quantity) over w90 vol
        from daily
        window w30 as (partition by product_id order by sale_date rows between 29 preceding and current row),
               w90 as (partition by product_id order by sale_date rows between 89 preceding and current row))
        select sale_date, product_id, daily_quantity, cast(daily_revenue as decimal(25,2)) daily_revenue,
               {rnd('ma30', 6)} moving_avg_30day, {rnd('ma90', 6)} moving_avg_90day, {rnd('vol', 6)} volatility_90day,
               {rnd('ma30 * cast(1.2 as double)', 0)} conservative_forecast
        from rolled where sale_date >= date '{AS_OF}' - 90"""
    ),
    "daily_sales": with_views(
        """select sale_date, product_id, cast(sum(quantity_sold) as bigint) daily_quantity,
           cast(sum(revenue) as decimal(25,2)) daily_revenue from v_sales group by 1, 2"""
    ),
    "latest_snapshot": with_views(
        "select * from v_inventory where snapshot_date = (select max(snapshot_date) from v_inventory)"
    ),
    "order_status_counts": with_views(
        "select delivery_status, count(*) total_orders from v_orders group by 1"
    ),
    "sales_range": with_views(
        """select count(*) total_sales, min(sale_date) min_sale_date, max(sale_date) max_sale_date from v_sales"""
    ),
}

for _report in A.REPORT_ORDER:
    QUERIES[f"{_report}_in_order"] = _shown(_report, QUERIES[_report])
    _order = ", ".join(f"{c} {'asc' if rising else 'desc'}" for c, rising in A.REPORT_ORDER[_report])
    ORACLE[f"{_report}_in_order"] = f"select *, row_number() over (order by {_order}) as position from ({ORACLE[_report]})"

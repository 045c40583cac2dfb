"""Registered queries: cleaning, de-duplication, derived columns, business rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline import bindings as B
from wharfline.functions.scalars import rounded
from wharfline.operators import transform as T
from wharfline.suite import shaped as Sh
from wharfline.suite.oracle import rnd, with_views

ORDER = ["sale_date", "sale_id", "product_id", "warehouse_id", "full_quantity", "full_revenue"]


def _filled(spark, sf, strategy):
    out = T.clean_nulls(Sh.gappy_sales(spark, sf), strategy)
    return out.withColumns({c: rounded(F.col(c), 6) for c in ("quantity_sold", "revenue")})


def _forward(spark, sf, keys=()):
    order = [c for c in ORDER if c not in keys]
    return T.clean_nulls(Sh.gappy_sales(spark, sf), "fill_forward", order, keys)


def _zero_sales(spark, sf):
    return B.sales(spark, sf).withColumn("quantity_sold", F.col("quantity_sold") % 10)


_LOW = {"products": Sh.low_products, "inventory": Sh.low_inventory, "orders": Sh.low_orders, "sales": Sh.low_sales}


def _impact(spark, sf):
    return reduce(DataFrame.unionByName, [T.business_rule_impact(f(spark, sf), t) for t, f in _LOW.items()])


def _timed(spark, sf):
    """Order dates as text with a time of day."""
    moment = F.timestamp_seconds(F.unix_seconds(F.col("order_date").cast("timestamp")) + F.col("order_quantity") * 60)
    return B.orders(spark, sf).select("order_id", F.date_format(moment, "yyyy-MM-dd HH:mm").alias("order_date"))


QUERIES = {
    "null_total": lambda spark, sf: T.null_total(Sh.gappy_sales(spark, sf)),
    "clean_nulls_drop": lambda spark, sf: T.clean_nulls(Sh.gappy_sales(spark, sf), "drop"),
    "clean_nulls_mean": lambda spark, sf: _filled(spark, sf, "fill_mean"),
    "clean_nulls_median": lambda spark, sf: _filled(spark, sf, "fill_median"),
    "clean_nulls_ffill": _forward,
    "clean_nulls_ffill_by_key": lambda spark, sf: _forward(spark, sf, ["warehouse_id"]),
    "dedup_rows": lambda spark, sf: T.remove_duplicates(Sh.sale_cells(spark, sf)),
    "dedup_subset": lambda spark, sf: T.remove_duplicates(
        B.orders(spark, sf), ["order_id"], [c for c in B.orders(spark, sf).columns if c != "order_id"]
    ),
    "standardize_dates_time": lambda spark, sf: T.standardize_dates(_timed(spark, sf), fmt="yyyy-MM-dd HH:mm").withColumn(
        "order_date", F.date_format("order_date", "yyyy-MM-dd HH:mm")
    ),
    "clean_nulls_unknown": lambda spark, sf: T.clean_nulls(Sh.gappy_sales(spark, sf), "no such strategy"),
    "standardize_dates": lambda spark, sf: T.standardize_dates(Sh.raw_orders(spark, sf)),
    "derive_inventory": lambda spark, sf: T.add_derived_columns(B.inventory(spark, sf), "inventory"),
    "derive_orders": lambda spark, sf: T.add_derived_columns(B.orders(spark, sf), "orders"),
    "derive_sales": lambda spark, sf: T.add_derived_columns(_zero_sales(spark, sf), "sales").withColumn(
        "unit_price", rounded(F.col("unit_price"), 6)
    ),
    **{
        f"business_rules_{t}": (lambda spark, sf, t=t, f=f: T.apply_business_rules(f(spark, sf), t))
        for t, f in _LOW.items()
    },
    "business_rule_impact": _impact,
}

_KEEP = {
    "products": "unit_cost > 0 and reorder_level >= 0",
    "inventory": "quantity_on_hand >= 0 and quantity_reserved >= 0",
    "orders": "order_quantity > 0 and order_cost >= 0",
    "sales": "quantity_sold > 0 and revenue >= 0",
}
_FULL = ", ".join(ORDER)


def _fill_sql(aggregate: str) -> str:
    cells = [
        rnd(f"coalesce(cast({c} as double), (select {aggregate}(cast({c} as double)) from v_gappy_sales))", 6) + f" {c}"
        for c in ("quantity_sold", "revenue")
    ]
    return with_views(f"select {_FULL}, {', '.join(cells)} from v_gappy_sales")


def _forward_sql(window: str) -> str:
    cells = [f"last_value({c} ignore nulls) over w {c}" for c in ("quantity_sold", "revenue")]
    return with_views(
        f"""select {_FULL}, {', '.join(cells)} from v_gappy_sales
        window w as ({window} rows between unbounded preceding and current row)"""
    )


ORACLE = {
    "null_total": with_views(
        "select cast(sum((quantity_sold is null)::int + (revenue is null)::int) as bigint) total_nulls from v_gappy_sales"
    ),
    "clean_nulls_drop": with_views("select * from v_gappy_sales where quantity_sold is not null and revenue is not null"),
    "clean_nulls_mean": _fill_sql("avg"),
    "clean_nulls_median": _fill_sql("median"),
    "clean_nulls_ffill": _forward_sql(f"order by {_FULL}"),
    "clean_nulls_ffill_by_key": _forward_sql(
        f"partition by warehouse_id order by {', '.join(c for c in ORDER if c != 'warehouse_id')}"
    ),
    "dedup_rows": with_views("select distinct * from v_sale_cells"),
    "dedup_subset": with_views(
        """select * exclude rn from (select *, row_number() over (partition by order_id order by order_date, supplier_id,
          order_quantity, order_cost, expected_delivery_date, actual_delivery_date nulls first, delivery_status) rn
          from v_orders) where rn = 1"""
    ),
    "standardize_dates_time": with_views(
        """select order_id, strftime(order_date + to_minutes(order_quantity), '%Y-%m-%d %H:%M') order_date from v_orders"""
    ),
    "clean_nulls_unknown": with_views("select * from v_gappy_sales"),
    "standardize_dates": with_views(
        """select * replace (cast(try_strptime(order_date, '%Y-%m-%d') as date) as order_date) from v_raw_orders"""
    ),
    "derive_inventory": with_views("select *, quantity_on_hand - quantity_reserved quantity_available from v_inventory"),
    "derive_orders": with_views("select * from v_done_orders"),
    "derive_sales": with_views(
        f"""select * replace (quantity_sold % 10 as quantity_sold),
          {rnd('cast(revenue as double) / nullif(quantity_sold % 10, 0)', 6)} unit_price from v_sales"""
    ),
    **{f"business_rules_{t}": with_views(f"select * from v_low_{t} where {keep}") for t, keep in _KEEP.items()},
    "business_rule_impact": with_views(
        " union all ".join(
            f"select '{t}' table_name, count(*) rows_before, count(*) filter (where {keep}) rows_kept, "
            f"count(*) - count(*) filter (where {keep}) rows_removed from v_low_{t}"
            for t, keep in _KEEP.items()
        )
    ),
}

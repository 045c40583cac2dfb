"""Supply-chain tables derived from the TPC-H-like parquet tables of TESTDATA.md.

Money is cast to two-decimal DECIMAL here, so sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _line_id() -> F.Column:
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint")


def suppliers(spark: SparkSession, sf: str) -> DataFrame:
    s, n = base(spark, sf, "supplier"), base(spark, sf, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("country"),
        F.floor(F.abs("s_acctbal") / 100).cast("int").alias("reliability_score"),
        ((F.col("s_suppkey") % 30).cast("int") + 5).alias("lead_time_days"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    n_suppliers = base(spark, sf, "supplier").agg(F.count("*")).scalar()
    return base(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_cost"),
        F.col("p_size").alias("reorder_level"),
        (F.col("p_partkey") % n_suppliers).alias("supplier_id"),
    )


def warehouses(spark: SparkSession, sf: str) -> DataFrame:
    n, r = base(spark, sf, "nation"), base(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("warehouse_id"),
        F.col("n_name").alias("warehouse_name"),
        F.col("r_name").alias("location"),
        ((F.col("n_nationkey") + 1) * 1000).alias("capacity_units"),
    )


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "lineitem").select(
        _line_id().alias("sale_id"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_suppkey") % 25).alias("warehouse_id"),
        F.col("l_quantity").cast("int").alias("quantity_sold"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("revenue"),
    )


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)
    return (
        base(spark, sf, "lineitem")
        .groupBy(
            F.col("l_partkey").alias("product_id"),
            (F.col("l_suppkey") % 25).alias("warehouse_id"),
            F.trunc("l_shipdate", "year").alias("snapshot_date"),
        )
        .agg(
            F.sum("l_quantity").cast("int").alias("quantity_on_hand"),
            F.sum(returned).cast("int").alias("quantity_reserved"),
        )
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    li, o = base(spark, sf, "lineitem"), base(spark, sf, "orders")
    ordered = F.col("o_orderdate").cast("date")
    arrived = F.date_add(ordered, F.lit(20) + F.col("l_quantity").cast("int") % 20)
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _line_id().alias("order_id"),
        ordered.alias("order_date"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("order_quantity"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("order_cost"),
        F.date_add(ordered, 30).alias("expected_delivery_date"),
        F.when(F.col("l_linestatus") != "O", arrived).alias("actual_delivery_date"),
        F.col("l_linestatus").alias("delivery_status"),
    )


def price_history(spark: SparkSession, sf: str) -> DataFrame:
    return base(spark, sf, "lineitem").select(
        _line_id().alias("price_history_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_shipdate").cast("date").alias("effective_date"),
    )


TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "suppliers": suppliers,
    "products": products,
    "warehouses": warehouses,
    "inventory": inventory,
    "orders": orders,
    "sales": sales,
    "price_history": price_history,
}


def bind(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return TABLES[table](spark, sf)


def bind_all(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: make(spark, sf) for name, make in TABLES.items()}

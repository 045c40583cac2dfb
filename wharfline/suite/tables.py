"""Registered queries: sources, sinks, ids and synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline import bindings as B
from wharfline.session import scratch_path
from wharfline.sources import readers as R
from wharfline.sources import synth as S
from wharfline.sources import writers as Wr
from wharfline.suite.oracle import with_views

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SYNTH_AS_OF = "2026-01-28"
CUSTOM_SQL = """
    select s.supplier_id, s.supplier_name, count(*) as n_orders, sum(o.order_cost) as total_cost
    from {suppliers} s join {orders} o on s.supplier_id = o.supplier_id
    where o.order_quantity >= :least
    group by s.supplier_id, s.supplier_name"""


def _files(sf: str) -> R.FileSource:
    return R.FileSource(sf, pattern="{table}.parquet")


def _custom(spark, sf):
    tables = {"suppliers": B.suppliers(spark, sf), "orders": B.orders(spark, sf)}
    return R.extract_query(spark, CUSTOM_SQL, {"least": 10}, tables).withColumn(
        "total_cost", F.col("total_cost").cast("decimal(25,2)")
    )


def _load_modes(spark, sf):
    """Replace, then append, then read back: each row twice."""
    target = Wr.FileTarget(scratch_path(spark, "load-modes"))
    rows = B.products(spark, sf)
    Wr.load(rows, target, "replace", create_backup=False)
    Wr.load(rows, target, "append")
    return target.read(spark)


REJECT = {"too many": "quantity_sold > 45", "no revenue": "revenue is null", "no quantity": "quantity_sold is null"}


def _load_quarantine(spark, sf):
    from wharfline.suite.shaped import gappy_sales

    good = Wr.FileTarget(scratch_path(spark, "load-good"))
    bad = Wr.FileTarget(scratch_path(spark, "load-bad"))
    Wr.load(gappy_sales(spark, sf), good, "fail", reject_if=REJECT, quarantine=bad)
    return good.read(spark).withColumn("reject_reason", F.lit("")).unionByName(bad.read(spark))


def _load_backup(spark, sf):
    """Replace a table that is there already: the copy holds what it was."""
    target = Wr.FileTarget(scratch_path(spark, "load-backup"))
    Wr.load(B.suppliers(spark, sf), target, "replace", create_backup=False)
    result = Wr.load(B.suppliers(spark, sf).withColumn("lead_time_days", F.lit(0)), target, "replace")
    kept = spark.read.parquet(result.backup)
    return kept.withColumn("version", F.lit("backup")).unionByName(target.read(spark).withColumn("version", F.lit("now")))


def _json(spark, sf):
    path, rows = scratch_path(spark, "json"), B.suppliers(spark, sf)
    Wr.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


def _insert_ignore(spark, sf):
    """The stock table before its newest snapshot takes one row per product, warehouse and year from the sales."""
    stock = B.inventory(spark, sf)
    newest = stock.select(F.max("snapshot_date")).scalar()
    batch = B.sales(spark, sf).select(
        "product_id",
        "warehouse_id",
        F.trunc("sale_date", "year").alias("snapshot_date"),
        F.col("quantity_sold").alias("quantity_on_hand"),
    )
    target = stock.where(F.col("snapshot_date") < newest)
    return Wr.insert_ignore(batch, target, ["product_id", "warehouse_id", "snapshot_date"], ["quantity_on_hand"])


def _surrogate_ids(spark, sf):
    batch = B.sales(spark, sf).drop("sale_id")
    return Wr.assign_surrogate_ids(batch, "sale_id", B.sales(spark, sf), ["sale_date", "product_id"])


def _surrogate_ids_hot(spark, sf):
    """Rows with very many copies: the ids of one value are consecutive."""
    batch = B.orders(spark, sf).select("delivery_status")
    return Wr.assign_surrogate_ids(batch, "order_id", B.orders(spark, sf), ["delivery_status"])


def _order_ids(spark, sf) -> DataFrame:
    return B.base(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))


QUERIES = {
    "extract_full": lambda spark, sf: R.extract_table(spark, _files(sf), "lineitem").withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    ),
    "extract_date_range": lambda spark, sf: R.extract_table(
        spark, _files(sf), "lineitem", "l_shipdate", "1998-01-01", "1998-12-31"
    ).withColumn("l_shipdate", F.col("l_shipdate").cast("date")),
    "extract_custom_query": _custom,
    "table_inventory": lambda spark, sf: R.table_inventory({t: B.base(spark, sf, t) for t in BASE_TABLES}),
    "load_modes": _load_modes,
    "load_quarantine": _load_quarantine,
    "load_backup": _load_backup,
    "json_round_trip": _json,
    "insert_ignore": _insert_ignore,
    "assign_surrogate_ids": _surrogate_ids,
    "assign_surrogate_ids_copies": _surrogate_ids_hot,
    "synth_inventory": lambda spark, sf: S.synth_inventory(_order_ids(spark, sf), SYNTH_AS_OF),
    "synth_orders": lambda spark, sf: S.synth_orders(_order_ids(spark, sf), SYNTH_AS_OF),
    "synth_sales": lambda spark, sf: S.synth_sales(_order_ids(spark, sf), SYNTH_AS_OF),
}


def _draw(purpose: str, low, high) -> str:
    word = f"cast('0x' || substr(md5(id || ':{purpose}:42'), 1, 12) as bigint)"
    return f"(cast({low} as bigint) + {word} % (cast({high} as bigint) - cast({low} as bigint) + 1))"


def _day(purpose: str, first: str) -> str:
    days = f"(date '{SYNTH_AS_OF}' - date '{first}')"
    return f"date '{first}' + cast({_draw(purpose, 0, days)} as int)"


def _money(purpose: str, low: int, high: int) -> str:
    return f"cast(cast({_draw(purpose, low * 100, high * 100)} as decimal(17,2)) / 100 as decimal(15,2))"


_IDS = "(select cast(o_orderkey as varchar) id from orders)"

ORACLE = {
    "load_backup": with_views(
        "select *, 'backup' as version from v_suppliers union all "
        "select * replace (cast(0 as int) as lead_time_days), 'now' as version from v_suppliers"
    ),
    "json_round_trip": with_views("select * from v_suppliers"),
    "extract_full": "select * replace (cast(l_shipdate as date) as l_shipdate) from lineitem",
    "extract_date_range": """select * replace (cast(l_shipdate as date) as l_shipdate) from lineitem
        where l_shipdate between date '1998-01-01' and date '1998-12-31'""",
    "extract_custom_query": with_views(
        """select s.supplier_id, s.supplier_name, count(*) n_orders, cast(sum(o.order_cost) as decimal(25,2)) total_cost
        from v_suppliers s join v_orders o on s.supplier_id = o.supplier_id
        where o.order_quantity >= 10 group by 1, 2"""
    ),
    "table_inventory": " union all ".join(
        f"select '{t}' table_name, (select count(*) from {t}) row_count, "
        f"cast((select count(*) from (describe {t})) as int) column_count"
        for t in BASE_TABLES
    ),
    "load_modes": with_views("select * from v_products union all select * from v_products"),
    "load_quarantine": with_views(
        """select *, concat_ws('; ', case when quantity_sold > 45 then 'too many' end,
             case when revenue is null then 'no revenue' end,
             case when quantity_sold is null then 'no quantity' end) reject_reason from v_gappy_sales"""
    ),
    "insert_ignore": with_views(
        """with batch as (
        select product_id, warehouse_id, cast(date_trunc('year', sale_date) as date) snapshot_date,
               min(quantity_sold) quantity_on_hand from v_sales group by 1, 2, 3)
        select * from batch b where not exists (
          select 1 from v_inventory t where t.product_id = b.product_id and t.warehouse_id = b.warehouse_id
            and t.snapshot_date = b.snapshot_date
            and t.snapshot_date < (select max(snapshot_date) from v_inventory))"""
    ),
    "assign_surrogate_ids": with_views(
        """select sale_date, product_id, warehouse_id, quantity_sold, revenue,
          (select max(sale_id) from v_sales) + row_number() over (
            order by sale_date, product_id, warehouse_id, quantity_sold, revenue) sale_id from v_sales"""
    ),
    "assign_surrogate_ids_copies": with_views(
        """select delivery_status, (select max(order_id) from v_orders)
          + row_number() over (order by delivery_status) order_id from v_orders"""
    ),
    "synth_inventory": f"""
        with drawn as (select id, {_draw('product', 1, 46)} product_id, {_draw('warehouse', 1, 18)} warehouse_id,
            {_draw('on_hand', 10, 999)} quantity_on_hand, {_day('snapshot', '2020-01-01')} snapshot_date from {_IDS})
        select product_id, warehouse_id, quantity_on_hand,
            {_draw('reserved', 'quantity_on_hand // 10', 'quantity_on_hand * 9 // 10')} quantity_reserved,
            snapshot_date from drawn""",
    "synth_orders": f"""
        with drawn as (select id, {_day('order', '2024-01-01')} order_date, {_draw('delivered', 0, 1)} = 1 done from {_IDS})
        select cast(id as bigint) order_id, order_date, {_draw('supplier', 1, 30)} supplier_id,
            {_draw('quantity', 1, 10000)} order_quantity, {_money('cost', 2000, 300000)} order_cost,
            order_date + cast({_draw('expected', 30, 1000)} as int) expected_delivery_date,
            case when done then order_date + cast({_draw('actual', 1, 1000)} as int) end actual_delivery_date,
            case when done then 'Delivered' when {_draw('open', 0, 1)} = 1 then 'Pending' else 'In Transit' end
              delivery_status
        from drawn""",
    "synth_sales": f"""
        select cast(id as bigint) sale_id, {_day('sale', '2024-01-01')} sale_date, {_draw('product', 1, 46)} product_id,
            {_draw('warehouse', 1, 18)} warehouse_id, {_draw('quantity', 1, 300)} quantity_sold,
            {_money('revenue', 700, 10000)} revenue from {_IDS}""",
}

"""SQL text of the bound tables, for the cross-check of the registered queries in DuckDB."""

from __future__ import annotations

import re

from wharfline.suite.shaped import VIEWS as SHAPED

VIEWS: dict[str, str] = {
    "v_suppliers": """
        select s_suppkey supplier_id, s_name supplier_name, n_name country,
               cast(floor(abs(s_acctbal) / 100) as int) reliability_score,
               cast(s_suppkey % 30 as int) + 5 lead_time_days
        from supplier join nation on s_nationkey = n_nationkey""",
    "v_products": """
        select p_partkey product_id, p_name product_name, p_type category,
               cast(p_retailprice as decimal(10,2)) unit_cost, p_size reorder_level,
               p_partkey % (select count(*) from supplier) supplier_id
        from part""",
    "v_warehouses": """
        select cast(n_nationkey as bigint) warehouse_id, n_name warehouse_name, r_name as location,
               (n_nationkey + 1) * 1000 capacity_units
        from nation join region on n_regionkey = r_regionkey""",
    "v_sales": """
        select l_orderkey * 10 + l_linenumber sale_id, cast(l_shipdate as date) sale_date,
               l_partkey product_id, l_suppkey % 25 warehouse_id, cast(l_quantity as int) quantity_sold,
               cast(l_extendedprice as decimal(15,2)) revenue
        from lineitem""",
    "v_inventory": """
        select l_partkey product_id, l_suppkey % 25 warehouse_id,
               cast(date_trunc('year', l_shipdate) as date) snapshot_date,
               cast(sum(l_quantity) as int) quantity_on_hand,
               cast(sum(case when l_returnflag = 'R' then l_quantity else 0 end) as int) quantity_reserved
        from lineitem group by 1, 2, 3""",
    "v_orders": """
        select l_orderkey * 10 + l_linenumber order_id, cast(o_orderdate as date) order_date,
               l_suppkey supplier_id, cast(l_quantity as int) order_quantity,
               cast(l_extendedprice as decimal(15,2)) order_cost,
               cast(o_orderdate as date) + 30 expected_delivery_date,
               case when l_linestatus <> 'O'
                    then cast(o_orderdate as date) + (20 + cast(l_quantity as int) % 20) end actual_delivery_date,
               l_linestatus delivery_status
        from lineitem join orders on l_orderkey = o_orderkey""",
    "v_price_history": """
        select l_orderkey * 10 + l_linenumber price_history_id, l_partkey product_id, l_suppkey supplier_id,
               l_extendedprice / l_quantity unit_price, cast(l_shipdate as date) effective_date
        from lineitem""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it names, directly or through other views."""
    texts = {**VIEWS, **SHAPED}
    used: list[str] = []

    def visit(text: str) -> None:
        for name in texts:
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(texts[name])
                if name not in used:
                    used.append(name)

    visit(sql)
    if not used:
        return sql
    ctes = ",\n".join(f"{name} as ({texts[name]})" for name in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def rnd(expression: str, digits: int) -> str:
    """Round half away from zero on the decimal form of a double, as Spark and MySQL do."""
    return f"cast(round(cast({expression} as decimal(38,12)), {digits}) as double)"

"""Registered queries: null, duplicate and key checks, validation reports, rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline import bindings as B
from wharfline.functions.scalars import rounded
from wharfline.operators import rules as Ru
from wharfline.operators import validate as V
from wharfline.operators.transform import add_derived_columns
from wharfline.schemas import FOREIGN_KEYS
from wharfline.suite import shaped as Sh
from wharfline.suite.oracle import rnd, with_views


def _done_orders(spark, sf):
    return add_derived_columns(B.orders(spark, sf), "orders")


def _sixth(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), 6) for c in columns})


def _pairs(column: str):
    """A map as text, so that results compare as plain values."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")


def _flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "table_name",
        "total_rows",
        _pairs("null_count").alias("null_count"),
        "duplicate_count",
        _pairs("missing_foreign_keys").alias("missing_foreign_keys"),
        "validation_passed",
        F.array_join("issues", " | ").alias("issues"),
    )


CHECKED = {
    "suppliers": (B.suppliers, "v_suppliers"),
    "products": (B.products, "v_products"),
    "warehouses": (B.warehouses, "v_warehouses"),
    "inventory": (B.inventory, "v_inventory"),
    "orders": (_done_orders, "v_done_orders"),
    "sales": (Sh.shifted_sales, "v_shifted_sales"),
    "price_history": (B.price_history, "v_price_history"),
}
COLUMNS = {
    "suppliers": "supplier_id supplier_name country reliability_score lead_time_days",
    "products": "product_id product_name category unit_cost reorder_level supplier_id",
    "warehouses": "warehouse_id warehouse_name location capacity_units",
    "inventory": "product_id warehouse_id snapshot_date quantity_on_hand quantity_reserved",
    "orders": "order_id order_date supplier_id order_quantity order_cost expected_delivery_date "
    "actual_delivery_date delivery_status delivery_delay_days is_late",
    "sales": "sale_id sale_date product_id warehouse_id quantity_sold revenue",
    "price_history": "price_history_id product_id supplier_id unit_price effective_date",
}


def _parents(spark, sf):
    return {p: B.bind(spark, sf, p) for p in ("suppliers", "products", "warehouses")}


def _summary(spark, sf):
    parents = _parents(spark, sf)
    reports = [V.validate_table(make(spark, sf), t, parents) for t, (make, _) in CHECKED.items()]
    return V.quality_summary(reports).drop("timestamp")


def _validated(spark, sf, table):
    return _flat_report(V.validate_table(CHECKED[table][0](spark, sf), table, _parents(spark, sf)))


def _rule_rows(results: DataFrame) -> DataFrame:
    return _sixth(
        results.select("table_name", "rule_name", "passed", "severity", "affected_rows", "affected_percentage"),
        "affected_percentage",
    )


def _one_rule(make, table, rule):
    def query(spark, sf):
        return _rule_rows(Ru.RuleBook().add_rules({table: [rule]}).execute_rules(make(spark, sf), table))

    return query


# Rule input: out-of-range values and NULLs, so that rules fail as well as pass.
RULE_INPUT = {
    "suppliers": (B.suppliers, "v_suppliers"),
    "products": (Sh.low_products, "v_low_products"),
    "inventory": (Sh.low_inventory, "v_low_inventory"),
    "orders": (Sh.low_orders, "v_low_orders"),
    "sales": (Sh.low_sales, "v_low_sales"),
}


def _rule_book(rules):
    def query(spark, sf):
        book = Ru.RuleBook().add_rules(rules)
        found = [book.execute_rules(RULE_INPUT[t][0](spark, sf), t) for t in rules]
        return _rule_rows(reduce(DataFrame.unionByName, found))

    return query


def _rule_summary(spark, sf):
    book = Ru.RuleBook().add_rules(Ru.STANDARD_RULES)
    for t in Ru.STANDARD_RULES:
        book.execute_rules(RULE_INPUT[t][0](spark, sf), t)
    return book.summary().drop("timestamp")


def _rule_messages(spark, sf):
    """The validation table of the report, with messages and details as text, and without the time."""
    book = Ru.RuleBook().add_rules(Ru.STANDARD_RULES)
    results = reduce(DataFrame.unionByName, [book.execute_rules(RULE_INPUT[t][0](spark, sf), t) for t in Ru.STANDARD_RULES])
    entries = F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("bigint").cast("string")))
    details = results.select("rule_name", F.array_join(entries, ";").alias("details"))
    return Ru.rule_report(results).drop("timestamp").join(details, "rule_name")


def _double_keys(spark, sf):
    """Keys as pandas writes integers with gaps: doubles with NULLs, against integer parents."""
    sales = Sh.shifted_sales(spark, sf)
    return sales.withColumns({"product_id": F.col("product_id").cast("double"), "warehouse_id": F.col("warehouse_id").cast("decimal(20,2)")})


def _required(spark, sf):
    report = V.validate_table(B.sales(spark, sf), "sales", {}, required_columns=["sale_id", "channel", "currency"])
    return _flat_report(report)


def _low_stock(spark, sf):
    """Stock against the reorder level of the product, brought in by a join."""
    levels = B.products(spark, sf).select("product_id", "reorder_level")
    stock = B.inventory(spark, sf).join(levels, "product_id")
    return _rule_rows(
        Ru.RuleBook().add_rules({"inventory": Ru.CUSTOM_RULES["inventory"]}).execute_rules(stock, "inventory")
    )


_COMPLETE = Ru.Rule("quantity_present", "completeness", "quantity_sold", severity="WARNING", threshold=2.5)
_UNIQUE = Ru.Rule("order_id_unique", "uniqueness", "order_id")
_VALID = Ru.STANDARD_RULES["sales"][0]
_CONSISTENT = Ru.STANDARD_RULES["inventory"][1]

QUERIES = {
    "null_counts": lambda spark, sf: V.null_counts(_done_orders(spark, sf)).drop("column_index"),
    "uniqueness_check": lambda spark, sf: V.duplicate_count(Sh.gappy_sales(spark, sf), ["sale_id"]),
    "uniqueness_check_nulls": lambda spark, sf: V.duplicate_count(Sh.gappy_sales(spark, sf), ["quantity_sold"]),
    "duplicate_rows": lambda spark, sf: V.duplicate_count(Sh.sale_cells(spark, sf)),
    "fk_orphans": lambda spark, sf: V.fk_orphans(Sh.shifted_sales(spark, sf), "sales", _parents(spark, sf)),
    "fk_orphans_double": lambda spark, sf: V.fk_orphans(_double_keys(spark, sf), "sales", _parents(spark, sf)),
    "required_columns": _required,
    "report_validation_rows": _rule_messages,
    "fk_orphan_rows": lambda spark, sf: V.fk_orphan_rows(
        Sh.shifted_sales(spark, sf), "product_id", B.products(spark, sf)
    ),
    "fk_valid_rows": lambda spark, sf: V.fk_valid_rows(
        Sh.shifted_sales(spark, sf), "product_id", B.products(spark, sf)
    ),
    "validate_nulls": lambda spark, sf: _sixth(V.null_threshold_issues(Sh.gappy_sales(spark, sf)), "null_fraction"),
    "validate_duplicates": lambda spark, sf: _sixth(
        V.duplicate_threshold_issues(Sh.sale_cells(spark, sf)), "duplicate_fraction"
    ),
    "validate_table": lambda spark, sf: _validated(spark, sf, "orders"),
    "validate_table_orphans": lambda spark, sf: _validated(spark, sf, "sales"),
    "quality_summary": _summary,
    "rule_uniqueness": _one_rule(B.orders, "orders", _UNIQUE),
    "rule_completeness": _one_rule(Sh.gappy_sales, "sales", _COMPLETE),
    "rule_validity": _one_rule(Sh.low_sales, "sales", _VALID),
    "rule_consistency": _one_rule(Sh.low_inventory, "inventory", _CONSISTENT),
    "rules_all_tables": _rule_book(Ru.STANDARD_RULES),
    "rules_documented": _rule_book(Ru.DOCUMENTED_RULES),
    "rules_custom": _rule_book(Ru.CUSTOM_RULES),
    "rules_low_stock": _low_stock,
    "rule_summary": _rule_summary,
}


# --- SQL --------------------------------------------------------------------------------------------------------------


def _null_rows(view: str, table: str) -> str:
    return " union all ".join(
        f"select '{c}' column_name, {i} idx, count(*) - count({c}) null_count, count(*) total_rows from {view}"
        for i, c in enumerate(COLUMNS[table].split())
    )


def _dups(view: str, columns: str) -> str:
    return (
        f"select cast(coalesce(sum(n - 1), 0) as bigint) duplicate_count, cast(coalesce(sum(n), 0) as bigint) total_rows "
        f"from (select count(*) n from {view} group by {columns})"
    )


def _orphans(view: str, table: str) -> str:
    parts = [
        f"select '{k.column}' column_name, '{k.parent}' parent_table, (select count(*) from {view} c where not exists "
        f"(select 1 from v_{k.parent} p where p.{k.column} = c.{k.column})) orphan_rows"
        for k in FOREIGN_KEYS
        if k.table == table
    ]
    return " union all ".join(parts) or "select '' column_name, '' parent_table, 0 orphan_rows where false"


def _pct1(part: str, whole: str) -> str:
    return f"printf('%.1f%%', round(cast({part} * 100.0 / {whole} as decimal(18,9)), 1))"


def _report(table: str) -> str:
    view = CHECKED[table][1]
    cols = ", ".join(COLUMNS[table].split())
    return f"""
        with nulls as ({_null_rows(view, table)}), dups as ({_dups(view, cols)}), fks as ({_orphans(view, table)}),
        found as (
        select 1 kind, idx pos, 'Column ''' || column_name || ''' has ' || {_pct1('null_count', 'total_rows')}
                 || ' nulls (threshold: 5.0%)' issue
          from nulls where null_count > 0.05 * total_rows
        union all
        select 2, 0, 'Found ' || duplicate_count || ' duplicates (' || {_pct1('duplicate_count', 'total_rows')} || ')'
          from dups where duplicate_count > 0.01 * total_rows
        union all
        select 3, row_number() over (order by column_name), 'Missing foreign key references in ''' || column_name
                 || ''': ' || orphan_rows || ' rows' from fks where orphan_rows > 0)
        select '{table}' table_name, (select total_rows from dups) total_rows,
          coalesce((select string_agg(column_name || '=' || null_count, ';' order by column_name)
                    from nulls where null_count > 0), '') null_count,
          (select duplicate_count from dups) duplicate_count,
          coalesce((select string_agg(column_name || '=' || orphan_rows, ';' order by column_name)
                    from fks where orphan_rows > 0), '') missing_foreign_keys,
          (select count(*) from found) = 0 validation_passed,
          coalesce((select string_agg(issue, ' | ' order by kind, pos) from found), '') issues"""


def _summary_sql(table: str) -> str:
    return f"""
        select table_name, total_rows,
          cast(case when null_count = '' then 0 else length(null_count) - length(replace(null_count, '=', '')) end as int)
            null_columns,
          (select cast(coalesce(sum(null_count), 0) as bigint) from ({_null_rows(CHECKED[table][1], table)})) total_nulls,
          duplicate_count duplicates,
          cast(length(missing_foreign_keys) - length(replace(missing_foreign_keys, '=', '')) as int) fk_issues,
          validation_passed,
          cast(case when issues = '' then 0 else 1 + (length(issues) - length(replace(issues, ' | ', ''))) / 3 end as int)
            issue_count
        from ({_report(table)})"""


def _rule_sql(table: str, view: str, rule: Ru.Rule, condition: str | None = None) -> str:
    if rule.kind == "uniqueness":
        failing = f"(select cast(coalesce(sum(n - 1), 0) as bigint) from (select count(*) n from {view} group by {rule.column}))"
    elif rule.kind == "completeness":
        failing = f"(select count(*) from {view} where {rule.column} is null)"
    else:
        failing = f"(select count(*) from {view} where ({condition}) is not true)"
    share = f"{failing} * 100.0 / (select count(*) from {view})"
    passed = f"{share} <= {rule.threshold or 0}" if rule.kind == "completeness" else f"{failing} = 0"
    return (
        f"select '{table}' table_name, '{rule.name}' rule_name, {passed} passed, '{rule.severity}' severity, "
        f"{failing} affected_rows, {rnd(share, 6)} affected_percentage"
    )


# The rule conditions once more, in DuckDB's SQL.
_CONDITIONS = {
    "reliability_score_range": "reliability_score between 0 and 100",
    "unit_cost_positive": "unit_cost > 0",
    "quantity_on_hand_valid": "quantity_on_hand >= 0",
    "reserved_not_exceed_onhand": "quantity_reserved <= quantity_on_hand",
    "order_quantity_positive": "order_quantity > 0",
    "quantity_sold_positive": "quantity_sold > 0",
    "lead_time_positive": "lead_time_days > 0",
    "reorder_level_valid": "reorder_level >= 0",
    "quantity_reserved_valid": "quantity_reserved >= 0",
    "order_cost_positive": "order_cost >= 0",
    "delivery_dates_logical": "actual_delivery_date is null or actual_delivery_date > order_date",
    "revenue_positive": "revenue >= 0",
    "revenue_quantity_consistency": "cast(revenue as double) / nullif(quantity_sold, 0) > 0",
    "reorder_level_reasonable": "reorder_level >= 10",
    "revenue_matches_calculation": "abs(revenue - quantity_sold * (revenue / nullif(quantity_sold, 0))) < 0.01",
    "low_stock_warning": "quantity_on_hand > reorder_level",
}


def _rules_sql(rules) -> str:
    return " union all ".join(
        _rule_sql(t, RULE_INPUT[t][1], r, _CONDITIONS.get(r.name)) for t, rs in rules.items() for r in rs
    )


_STANDARD_SQL = with_views(_rules_sql(Ru.STANDARD_RULES))
_ABSENT = (
    "select 'inventory' table_name, 'low_stock_warning' rule_name, false passed, 'CRITICAL' severity, "
    "cast(0 as bigint) affected_rows, cast(0 as double) affected_percentage"
)

def _message_sql(table: str, rule: Ru.Rule) -> str:
    row = _rule_sql(table, RULE_INPUT[table][1], rule, _CONDITIONS.get(rule.name))
    what = "duplicate_count" if rule.kind == "uniqueness" else "invalid_count"
    return (
        f"select rule_name, case when passed then '✓ PASS' else '✗ FAIL' end status, severity, "
        f"case when passed then '✓ PASS' else '✗ FAIL' end || ': {rule.description}' message, affected_rows, "
        f"printf('%.2f%%', round(cast(affected_percentage as decimal(18,9)), 2)) affected_percentage, "
        f"'{what}=' || affected_rows details from ({row})"
    )


ORACLE = {
    "fk_orphans_double": with_views(_orphans("v_shifted_sales", "sales")),
    "required_columns": with_views(
        "select table_name, total_rows, null_count, duplicate_count, '' missing_foreign_keys, false validation_passed, "
        "'Missing required columns: channel, currency' || case when issues = '' then '' else ' | ' || issues end issues "
        f"from ({_report('sales').replace('v_shifted_sales', 'v_sales')})"
    ),
    "report_validation_rows": with_views(
        " union all ".join(_message_sql(t, r) for t, rs in Ru.STANDARD_RULES.items() for r in rs)
    ),
    "null_counts": with_views(f"select * exclude idx from ({_null_rows('v_done_orders', 'orders')})"),
    "uniqueness_check": with_views(_dups("v_gappy_sales", "sale_id")),
    "uniqueness_check_nulls": with_views(_dups("v_gappy_sales", "quantity_sold")),
    "duplicate_rows": with_views(_dups("v_sale_cells", "product_id, warehouse_id, quantity_sold")),
    "fk_orphans": with_views(_orphans("v_shifted_sales", "sales")),
    "fk_orphan_rows": with_views(
        "select * from v_shifted_sales c where not exists (select 1 from v_products p where p.product_id = c.product_id)"
    ),
    "fk_valid_rows": with_views(
        "select * from v_shifted_sales c where exists (select 1 from v_products p where p.product_id = c.product_id)"
    ),
    "validate_nulls": with_views(
        f"""select column_name, null_count, {rnd('null_count * 1.0 / total_rows', 6)} null_fraction,
          null_count > 0.05 * total_rows exceeds_threshold
        from (select 'quantity_sold' column_name, count(*) - count(quantity_sold) null_count, count(*) total_rows
              from v_gappy_sales
              union all select 'revenue', count(*) - count(revenue), count(*) from v_gappy_sales)"""
    ),
    "validate_duplicates": with_views(
        f"""select duplicate_count, {rnd('duplicate_count * 1.0 / total_rows', 6)} duplicate_fraction,
          duplicate_count > 0.01 * total_rows exceeds_threshold
        from ({_dups('v_sale_cells', 'product_id, warehouse_id, quantity_sold')})"""
    ),
    "validate_table": with_views(_report("orders")),
    "validate_table_orphans": with_views(_report("sales")),
    "quality_summary": with_views(" union all ".join(_summary_sql(t) for t in CHECKED)),
    "rule_uniqueness": with_views(_rule_sql("orders", "v_orders", _UNIQUE)),
    "rule_completeness": with_views(_rule_sql("sales", "v_gappy_sales", _COMPLETE)),
    "rule_validity": with_views(_rule_sql("sales", "v_low_sales", _VALID, "quantity_sold > 0")),
    "rule_consistency": with_views(
        _rule_sql("inventory", "v_low_inventory", _CONSISTENT, "quantity_reserved <= quantity_on_hand")
    ),
    "rules_all_tables": _STANDARD_SQL,
    "rules_documented": with_views(_rules_sql(Ru.DOCUMENTED_RULES)),
    # The third rule names a column that the inventory lacks: a failed result, not an error.
    "rules_custom": with_views(
        _rules_sql({t: r for t, r in Ru.CUSTOM_RULES.items() if t != "inventory"}) + " union all " + _ABSENT
    ),
    "rules_low_stock": with_views(
        _rule_sql(
            "inventory",
            "(select i.*, p.reorder_level from v_inventory i join v_products p on i.product_id = p.product_id)",
            Ru.CUSTOM_RULES["inventory"][0],
            _CONDITIONS["low_stock_warning"],
        )
    ),
    "rule_summary": f"""
        select rule_name, case when passed then '✓ PASS' else '✗ FAIL' end status, severity, affected_rows,
          printf('%.2f%%', round(cast(affected_percentage as decimal(18,9)), 2)) affected_percentage
        from ({_STANDARD_SQL})""",
}

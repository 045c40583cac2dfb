"""Registered queries: profiles, outliers, reports, ETL runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline import bindings as B
from wharfline.functions.scalars import rounded
from wharfline.operators import anomaly as An
from wharfline.operators import profile as Pr
from wharfline.operators import rules as Ru
from wharfline.operators.iforest import isolation_forest
from wharfline.operators.transform import transform_table
from wharfline.plans import etl, report
from wharfline.session import cut, scratch_path
from wharfline.sources.readers import FrameSource
from wharfline.sources.writers import FileTarget
from wharfline.suite import shaped as Sh
from wharfline.suite.checks import CHECKED, COLUMNS, _dups, _null_rows, _rules_sql
from wharfline.suite.oracle import rnd, with_views

NUMERIC = {
    "v_products": ["product_id", "unit_cost", "reorder_level", "supplier_id"],
    "v_gappy_sales": ["sale_id", "product_id", "warehouse_id", "quantity_sold", "revenue"],
    "v_sales": ["sale_id", "product_id", "warehouse_id", "quantity_sold", "revenue"],
    "v_inventory": ["product_id", "warehouse_id", "quantity_on_hand", "quantity_reserved"],
    "events": ["event_id", "user_id", "value"],
}
STATS = ["mean", "median", "std", "min", "max", "q25", "q75", "skewness", "kurtosis"]


def _events(spark, sf):
    return B.base(spark, sf, "events")


def _numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return Pr.profile_numeric(df, columns).withColumns({c: rounded(F.col(c), 4) for c in STATS})


def _categorical(df: DataFrame) -> DataFrame:
    text = F.transform(
        "value_distribution", lambda t: F.concat(t["value"], F.lit("="), t["frequency"].cast("string"))
    )
    return Pr.profile_categorical(df).withColumn("value_distribution", F.array_join(text, ";"))


def _profile_flat(df: DataFrame, table: str) -> DataFrame:
    """The table profile with all its figures."""
    numeric = {c: rounded(F.col(f"numeric_stats.{c}"), 4).alias(c) for c in STATS}
    text = F.transform(
        "categorical_stats.value_distribution", lambda t: F.concat(t["value"], F.lit("="), t["frequency"].cast("string"))
    )
    kinds = {"numeric": "num", "date": "date", "categorical": "cat"}
    return Pr.profile_table(df, table).select(
        "table_name",
        "row_count",
        "column_count",
        "duplicate_rows",
        "column_index",
        "column_name",
        "kind",
        "null_count",
        rounded(F.col("null_percentage"), 6).alias("null_percentage"),
        *numeric.values(),
        *[F.col(f"{k}_stats.{c}").alias(f"{short}_{c}") for k, short in kinds.items() for c in ("count", "missing")],
        F.col("date_stats.min_date").alias("min_date"),
        F.col("date_stats.max_date").alias("max_date"),
        F.col("date_stats.date_range_days").alias("date_range_days"),
        F.col("categorical_stats.unique_count").alias("unique_count"),
        F.col("categorical_stats.top_value").alias("top_value"),
        F.col("categorical_stats.top_frequency").alias("top_frequency"),
        F.array_join(text, ";").alias("value_distribution"),
    )


def _scan(df: DataFrame, table: str, order_by: list[str]) -> DataFrame:
    values = F.transform("outlier_values", lambda v: F.format_string("%.2f", v))
    return An.anomaly_scan(df, table, order_by).withColumns(
        {
            "outlier_percentage": rounded(F.col("outlier_percentage"), 6),
            "outlier_values": F.array_join(values, ";"),
        }
    )


def _stored(make):
    """The bound table written once: scans and profiles read their input several times."""
    return lambda spark, sf: cut(make(spark, sf), "bound")


SCANNED = {
    "products": (B.products, "v_products", ["product_id"]),
    "inventory": (_stored(B.inventory), "v_inventory", ["product_id", "warehouse_id", "snapshot_date"]),
    "sales": (_stored(B.sales), "v_sales", ["sale_id", "sale_date"]),
    "events": (_events, "events", ["event_id"]),
}


def _scans(spark, sf) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [An.anomaly_scan(make(spark, sf), t, order) for t, (make, _, order) in SCANNED.items()]
    )


def _scans_flat(spark, sf) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [_scan(make(spark, sf), t, order) for t, (make, _, order) in SCANNED.items()]
    )


def _samples(spark, sf):
    df = _events(spark, sf)
    return An.outlier_samples(df, An.iqr_bounds(df, ["value"]), ["event_id"])


PLANTED = 5


def _iforest(spark, sf):
    """What must hold of the scores of all events and of a few far points made from them."""
    events = _events(spark, sf).select("event_id", "value", "user_id")
    far = events.where(F.col("event_id") < PLANTED).select(
        (-1 - F.col("event_id")).alias("event_id"), (F.coalesce("value", F.lit(0.0)) * 100 + 1e6).alias("value"),
        (F.col("user_id") * 1000 + 10_000_000).alias("user_id"))
    out = isolation_forest(events.unionByName(far), ["event_id"], ["value", "user_id"])
    flagged = F.col("prediction") == -1
    return out.agg(
        F.count("*").alias("scored"),
        (F.count_if(flagged) <= F.ceil(0.1 * F.count("*"))).alias("within_contamination"),
        F.bool_and((F.col("score") > 0) & (F.col("score") < 1)).alias("scores_valid"),
        F.count_if(flagged & (F.col("event_id") < 0)).alias("planted_found"),
    )


def _quality_report(spark, sf):
    products, sales = B.products(spark, sf), _stored(B.sales)(spark, sf)
    book = Ru.RuleBook().add_rules(Ru.STANDARD_RULES)
    results = book.execute_rules(products, "products").unionByName(book.execute_rules(sales, "sales"))
    profiles = Pr.profile_table(products, "products").select("table_name", "row_count", "column_count", "duplicate_rows")
    profiles = profiles.unionByName(
        Pr.profile_table(sales, "sales").select("table_name", "row_count", "column_count", "duplicate_rows")
    )
    scans = An.anomaly_scan(products, "products", ["product_id"]).unionByName(
        An.anomaly_scan(sales, "sales", ["sale_id", "sale_date"])
    )
    return report.quality_report(results, profiles, scans)


def _profile_rows(spark, sf):
    profiles = [
        Pr.profile_table(_stored(B.TABLES[t])(spark, sf), t).drop("numeric_stats", "categorical_stats", "date_stats")
        for t in ("products", "inventory")
    ]
    return report.report_profile_rows(reduce(DataFrame.unionByName, profiles))


def _etl_run(spark, sf):
    source = FrameSource({**B.bind_all(spark, sf), "sales": Sh.gappy_sales(spark, sf)})
    tables = ["suppliers", "products", "inventory", "orders", "sales", "no_such_table"]
    return etl.run_pipeline(spark, source, tables).summary(spark).select(
        "table_name", "status", "rows_extracted", "rows_transformed", "rows_loaded", "validation_passed"
    )


def _etl_load(spark, sf):
    """A full run into empty tables, read back as row counts."""
    source = FrameSource(B.bind_all(spark, sf))
    tables = ["suppliers", "products", "inventory", "orders", "sales"]
    targets = {t: FileTarget(scratch_path(spark, f"etl-load-{t}")) for t in tables}
    run = etl.run_pipeline(spark, source, tables, targets=targets)
    stored = reduce(DataFrame.unionByName, [
        targets[t].read(spark).agg(F.count("*").alias("rows_stored")).withColumn("table_name", F.lit(t)) for t in tables])
    return run.summary(spark).select("table_name", "status", "rows_extracted", "rows_loaded").join(stored, "table_name")


def _etl_gate(spark, sf):
    """Tables that fail validation are not loaded; orders have open deliveries and fail, as do sales with NULLs."""
    source = FrameSource({**B.bind_all(spark, sf), "sales": Sh.gappy_sales(spark, sf)})
    tables = ["suppliers", "products", "orders", "sales"]
    targets = {t: FileTarget(scratch_path(spark, f"etl-gate-{t}")) for t in tables}
    run = etl.run_pipeline(spark, source, tables, on_fail="skip", targets=targets)
    return run.summary(spark).select("table_name", "status", "rows_loaded", "validation_passed", "error")


def _etl_orphaned(spark, sf):
    """A source without suppliers: the keys to it go unchecked, the tables are processed."""
    tables = {t: df for t, df in B.bind_all(spark, sf).items() if t != "suppliers"}
    run = etl.run_pipeline(spark, FrameSource(tables), ["products", "orders"])
    return run.quality().select("table_name", "total_rows", "fk_issues").join(
        run.summary(spark).select("table_name", "status"), "table_name")


QUERIES = {
    "etl_full_load": _etl_load,
    "etl_gate": _etl_gate,
    "etl_absent_parent": _etl_orphaned,
    "value_distribution": lambda spark, sf: Pr.value_distribution(
        B.products(spark, sf), ["category", "product_name"]
    ).unionByName(Pr.value_distribution(B.orders(spark, sf), ["delivery_status"])),
    "profile_numeric": lambda spark, sf: _numeric(_stored(Sh.gappy_sales)(spark, sf), NUMERIC["v_gappy_sales"]),
    "profile_numeric_events": lambda spark, sf: _numeric(_events(spark, sf), NUMERIC["events"]),
    "profile_categorical": lambda spark, sf: _categorical(B.products(spark, sf)),
    "profile_date": lambda spark, sf: Pr.profile_date(Sh.raw_orders(spark, sf)),
    "profile_table": lambda spark, sf: _profile_flat(_done(spark, sf), "orders"),
    "profile_summary": lambda spark, sf: Pr.profile_summary(Pr.profile_table(_done(spark, sf), "orders")).drop("dtype"),
    "outliers_iqr": lambda spark, sf: An.flag_outliers_iqr(_events(spark, sf), "value").drop("ts"),
    "outliers_iqr_inventory": lambda spark, sf: An.flag_outliers_iqr(
        _stored(B.inventory)(spark, sf), "quantity_on_hand"
    ),
    "outliers_zscore": lambda spark, sf: An.flag_outliers_zscore(_events(spark, sf), "value").drop("ts"),
    "outliers_iforest": _iforest,
    "outlier_samples": _samples,
    "anomaly_scan": _scans_flat,
    "outlier_summary": lambda spark, sf: An.outlier_summary(_scans(spark, sf)),
    "report_anomaly_rows": lambda spark, sf: report.report_anomaly_rows(_scans(spark, sf)),
    "report_profile_rows": _profile_rows,
    "quality_report": _quality_report,
    "etl_orders": lambda spark, sf: transform_table(B.orders(spark, sf), "orders"),
    "etl_sales": lambda spark, sf: transform_table(Sh.low_sales(spark, sf), "sales").withColumn(
        "unit_price", rounded(F.col("unit_price"), 6)
    ),
    "etl_run_summary": _etl_run,
}


def _done(spark, sf):
    return _stored(CHECKED["orders"][0])(spark, sf)


# --- SQL --------------------------------------------------------------------------------------------------------------


def _numeric_sql(view: str) -> str:
    def one(c: str) -> str:
        x = f"cast({c} as double)"
        return (
            f"select '{c}' column_name, count({c}) count, count(*) - count({c}) missing, {rnd(f'avg({x})', 4)} mean, "
            f"{rnd(f'quantile_cont({x}, 0.5)', 4)} median, {rnd(f'stddev_samp({x})', 4)} std, "
            f"{rnd(f'min({x})', 4)} min, {rnd(f'max({x})', 4)} max, "
            f"{rnd(f'quantile_cont({x}, 0.25)', 4)} q25, {rnd(f'quantile_cont({x}, 0.75)', 4)} q75, "
            f"{rnd(f'skewness({x})', 4)} skewness, {rnd(f'kurtosis({x})', 4)} kurtosis from {view}"
        )

    return " union all ".join(one(c) for c in NUMERIC[view])


def _top_sql(view: str, columns: list[str]) -> str:
    return " union all ".join(
        f"""select * from (select '{c}' column_name, cast(row_number() over (order by count(*) desc, {c}) as int) rank,
            cast({c} as varchar) as value, count(*) frequency from {view} where {c} is not null group by {c}) where rank <= 10"""
        for c in columns
    )


def _scan_sql(view: str, table: str, order: list[str]) -> str:
    def one(c: str) -> str:
        x = f"cast({c} as double)"
        q1 = f"(select quantile_cont({x}, 0.25) from {view})"
        q3 = f"(select quantile_cont({x}, 0.75) from {view})"
        return f"""
            select '{table}' table_name, '{c}' column_name, 'IQR' as method,
              (select count(*) from {view} where {x} < {q1} - 1.5 * ({q3} - {q1}) or {x} > {q3} + 1.5 * ({q3} - {q1}))
                outlier_count,
              (select count(*) from {view}) all_rows,
              coalesce((select string_agg(printf('%.2f', v), ';' order by rn) from (
                 select {x} v, row_number() over (order by {', '.join(order)}, {x}) rn from {view}
                 where {x} < {q1} - 1.5 * ({q3} - {q1}) or {x} > {q3} + 1.5 * ({q3} - {q1})) where rn <= 10), '')
                outlier_values
            where (select count(distinct {c}) from {view}) > 10"""

    return " union all ".join(one(c) for c in NUMERIC[view])


_ALL_SCANS = " union all ".join(_scan_sql(view, t, order) for t, (_, view, order) in SCANNED.items())
_SCAN_ROWS = with_views(
    f"select table_name, column_name, method, outlier_count, "
    f"printf('%.2f%%', round(cast(outlier_count * 100.0 / all_rows as decimal(18,9)), 2)) outlier_percentage "
    f"from ({_ALL_SCANS})"
)
_KINDS = {
    "order_id": "numeric", "order_date": "date", "supplier_id": "numeric", "order_quantity": "numeric",
    "order_cost": "numeric", "expected_delivery_date": "date", "actual_delivery_date": "date",
    "delivery_status": "categorical", "delivery_delay_days": "numeric", "is_late": "categorical",
}


def _profile_sql() -> str:
    view = "v_done_orders"

    def one(i: int, c: str) -> str:
        kind, x = _KINDS[c], f"cast({c} as double)"
        figures = {
            "mean": f"avg({x})", "median": f"quantile_cont({x}, 0.5)", "std": f"stddev_samp({x})", "min": f"min({x})", "max": f"max({x})",
            "q25": f"quantile_cont({x}, 0.25)", "q75": f"quantile_cont({x}, 0.75)", "skewness": f"skewness({x})", "kurtosis": f"kurtosis({x})",
        }
        parts = [f"{rnd(e, 4) if kind == 'numeric' else 'cast(null as double)'} {n}" for n, e in figures.items()]
        for k, short in (("numeric", "num"), ("date", "date"), ("categorical", "cat")):
            own = kind == k
            parts += [f"{f'count({c})' if own else 'cast(null as bigint)'} {short}_count", f"{f'count(*) - count({c})' if own else 'cast(null as bigint)'} {short}_missing"]
        day = "strftime(cast({}({}) as timestamp), '%Y-%m-%d %H:%M:%S')"
        dates = {"min_date": day.format("min", c), "max_date": day.format("max", c), "date_range_days": f"cast(max({c}) - min({c}) as bigint)"}
        parts += [f"{e if kind == 'date' else 'cast(null as ' + ('bigint' if n == 'date_range_days' else 'varchar') + ')'} {n}" for n, e in dates.items()]
        groups = f"(select cast({c} as varchar) v, count(*) k, row_number() over (order by count(*) desc, {c}) r from {view} where {c} is not null group by {c})"
        texts = {
            "unique_count": (f"count(distinct {c})", "bigint"), "top_value": (f"(select v from {groups} where r = 1)", "varchar"),
            "top_frequency": (f"(select k from {groups} where r = 1)", "bigint"),
            "value_distribution": (f"(select string_agg(v || '=' || k, ';' order by r) from {groups} where r <= 10)", "varchar"),
        }
        parts += [f"{e if kind == 'categorical' else f'cast(null as {t})'} {n}" for n, (e, t) in texts.items()]
        return (
            f"select 'orders' table_name, count(*) row_count, cast({len(_KINDS)} as int) column_count, "
            f"(select duplicate_count from dups) duplicate_rows, cast({i} as int) column_index, '{c}' column_name, "
            f"'{kind}' kind, count(*) - count({c}) null_count, "
            f"{rnd(f'(count(*) - count({c})) * 100.0 / count(*)', 6)} null_percentage, {', '.join(parts)} from {view}"
        )

    rows = " union all ".join(one(i, c) for i, c in enumerate(_KINDS))
    return f"with dups as ({_dups(view, ', '.join(_KINDS))}) {rows}"


def _processed() -> dict[str, tuple[str, str]]:
    """Rows extracted and rows left after the transformation, per table."""
    keep = {"products": "unit_cost > 0 and reorder_level >= 0", "inventory": "quantity_on_hand >= 0 and quantity_reserved >= 0",
            "orders": "order_quantity > 0 and order_cost >= 0", "sales": "quantity_sold > 0 and revenue >= 0"}
    out = {}
    for t in ("suppliers", "products", "inventory", "orders", "sales"):
        rows = f"(select distinct * from v_{t})"
        where = f" where {keep[t]}" if t in keep else ""
        out[t] = (f"(select count(*) from v_{t})", f"(select count(*) from {rows}{where})")
    return out


def _loaded_sql() -> str:
    return " union all ".join(
        f"select '{t}' table_name, 'processed' status, {raw} rows_extracted, {left} rows_loaded, {left} rows_stored"
        for t, (raw, left) in _processed().items()
    )


def _gate_sql() -> str:
    parts = []
    for t in ("suppliers", "products", "orders", "sales"):
        left = _processed()[t][1].replace("v_sales", "v_gappy_sales")
        parts.append(
            f"select '{t}' table_name, 'failed' status, cast(0 as bigint) rows_loaded, false validation_passed, "
            "'validation failed, load skipped' error" if t == "orders" else
            f"select '{t}' table_name, 'processed' status, {left} rows_loaded, true validation_passed, cast(null as varchar) error"
        )
    return " union all ".join(parts)


def _absent_sql() -> str:
    return " union all ".join(
        f"select '{t}' table_name, {_processed()[t][1]} total_rows, cast(0 as int) fk_issues, 'processed' status"
        for t in ("products", "orders")
    )


def _run_sql() -> str:
    rows = {
        "suppliers": ("v_suppliers", "v_suppliers", None),
        "products": ("v_products", "v_products", "unit_cost > 0 and reorder_level >= 0"),
        "inventory": ("v_inventory", "v_inventory", "quantity_on_hand >= 0 and quantity_reserved >= 0"),
        "orders": ("v_orders", "v_orders", "order_quantity > 0 and order_cost >= 0"),
        "sales": ("v_gappy_sales", "v_gappy_sales", "quantity_sold > 0 and revenue >= 0"),
    }
    # orders fail on undelivered rows, the others pass
    parts = [
        f"select '{t}' table_name, 'processed' status, (select count(*) from {raw}) rows_extracted, "
        f"(select count(*) from (select distinct * from {view}) {'where ' + keep if keep else ''}) rows_transformed, "
        f"cast(0 as bigint) rows_loaded, {t != 'orders'} validation_passed"
        for t, (raw, view, keep) in rows.items()
    ]
    parts.append(
        "select 'no_such_table', 'failed', cast(0 as bigint), cast(0 as bigint), cast(0 as bigint), cast(null as boolean)"
    )
    return " union all ".join(parts)


_RULE_SQL = {t: Ru.STANDARD_RULES[t] for t in ("products", "sales")}


def _passed_sql() -> str:
    return (
        _rules_sql(_RULE_SQL).replace("v_low_products", "v_products").replace("v_low_sales", "v_sales")
    )


def _report_scans() -> str:
    return " union all ".join(_scan_sql(SCANNED[t][1], t, SCANNED[t][2]) for t in ("products", "sales"))


ORACLE = {
    "value_distribution": with_views(
        _top_sql("v_products", ["category", "product_name"]) + " union all " + _top_sql("v_orders", ["delivery_status"])
    ),
    "profile_numeric": with_views(_numeric_sql("v_gappy_sales")),
    "profile_numeric_events": with_views(_numeric_sql("events")),
    "profile_categorical": with_views(
        f"""with top as ({_top_sql('v_products', ['product_name', 'category'])}),
        totals as (select 'product_name' column_name, count(product_name) count,
             count(*) - count(product_name) missing, count(distinct product_name) unique_count from v_products
           union all select 'category', count(category), count(*) - count(category), count(distinct category)
           from v_products)
        select t.column_name, t.count, t.missing, t.unique_count,
          max(case when rank = 1 then value end) top_value, max(case when rank = 1 then frequency end) top_frequency,
          string_agg(value || '=' || frequency, ';' order by rank) value_distribution
        from totals t join top using (column_name) group by 1, 2, 3, 4"""
    ),
    "profile_date": with_views(
        """with d as (select try_strptime(order_date, '%Y-%m-%d') a, cast(expected_delivery_date as timestamp) b
                    from v_raw_orders)
        select 'order_date' column_name, count(a) count, count(*) - count(a) missing,
          strftime(min(a), '%Y-%m-%d %H:%M:%S') min_date, strftime(max(a), '%Y-%m-%d %H:%M:%S') max_date,
          cast(datediff('day', min(a), max(a)) as bigint) date_range_days from d
        union all
        select 'expected_delivery_date', count(b), count(*) - count(b), strftime(min(b), '%Y-%m-%d %H:%M:%S'),
          strftime(max(b), '%Y-%m-%d %H:%M:%S'), cast(datediff('day', min(b), max(b)) as bigint) from d"""
    ),
    "profile_table": with_views(_profile_sql()),
    "profile_summary": with_views(
        f"""select 'orders' table_name, column_name, null_count,
          printf('%.2f%%', round(cast(null_count * 100.0 / total_rows as decimal(18,9)), 2)) null_percentage
        from ({_null_rows('v_done_orders', 'orders')})"""
    ),
    "outliers_iqr": """
        with q as (select quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 from events)
        select event_id, user_id, event_type, value, props,
          value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1) is_outlier from events, q""",
    "outliers_iqr_inventory": with_views(
        """with q as (select quantile_cont(cast(quantity_on_hand as double), 0.25) q1,
                           quantile_cont(cast(quantity_on_hand as double), 0.75) q3 from v_inventory)
        select v_inventory.*, quantity_on_hand < q1 - 1.5 * (q3 - q1) or quantity_on_hand > q3 + 1.5 * (q3 - q1) is_outlier
        from v_inventory, q"""
    ),
    "outliers_zscore": """
        with s as (select avg(value) m, stddev_pop(value) sd from events)
        select event_id, user_id, event_type, value, props, abs((value - m) / sd) > 3 is_outlier from events, s""",
    "outlier_samples": """
        with q as (select quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3 from events)
        select 'value' column_name, cast(row_number() over (order by event_id) as int) rank, value from events, q
        where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)
        qualify row_number() over (order by event_id) <= 10""",
    "anomaly_scan": with_views(
        f"select table_name, column_name, method, outlier_count, "
        f"{rnd('outlier_count * 100.0 / all_rows', 6)} outlier_percentage, outlier_values from ({_ALL_SCANS})"
    ),
    "outlier_summary": _SCAN_ROWS,
    "report_anomaly_rows": _SCAN_ROWS,
    "report_profile_rows": with_views(
        " union all ".join(
            f"select '{t}' table_name, (select count(*) from v_{t}) row_count, "
            f"cast({len(COLUMNS[t].split())} as int) column_count, "
            f"(select duplicate_count from ({_dups(f'v_{t}', ', '.join(COLUMNS[t].split()))})) duplicate_rows"
            for t in ("products", "inventory")
        )
    ),
    "quality_report": with_views(
        f"""with r as ({_passed_sql()}), o as ({_report_scans()})
        select (select count(*) from r) total_rules, (select count(*) from r where passed) passed,
          (select count(*) from r where not passed) failed,
          (select printf('%.2f%%', count(*) filter (where passed) * 100.0 / count(*)) from r) pass_rate,
          cast(2 as bigint) total_tables,
          (select count(*) from v_products) + (select count(*) from v_sales) total_rows, cast(12 as bigint) total_columns,
          (select cast(sum(outlier_count) as bigint) from o) total_outliers_detected"""
    ),
    "etl_orders": with_views("select distinct * from v_done_orders where order_quantity > 0 and order_cost >= 0"),
    "etl_sales": with_views(
        f"""select distinct *, {rnd('cast(revenue as double) / nullif(quantity_sold, 0)', 6)} unit_price
        from v_low_sales where quantity_sold > 0 and revenue >= 0"""
    ),
    "etl_run_summary": with_views(_run_sql()),
    "etl_full_load": with_views(_loaded_sql()),
    "etl_gate": with_views(_gate_sql()),
    "etl_absent_parent": with_views(_absent_sql()),
    "outliers_iforest": f"""
        select count(*) + (select count(*) from events where event_id < {PLANTED} and user_id is not null) scored,
          true within_contamination, true scores_valid,
          (select count(*) from events where event_id < {PLANTED} and user_id is not null) planted_found
        from events where value is not null and user_id is not null""",
}

"""Edge fixtures: zeros, NULLs, ties, duplicates, bad dates, empty tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wharfline.functions.scalars import rounded
from wharfline.operators import anomaly as An
from wharfline.operators import profile as Pr
from wharfline.operators import rules as Ru
from wharfline.operators import transform as T
from wharfline.operators import validate as V
from wharfline.operators.iforest import isolation_forest
from wharfline.plans import analytics as A
from wharfline.plans.report import quality_report

D = dt.date


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- transform --------------------------------------------------------------------------------------------------------


def test_zero_quantity_gives_null_price_and_is_filtered(spark):
    df = frame(spark, [(0, 10.0), (4, 10.0), (None, 1.0)], "quantity_sold int, revenue double")
    priced = T.add_derived_columns(df, "sales")
    assert sorted(map(str, (r["unit_price"] for r in priced.collect()))) == ["2.5", "None", "None"]
    assert [r["quantity_sold"] for r in T.apply_business_rules(priced, "sales").collect()] == [4]


def test_late_is_false_without_delivery(spark):
    rows = [(D(2026, 1, 5), D(2026, 1, 3)), (None, D(2026, 1, 3)), (D(2026, 1, 3), D(2026, 1, 3))]
    out = T.add_derived_columns(frame(spark, rows, "actual_delivery_date date, expected_delivery_date date"), "orders")
    assert [(r["delivery_delay_days"], r["is_late"]) for r in out.collect()] == [(2, True), (None, False), (0, False)]


def test_derivation_skipped_without_inputs(spark):
    df = frame(spark, [(1,)], "quantity_on_hand int")
    assert T.add_derived_columns(df, "inventory").columns == ["quantity_on_hand"]
    assert T.add_derived_columns(df, "suppliers").columns == ["quantity_on_hand"]


def test_dates_by_one_format(spark):
    df = frame(spark, [("2026-01-01", 1), ("01/02/2026", 2), ("x", 3), (None, 4)], "order_date string, n int")
    out = T.standardize_dates(df).orderBy("n").collect()
    assert [r["order_date"] for r in out] == [D(2026, 1, 1), None, None, None]


def test_keep_first_and_idempotent_dedup(spark):
    df = frame(spark, [(1, 3), (1, 2), (None, 9), (None, 8), (2, 5)], "id int, v int")
    kept = T.remove_duplicates(df, ["id"], ["v"])
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, 2), (2, 5), (None, 8)]
    with pytest.raises(ValueError):
        T.remove_duplicates(df, ["id"])
    once = T.remove_duplicates(df.unionByName(df))
    assert once.count() == T.remove_duplicates(once).count() == 5


def test_keep_first_reduces_before_the_shuffle(spark):
    df = frame(spark, [(1, 3), (1, 2)], "id int, v int")
    plan = T.remove_duplicates(df, ["id"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_fill_strategies(spark):
    df = frame(spark, [(1, None, "a"), (2, 4.0, None), (3, 10.0, "c"), (4, 1.0, "d")], "i int, v double, s string")
    assert [r["v"] for r in T.clean_nulls(df, "fill_mean").orderBy("i").collect()] == [5.0, 4.0, 10.0, 1.0]
    median = T.clean_nulls(df, "fill_median")
    assert [r["v"] for r in median.orderBy("i").collect()] == [4.0, 4.0, 10.0, 1.0]
    assert median.schema["i"].dataType.simpleString() == "int"  # no NULL, type kept
    assert [r["s"] for r in median.orderBy("i").collect()] == ["a", None, "c", "d"]
    assert T.clean_nulls(df, "drop").count() == 2
    assert T.clean_nulls(df, "no such strategy") is df
    with pytest.raises(ValueError):
        T.clean_nulls(df, "fill_forward")


def test_rule_impact(spark):
    df = frame(spark, [(1.0, 0), (0.0, 1), (2.0, None)], "unit_cost double, reorder_level int")
    assert tuple(T.business_rule_impact(df, "products").first()) == ("products", 3, 1, 2)


# --- checks -----------------------------------------------------------------------------------------------------------


def test_null_keys_are_duplicates_of_each_other(spark):
    assert V.duplicate_count(frame(spark, [(None,), (None,), (1,)], "id int")).first()["duplicate_count"] == 1


def parents(spark):
    return {
        "products": frame(spark, [(1,), (2,), (2,)], "product_id int"),
        "warehouses": frame(spark, [(7,)], "warehouse_id int"),
    }


def test_orphans_count_null_and_unknown_keys(spark):
    df = frame(spark, [(999, 7), (None, 7), (1, 7), (2, 7), (2, 7)], "product_id int, warehouse_id int")
    found = {r["column_name"]: r["orphan_rows"] for r in V.fk_orphans(df, "sales", parents(spark)).collect()}
    assert found == {"product_id": 2, "warehouse_id": 0}
    bad = V.fk_orphan_rows(df, "product_id", parents(spark)["products"]).count()
    good = V.fk_valid_rows(df, "product_id", parents(spark)["products"]).count()
    assert (bad, good) == (2, 3)


def test_thresholds_are_strict(spark):
    twenty = frame(spark, [(i, None if i == 0 else "x") for i in range(20)], "i int, s string")
    assert V.validate_table(twenty, "t").first()["validation_passed"]  # 1 of 20 = 0.05
    nineteen = twenty.where("i < 19")
    report = V.validate_table(nineteen, "t").first()
    assert report["issues"] == ["Column 's' has 5.3% nulls (threshold: 5.0%)"] and report["null_count"] == {"s": 1}
    hundred = frame(spark, [(max(i, 1),) for i in range(100)], "i int")
    assert V.validate_table(hundred, "t").first()["validation_passed"]  # 1 of 100 = 0.01
    assert V.validate_table(hundred.where("i < 99"), "t").first()["issues"] == ["Found 1 duplicates (1.0%)"]


def test_required_columns_and_orphans_are_issues(spark):
    df = frame(spark, [(999, 7), (1, 7)], "product_id int, warehouse_id int")
    report = V.validate_table(df, "sales", parents(spark), required_columns=["product_id", "sale_id"]).first()
    assert report["issues"] == [
        "Missing required columns: sale_id",
        "Missing foreign key references in 'product_id': 1 rows",
    ]
    summary = V.quality_summary([V.validate_table(df, "sales", parents(spark))]).first()
    assert (summary["fk_issues"], summary["issue_count"], summary["validation_passed"]) == (1, 1, False)


def test_empty_table_passes(spark):
    report = V.validate_table(frame(spark, [], "a int, b string"), "t").first()
    assert (report["total_rows"], report["duplicate_count"], report["validation_passed"]) == (0, 0, True)


# --- rules ------------------------------------------------------------------------------------------------------------


def run_rules(spark, df, *rules):
    book = Ru.RuleBook().add_rules({"t": rules})
    return [r.asDict() for r in book.execute_rules(df, "t").orderBy("rule_index").collect()]


def test_null_is_invalid_and_counts_survive_repartition(spark):
    df = frame(spark, [(1,), (None,), (-1,)], "q int")
    rule = Ru.Rule("r", "validity", "q", "q >= 0", description="d")
    for n in (1, 4):
        (r,) = run_rules(spark, df.repartition(n), rule)
        assert (r["passed"], r["affected_rows"], round(r["affected_percentage"], 4)) == (False, 2, 66.6667)
    assert r["message"] == "✗ FAIL: d" and r["details"] == {"invalid_count": 2.0}


def test_broken_rules_fail_alone(spark):
    df = frame(spark, [(1, 0), (2, 1)], "a int, b int")
    out = run_rules(
        spark,
        df,
        Ru.Rule("missing column", "validity", "x", "x > 0", "WARNING"),
        Ru.Rule("division by zero", "consistency", "a", "a / b > 0", "WARNING"),
        Ru.Rule("unknown kind", "foo", "a"),
        Ru.Rule("no condition", "validity", "a"),
        Ru.Rule("good", "validity", "a", lambda t: F.col("a") > 0, "WARNING"),
        Ru.Rule("unique", "uniqueness", "a"),
        Ru.Rule("no such column", "uniqueness", "x"),
    )
    assert [(r["rule_name"], r["passed"], r["severity"]) for r in out] == [
        ("missing column", False, "CRITICAL"),
        ("division by zero", False, "CRITICAL"),
        ("no condition", False, "CRITICAL"),
        ("good", True, "WARNING"),
        ("unique", True, "CRITICAL"),
        ("no such column", False, "CRITICAL"),
    ]
    assert out[0]["message"].startswith("Condition evaluation failed")
    assert out[2]["message"] == "No condition defined for rule"
    assert out[5]["message"].startswith("Rule execution failed")


def test_completeness_threshold_is_a_percentage(spark):
    df = frame(spark, [(None,), (1,), (2,), (3,)], "a int")
    loose, strict = run_rules(
        spark, df, Ru.Rule("l", "completeness", "a", threshold=25.0), Ru.Rule("s", "completeness", "a")
    )
    assert loose["passed"] and not strict["passed"] and strict["details"]["null_percentage"] == 25.0


def test_no_rules_and_empty_table(spark):
    df = frame(spark, [], "a int")
    assert run_rules(spark, df) == []
    (r,) = run_rules(spark, df, Ru.Rule("u", "uniqueness", "a"))
    assert r["passed"] and r["affected_percentage"] == 0.0


def test_standard_rules_cover_five_tables():
    assert {t: len(r) for t, r in Ru.STANDARD_RULES.items()} == {
        "suppliers": 2, "products": 2, "inventory": 2, "orders": 1, "sales": 1,
    }


# --- profiles and outliers --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [[], [4.0], [1.0, 2.0], [1.0, 2.0, 4.0], [5.0, 5.0, 5.0, 5.0], [1.0, 2.0, 3.0, 10.0, 4.0]])
def test_numeric_profile_equals_pandas(spark, values):
    import pandas as pd

    s = pd.Series(values, dtype=float)
    r = Pr.profile_numeric(frame(spark, [(v,) for v in values] + [(None,)], "v double")).first()
    want = [s.mean(), s.median(), s.std(), s.min(), s.max(), s.quantile(0.25), s.quantile(0.75), s.skew(), s.kurt()]
    names = ["mean", "median", "std", "min", "max", "q25", "q75", "skewness", "kurtosis"]
    assert (r["count"], r["missing"]) == (len(values), 1)
    assert [r[n] for n in names] == [None if pd.isna(w) else pytest.approx(w) for w in want]


def test_approximate_profile_is_close(spark):
    df = spark.range(0, 10_001).select(F.col("id").cast("double").alias("v"))
    r = Pr.profile_numeric(df, approximate=True).first()
    assert r["median"] == pytest.approx(5000, abs=3) and r["std"] == pytest.approx(2887.1844, abs=0.01)


def test_table_profile_kinds(spark):
    rows = [(1, True, "a", "2026-01-01"), (2, None, "a", "bad"), (2, None, "a", "bad")]
    df = frame(spark, rows, "n int, flag boolean, s string, some_date string")
    out = {r["column_name"]: r for r in Pr.profile_table(df, "t").collect()}
    assert {c: r["kind"] for c, r in out.items()} == {
        "n": "numeric", "flag": "categorical", "s": "categorical", "some_date": "date",
    }
    assert {(r["row_count"], r["column_count"], r["duplicate_rows"]) for r in out.values()} == {(3, 4, 1)}
    assert out["some_date"]["date_stats"]["missing"] == 2 and out["some_date"]["null_count"] == 0
    assert out["flag"]["categorical_stats"]["top_value"] == "true" and out["n"]["numeric_stats"]["max"] == 2.0


def test_categorical_ties_and_empty_column(spark):
    df = frame(spark, [("b", None), ("a", None), ("a", None), ("b", None), ("c", None)], "s string, empty string")
    out = {r["column_name"]: r for r in Pr.profile_categorical(df).collect()}
    assert (out["s"]["top_value"], out["s"]["top_frequency"], out["s"]["unique_count"]) == ("a", 2, 3)
    assert [(v["value"], v["frequency"]) for v in out["s"]["value_distribution"]] == [("a", 2), ("b", 2), ("c", 1)]
    assert (out["empty"]["missing"], out["empty"]["top_value"], out["empty"]["top_frequency"]) == (5, None, 0)


def test_constant_column_has_no_outlier(spark):
    df = frame(spark, [(5.0,), (5.0,), (5.0,), (None,)], "v double")
    assert not An.flag_outliers_zscore(df, "v").where("is_outlier").count()
    assert not An.flag_outliers_iqr(df, "v").where("is_outlier").count()
    assert An.flag_outliers_iqr(frame(spark, [], "v double"), "v").columns == ["v", "is_outlier"]


def test_scan_takes_columns_with_more_than_ten_values(spark):
    rows = [(i, i % 10, None if i == 3 else (1000 if i in (7, 11) else i)) for i in range(40)]
    out = An.anomaly_scan(frame(spark, rows, "id int, few int, v int"), "t", ["id"]).orderBy("column_name").collect()
    assert [(r["column_name"], r["outlier_count"]) for r in out] == [("id", 0), ("v", 2)]
    assert out[1]["outlier_values"] == [1000.0, 1000.0] and out[1]["outlier_percentage"] == 5.0


def test_report_without_rules(spark):
    rules = frame(spark, [], Ru.RESULT_SCHEMA)
    profiles = frame(spark, [("t", 3, 2, 0)], "table_name string, row_count bigint, column_count int, duplicate_rows bigint")
    scans = frame(spark, [("t", 4)], "table_name string, outlier_count bigint")
    assert tuple(quality_report(rules, profiles, scans).first()) == (0, 0, 0, "N/A", 1, 3, 2, 4)


@pytest.mark.parametrize("n", [500, 30_000])
def test_forest_flags_planted_outliers(spark, n):
    noise = spark.range(n).select("id", F.randn(1).alias("x"), F.randn(2).alias("y"))
    far = frame(spark, [(n + i, 9.0 + i, -9.0) for i in range(5)], "id bigint, x double, y double")
    gaps = frame(spark, [(n + 9, None, 1.0)], "id bigint, x double, y double")
    out = isolation_forest(noise.unionByName(far).unionByName(gaps), ["id"], ["x", "y"]).cache()
    assert out.count() == n + 5
    assert out.where((F.col("id") >= n) & (F.col("prediction") == -1)).count() == 5
    assert out.where("prediction = -1").count() == pytest.approx(0.1 * n, rel=0.05)


# --- analytics --------------------------------------------------------------------------------------------------------


def test_health_without_sales_and_fan_out(spark):
    products = frame(spark, [(1, "a"), (2, "b"), (3, "c")], "product_id int, product_name string")
    stock = [(1, 100, D(2026, 1, 2)), (1, 50, D(2026, 1, 2)), (2, 80, D(2026, 1, 2)), (2, 999, D(2026, 1, 1))]
    inventory = frame(spark, stock, "product_id int, quantity_on_hand int, snapshot_date date")
    sales = frame(spark, [(1, D(2026, 1, 1), 10), (1, D(2026, 1, 2), 20)], "product_id int, sale_date date, quantity_sold int")
    rows = A.inventory_health(products, inventory, sales).orderBy("stock_rank").collect()
    assert [tuple(r)[2:] for r in rows] == [(300, 15.0, 20.0, "LOW", 1, 100.0), (80, None, None, "EXCESS", 2, 0.0)]
    true = A.inventory_health_true_stock(products, inventory, sales).orderBy("stock_rank").collect()
    assert [(r["product_id"], r["total_stock"]) for r in true] == [(1, 150), (2, 80)]


def test_output_filter_does_not_shorten_the_frames(spark):
    rows = [(D(2026, 1, 1), 1, 10, 1.0), (D(2026, 3, 30), 1, 20, 1.0)]
    df = frame(spark, rows, "sale_date date, product_id int, quantity_sold int, revenue double")
    (r,) = A.sales_rolling(df, "2026-04-05", 365, 30).collect()
    assert (r["moving_avg_30day"], r["volatility_90day"], r["conservative_forecast"]) == (15.0, 5.0, 18.0)


def test_rounding_is_half_away_from_zero(spark):
    # 2822 / (400 / 17) is 119.935, held as 119.93499999999999
    df = frame(spark, [(2822 / (400 / 17),), (119.9349,), (-0.005,), (1.005,), (1e300,), (None,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"), 2)).collect()] == [119.94, 119.93, -0.01, 1.01, 1e300, None]

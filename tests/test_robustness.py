"""Keys of several types, absent parents, failing rules, empty kinds of columns, repeatable results and plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wharfline.functions import global_order as G
from wharfline.operators import anomaly, profile, rules, transform, validate
from wharfline.operators.iforest import isolation_forest
from wharfline.plans import analytics, etl
from wharfline.sources import readers, writers


@pytest.mark.parametrize("n", [500, 20_000])
def test_forest_does_not_depend_on_the_partitions(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 97).cast("double").alias("x"), (F.col("id") * 7 % 89).cast("double").alias("y"))
    a, b = (
        {r.id: (r.score, r.prediction) for r in isolation_forest(df.repartition(k), ["id"], ["x", "y"], n_trees=20).collect()}
        for k in (2, 7)
    )
    assert a == b and len(a) == n
    assert sum(p == -1 for _, p in a.values()) <= n // 10 + 1


@pytest.mark.parametrize(("child", "parent"), [
    ("double", "bigint"), ("decimal(20,2)", "int"), ("int", "double"), ("decimal(20,2)", "decimal(10,0)"), ("string", "string"), ("int", "string")])
def test_foreign_keys_of_several_types(spark, child, parent):
    df = spark.createDataFrame([("1",), ("2",), ("2",), (None,), ("9",)], "supplier_id string").select(F.col("supplier_id").cast(child))
    suppliers = spark.createDataFrame([("1",), ("2",)], "supplier_id string").select(F.col("supplier_id").cast(parent))
    found = validate.fk_orphans(df, "products", {"suppliers": suppliers}).collect()
    assert [(r.column_name, r.orphan_rows) for r in found] == [("supplier_id", 2)]
    report = validate.validate_table(df, "products", {"suppliers": suppliers}).first()
    assert report.missing_foreign_keys == {"supplier_id": 2} and report.duplicate_count == 1


def test_foreign_keys_are_checked_apart(spark):
    """One key of text does not turn the other to text."""
    sales = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "product_id double, warehouse_id string")
    parents = {"products": spark.createDataFrame([(1,), (2,)], "product_id int"), "warehouses": spark.createDataFrame([("a",)], "warehouse_id string")}
    assert {r.column_name: r.orphan_rows for r in validate.fk_orphans(sales, "sales", parents).collect()} == {"product_id": 0, "warehouse_id": 1}


def test_absent_parent_leaves_the_other_keys(spark):
    sales = spark.createDataFrame([(1, dt.date(2026, 1, 1), 1, 5, 2, 3.0)], "sale_id int, sale_date date, product_id int, warehouse_id int, quantity_sold int, revenue double")
    warehouses = spark.createDataFrame([(6,)], "warehouse_id int")
    run = etl.run_pipeline(spark, readers.FrameSource({"sales": sales, "warehouses": warehouses}), ["sales"])
    assert run.tables[0].status == "processed" and run.tables[0].error is None
    assert run.tables[0].report.first().missing_foreign_keys == {"warehouse_id": 1}


def test_no_reports_give_an_empty_summary(spark):
    sales = spark.createDataFrame([(1,)], "sale_id int")
    run = etl.run_pipeline(spark, readers.FrameSource({"sales": sales}), ["sales"], validate=False)
    assert run.quality().count() == 0 and run.quality().columns == validate.quality_summary([]).columns


def test_time_of_execution_does_not_move(spark):
    df = spark.createDataFrame([(1,)], "quantity_sold int")
    book = rules.RuleBook().add_rules({"sales": rules.STANDARD_RULES["sales"]})
    result, report = book.execute_rules(df, "sales"), validate.validate_table(df, "sales")
    assert result.first().timestamp == result.first().timestamp
    assert report.first().timestamp == report.first().timestamp
    assert abs(dt.datetime.now() - report.first().timestamp) < dt.timedelta(minutes=5)


def test_any_error_of_a_condition_fails_its_rule_only(spark):
    def broken(df):
        return [][1]

    book = rules.RuleBook().add_rules({"sales": [rules.Rule("broken", "validity", "q", broken), rules.Rule("fine", "validity", "q", "q > 0")]})
    rows = book.execute_rules(spark.createDataFrame([(1,)], "q int"), "sales").collect()
    assert [(r.rule_name, r.passed) for r in rows] == [("broken", False), ("fine", True)]
    assert "list index" in rows[0].message


def test_tables_without_a_kind_of_column(spark):
    numbers, texts = spark.createDataFrame([(1,)], "n int"), spark.createDataFrame([("a",)], "t string")
    for make in (profile.profile_date, profile.profile_categorical, profile.value_distribution):
        assert make(numbers).count() == 0
    assert profile.profile_numeric(texts).count() == 0
    assert anomaly.anomaly_scan(texts, "t").count() == 0
    assert profile.profile_table(numbers, "n").count() == 1


def test_dates_keep_their_time(spark):
    df = spark.createDataFrame([("2026-01-05 10:30",), ("junk",)], "order_date string")
    got = [r.order_date for r in transform.standardize_dates(df, fmt="yyyy-MM-dd HH:mm").collect()]
    assert got == [dt.datetime(2026, 1, 5, 10, 30), None]
    assert transform.standardize_dates(df).dtypes == [("order_date", "date")]


def test_rejected_rows_are_judged_once(spark, tmp_path):
    df = spark.range(1_000).withColumn("r", F.rand())
    good, bad = writers.FileTarget(f"{tmp_path}/good"), writers.FileTarget(f"{tmp_path}/bad")
    result = writers.load(df, good, "fail", reject_if={"low": "r < 0.5"}, quarantine=bad)
    assert result.rows_loaded + result.rows_failed == 1_000
    ids = [r.id for r in good.read(spark).select("id").union(bad.read(spark).select("id")).collect()]
    assert sorted(ids) == list(range(1_000))


def test_first_rows_of_a_large_group(spark):
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id"))
    top = G.first_per_group(df, "g", [F.col("id").desc()], 2_000)
    rows = top.collect()
    assert len(rows) == 2_000 and {r.id for r in rows} == set(range(18_000, 20_000)) and {r["rank"] for r in rows} == set(range(1, 2_001))
    assert "_salt" in top._jdf.queryExecution().toString()


def test_fences_reach_the_scan(spark, tmp_path):
    spark.range(1_000).withColumn("v", F.when(F.col("id") == 7, 10**6).otherwise(F.col("id") % 50)).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    samples = anomaly.outlier_samples(df, {"v": (-10.0, 100.0)}, ["id"])
    assert [r.value for r in samples.collect()] == [1e6]
    assert "LessThan(v,-9)" in samples._jdf.queryExecution().toString()


def test_columns_vary_by_exact_count(spark):
    df = spark.range(5_000).select((F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"))
    assert anomaly._varied(df, ["ten", "eleven"], 10) == ["eleven"]


def test_reports_in_order(spark):
    df = spark.createDataFrame([(1, 50.0), (2, 90.0), (3, 90.0)], "supplier_id int, on_time_pct double")
    assert [r.supplier_id for r in analytics.in_report_order(df, "supplier_delivery").collect()] == [2, 3, 1]


def test_jdbc_refuses_to_read_a_table_in_one_task(spark):
    source = readers.JdbcSource("jdbc:x", small=["suppliers"])
    with pytest.raises(ValueError, match="sales"):
        source.read(spark, "sales")
    assert source.reader_options("suppliers")["fetchsize"] == "10000"

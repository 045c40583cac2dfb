"""Sources, sinks, synthetic tables and ETL runs."""

import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from wharfline.plans import etl
from wharfline.session import cut, scratch_root
from wharfline.sources import readers as R
from wharfline.sources import synth as S
from wharfline.sources import writers as Wr


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_date_range_needs_all_three_and_reaches_the_scan(spark, folder):
    days = spark.range(10).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    days.write.parquet(f"{folder}/days")
    source = R.FileSource(folder)
    part = R.extract_table(spark, source, "days", "d", "2026-01-03", dt.date(2026, 1, 5))
    assert part.count() == 3
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d" in part._jdf.queryExecution().toString()
    assert R.extract_table(spark, source, "days", "d", "2026-01-03").count() == 10


def test_nan_becomes_null_at_the_source(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, n int")
    out = R.extract_table(spark, R.FrameSource({"t": df}), "t").orderBy("n").collect()
    assert [r["x"] for r in out] == [None, 2.0]


def test_query_with_named_values(spark):
    df = spark.range(10)
    assert R.extract_query(spark, "select * from {t} where id > :least", {"least": 7}, {"t": df}).count() == 2


def test_jdbc_options():
    source = R.JdbcSource("jdbc:x", {"user": "u"}, {"sales": ("sale_id", 1, 900, 8)})
    assert source.reader_options("sales")["numPartitions"] == "8"
    assert "numPartitions" not in source.reader_options("orders")
    assert Wr.JdbcTarget("jdbc:x", "sales", 500).writer_options()["batchsize"] == "500"


def test_load_modes_and_backup(spark, folder):
    target = Wr.FileTarget(f"{folder}/out")
    df = spark.range(5)
    assert Wr.load(df, target, "replace").backup is None  # nothing to copy yet: warns only
    assert Wr.load(df, target, "append") == Wr.LoadResult(5, 0)
    with pytest.raises(Exception, match="already exists"):
        Wr.load(df, target, "fail")
    replaced = Wr.load(spark.range(2), target, "replace")
    assert spark.read.parquet(replaced.backup).count() == 10
    assert target.read(spark).count() == 2
    with pytest.raises(ValueError):
        Wr.load(df, target, "upsert")


def test_quarantine_keeps_every_row(spark, folder):
    good, bad = Wr.FileTarget(f"{folder}/good"), Wr.FileTarget(f"{folder}/bad")
    df = spark.createDataFrame([(1,), (-1,), (None,)], "q int")
    result = Wr.load(df, good, "append", reject_if={"negative": "q < 0", "missing": F.col("q").isNull()}, quarantine=bad)
    assert result == Wr.LoadResult(1, 2)
    assert sorted(r["reject_reason"] for r in bad.read(spark).collect()) == ["missing", "negative"]


def test_insert_ignore_and_ids(spark):
    target = spark.createDataFrame([(1, 1, "d1", 5)], "product_id int, warehouse_id int, day string, q int")
    batch = spark.createDataFrame([(1, 1, "d1", 6), (1, 2, "d1", 8), (1, 2, "d1", 7)], target.schema)
    fresh = Wr.insert_ignore(batch, target, ["product_id", "warehouse_id", "day"], ["q"])
    assert [tuple(r) for r in fresh.collect()] == [(1, 2, "d1", 7)]
    assert Wr.next_id(spark.createDataFrame([], "id int"), "id") == 1
    ids = Wr.assign_surrogate_ids(spark.range(4).select(F.col("id").alias("v")), "k", spark.range(8).withColumnRenamed("id", "k"))
    assert sorted(r["k"] for r in ids.collect()) == [8, 9, 10, 11]


def test_json(spark, folder):
    Wr.write_json(spark.createDataFrame([(1, "a")], "n int, s string"), f"{folder}/j")
    lines = [x for part in pathlib.Path(folder, "j").glob("part-*.json") for x in part.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"n": 1, "s": "a"}]


def test_synthetic_orders_are_repeatable_and_valid(spark):
    base = S.ids(spark, 20_000)
    one = S.synth_orders(base, "2026-01-28")
    assert one.exceptAll(S.synth_orders(base.repartition(13), "2026-01-28")).isEmpty()
    gap = F.datediff("expected_delivery_date", "order_date")
    r = one.agg(
        F.min(gap), F.max(gap), F.avg((F.col("delivery_status") == "Delivered").cast("int")), F.min("supplier_id"),
        F.max("supplier_id"), F.min("order_cost"), F.max("order_cost"),
        F.count_if((F.col("delivery_status") == "Delivered") != F.col("actual_delivery_date").isNotNull()),
    ).first()
    assert r[0] >= 30 and r[1] <= 1000 and abs(r[2] - 0.5) < 0.02 and (r[3], r[4]) == (1, 30)
    assert r[5] >= 2000 and r[6] <= 300000 and r[7] == 0
    stock = S.synth_inventory(base, "2026-01-28")
    share = F.col("quantity_reserved") / F.col("quantity_on_hand")
    low, high = stock.agg(F.min(share), F.max(share)).first()
    assert low >= 0 and high <= 0.9


def tables(spark):
    suppliers = spark.createDataFrame([(1, "a", 50), (2, "b", 60)], "supplier_id int, supplier_name string, reliability_score int")
    orders = spark.createDataFrame(
        [(1, 1, 5, 9.0, "2026-01-02", "2026-01-01"), (2, 2, 0, 9.0, None, "2026-01-01"), (3, 9, 5, 9.0, None, "2026-01-01")],
        "order_id int, supplier_id int, order_quantity int, order_cost double, actual_delivery_date string, expected_delivery_date string",
    )
    return R.FrameSource({"suppliers": suppliers, "orders": orders})


@pytest.mark.parametrize("on_fail, status, loaded", [("warn", "processed", 2), ("skip", "failed", 0)])
def test_pipeline_gate(spark, folder, on_fail, status, loaded):
    targets = {"orders": Wr.FileTarget(f"{folder}/orders")}
    run = etl.run_pipeline(spark, tables(spark), ["suppliers", "orders", "nowhere"], on_fail=on_fail, targets=targets)
    rows = {r["table_name"]: r for r in run.summary(spark).collect()}
    assert rows["suppliers"]["status"] == "processed" and rows["suppliers"]["validation_passed"]
    orders = rows["orders"]
    assert (orders["status"], orders["rows_extracted"], orders["rows_transformed"], orders["rows_loaded"]) == (status, 3, 2, loaded)
    assert "Missing foreign key references in 'supplier_id': 1 rows" in orders["issues"]
    assert rows["nowhere"]["status"] == "failed" and "nowhere" in run.failed_tables
    assert run.quality().count() == 2
    assert run.totals(spark).first()["total_rows_extracted"] == 5


def test_pipeline_flags(spark):
    run = etl.run_pipeline(spark, tables(spark), ["orders"], validate=False, transform=False)
    (t,) = run.tables
    assert (t.rows_transformed, t.validation_passed, t.report) == (3, None, None)


def test_cut_goes_to_the_shared_folder(spark):
    df = cut(spark.range(3), "probe")
    assert df.count() == 3 and all(f.startswith(("file:", "/")) and scratch_root(spark).split(":")[-1] in f for f in df.inputFiles())

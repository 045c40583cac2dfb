"""Digits and quantiles, row fingerprints, ordered passes and fused counts: results, and the plans that they promise."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.functions import fingerprints as Fp
from wharfline.functions import global_order as G
from wharfline.functions import quantiles as Q
from wharfline.operators import anomaly, iforest, profile, rules, validate
from wharfline.sources import writers


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain_quantile(values, p):
    place = (len(values) - 1) * p
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low if low == high else low + (high - low) * (place - math.floor(place))


# ---- digits

WILD = [0.0, -0.0, 5e-324, -5e-324, 1e-300, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 2.0, 1e15 + 1, 1e15 + 2, 1.7e308, -1.7e308,
        math.inf, -math.inf, 3.0, -3.0, -2.9999]


def test_digits_rise_with_the_values(spark):
    rng = random.Random(4)
    near = [x for k in range(-40, 40) for b in (2.0**k, -(2.0**k)) for x in (b, math.nextafter(b, math.inf), math.nextafter(b, -math.inf))]
    values = WILD + near + [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(3_000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", Q._digit(F.col("v")).alias("d")).collect()
    ordered = sorted(rows, key=lambda r: r.v)
    assert all(a.d <= b.d for a, b in zip(ordered, ordered[1:]))
    nan = spark.range(1).select(Q._digit(F.lit(math.nan)).alias("d")).first().d
    assert nan > max(r.d for r in rows)


@pytest.mark.parametrize("few", [1, 3, 10_000])
def test_quantiles_of_extreme_values(spark, few):
    rng = random.Random(9)
    narrow = [1e9 + rng.random() for _ in range(700)] + [1e9 + 0.5] * 300  # one digit holds them all
    columns = {"wild": WILD, "narrow": narrow, "ids": [float(k) for k in range(10_000, 11_000)], "minus": [-x for x in narrow]}
    size = max(map(len, columns.values()))
    rows = list(zip(*[v + [None] * (size - len(v)) for v in columns.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found, counted = Q.exact_quantiles(df, list(columns), probs, few=few)
    for c, values in columns.items():
        assert list(map(repr, found[c])) == [repr(plain_quantile(sorted(values), p)) for p in probs], c
    assert [d.rows for d in counted] == [size] * 4 and [d.n for d in counted] == [len(v) for v in columns.values()]


def test_a_logarithm_that_falls_is_mended(spark, monkeypatch):
    true = Q._digit
    monkeypatch.setattr(Q, "_digit", lambda v: F.when(F.abs(v - 50) < 1, true(v) + 30).otherwise(true(v)))
    values = [float(k) / 7 for k in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert Q.exact_quantiles(df, ["v"], [0.1, 0.39, 0.4, 0.7])[0]["v"] == [plain_quantile(values, p) for p in (0.1, 0.39, 0.4, 0.7)]


@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_moments_of_digits(spark, shift):
    rng = np.random.default_rng(3)
    values = shift + np.concatenate((rng.gamma(1.5, 2.0, 3_000), rng.normal(0, 1, 500), np.full(500, 4.0)))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    mean, s2, s3, s4 = Q.digits(df, ["v"], moments=True)[0].moments()
    exact = values.astype(np.longdouble)
    d = exact - exact.mean()
    assert mean == pytest.approx(float(exact.mean()), rel=1e-14)
    # a mean of 1e9 is itself rounded to a ten-millionth
    assert [s2, s3, s4] == pytest.approx([float((d**k).sum()) for k in (2, 3, 4)], rel=1e-6 if shift else 1e-10)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(0.1, None)] * 7, "a double, b double").repartition(3)
    one, none = Q.digits(df, ["a", "b"], moments=True)
    assert one.moments() == (0.1, 0.0, 0.0, 0.0) and none.moments()[0] is None and (none.n, none.rows) == (0, 7)
    assert [d.rows for d in Q.digits(df.limit(0), ["a"])] == [0]


def test_anomaly_scan_reads_three_times(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, rng.gauss(0, 1), i % 3, 1.0) for i in range(4_000)], "id int, v double, few int, one double")
    seen = spark.sparkContext.accumulator(0)

    def tally(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out = anomaly.anomaly_scan(df.mapInArrow(tally, df.schema), "t", ["id"])
    got = {r.column_name: r for r in out.collect()}
    assert set(got) == {"id", "v"}
    values = sorted((r.v, r.id) for r in df.collect())
    q1, q3 = plain_quantile([v for v, _ in values], 0.25), plain_quantile([v for v, _ in values], 0.75)
    outside = sorted((i, v) for v, i in values if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1))
    assert got["v"].outlier_count == len(outside) > 10 and got["v"].outlier_values == [v for _, v in outside[:10]]
    assert got["id"].outlier_count == 0 and got["id"].outlier_values == []
    assert seen.value <= 3 * 4_000


def test_table_profile_of_nulls_and_dates(spark):
    rows = [(1, "2024-01-01", "a", None), (None, "x", None, None), (3, None, "a", None), (3, "2024-03-01", "b", None)]
    df = spark.createDataFrame(rows, "n int, text_date string, s string, day_date date")
    got = {r.column_name: r for r in profile.profile_table(df, "t").collect()}
    assert {c: r.null_count for c, r in got.items()} == {"n": 1, "text_date": 1, "s": 1, "day_date": 4}
    assert tuple(got["text_date"].date_stats) == (2, 2, "2024-01-01 00:00:00", "2024-03-01 00:00:00", 60)
    assert tuple(got["day_date"].date_stats) == (0, 4, None, None, 0)
    assert got["n"].null_percentage == 25.0 and got["n"].row_count == 4 and got["n"].duplicate_rows == 0
    assert got["s"].categorical_stats.top_value == "a" and got["n"].date_stats is None and got["s"].numeric_stats is None
    empty = profile.profile_table(df.limit(0), "t").collect()
    assert [r.null_percentage for r in empty] == [0.0] * 4 and {r.row_count for r in empty} == {0}


# ---- fingerprints

MIXED = "a string, b double, c array<int>, d struct<x:int,y:string>, e decimal(30,2), f timestamp"


def mixed_rows():
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        rows.append((rng.choice([None, "", "x", "xy"]), rng.choice([None, 0.0, -0.0, math.nan, 1.5]), rng.choice([None, [], [1], [1, None]]),
                     rng.choice([None, (None, "p"), (1, None)]), None, None))
    return rows


@pytest.mark.parametrize("clash", [False, True])
def test_repeated_rows(spark, monkeypatch, clash):
    if clash:  # all rows share a few fingerprints: only the comparison of whole rows can tell them apart
        monkeypatch.setattr(Fp, "fingerprint", lambda df, columns: [F.length(F.coalesce("a", F.lit(""))).cast("long"), F.lit(1).cast("long")])
    df = spark.createDataFrame(mixed_rows(), MIXED).repartition(6)
    want = df.groupBy(*df.columns).count().agg(F.sum(F.col("count") - 1)).first()[0]
    got = Fp.row_counts(df)
    assert got.repeated == want > 0 and got.total == 400
    assert got.nulls == {c: df.where(F.col(c).isNull()).count() for c in df.columns}


def test_nulls_that_change_places(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), (None, "x")], "a string, b string")
    assert Fp.row_counts(df).repeated == 1 and Fp.row_counts(df, ["a"]).repeated == 1
    assert Fp.row_counts(df.limit(0)) == Fp.RowCounts(0, 0, {"a": 0, "b": 0})


def test_many_columns(spark):
    names = [f"c{k}" for k in range(130)]
    df = spark.range(5).select(*[F.when(F.col("id") * 30 > k, F.lit("v")).alias(c) for k, c in enumerate(names)])
    got = Fp.row_counts(df.union(df))
    assert got.repeated == 5 and got.nulls["c0"] == 2 and got.nulls["c129"] == 10


def test_fingerprints_are_all_that_is_shuffled(spark, monkeypatch):
    plans = []
    true = Fp.observed
    monkeypatch.setattr(Fp, "observed", lambda df, figures, action: (plans.append(plan_of(df)), true(df, figures, action))[1])
    df = spark.createDataFrame([("a" * 50, "b" * 50, k) for k in range(20)], "x string, y string, z int")
    assert validate.duplicate_count(df).first().duplicate_count == 0
    (plan,) = plans
    exchange = re.search(r"Exchange hashpartitioning\(([^)]*)\)", plan)[1]
    assert re.findall(r"_[ks]\d", exchange) == ["_k0", "_k1", "_s0"] and "x#" not in exchange


# ---- uniqueness


def test_uniqueness_rules_share_a_scan(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", -0.0), (2, None, 1.0), (None, None, None)], "i int, s string, d double")
    checks = [rules._Check(i, rules.Rule(f"u_{c}", "uniqueness", c)) for i, c in enumerate(("i", "s", "d"))]
    found = rules._counts(df, checks)
    assert len(re.findall(r"Scan ExistingRDD\[i#", plan_of(found))) == 1
    assert {r.rule_index: (r.failing, r.total) for r in found.collect()} == {0: (1, 4), 1: (2, 4), 2: (1, 4)}
    assert {tuple(r)[1:] for r in rules._counts(df.limit(0), checks).collect()} == {(0, 0)}


# ---- ordered passes


def test_one_exchange_of_rows(spark):
    df = spark.range(0, 500, 1, 3).select("id", (F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
    for out in (G.forward_fill(df, ["v"], ["id"], ["k"]), G.with_percent_rank(df, "v", ["id"], "r"), G.with_row_number(df, ["id"], "n")):
        plan = plan_of(out)
        rows = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "_last" not in x]
        assert all(x.startswith("_part") for x in rows) and len(rows) <= 1, plan  # of one row a range and task
        assert "rangepartitioning" not in plan


def test_input_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def tally(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 1_000, 1, 4).select("id", (F.col("id") * 37 % 101).alias("v")).mapInArrow(tally, "id long, v long")
    assert G.with_percent_rank(df, "v", ["id"], "r").count() == 1_000
    assert seen.value == 1_000


def test_stored_rows_are_not_copied(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "s"))
    plain = spark.read.parquet(str(tmp_path / "s")).where("id > 1").select((F.col("id") + 1).alias("x"))
    assert G.stored_once(plain) is plain
    joined = plain.join(spark.range(5).withColumnRenamed("id", "x"), "x")
    assert G.stored_once(joined) is not joined


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_passes_across_batches(spark, batch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rng = random.Random(batch)
        rows = [(rng.choice(["a", None, "b"]), i, rng.choice([None, None, 1.5, float("nan")]), rng.choice([None, "s"])) for i in range(300)]
        df = spark.createDataFrame(rows, "k string, i int, v double, s string").repartition(4)
        got = {r.i: (r.v, r.s) for r in G.forward_fill(df, ["v", "s"], ["i"], ["k"]).collect()}
        last = {}
        for k, i, v, s in rows:
            was = last.get(k, (None, None))
            last[k] = (was[0] if v is None else v, was[1] if s is None else s)
            assert str(got[i]) == str(last[k])
        ranked = {r.i: r.p for r in G.with_percent_rank(df, "s", ["i"], "p").collect()}
        nulls = sum(r[3] is None for r in rows)
        assert set(ranked.values()) == {0.0, nulls / 299}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_ranges_follow_the_tables_that_are_read(spark, tmp_path):
    spark.range(3_000).write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    joined = G.with_row_number(rows, ["id"], "n").join(F.broadcast(rows), "id")
    assert G.range_count(rows) == G.range_count(joined) == int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- insert-ignore


@pytest.mark.parametrize("few", [0, 1_000])
def test_insert_ignore_filters_the_target(spark, tmp_path, few):
    target = [(k, f"k{k % 7}", k) for k in range(0, 40_000, 3)] + [(None, "k1", 1), (5, None, 1)]
    spark.createDataFrame(target, "a int, b string, v int").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    batch = [(k, f"k{k % 7}", v) for k in range(200, 500) for v in (2, 1)] + [(None, "k1", 9), (5, None, 9), (600, "other", 1)]
    df = spark.createDataFrame(batch, "a int, b string, v int").repartition(4)
    out = writers.insert_ignore(df, stored, ["a", "b"], ["v"], few=few)
    have = {(a, b) for a, b, _ in target if a is not None and b is not None}
    want = [(a, b, v) for a, b, v in batch if (a, b) not in have and (v == 1 or a is None or b is None)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(a,5\)", plan_of(out))
    fresh = df.where("v = 1")
    kept = writers._possible(stored.select("a", "b"), fresh, ["a", "b"], few).collect()
    hits = {(a, b) for a, b, _ in batch} & have
    assert hits <= set(map(tuple, kept)) and len(kept) < 2 * len(hits)
    assert "BroadcastHashJoin" in plan_of(out)


def test_insert_ignore_of_nothing(spark):
    df = spark.createDataFrame([(1, 1)], "a int, v int")
    assert writers.insert_ignore(df.limit(0), df, ["a"], ["v"]).collect() == []
    assert len(writers.insert_ignore(df, df.limit(0), ["a"], ["v"]).collect()) == 1
    assert writers.insert_ignore(df, df.withColumn("a", F.col("a").cast("long")), ["a"], ["v"], few=0).collect() == []


# ---- isolation forest


@pytest.mark.parametrize(("n", "trees", "psi"), [(3_000, 40, 64), (50, 7, 50), (400, 1, 100)])
def test_forest_samples(spark, n, trees, psi):
    rows = spark.range(n).select("id", (F.col("id") * 1.5).alias("_f0"))
    one = iforest._sample(rows, ["id"], n, trees, psi, 7)
    other = iforest._sample(rows.repartition(5), ["id"], n, trees, psi, 7)
    assert {r["tree"]: r["count"] for r in one.groupBy("tree").count().collect()} == {t: psi for t in range(trees)}
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    if n == 3_000:  # rows are taken alike, and trees take them apart
        means = [r[1] for r in one.groupBy("tree").agg(F.avg("_f0")).collect()]
        assert abs(sum(means) / trees - 0.75 * n) < 0.03 * n
        often = {r["count"] for r in one.groupBy("_f0").count().collect()}
        assert max(often) < 8


# ---- heavy values


def test_top_values_are_proven_or_counted(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abcdefghijklm") * rng.randint(1, 2), f"id{i}", None, rng.choice(["x", None]), i % 4000) for i in range(24_000)]
    df = spark.createDataFrame(rows, "`odd ``name` string, id string, none string, few string, wide int").repartition(5)
    columns = ["odd `name", "id", "none", "few", "wide"]
    proven, others = profile._heavy_values(df, columns, 10)
    assert {r[0] for r in proven} == {"odd `name"} and others == columns[1:]
    got = {}
    for r in profile.value_distribution(df, columns).collect():
        got.setdefault(r.column_name, []).append((r["rank"], r.value, r.frequency))
    for i, c in enumerate(columns):
        counts = {}
        for row in rows:
            if row[i] is not None:
                counts[str(row[i])] = counts.get(str(row[i]), 0) + 1
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert sorted(got.get(c, [])) == [(k + 1, v, n) for k, (v, n) in enumerate(want)], c


def test_a_hot_value_among_many_single_ones(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot"), (F.col("id") % 6).cast("string"))).otherwise(F.col("id").cast("string")).alias("s"))
    proven, others = profile._heavy_values(df, ["s"], 2)
    assert proven == [("s", 1, "hot0", 10_000), ("s", 2, "hot3", 10_000)] and not others
    assert profile._heavy_values(df, ["s"], 3) == ([], ["s"])


# ---- counts of a validation and rows without repeats, by one hash a row


@pytest.mark.parametrize("few", [Fp.FEW, 0])
@pytest.mark.parametrize("clash", [False, True])
def test_scan_counts(spark, monkeypatch, few, clash):
    monkeypatch.setattr(Fp, "FEW", few)
    if clash:  # one hash for all rows of a value of a: whole rows are compared
        monkeypatch.setattr(Fp, "fingerprint", lambda df, columns: [F.length(F.coalesce("a", F.lit(""))).cast("long")])
    df = spark.createDataFrame(mixed_rows(), MIXED).repartition(6)
    cells = [F.struct(F.lit(0).alias("place"), F.lit(None).cast("bigint").alias("number"), F.col("a").alias("text")),
             F.struct(F.lit(1).alias("place"), F.lit(7).cast("bigint").alias("number"), F.lit(None).cast("string").alias("text"))]
    got, values = Fp.scan_counts(df, cells)
    assert got == Fp.row_counts(df) and got.repeated > 0
    want = {(0, None, r.a, r["count"]) for r in df.groupBy("a").count().collect()} | {(1, 7, None, 400)}
    assert {tuple(r) for r in values.collect()} == want
    assert Fp.scan_counts(df.limit(0), cells)[0] == Fp.RowCounts(0, 0, dict.fromkeys(df.columns, 0))


@pytest.mark.parametrize("few", [Fp.FEW, 0])
@pytest.mark.parametrize("clash", [False, True])
def test_distinct_rows(spark, monkeypatch, few, clash):
    monkeypatch.setattr(Fp, "FEW", few)
    if clash:
        monkeypatch.setattr(Fp, "fingerprint", lambda df, columns: [F.length(F.coalesce("a", F.lit(""))).cast("long")])
    df = spark.createDataFrame(mixed_rows(), MIXED).repartition(6)
    got, want = Fp.distinct_rows(df), df.dropDuplicates()
    assert got.count() == want.count() < 400 and got.exceptAll(want).isEmpty() and got.columns == df.columns
    assert Fp.distinct_rows(df.limit(0)).count() == 0
    once = spark.range(9)
    assert clash or Fp.distinct_rows(once) is once


def shuffled_by(spark, action):
    """Bytes that the stages of ``action`` write to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.length()))

    before = total()
    action()
    return total() - before


def wide_sales(spark, path):
    n = F.col("id")
    spark.range(0, 60_000, 1, 4).select(
        n.alias("sale_id"), *[F.xxhash64(n, F.lit(k)).alias(f"v{k}") for k in range(6)], (n % 7).alias("product_id"), (n % 5).alias("warehouse_id"),
    ).write.parquet(path)  # 56 bytes a row that do not compress
    return spark.read.parquet(path)


def test_validation_shuffles_a_hash_a_row(spark, tmp_path):
    df = wide_sales(spark, str(tmp_path / "sales"))
    parents = {"products": spark.range(6).withColumnRenamed("id", "product_id"), "warehouses": spark.range(5).withColumnRenamed("id", "warehouse_id")}
    found = []
    moved = shuffled_by(spark, lambda: found.append(validate.validate_table(df, "sales", parents).first()))
    assert (found[0].duplicate_count, found[0].missing_foreign_keys) == (0, {"product_id": 8571})
    assert moved < 60_000 * 20  # three hashes a row, moved twice as keys were counted apart, were five times that


def test_etl_shuffles_no_rows(spark, tmp_path):
    from wharfline.plans import etl
    from wharfline.sources.readers import FrameSource

    df = wide_sales(spark, str(tmp_path / "sales"))
    runs = []
    moved = shuffled_by(spark, lambda: runs.append(etl.run_pipeline(spark, FrameSource({"price_history": df}), ["price_history"], validate=False)))
    assert (runs[0].tables[0].rows_extracted, runs[0].tables[0].rows_transformed) == (60_000, 60_000)
    assert moved < 60_000 * 20  # whole rows are more than 50 bytes

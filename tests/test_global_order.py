"""Order over whole tables against plain Python on small data with hot values."""

import random

import pytest
from pyspark.sql import functions as F

from wharfline.functions import global_order as G
from wharfline.functions.quantiles import exact_quantiles


def rows_with_ties(n=3000, seed=3):
    rng = random.Random(seed)
    # a third NULL, a third one value, the rest spread out
    return [(i, rng.choice([None, 5.0, float(rng.randint(0, 400))])) for i in range(n)]


@pytest.fixture(scope="module")
def no_coalescing(spark):
    """Keep all range partitions, so that runs of equal values cross partition borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_row_number_is_dense_and_ordered(spark, no_coalescing):
    df = spark.createDataFrame(rows_with_ties(), "id int, v double").repartition(7)
    out = G.with_row_number(df, [F.col("v").asc_nulls_first(), "id"], "rn", 10).collect()
    want = sorted(rows_with_ties(), key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [r["id"] for r in sorted(out, key=lambda r: r["rn"])] == [i for i, _ in want]
    assert sorted(r["rn"] for r in out) == list(range(10, 10 + len(want)))


def test_row_number_as_read_is_dense(spark):
    out = G.with_row_number(spark.range(0, 1000, 1, 5), None, "rn").collect()
    assert sorted(r["rn"] for r in out) == list(range(1, 1001))


@pytest.mark.parametrize("data", [rows_with_ties(), [(i, 1.0) for i in range(50)], [(1, 2.0)], [(i, None) for i in range(9)]])
def test_percent_rank_equals_window(spark, no_coalescing, data):
    df = spark.createDataFrame(data, "id int, v double").repartition(5)
    got = {r["id"]: r["pr"] for r in G.with_percent_rank(df, "v", ["id"], "pr").collect()}
    df.createOrReplaceTempView("ranked_input")
    want = spark.sql("select id, percent_rank() over (order by v nulls first) pr from ranked_input").collect()
    assert got == pytest.approx({r["id"]: r["pr"] for r in want})


def plain_fill(rows, key):
    last, out = {}, []
    for r in rows:
        k = r[0] if key else 0
        if r[2] is not None:
            last[k] = r[2]
        out.append((r[0], r[1], last.get(k)))
    return out


@pytest.mark.parametrize("key", [False, True])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.6])
def test_forward_fill(spark, no_coalescing, key, share):
    rng = random.Random(11)
    rows = [
        (rng.choice(["hot", "hot", "cold", f"k{i % 50}"]), i, float(i) if rng.random() < share else None)
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(6)
    got = G.forward_fill(df, ["v"], ["i"], ["k"] if key else []).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == plain_fill(rows, key)


def test_forward_fill_leading_null(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, 1.0, None, None, 4.0])], "i int, v double")
    out = sorted(G.forward_fill(df, ["v"], ["i"]).collect())
    assert [r["v"] for r in out] == [None, 1.0, 1.0, 1.0, 4.0]


@pytest.mark.parametrize("chunk", [7, 100_000])
def test_dense_ids_with_many_copies(spark, chunk):
    data = ["a"] * 40 + ["b"] * 500 + ["c"] * 3
    df = spark.createDataFrame([(x,) for x in data], "x string").repartition(6)
    out = sorted(map(tuple, G.with_dense_ids(df, ["x"], "id", 101, chunk).select("id", "x").collect()))
    assert out == list(zip(range(101, 101 + len(data)), data))


def plain_quantile(values, p):
    values = sorted(values)
    place = (len(values) - 1) * p
    low = int(place)
    high = min(low + 1, len(values) - 1) if place > low else low
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("few", [1, 20, 500, 100_000])
def test_quantiles_exact_for_any_bracket_size(spark, few):
    rng = random.Random(5)
    data = [
        (
            rng.gauss(0, 1),  # all distinct
            float(rng.choice([1, 1, 1, 2])),  # two hot values
            None if rng.random() < 0.3 else rng.choice([7.0, rng.random() * 100]),  # NULLs and one hot value
            3.0,  # constant
            None,
        )
        for _ in range(5000)
    ]
    names = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got, *_ = exact_quantiles(df, names, probs, few=few)
    for i, n in enumerate(names):
        values = [r[i] for r in data if r[i] is not None]
        assert got[n] == ([None] * len(probs) if not values else [plain_quantile(values, p) for p in probs]), n


def test_quantiles_do_not_depend_on_the_partitions(spark):
    df = spark.range(0, 20_000, 1, 6).select((F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    found = [exact_quantiles(df.repartition(k), ["v"], [0.3, 0.9], few=50)[0]["v"] for k in (1, 2)]
    found.append(exact_quantiles(df.repartition(3), ["v"], [0.3, 0.9], few=50)[0]["v"])
    assert found[0] == found[1] == found[2]

"""Outliers by interquartile range and by z-score, and the scan of all numeric columns of a table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions import global_order as G
from wharfline.functions.quantiles import ColumnDigits, digits
from wharfline.functions.scalars import is_true, percent_text
from wharfline.operators.profile import quantiles
from wharfline.schemas import numeric_columns
from wharfline.session import cut

SCAN_SCHEMA = (
    "table_name string, column_name string, method string, outlier_count bigint, "
    "outlier_percentage double, outlier_values array<double>"
)


Fence = tuple[float, float]


def _fence(q1: float, q3: float, multiplier: float) -> Fence:
    return q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1)


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, approximate: bool = False
) -> dict[str, Fence]:
    """Lower and upper fence per column with values: a few numbers, so that scans can skip row groups by them."""
    found = quantiles(df, columns, (0.25, 0.75), approximate)
    return {c: _fence(q1, q3, multiplier) for c, (q1, q3) in found.items() if q1 is not None}


def _outside(column: str, bounds: Fence) -> Column:
    value = F.col(column).cast("double")
    return (value < F.lit(bounds[0])) | (value > F.lit(bounds[1]))


def _may_be_outside(df: DataFrame, column: str, bounds: Fence) -> Column:
    """True for every outlier; integers are compared in their own type, so that the scan can skip row groups."""
    if not isinstance(df.schema[column].dataType, T.IntegralType) or not all(abs(b) < 2**53 for b in bounds):
        return _outside(column, bounds)
    value = F.col(column)
    return (value < F.lit(math.ceil(bounds[0]) + 1)) | (value > F.lit(math.floor(bounds[1]) - 1))


def flag_outliers_iqr(
    df: DataFrame, column: str, multiplier: float = 1.5, name: str = "is_outlier", approximate: bool = False
) -> DataFrame:
    """Adds a flag; NULL values are not outliers."""
    bounds = iqr_bounds(df, [column], multiplier, approximate).get(column)
    return df.withColumn(name, is_true(_outside(column, bounds)) if bounds else F.lit(False))


def flag_outliers_zscore(df: DataFrame, column: str, threshold: float = 3.0, name: str = "is_outlier") -> DataFrame:
    """Adds a flag for values more than ``threshold`` population deviations from the mean."""
    value = F.col(column).cast("double")
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")).first()
    if not stats["std"]:  # empty or constant column
        return df.withColumn(name, F.lit(False))
    z = F.abs((value - F.lit(stats["mean"])) / F.lit(stats["std"]))
    return df.withColumn(name, is_true(z > F.lit(float(threshold))))


def outlier_samples(
    df: DataFrame, bounds: dict[str, Fence], order_by: Sequence[str], k: int = 10
) -> DataFrame:
    """``(column_name, rank, value)``: the first k outliers per column in ``order_by``.

    The fences filter the scan first; then at most k rows per column leave a task.
    """
    if not bounds:
        return df.sparkSession.createDataFrame([], "column_name string, rank int, value double")
    return _first_outliers(_outliers(df, bounds, order_by), k)


def _outliers(df: DataFrame, bounds: dict[str, Fence], order_by: Sequence[str]) -> DataFrame:
    """``(column_name, value, _o0, _o1, …)``: the values outside the fences, with the columns that order them."""
    any_outside = reduce(Column.__or__, [_may_be_outside(df, c, b) for c, b in bounds.items()])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).cast("double").alias("value"),
            is_true(_outside(c, b)).alias("outside"),
        )
        for c, b in bounds.items()
    ]
    return (
        df.where(any_outside)
        .select(
            *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
            F.explode(F.filter(F.array(*cells), lambda s: s["outside"])).alias("cell"),
        )
        .select("cell.column_name", "cell.value", *[f"_o{i}" for i in range(len(order_by))])
    )


def _first_outliers(outside: DataFrame, k: int) -> DataFrame:
    first = [*[c for c in outside.columns if c.startswith("_o")], "value"]
    return G.first_per_group(outside, "column_name", first, k).select("column_name", "rank", "value")


def _varied(
    df: DataFrame, columns: Sequence[str], min_distinct: int, counted: Sequence[ColumnDigits] | None = None
) -> list[str]:
    """Columns with more than ``min_distinct`` values.

    The digits of a column mostly tell; of the others, at most ``min_distinct`` + 1 values each leave a task.
    """
    counted = digits(df, columns) if counted is None else counted
    unsure = [c for c, d in zip(columns, counted, strict=True) if not d.exactly and d.least_distinct <= min_distinct]
    found: dict[str, int] = {}
    if unsure:
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in unsure]
        values = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
        # dense_rank() <= k is cut down within each task before the shuffle; min_distinct is a handful
        rank = F.dense_rank().over(W.partitionBy("column_name").orderBy("value"))
        few = values.distinct().withColumn("_r", rank).where(F.col("_r") <= min_distinct + 1)
        found = {r["column_name"]: r["n"] for r in few.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    return [c for c, d in zip(columns, counted, strict=True) if found.get(c, d.least_distinct) > min_distinct]


def anomaly_scan(
    df: DataFrame,
    table: str,
    order_by: Sequence[str] | None = None,
    multiplier: float = 1.5,
    min_distinct: int = 10,
    k: int = 10,
    approximate: bool = False,
) -> DataFrame:
    """IQR outliers of every numeric column with more than ``min_distinct`` values.

    Three scans of the table: the digits of all numeric columns tell which of them vary, the open digits of the quartiles give
    the fences, and the last scan writes the values outside, which are counted and sampled.  The percentage is
    of all rows, NULLs included.
    """
    columns = numeric_columns(df)
    spark = df.sparkSession
    of_column = dict(zip(columns, digits(df, columns), strict=True))
    columns = _varied(df, columns, min_distinct, list(of_column.values()))
    if not columns:
        return spark.createDataFrame([], SCAN_SCHEMA)
    counted = [of_column[c] for c in columns]
    total = counted[0].rows
    found = quantiles(df, columns, (0.25, 0.75), approximate, counted=counted)
    bounds = {c: _fence(*found[c], multiplier) for c in columns}
    # a column whose ends lie inside its fences has no outliers: it is not read again
    beyond = {c: b for (c, b), d in zip(bounds.items(), counted, strict=True) if d.low < b[0] or d.high > b[1]}
    outside = cut(_outliers(df, beyond, order_by or df.columns), "outliers") if beyond else None
    outliers = {r["column_name"]: r["n"] for r in outside.groupBy("column_name").agg(F.count("*").alias("n")).collect()} if beyond else {}
    rows = [(table, c, "IQR", outliers.get(c, 0), outliers.get(c, 0) / total * 100) for c in columns]
    totals = spark.createDataFrame(rows, SCAN_SCHEMA.rsplit(",", 1)[0])
    empty = F.array().cast("array<double>")
    if not outliers:
        return totals.withColumn("outlier_values", empty)
    samples = (
        _first_outliers(outside, k)
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("_s"))  # k per column
    )
    return totals.join(F.broadcast(samples), "column_name", "left").select(
        *totals.columns, F.coalesce(F.transform("_s", lambda s: s["value"]), empty).alias("outlier_values")
    )


def outlier_summary(scan: DataFrame) -> DataFrame:
    return scan.select(
        "table_name",
        "column_name",
        "method",
        "outlier_count",
        percent_text(F.col("outlier_percentage")).alias("outlier_percentage"),
    )

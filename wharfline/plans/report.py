"""The overall quality report and its tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharfline.functions.scalars import percent_text


def report_profile_rows(profiles: DataFrame) -> DataFrame:
    """One row per profiled table."""
    return profiles.select("table_name", "row_count", "column_count", "duplicate_rows").distinct()


def report_anomaly_rows(scans: DataFrame) -> DataFrame:
    return scans.select(
        "table_name",
        "column_name",
        "method",
        "outlier_count",
        percent_text(F.col("outlier_percentage")).alias("outlier_percentage"),
    )


def quality_report(rules: DataFrame, profiles: DataFrame, scans: DataFrame) -> DataFrame:
    """One row: rules run and passed, tables, rows and columns profiled, outliers found."""
    names = ("total_rules", "passed", "total_tables", "total_rows", "total_columns", "total_outliers_detected")

    def part(df: DataFrame, **values) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        return df.select(*[values.get(n, zero).cast("bigint").alias(n) for n in names])

    one = F.lit(1)
    rows = reduce(
        DataFrame.unionByName,
        [
            part(rules, total_rules=one, passed=F.col("passed").cast("int")),
            part(
                report_profile_rows(profiles),
                total_tables=one,
                total_rows=F.col("row_count"),
                total_columns=F.col("column_count"),
            ),
            part(scans, total_outliers_detected=F.col("outlier_count")),
        ],
    )
    total = rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    rate = F.when(F.col("total_rules") > 0, percent_text(F.col("passed") * 100 / F.col("total_rules"))).otherwise("N/A")
    return total.select(
        "total_rules",
        "passed",
        (F.col("total_rules") - F.col("passed")).alias("failed"),
        rate.alias("pass_rate"),
        "total_tables",
        "total_rows",
        "total_columns",
        "total_outliers_detected",
    )

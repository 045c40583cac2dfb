"""Null, duplicate and foreign-key checks, and the per-table validation report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.config import QualityConfig
from wharfline.functions.fingerprints import row_counts, scan_counts
from wharfline.functions.scalars import percent_text, ratio
from wharfline.schemas import ForeignKey, foreign_keys


SUMMARY_SCHEMA = (
    "table_name string, total_rows bigint, null_columns int, total_nulls bigint, duplicates bigint, fk_issues int, "
    "validation_passed boolean, issue_count int, timestamp timestamp"
)


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_index, column_name, null_count, total_rows)`` from one scan."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    items = [
        F.struct(F.lit(i).alias("column_index"), F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*items)), F.col("_rows").alias("total_rows"))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows beyond the first of each value; NULLs equal each other.

    Counted when called, by fingerprints: whole rows are compared only where those are equal.
    """
    found = row_counts(df, columns)
    return df.sparkSession.createDataFrame([(found.repeated, found.total)], "duplicate_count bigint, total_rows bigint")


def _key_text(column: Column, own: T.DataType, other: T.DataType) -> Column:
    """A key as text in the type that both sides share: numbers meet as numbers, all else as text.

    NaN is no key, and -0.0 is 0.
    """
    pair = (own, other)
    if all(isinstance(t, T.IntegralType) for t in pair):
        return column.cast("bigint").cast("string")
    if not all(isinstance(t, T.NumericType) for t in pair):
        return column.cast("string")
    if any(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in pair):
        value = column.cast("double")
        return F.when(~F.isnan(value), value + F.lit(0.0)).cast("string")
    scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in pair)
    return column.cast(f"decimal(38,{scale})").cast("string")


def _key_cells(df: DataFrame, keys: Sequence[ForeignKey], parents: Mapping[str, DataFrame]) -> list[Column]:
    """A struct (place, number, text) for each key: whole numbers as such, all else as text."""
    cells = []
    for i, k in enumerate(keys):
        own, other = df.schema[k.column].dataType, parents[k.parent].schema[k.column].dataType
        whole = isinstance(own, T.IntegralType) and isinstance(other, T.IntegralType)
        number = F.col(k.column).cast("bigint") if whole else F.lit(None).cast("bigint")
        text = F.lit(None).cast("string") if whole else _key_text(F.col(k.column), own, other)
        cells.append(F.struct(F.lit(i).alias("place"), number.alias("number"), text.alias("text")))
    return cells


def _orphans(df: DataFrame, values: DataFrame, keys: Sequence[ForeignKey], parents: Mapping[str, DataFrame]) -> DataFrame:
    """``(place, orphan_rows)`` of the keys of ``df`` that have orphans; ``values``: its cells by value, ``n`` rows each."""
    known = reduce(
        DataFrame.unionByName,
        [
            parents[k.parent].select(
                F.lit(i).alias("place"),
                _key_text(F.col(k.column), parents[k.parent].schema[k.column].dataType, df.schema[k.column].dataType).alias("value"),
            )
            for i, k in enumerate(keys)
        ],
    )
    values = values.select("place", F.coalesce(F.col("number").cast("string"), "text").alias("value"), "n")
    return values.join(known, ["place", "value"], "left_anti").groupBy("place").agg(F.sum("n").alias("orphan_rows"))


def _checked_keys(df: DataFrame, table: str, parents: Mapping[str, DataFrame]) -> list[ForeignKey]:
    return [k for k in foreign_keys(table, df.columns) if k.parent in parents and k.column in parents[k.parent].columns]


def fk_orphans(df: DataFrame, table: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """``(column_name, parent_table, orphan_rows)`` for each checked key, NULL keys included.

    Rows are first counted per key value, all keys in one scan; only distinct
    values meet the parents, so neither a hot key nor a large parent table
    moves fact rows.  A key of one numeric type meets a parent of another by value.
    """
    keys = _checked_keys(df, table, parents)
    if not keys:
        return df.sparkSession.createDataFrame([], "column_name string, parent_table string, orphan_rows bigint")
    values = df.select(F.inline(F.array(*_key_cells(df, keys, parents)))).groupBy("place", "number", "text").agg(F.count("*").alias("n"))
    zeros = df.sparkSession.createDataFrame([(i, k.column, k.parent) for i, k in enumerate(keys)], "place int, column_name string, parent_table string")
    found = zeros.join(_orphans(df, values, keys, parents), "place", "left")
    return found.select("column_name", "parent_table", F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows"))


def fk_orphan_rows(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Rows whose key has no parent; NULL keys never have one, so they skip the join and its shuffle."""
    unmatched = df.where(F.col(column).isNotNull()).join(parent.select(column), column, "left_anti")
    return df.where(F.col(column).isNull()).unionByName(unmatched)


def fk_valid_rows(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    return df.join(parent.select(column), column, "left_semi")


def validation_metrics(df: DataFrame, table: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """``(kind, position, name, n)`` rows: total rows, nulls per column, duplicates, orphans per key.

    Counted when called, in one scan of the table, by one shuffle of a hash a row and of the values of the keys; rows are
    read again only where hashes repeat.
    """
    keys = _checked_keys(df, table, parents)
    found, values = scan_counts(df, _key_cells(df, keys, parents))
    rows = [("rows", 0, "", found.total), ("duplicate", 0, "", found.repeated)]
    rows += [("null", i, c, found.nulls[c]) for i, c in enumerate(df.columns)]
    if keys:
        rows += [("fk", r.place, keys[r.place].column, r.orphan_rows) for r in _orphans(df, values, keys, parents).collect()]
    return df.sparkSession.createDataFrame(rows, "kind string, position int, name string, n bigint")


def validate_table(
    df: DataFrame,
    table: str,
    parents: Mapping[str, DataFrame] | None = None,
    config: QualityConfig = QualityConfig(),
    required_columns: Sequence[str] | None = None,
) -> DataFrame:
    """The validation report as one row; passed when it lists no issue.

    The metrics are a handful of rows (columns + keys + 2), which the last
    aggregation folds into maps and the issue list.
    """
    missing = sorted(set(required_columns or ()) - set(df.columns))
    metrics = validation_metrics(df, table, parents or {})
    item = F.struct("position", "name", "n")

    def rows_of(kind: str):
        return F.array_sort(F.collect_list(F.when((F.col("kind") == kind) & (F.col("n") > 0), item)))

    def single(kind: str):
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    folded = metrics.agg(
        single("rows").alias("total_rows"),
        single("duplicate").alias("duplicate_count"),
        rows_of("null").alias("_nulls"),
        rows_of("fk").alias("_fks"),
    )

    def share(n):
        return ratio(n, F.col("total_rows"))

    def as_map(items: str):
        return F.map_from_entries(F.transform(items, lambda m: F.struct(m["name"], m["n"])))

    def share_text(n):
        return percent_text(share(n) * 100, 1)

    # Message formats: fixed values, kept as the users of the reports know them.
    null_limit = f"{config.null_threshold:.1%}"
    null_issues = F.transform(
        F.filter("_nulls", lambda m: share(m["n"]) > config.null_threshold),
        lambda m: F.concat(
            F.lit("Column '"), m["name"], F.lit("' has "), share_text(m["n"]), F.lit(f" nulls (threshold: {null_limit})")
        ),
    )
    dup = F.col("duplicate_count")
    dup_issues = F.when(
        F.coalesce(share(dup) > config.duplicate_threshold, F.lit(False)),
        F.array(F.concat(F.lit("Found "), dup.cast("string"), F.lit(" duplicates ("), share_text(dup), F.lit(")"))),
    ).otherwise(F.array().cast("array<string>"))
    fk_issues = F.transform(
        "_fks",
        lambda m: F.concat(
            F.lit("Missing foreign key references in '"), m["name"], F.lit("': "), m["n"].cast("string"), F.lit(" rows")
        ),
    )
    required_issues = (
        F.array(F.lit(f"Missing required columns: {', '.join(missing)}"))
        if missing
        else F.array().cast("array<string>")
    )
    return folded.select(
        F.lit(table).alias("table_name"),
        "total_rows",
        as_map("_nulls").alias("null_count"),
        "duplicate_count",
        as_map("_fks").alias("missing_foreign_keys"),
        F.concat(required_issues, null_issues, dup_issues, fk_issues).alias("issues"),
        F.lit(dt.datetime.now()).alias("timestamp"),  # when the check was asked for, however often it is read
    ).select(
        "table_name",
        "total_rows",
        "null_count",
        "duplicate_count",
        "missing_foreign_keys",
        (F.size("issues") == 0).alias("validation_passed"),
        "issues",
        "timestamp",
    )


def null_threshold_issues(df: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Columns with NULLs, their share, and whether it exceeds the threshold."""
    share = ratio(F.col("null_count"), F.col("total_rows"))
    return (
        null_counts(df)
        .where("null_count > 0")
        .select(
            "column_name",
            "null_count",
            share.alias("null_fraction"),
            (share > config.null_threshold).alias("exceeds_threshold"),
        )
    )


def duplicate_threshold_issues(df: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    share = F.coalesce(ratio(F.col("duplicate_count"), F.col("total_rows")), F.lit(0.0))
    return duplicate_count(df).select(
        "duplicate_count",
        share.alias("duplicate_fraction"),
        (share > config.duplicate_threshold).alias("exceeds_threshold"),
    )


def quality_summary(reports: Sequence[DataFrame]) -> DataFrame:
    """One row per validation report; none without reports."""
    if not reports:
        return SparkSession.active().createDataFrame([], SUMMARY_SCHEMA)
    return reduce(DataFrame.unionByName, reports).select(
        "table_name",
        "total_rows",
        F.size("null_count").alias("null_columns"),
        F.aggregate(F.map_values("null_count"), F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total_nulls"),
        F.col("duplicate_count").alias("duplicates"),
        F.size("missing_foreign_keys").alias("fk_issues"),
        "validation_passed",
        F.size("issues").alias("issue_count"),
        "timestamp",
    )

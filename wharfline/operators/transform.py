"""Cleaning, de-duplication, derived columns and business rules."""

from __future__ import annotations

import re
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions import global_order as G
from wharfline.functions.quantiles import exact_quantiles
from wharfline.functions.scalars import is_true, ratio
from wharfline.schemas import date_named_columns, numeric_columns

log = logging.getLogger(__name__)


def null_total(df: DataFrame) -> DataFrame:
    """One row: the number of NULL cells of the table."""
    cells = [F.count_if(F.col(c).isNull()) for c in df.columns]
    return df.agg(sum(cells[1:], cells[0]).alias("total_nulls"))


def _fill_with(df: DataFrame, statistics: dict[str, float | None]) -> DataFrame:
    """Only columns that hold NULLs change type to double, as a mean need not fit the column type."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in statistics.items() if v is not None}
    )


def _with_nulls(df: DataFrame) -> list[str]:
    """Numeric columns that hold a NULL: one scan, one row back."""
    numeric = numeric_columns(df)
    if not numeric:
        return []
    has_null = df.agg(*[F.bool_or(F.col(c).isNull()).alias(c) for c in numeric]).first()
    return [c for c in numeric if has_null[c]]


def fill_mean(df: DataFrame) -> DataFrame:
    columns = _with_nulls(df)
    if not columns:
        return df
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return _fill_with(df, {c: means[c] for c in columns})


def fill_median(df: DataFrame, approximate: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Exact medians by default; ``approximate`` stops at one sketch pass."""
    columns = _with_nulls(df)
    if not columns:
        return df
    if approximate:
        medians = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in columns])
        return _fill_with(df, medians.first().asDict())
    found, *_ = exact_quantiles(df, columns, [0.5])
    return _fill_with(df, {c: q for c, (q,) in found.items()})


def clean_nulls(
    df: DataFrame,
    strategy: str = "drop",
    order_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """``drop``, ``fill_mean``, ``fill_median`` or ``fill_forward`` (the last needs ``order_by``)."""
    if strategy == "drop":
        return df.na.drop("any")
    if strategy == "fill_mean":
        return fill_mean(df)
    if strategy == "fill_median":
        return fill_median(df)
    if strategy == "fill_forward":
        if not order_by:
            raise ValueError("fill_forward needs order_by: Spark rows have no order of their own")
        fillable = [c for c in df.columns if c not in (*order_by, *partition_by)]
        return G.forward_fill(df, fillable, order_by, partition_by)
    log.warning("unknown null strategy %r, table returned unchanged", strategy)
    return df


def remove_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Distinct rows, or the first row in ``order_by`` of each ``subset`` value.

    ``row_number() = 1`` is cut down to one row per key and task before the
    shuffle, so a key with very many rows stays cheap.
    """
    if subset is None:
        return df.dropDuplicates()
    if not order_by:
        raise ValueError("keep-first needs order_by, with ties broken, to be repeatable")
    first = W.partitionBy(*subset).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def standardize_dates(
    df: DataFrame, date_columns: Sequence[str] | None = None, fmt: str = "yyyy-MM-dd"
) -> DataFrame:
    """Text columns become dates by one explicit format, or timestamps if the format has a time; what does not parse becomes NULL."""
    wanted = date_named_columns(df) if date_columns is None else [c for c in date_columns if c in df.columns]
    texts = [c for c in wanted if isinstance(df.schema[c].dataType, (T.StringType, T.VarcharType, T.CharType))]
    letters = re.sub(r"'[^']*'", "", fmt)  # quoted text is no field
    kind = "timestamp" if re.search(r"[HhKkmsSan]", letters) else "date"
    return df.withColumns({c: F.try_to_timestamp(c, F.lit(fmt)).cast(kind) for c in texts})


def _derive_inventory() -> tuple[set[str], dict[str, Column]]:
    return {"quantity_on_hand", "quantity_reserved"}, {
        "quantity_available": F.col("quantity_on_hand") - F.col("quantity_reserved")
    }


def _derive_orders() -> tuple[set[str], dict[str, Column]]:
    delay = F.datediff("actual_delivery_date", "expected_delivery_date")
    return {"actual_delivery_date", "expected_delivery_date"}, {
        "delivery_delay_days": delay,
        "is_late": is_true(delay > 0),
    }


def _derive_sales() -> tuple[set[str], dict[str, Column]]:
    return {"revenue", "quantity_sold"}, {"unit_price": ratio(F.col("revenue"), F.col("quantity_sold"))}


_DERIVED = {"inventory": _derive_inventory, "orders": _derive_orders, "sales": _derive_sales}


def add_derived_columns(df: DataFrame, table: str) -> DataFrame:
    """Adds the derived columns of the table; unchanged if an input column is absent."""
    if table not in _DERIVED:
        return df
    needed, columns = _DERIVED[table]()
    return df.withColumns(columns) if needed <= set(df.columns) else df


def business_rule(table: str) -> Column | None:
    """The row filter of a table; a NULL input fails it."""
    rules = {
        "products": (F.col("unit_cost") > 0) & (F.col("reorder_level") >= 0),
        "inventory": (F.col("quantity_on_hand") >= 0) & (F.col("quantity_reserved") >= 0),
        "orders": (F.col("order_quantity") > 0) & (F.col("order_cost") >= 0),
        "sales": (F.col("quantity_sold") > 0) & (F.col("revenue") >= 0),
    }
    return rules.get(table)


def apply_business_rules(df: DataFrame, table: str) -> DataFrame:
    keep = business_rule(table)
    return df if keep is None else df.where(keep)


def business_rule_impact(df: DataFrame, table: str) -> DataFrame:
    """One row: rows before, kept and removed, in one scan."""
    keep = business_rule(table)
    kept = F.count("*") if keep is None else F.count_if(is_true(keep))
    return df.agg(F.count("*").alias("rows_before"), kept.alias("rows_kept")).select(
        F.lit(table).alias("table_name"),
        "rows_before",
        "rows_kept",
        (F.col("rows_before") - F.col("rows_kept")).alias("rows_removed"),
    )


def transform_rows(df: DataFrame, table: str) -> DataFrame:
    """Standardise dates, derive, apply business rules: each row by itself."""
    return apply_business_rules(add_derived_columns(standardize_dates(df), table), table)


def transform_table(df: DataFrame, table: str) -> DataFrame:
    """De-duplicate, standardise dates, derive, apply business rules."""
    return transform_rows(remove_duplicates(df), table)

"""Table sources: parquet folders, catalog tables, JDBC tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.functions.scalars import missing_to_null

Moment = dt.date | dt.datetime | str


class Source(Protocol):
    """Anything that yields a DataFrame for a table name."""

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class FileSource:
    """One folder or file per table; ``pattern`` names it."""

    root: str
    fmt: str = "parquet"
    pattern: str = "{table}"
    options: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.format(self.fmt).options(**self.options)
        if table in self.schemas:
            reader = reader.schema(self.schemas[table])
        return reader.load(f"{self.root}/{self.pattern.format(table=table)}")


@dataclass(frozen=True)
class CatalogSource:
    database: str | None = None

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(f"{self.database}.{table}" if self.database else table)


@dataclass(frozen=True)
class JdbcSource:
    """Credentials and driver come in ``options``.

    A table is read in parts: by ``split``, which maps it to (column, lower, upper,
    partitions), or by ``keys``, which maps it to (integer column, partitions) and
    lets the database tell the bounds.  Only tables named in ``small`` may be
    read by one task.
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    split: Mapping[str, tuple[str, str, str, int]] = field(default_factory=dict)
    keys: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    small: Sequence[str] = ()
    fetch_size: int = 10_000

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        options = self.reader_options(table)
        if table in self.keys and table not in self.split:
            column, parts = self.keys[table]
            ask = {"url": self.url, **self.options, "query": f"select min({column}) as low, max({column}) as high from {table}"}
            low, high = spark.read.format("jdbc").options(**ask).load().first()
            if low is not None and high > low:
                options |= self._parts(column, low, high + 1, parts)
        elif table not in self.split and table not in self.small:
            raise ValueError(f"no way to read {table} in parts: give its split or key, or name it as small")
        return spark.read.format("jdbc").options(**options).load()

    @staticmethod
    def _parts(column: str, low: object, high: object, parts: int) -> dict[str, str]:
        return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}

    def reader_options(self, table: str) -> dict[str, str]:
        options = {"url": self.url, "dbtable": table, "fetchsize": str(self.fetch_size), **self.options}
        if table in self.split:
            options |= self._parts(*self.split[table])
        return options


@dataclass(frozen=True)
class FrameSource:
    """Tables already at hand as DataFrames."""

    tables: Mapping[str, DataFrame]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.tables[table]


def nan_to_null(df: DataFrame) -> DataFrame:
    if not any(t in ("double", "float") for _, t in df.dtypes):
        return df
    return df.select(*[missing_to_null(c, t) for c, t in df.dtypes])


def extract_table(
    spark: SparkSession,
    source: Source,
    table: str,
    date_column: str | None = None,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """A whole table, or its rows with ``date_column`` between ``start`` and ``end`` inclusive.

    The range applies only when all three are given.  It is set on the raw scan,
    so it reaches the parquet reader or the database.
    """
    df = source.read(spark, table)
    if date_column and start is not None and end is not None:
        as_type = df.schema[date_column].dataType
        df = df.where(F.col(date_column).between(F.lit(start).cast(as_type), F.lit(end).cast(as_type)))
    return nan_to_null(df)


def extract_query(
    spark: SparkSession,
    sql: str,
    args: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """A custom query: ``:name`` takes its value from ``args``, ``{name}`` its table from ``tables``."""
    return spark.sql(sql, args=dict(args or {}) or None, **(tables or {}))


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, row count and column count per table."""
    rows: Sequence[DataFrame] = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)

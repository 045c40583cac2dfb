"""Table schemas, keys and foreign keys of the supply-chain star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "suppliers": "supplier_id int, supplier_name string not null, country string, "
    "reliability_score decimal(5,2), lead_time_days int, created_date timestamp",
    "products": "product_id int, product_name string not null, category string, "
    "unit_cost decimal(10,2), reorder_level int, supplier_id int",
    "warehouses": "warehouse_id int, warehouse_name string not null, location string, "
    "capacity_units int, current_utilization_pct decimal(5,2)",
    "inventory": "inventory_id int, product_id int not null, warehouse_id int not null, "
    "quantity_on_hand int, quantity_reserved int, snapshot_date date not null",
    "orders": "order_id int, order_date date not null, supplier_id int not null, order_quantity int not null, "
    "order_cost decimal(15,2), expected_delivery_date date, actual_delivery_date date, delivery_status string",
    "sales": "sale_id int, sale_date date not null, product_id int not null, warehouse_id int not null, "
    "quantity_sold int not null, revenue decimal(15,2)",
    "price_history": "price_history_id int, product_id int not null, supplier_id int not null, "
    "unit_price decimal(10,2), effective_date date not null",
}


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    parent: str


FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("products", "supplier_id", "suppliers"),
    ForeignKey("inventory", "product_id", "products"),
    ForeignKey("inventory", "warehouse_id", "warehouses"),
    ForeignKey("orders", "supplier_id", "suppliers"),
    ForeignKey("sales", "product_id", "products"),
    ForeignKey("sales", "warehouse_id", "warehouses"),
    ForeignKey("price_history", "product_id", "products"),
    ForeignKey("price_history", "supplier_id", "suppliers"),
)


def foreign_keys(table: str, columns: list[str] | None = None) -> list[ForeignKey]:
    """Foreign keys of a table, limited to those whose column is present."""
    return [k for k in FOREIGN_KEYS if k.table == table and (columns is None or k.column in columns)]


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers only: booleans are profiled as categories."""
    return isinstance(dtype, T.NumericType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def date_named_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "date" in c.lower()]

"""Data-quality rules: definition, execution, summary."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharfline.functions.scalars import is_true, percent_text

log = logging.getLogger(__name__)

Condition = Column | str | Callable[[DataFrame], Column]

RESULT_SCHEMA = (
    "table_name string, rule_index int, rule_name string, passed boolean, severity string, message string, "
    "affected_rows bigint, affected_percentage double, details map<string,double>, timestamp timestamp"
)

# Status texts: fixed values.
PASS, FAIL = "✓ PASS", "✗ FAIL"


@dataclass(frozen=True)
class Rule:
    """``kind`` is uniqueness, completeness, validity or consistency.

    ``condition`` is a Column, a SQL text or a function of the table; it must
    hold for every row, and NULL does not hold.  ``threshold`` is the allowed
    share of NULLs in percent (completeness only).
    """

    name: str
    kind: str
    column: str
    condition: Condition | None = None
    severity: str = "CRITICAL"
    description: str = ""
    threshold: float | None = None


def _condition_column(df: DataFrame, condition: Condition) -> Column:
    if isinstance(condition, str):
        return F.expr(condition)
    return condition(df) if callable(condition) and not isinstance(condition, Column) else condition


@dataclass
class _Check:
    """A rule that passed analysis: the number of failing rows as an aggregate, or a value to group by."""

    index: int
    rule: Rule
    failing: Column | None = None  # None: uniqueness


@dataclass
class RuleBook:
    """Rules per table and the results collected so far."""

    rules: dict[str, list[Rule]] = field(default_factory=dict)
    results: list[DataFrame] = field(default_factory=list)

    def add_rule(self, table: str, rule: Rule) -> None:
        self.rules.setdefault(table, []).append(rule)

    def add_rules(self, by_table: dict[str, Sequence[Rule]]) -> RuleBook:
        for table, rules in by_table.items():
            for rule in rules:
                self.add_rule(table, rule)
        return self

    def execute_rules(self, df: DataFrame, table: str) -> DataFrame:
        """One row per rule of the table, in order.

        All row conditions of the table share one aggregation; each uniqueness
        rule adds one narrow group count.  Rule counts (a few rows) come back to
        the driver so that a rule that fails at run time becomes a failed result
        and leaves the others intact.
        """
        spark = df.sparkSession
        checks: list[_Check] = []
        rows: list[tuple] = []
        for index, rule in enumerate(self.rules.get(table, [])):
            try:
                check = self._analyse(df, index, rule)
            except Exception as e:  # noqa: BLE001 - a condition is the user's code: whatever it raises fails this rule only
                rows.append(_failed(table, index, rule, _error_text(rule, e)))
                continue
            if isinstance(check, str):
                rows.append(_failed(table, index, rule, check))
            elif check is not None:
                checks.append(check)
        rows += self._run(df, table, checks)
        rows.sort(key=lambda r: r[1])
        now = dt.datetime.now()  # of this execution, however often the result is read
        result = spark.createDataFrame([(*r, now) for r in rows], RESULT_SCHEMA)
        self.results.append(result)
        return result

    @staticmethod
    def _analyse(df: DataFrame, index: int, rule: Rule) -> _Check | str | None:
        """A check, a failure text, or None for a kind of rule that is not known."""
        if rule.kind == "uniqueness":
            df.select(rule.column)
            return _Check(index, rule)
        if rule.kind == "completeness":
            df.select(rule.column)
            return _Check(index, rule, F.count_if(F.col(rule.column).isNull()))
        if rule.kind in ("validity", "consistency"):
            if rule.condition is None:
                return "No condition defined for rule"
            failing = F.count_if(~is_true(_condition_column(df, rule.condition)))
            df.agg(failing)  # analysis only: an unknown column is found here, before any job
            return _Check(index, rule, failing)
        return None

    def _run(self, df: DataFrame, table: str, checks: list[_Check]) -> list[tuple]:
        if not checks:
            return []
        try:
            counts = {r["rule_index"]: r for r in _counts(df, checks).collect()}
            return [_result(table, c, counts[c.index]["failing"], counts[c.index]["total"]) for c in checks]
        except PySparkException as e:
            if len(checks) == 1:
                return [_failed(table, checks[0].index, checks[0].rule, _error_text(checks[0].rule, e))]
            log.warning("rules of %s failed together, running them one by one", table)
            return [row for c in checks for row in self._run(df, table, [c])]

    def summary(self) -> DataFrame:
        """Name, status, severity, affected rows and percentage of every result so far."""
        if not self.results:
            raise ValueError("no rules executed yet")
        return rule_summary(reduce(DataFrame.unionByName, self.results))


def _counts(df: DataFrame, checks: list[_Check]) -> DataFrame:
    """``(rule_index, failing, total)`` rows."""
    fused = [c for c in checks if c.failing is not None]
    parts: list[DataFrame] = []
    if fused:
        one = df.agg(F.count("*").alias("_total"), *[c.failing.alias(f"_{c.index}") for c in fused])
        items = [
            F.struct(
                F.lit(c.index).alias("rule_index"), F.col(f"_{c.index}").alias("failing"), F.col("_total").alias("total")
            )
            for c in fused
        ]
        parts.append(one.select(F.inline(F.array(*items))))
    unique = [c for c in checks if c.failing is None]
    if unique:
        # all uniqueness rules in one scan: values are counted per rule, map-side first, as text if there are several rules
        kinds = dict(df.dtypes)

        def cell(c: _Check) -> Column:
            value = F.col(c.rule.column)
            if kinds.get(c.rule.column) in ("float", "double"):
                value = value + F.lit(0).cast(kinds[c.rule.column])  # -0.0 is 0.0
            return F.struct(F.lit(c.index).alias("rule_index"), (value.cast("string") if len(unique) > 1 else value).alias("value"))

        counted = df.select(F.inline(F.array(*map(cell, unique)))).groupBy("rule_index", "value").agg(F.count("*").alias("_n"))
        found = counted.groupBy("rule_index").agg(F.sum(F.col("_n") - 1).alias("failing"), F.sum("_n").alias("total"))
        none = df.sparkSession.createDataFrame([(c.index,) for c in unique], "rule_index int")
        parts.append(
            none.join(found, "rule_index", "left").select(
                "rule_index", F.coalesce("failing", F.lit(0)).alias("failing"), F.coalesce("total", F.lit(0)).alias("total")))
    return reduce(DataFrame.unionByName, parts)


def _result(table: str, check: _Check, failing: int, total: int) -> tuple:
    rule = check.rule
    share = failing / total * 100 if total else 0.0
    if rule.kind == "completeness":
        passed = share <= (rule.threshold or 0.0)
        details = {"null_count": float(failing), "null_percentage": share}
    else:
        passed = failing == 0
        details = {"duplicate_count" if rule.kind == "uniqueness" else "invalid_count": float(failing)}
    message = f"{PASS if passed else FAIL}: {rule.description}"
    return (table, check.index, rule.name, passed, rule.severity, message, failing, share, details)


def _failed(table: str, index: int, rule: Rule, message: str) -> tuple:
    return (table, index, rule.name, False, "CRITICAL", message, 0, 0.0, {})


def _error_text(rule: Rule, e: Exception) -> str:
    what = "Condition evaluation" if rule.kind in ("validity", "consistency") else "Rule execution"
    return f"{what} failed: {str(e).splitlines()[0] if str(e) else type(e).__name__}"


def rule_report(results: DataFrame) -> DataFrame:
    """Results for display: status text, message and formatted percentage."""
    return results.select(
        "rule_name",
        F.when(F.col("passed"), PASS).otherwise(FAIL).alias("status"),
        "severity",
        "message",
        "affected_rows",
        percent_text(F.col("affected_percentage")).alias("affected_percentage"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )


def rule_summary(results: DataFrame) -> DataFrame:
    return rule_report(results).drop("message")


# Names, descriptions and severities of the rules below: fixed values, as the users of the reports know them.
STANDARD_RULES: dict[str, tuple[Rule, ...]] = {
    "suppliers": (
        Rule("supplier_id_unique", "uniqueness", "supplier_id", description="Supplier ID must be unique"),
        Rule(
            "reliability_score_range",
            "validity",
            "reliability_score",
            "reliability_score between 0 and 100",
            description="Reliability score must be between 0 and 100",
        ),
    ),
    "products": (
        Rule("product_id_unique", "uniqueness", "product_id", description="Product ID must be unique"),
        Rule("unit_cost_positive", "validity", "unit_cost", "unit_cost > 0", description="Unit cost must be positive"),
    ),
    "inventory": (
        Rule(
            "quantity_on_hand_valid",
            "validity",
            "quantity_on_hand",
            "quantity_on_hand >= 0",
            description="Quantity on hand cannot be negative",
        ),
        Rule(
            "reserved_not_exceed_onhand",
            "consistency",
            "quantity_reserved",
            "quantity_reserved <= quantity_on_hand",
            description="Reserved quantity cannot exceed quantity on hand",
        ),
    ),
    "orders": (
        Rule(
            "order_quantity_positive",
            "validity",
            "order_quantity",
            "order_quantity > 0",
            description="Order quantity must be positive",
        ),
    ),
    "sales": (
        Rule(
            "quantity_sold_positive",
            "validity",
            "quantity_sold",
            "quantity_sold > 0",
            description="Quantity sold must be positive",
        ),
    ),
}

# The further rules of the written rule list.
DOCUMENTED_RULES: dict[str, tuple[Rule, ...]] = {
    "suppliers": (
        Rule("lead_time_positive", "validity", "lead_time_days", "lead_time_days > 0", "WARNING", "Lead time must be positive"),
    ),
    "products": (
        Rule("reorder_level_valid", "validity", "reorder_level", "reorder_level >= 0", "WARNING", "Reorder level non-negative"),
        Rule("product_name_not_null", "completeness", "product_name", description="Product name required"),
    ),
    "inventory": (
        Rule("quantity_reserved_valid", "validity", "quantity_reserved", "quantity_reserved >= 0", description="Reserved not negative"),
    ),
    "orders": (
        Rule("order_cost_positive", "validity", "order_cost", "order_cost >= 0", description="Cost not negative"),
        # An open order has no delivery date yet and is not at fault.
        Rule(
            "delivery_dates_logical",
            "consistency",
            "actual_delivery_date",
            "actual_delivery_date is null or actual_delivery_date > order_date",
            "WARNING",
            "Delivery date after order date",
        ),
    ),
    "sales": (
        Rule("revenue_positive", "validity", "revenue", "revenue >= 0", description="Revenue not negative"),
        Rule(
            "revenue_quantity_consistency",
            "consistency",
            "revenue",
            "try_divide(revenue, quantity_sold) > 0",
            "WARNING",
            "Revenue per unit positive",
        ),
    ),
}

# The custom rules of the usage examples.
CUSTOM_RULES: dict[str, tuple[Rule, ...]] = {
    "products": (
        Rule(
            "reorder_level_reasonable",
            "validity",
            "reorder_level",
            lambda df: F.col("reorder_level") >= 10,
            "WARNING",
            "Reorder level should be at least 10",
        ),
    ),
    "sales": (
        Rule(
            "revenue_matches_calculation",
            "consistency",
            "revenue",
            "abs(revenue - quantity_sold * try_divide(revenue, quantity_sold)) < 0.01",
            description="Revenue should match quantity * unit_price",
        ),
    ),
    "inventory": (
        Rule(
            "low_stock_warning",
            "validity",
            "quantity_on_hand",
            "quantity_on_hand > reorder_level",
            "WARNING",
            "Stock should be above reorder point",
        ),
    ),
}

"""Extract, transform, validate and load a list of tables."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.config import QualityConfig
from wharfline.functions.fingerprints import distinct_rows
from wharfline.operators.transform import transform_rows
from wharfline.operators.validate import quality_summary, validate_table
from wharfline.schemas import foreign_keys
from wharfline.session import cut
from wharfline.sources.readers import Source, extract_table
from wharfline.sources.writers import Target, load

log = logging.getLogger(__name__)

RUN_SCHEMA = (
    "table_name string, status string, rows_extracted bigint, rows_transformed bigint, rows_loaded bigint, "
    "validation_passed boolean, issues array<string>, error string"
)


@dataclass
class TableRun:
    table: str
    status: str = "failed"
    rows_extracted: int = 0
    rows_transformed: int = 0
    rows_loaded: int = 0
    validation_passed: bool | None = None
    issues: list[str] = field(default_factory=list)
    error: str | None = None
    data: DataFrame | None = None
    report: DataFrame | None = None


@dataclass
class PipelineRun:
    start: dt.datetime
    end: dt.datetime
    tables: list[TableRun]

    @property
    def failed_tables(self) -> list[str]:
        return [t.table for t in self.tables if t.status == "failed"]

    @property
    def tables_processed(self) -> int:
        return len(self.tables) - len(self.failed_tables)

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row per table."""
        rows = [
            (
                t.table,
                t.status,
                t.rows_extracted,
                t.rows_transformed,
                t.rows_loaded,
                t.validation_passed,
                t.issues,
                t.error,
            )
            for t in self.tables
        ]
        return spark.createDataFrame(rows, RUN_SCHEMA)

    def totals(self, spark: SparkSession) -> DataFrame:
        """The run as one row."""
        return self.summary(spark).agg(
            F.count_if(F.col("status") != "failed").alias("tables_processed"),
            F.count_if(F.col("status") == "failed").alias("tables_failed"),
            F.coalesce(F.sum("rows_extracted"), F.lit(0)).alias("total_rows_extracted"),
            F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("total_rows_loaded"),
        )

    def quality(self) -> DataFrame:
        return quality_summary([t.report for t in self.tables if t.report is not None])


def _parents(spark: SparkSession, source: Source, df: DataFrame, table: str) -> dict[str, DataFrame]:
    """The parents of the keys that ``df`` has; one that cannot be read is left out with a warning."""
    found: dict[str, DataFrame] = {}
    for key in foreign_keys(table, df.columns):
        try:
            found[key.parent] = extract_table(spark, source, key.parent)
        except Exception as e:  # noqa: BLE001 - whatever a source raises, the other keys are still checked
            log.warning("%s.%s not checked, no %s: %s", table, key.column, key.parent, str(e).splitlines()[0] if str(e) else type(e).__name__)
    return found


def run_table(
    spark: SparkSession,
    source: Source,
    table: str,
    validate: bool = True,
    transform: bool = True,
    config: QualityConfig = QualityConfig(),
    on_fail: str = "warn",
    target: Target | None = None,
    if_exists: str = "append",
) -> TableRun:
    """One table end to end.

    The extracted table is written once to the scratch area, and counted there.
    De-duplication shuffles a hash a row; what it and the row-wise transformation
    leave is read from that copy by the validation and the load.  Only a table with
    very many repeated rows is written a second time, without them.
    """
    run = TableRun(table)
    try:
        raw = cut(extract_table(spark, source, table), f"etl-{table}")
        run.rows_extracted = raw.count()
        run.data = transform_rows(distinct_rows(raw), table) if transform else raw
        run.rows_transformed = run.data.count()
        if validate:
            report = validate_table(run.data, table, _parents(spark, source, run.data, table), config)
            row = report.first()
            run.report = spark.createDataFrame([row], report.schema)  # one row, computed once
            run.validation_passed, run.issues = row["validation_passed"], list(row["issues"])
            for issue in run.issues:
                log.warning("%s: %s", table, issue)
            if not run.validation_passed and on_fail == "skip":
                run.error = "validation failed, load skipped"
                return run
        if target is not None:
            run.rows_loaded = load(run.data, target, if_exists).rows_loaded
        run.status = "processed"
    except Exception as e:  # noqa: BLE001 - a failing table is recorded and must not stop the others
        log.error("%s failed: %s", table, e)
        run.error = str(e).splitlines()[0] if str(e) else type(e).__name__
    return run


def run_pipeline(
    spark: SparkSession,
    source: Source,
    tables: Sequence[str],
    validate: bool = True,
    transform: bool = True,
    on_fail: str = "warn",
    targets: Mapping[str, Target] | None = None,
    if_exists: str = "append",
    config: QualityConfig = QualityConfig(),
    concurrent_tables: int = 4,
) -> PipelineRun:
    """All tables; independent tables share the cluster from a few driver threads.

    ``on_fail``: ``warn`` counts a table that fails validation as processed,
    ``skip`` marks it failed and does not load it.
    """
    if on_fail not in ("warn", "skip"):
        raise ValueError("on_fail must be 'warn' or 'skip'")
    start = dt.datetime.now()

    def one(table: str) -> TableRun:
        target = (targets or {}).get(table)
        return run_table(spark, source, table, validate, transform, config, on_fail, target, if_exists)

    with ThreadPoolExecutor(max_workers=max(1, concurrent_tables)) as pool:
        runs = list(pool.map(one, tables))
    return PipelineRun(start, dt.datetime.now(), runs)

"""Table sinks: load with modes, quarantine and backup; insert-ignore; surrogate ids; JSON."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wharfline.functions.global_order import with_dense_ids, with_row_number
from wharfline.session import cut
from wharfline.functions.scalars import is_true

log = logging.getLogger(__name__)

MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


@dataclass(frozen=True)
class LoadResult:
    rows_loaded: int
    rows_failed: int
    backup: str | None = None


@dataclass(frozen=True)
class FileTarget:
    """A table as a folder of files; ``partition_by`` lays it out for pruning."""

    path: str
    fmt: str = "parquet"
    partition_by: Sequence[str] = ()
    options: Mapping[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, mode: str) -> None:
        writer = df.write.format(self.fmt).mode(mode).options(**self.options)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).save(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format(self.fmt).options(**self.options).load(self.path)

    def sibling(self, suffix: str) -> FileTarget:
        return FileTarget(f"{self.path}_{suffix}", self.fmt, self.partition_by, self.options)


@dataclass(frozen=True)
class CatalogTarget:
    table: str
    fmt: str = "parquet"
    partition_by: Sequence[str] = ()

    def write(self, df: DataFrame, mode: str) -> None:
        writer = df.write.format(self.fmt).mode(mode)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).saveAsTable(self.table)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def sibling(self, suffix: str) -> CatalogTarget:
        return CatalogTarget(f"{self.table}_{suffix}", self.fmt, self.partition_by)


@dataclass(frozen=True)
class JdbcTarget:
    """Credentials and driver come in ``options``; every task writes in batches of ``batch_size`` rows."""

    url: str
    table: str
    batch_size: int = 1000
    options: Mapping[str, str] = field(default_factory=dict)

    def writer_options(self) -> dict[str, str]:
        return {"url": self.url, "dbtable": self.table, "batchsize": str(self.batch_size), **self.options}

    def write(self, df: DataFrame, mode: str) -> None:
        df.write.format("jdbc").mode(mode).options(**self.writer_options()).save()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, dbtable=self.table, **self.options).load()

    def sibling(self, suffix: str) -> JdbcTarget:
        return JdbcTarget(self.url, f"{self.table}_{suffix}", self.batch_size, self.options)


Target = FileTarget | CatalogTarget | JdbcTarget


def _write_counted(df: DataFrame, target: Target, mode: str) -> int:
    """Write and count in the same job.

    The count sits in the writing stage itself, whose tasks are each counted once.
    """
    seen = Observation()
    target.write(df.observe(seen, F.count(F.lit(1)).alias("n")), mode)
    return int(seen.get["n"])


def backup(spark: SparkSession, target: Target) -> str | None:
    """Copy the target to a timestamped sibling; a target that cannot be read only warns."""
    copy = target.sibling(f"backup_{dt.datetime.now():%Y%m%d_%H%M%S}")
    try:
        copy.write(target.read(spark), "errorifexists")
    except (AnalysisException, PySparkException) as e:
        log.warning("no backup made: %s", str(e).splitlines()[0])
        return None
    return copy.path if isinstance(copy, FileTarget) else copy.table


def with_reject_reason(df: DataFrame, reject_if: Mapping[str, Column | str]) -> DataFrame:
    """Adds ``reject_reason``: the names of the conditions that a row meets, empty for a valid row."""
    reasons = [
        F.when(is_true(F.expr(c) if isinstance(c, str) else c), F.lit(name)) for name, c in reject_if.items()
    ]
    return df.withColumn("reject_reason", F.concat_ws("; ", *reasons))


def split_valid(df: DataFrame, reject_if: Mapping[str, Column | str]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet no reject condition, and the others with ``reject_reason``."""
    judged = with_reject_reason(df, reject_if)
    return judged.where("reject_reason = ''").drop("reject_reason"), judged.where("reject_reason != ''")


def load(
    df: DataFrame,
    target: Target,
    if_exists: str = "append",
    create_backup: bool = True,
    reject_if: Mapping[str, Column | str] | None = None,
    quarantine: Target | None = None,
) -> LoadResult:
    """Write to ``target``; rows that meet a reject condition go to ``quarantine`` instead.

    One bad row never costs its neighbours: rows are separated before the write,
    so the result does not depend on batch borders.
    """
    if if_exists not in MODES:
        raise ValueError(f"if_exists must be one of {sorted(MODES)}")
    kept = backup(df.sparkSession, target) if create_backup and if_exists == "replace" else None
    if not reject_if:
        return LoadResult(_write_counted(df, target, MODES[if_exists]), 0, kept)
    # judged and stored once: both writes see the same rows, even if the input cannot be read twice alike
    judged = cut(with_reject_reason(df, reject_if), "load")
    rejected = judged.where("reject_reason != ''")
    # rejected rows first: a failure between the writes then loses none
    failed = _write_counted(rejected, quarantine, "append") if quarantine else rejected.count()
    loaded = _write_counted(judged.where("reject_reason = ''").drop("reject_reason"), target, MODES[if_exists])
    return LoadResult(loaded, failed, kept)


FEW_KEYS = 100_000  # keys of a batch that are sent to every task as they are
BITS_PER_KEY, MOST_BITS = 16, 1 << 28  # of the filter of a larger batch; at most 32 MB are sent


def insert_ignore(
    batch: DataFrame, target: DataFrame, unique: Sequence[str], order_by: Sequence[str], few: int = FEW_KEYS
) -> DataFrame:
    """Rows of ``batch`` to append: first per unique key, keys already in ``target`` skipped.

    The batch is reduced to one row per key and stored before it meets the target.  The bounds of its keys go into the target's
    scan, and its keys (or, of a large batch, a Bloom filter of them) are looked up there, so that
    about as many target rows are shuffled as the batch has.
    """
    first = W.partitionBy(*unique).orderBy(*order_by)
    fresh = cut(batch.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn"), "insert")
    known = _possible(target.select(*unique), fresh, list(unique), few)
    return fresh.join(known, list(unique), "left_anti").select(*batch.columns)


def _possible(target: DataFrame, fresh: DataFrame, unique: list[str], few: int) -> DataFrame:
    """The keys of ``target`` that ``fresh`` may hold: all that it holds, and few others."""
    found = fresh.agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(unique) for f in (F.min, F.max)]).first()
    for i, c in enumerate(unique):  # NULL keys equal none
        target = target.where(F.col(c).between(F.lit(found[f"min_{i}"]), F.lit(found[f"max_{i}"])))
    keys = fresh.select(*unique)
    if found["n"] <= few:
        return target.join(F.broadcast(keys), unique, "left_semi")
    if dict(keys.dtypes) != dict(target.dtypes):  # hashes of a key depend on its type
        return target
    bits = min(MOST_BITS, 1 << (found["n"] * BITS_PER_KEY - 1).bit_length())
    place = F.pmod(F.xxhash64(*unique), F.lit(bits)) + 1
    bitmaps = (
        keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bitmap"))
    )
    placed = target.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    at = F.bitmap_bit_position("_place").cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int"))
    return placed.join(F.broadcast(bitmaps), "_bucket").where(bit != 0).select(*unique)  # rows of 32,768 bits


def next_id(existing: DataFrame, column: str) -> int:
    """One more than the largest id, 1 for an empty table."""
    return existing.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint").alias("m")).first()["m"] + 1


def assign_surrogate_ids(
    batch: DataFrame, column: str, existing: DataFrame | None = None, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Consecutive ids after those of ``existing``, in ``order_by`` (then all other columns) or as the rows are read."""
    start = next_id(existing, column) if existing is not None else 1
    if order_by is None:
        return with_row_number(batch, None, column, start)
    return with_dense_ids(batch, order_by, column, start)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)

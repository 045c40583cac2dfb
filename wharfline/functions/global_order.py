"""Whole-table order without a single-task window.

``Window.orderBy`` without a partition key moves every row to one task.  The
functions here range-partition the rows instead, which is the only exchange of
rows.  What needs the order inside a range - positions, runs of equal values,
running sums, filled values - is made in one pass over the sorted range, before
it is written; what crosses the border of two ranges is carried by one small row
a range, from aggregates that are combined map-side.  The number of such rows is
the number of ranges, whatever the data size, which is the bound that makes the
broadcasts below safe.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from wharfline.session import cut

PART, POS = "_part", "_pos"
RANGE_BYTES, MOST_RANGES = 1 << 28, 100_000
UNKNOWN = 1 << 60  # rows that came from the driver have no estimate but a number above this one
_POS_BITS = 33  # monotonically_increasing_id keeps the row index in its low 33 bits


def _with_position(df: DataFrame) -> DataFrame:
    seq = F.monotonically_increasing_id()
    return (
        df.withColumn("_seq", seq)
        .withColumn(PART, F.shiftright("_seq", _POS_BITS).cast("int"))
        .withColumn(POS, F.col("_seq").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_seq")
    )


def range_count(df: DataFrame) -> int:
    """Ranges of about RANGE_BYTES of the tables that the plan reads, as many as there are shuffle partitions at least."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))
    size = sum(x for x in sizes if x < UNKNOWN)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_RANGES, max(least, -(-size // RANGE_BYTES)))


# Nodes of a plan that are cheap to run twice.
_CHEAP = {"Project", "Filter", "Relation", "LocalRelation", "Range", "LogicalRDD", "LocalLimit", "RelationV2", "DataSourceV2ScanRelation"}


def stored_once(df: DataFrame, label: str = "input") -> DataFrame:
    """``df`` itself if it only reads, filters and projects stored rows; else its rows, written once.

    Range partitioning reads its input twice, once to find the borders.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = [(m[1], m[0]) for m in re.finditer(r"^[\s:+\-|]*([A-Z]\w*).*", plan, re.MULTILINE)]
    cheap = all(name in _CHEAP or (name == "Join" and "strategy=broadcast" in line) for name, line in nodes)
    return df if cheap and "UDF" not in plan else cut(df, label)


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    df = stored_once(df)
    return df.repartitionByRange(range_count(df), *order).sortWithinPartitions(*order)


def range_sorted(df: DataFrame, order: Sequence[Column | str], label: str = "ranged") -> DataFrame:
    """Rows with ``_part`` (range partition) and ``_pos`` (0-based place in it), written once.

    ``order`` should be total: rows that tie on all of it stay in one range partition.
    """
    return cut(_with_position(_ranged(df, order)), label)


class Step:
    """What an ordered pass does in one range; it keeps what it needs of earlier rows."""

    def rows(self, rows: pa.Table, at: int) -> pa.Table:
        """The next rows of the range, the first of which has place ``at``, with the columns of the pass."""
        raise NotImplementedError

    def edge(self) -> dict[str, pa.Array]:
        """What the next ranges need to know of this one: one value each."""
        raise NotImplementedError


def ordered_pass(
    df: DataFrame, order: Sequence[Column | str], step: Callable[[], Step], schema: str, edge: str, label: str
) -> tuple[DataFrame, list[Row]]:
    """Rows of the pass with ``_part`` and ``_pos``, written once, and one row for each range, in order.

    ``schema`` names the columns of ``step().rows``, ``edge`` those of ``step().edge``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, one, last = TaskContext.get().partitionId(), 0, step(), None
        for batch in batches:
            if batch.num_rows:
                last = one.rows(pa.Table.from_batches([batch]), at)
                marks = [pa.array(np.full(last.num_rows, part, dtype=np.int32)), pa.array(np.arange(at, at + last.num_rows)), pa.nulls(last.num_rows, ends)]
                at += last.num_rows
                yield from pa.Table.from_arrays([*last.columns, *marks], names=[*last.column_names, PART, POS, "_edge"]).to_batches()
        if last is not None:
            values = one.edge()
            border = pa.StructArray.from_arrays([values[f.name].cast(f.type) for f in ends], fields=list(ends))
            nulls = [pa.nulls(1, f.type) for f in last.schema]
            yield pa.RecordBatch.from_arrays(
                [*nulls, pa.array([part], pa.int32()), pa.array([-1]), border], names=[*last.column_names, PART, POS, "_edge"])

    ends = to_arrow_type(df.sparkSession.createDataFrame([], edge).schema)
    done = cut(_ranged(df, order).mapInArrow(run, f"{schema}, {PART} int, {POS} bigint, _edge struct<{edge}>"), label)
    edges = done.where(F.col(POS) < 0).select(PART, "_edge.*").collect()  # a row a range
    return done.where(F.col(POS) >= 0).drop("_edge"), sorted(edges, key=lambda r: r[PART])


def _by_part(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Values that every task needs: one row a range."""
    return F.broadcast(spark.createDataFrame(list(rows), f"{PART} int, {schema}"))


def _before(counts: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """(range, rows of the ranges before) from (range, rows)."""
    ordered = sorted(counts)
    return [(part, end - n) for (part, n), end in zip(ordered, accumulate(n for _, n in ordered))]


def _same(a: object, b: object) -> bool:
    """Equality as grouping has it: NULLs are equal, and so are NaNs."""
    if isinstance(a, (tuple, list)) and isinstance(b, (tuple, list)):
        return len(a) == len(b) and all(map(_same, a, b))
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)


def _changes(table: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Whether each row but the first differs from the one before it in ``columns``; NULLs equal each other."""
    new = np.zeros(table.num_rows - 1, dtype=bool)
    for c in columns:
        codes = table.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new |= codes[1:] != codes[:-1]
    return new


def file_order(df: DataFrame, label: str = "filed") -> DataFrame:
    """As ``range_sorted`` in the order the rows are read: no shuffle at all."""
    return cut(_with_position(df), label)


def with_row_number(
    df: DataFrame, order: Sequence[Column | str] | None, name: str, start: int | Column = 1
) -> DataFrame:
    """Dense whole-table numbers from ``start``; ``order=None`` takes the rows as read."""
    rows = range_sorted(df, order, "numbered") if order else file_order(df, "numbered")
    sizes = rows.groupBy(PART).agg(F.count("*").alias("n")).collect()
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = rows.join(_by_part(df.sparkSession, _before([tuple(r) for r in sizes]), "_before bigint"), PART)
    return numbered.withColumn(name, (F.col("_before") + F.col(POS) + first).cast("bigint")).drop(
        PART, POS, "_before"
    )


def with_dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 1, chunk: int = 100_000) -> DataFrame:
    """Dense numbers in ``order``, then by all other columns.

    Copies of a row cannot be told apart, so they are counted (map-side) and
    ranked as one row, then take as many consecutive numbers as there are
    copies.  A row with more than ``chunk`` copies is expanded by several tasks.
    """
    ordered = [*order, *[c for c in df.columns if c not in order]]
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))

    class Copies(Step):
        total = 0

        def rows(self, rows: pa.Table, at: int) -> pa.Table:
            copies = rows.column("_copies").to_numpy()
            ends = self.total + np.cumsum(copies)
            self.total = int(ends[-1])
            return rows.append_column("_before_in", pa.array(ends - copies))

        def edge(self) -> dict[str, pa.Array]:
            return {"n": pa.array([self.total])}

    rows, edges = ordered_pass(counted, ordered, Copies, f"{_fields(counted)}, _before_in bigint", "n bigint", "ids")
    offsets = _by_part(df.sparkSession, _before([tuple(r) for r in edges]), "_before bigint")
    first = F.col("_before") + F.col("_before_in") + F.lit(start)
    numbered = rows.join(offsets, PART).select(*df.columns, "_copies", first.cast("bigint").alias("_first"))

    def expanded(part: DataFrame) -> DataFrame:
        ids = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1))
        return part.withColumn(name, ids).select(*df.columns, name)

    usual = numbered.where(F.col("_copies") <= chunk)
    pieces = (
        numbered.where(F.col("_copies") > chunk)
        .withColumn("_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(chunk).cast("bigint"))))
        .withColumn("_first", F.col("_first") + F.col("_at"))
        .withColumn("_copies", F.least(F.lit(chunk), F.col("_copies") - F.col("_at")))
        .drop("_at")
        .repartition("_first")
    )
    return expanded(usual).unionByName(expanded(pieces))


def with_percent_rank(df: DataFrame, value: str, tie_break: Sequence[str], name: str) -> DataFrame:
    """``percent_rank() over (order by value nulls first)``; ties share the rank of their first row.

    A value shared by very many rows may span several range partitions, so the
    place where such a run begins is carried over to the partitions it goes on in.
    """
    class Runs(Step):
        last: pa.Table | None = None  # the last row so far, and the place where its run of equal values begins
        begin = n = 0
        first: pa.Array

        def rows(self, rows: pa.Table, at: int) -> pa.Table:
            column = rows.select([value])
            if self.last is None:
                self.first = column.column(0).slice(0, 1).combine_chunks()
                new = np.concatenate(([True], _changes(column, [value])))
            else:
                new = _changes(pa.concat_tables([self.last, column]), [value])
            begin = np.maximum.accumulate(np.where(new, at + np.arange(rows.num_rows), self.begin))
            self.last, self.begin, self.n = column.slice(rows.num_rows - 1), int(begin[-1]), at + rows.num_rows
            return rows.append_column("_begin_in", pa.array(begin))

        def edge(self) -> dict[str, pa.Array]:
            return {"n": pa.array([self.n]), "first": self.first, "last": self.last.column(0).combine_chunks(), "at": pa.array([self.begin])}

    kind = df.schema[value].dataType.simpleString()
    rows, edges = ordered_pass(
        df, [F.col(value).asc_nulls_first(), *tie_break], Runs, f"{_fields(df)}, _begin_in bigint",
        f"n bigint, first {kind}, last {kind}, at bigint", "ranked")
    before, total = dict(_before([(e[PART], e["n"]) for e in edges])), sum(e["n"] for e in edges)
    carry, open_at, open_value = [], 0, None  # where the last run of the ranges so far begins, and its value
    for i, e in enumerate(edges):
        goes_on = i > 0 and _same(open_value, e["first"])
        carry.append((e[PART], before[e[PART]], open_at if goes_on else before[e[PART]]))
        if not (goes_on and e["at"] == 0):
            open_at = before[e[PART]] + e["at"]
        open_value = e["last"]
    rank0 = F.when(F.col("_begin_in") == 0, F.col("_begin")).otherwise(F.col("_before") + F.col("_begin_in"))
    rank = rank0 / (total - 1) if total > 1 else F.lit(0.0)
    joined = rows.join(_by_part(df.sparkSession, carry, "_before bigint, _begin bigint"), PART)
    return joined.withColumn(name, rank).drop(PART, POS, "_begin_in", "_before", "_begin")


def forward_fill(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """NULLs take the last earlier non-null value in ``order``, within ``keys`` if any are given.

    Keys only lead the sort: a key with very many rows is split over range
    partitions like any other stretch of rows.
    """
    used = list(dict.fromkeys([*keys, *columns]))

    class Fill(Step):
        last: pa.Table | None = None  # the last row so far, filled
        first: pa.Table
        first_key = True  # whether all rows so far have the first key of the range

        def rows(self, rows: pa.Table, at: int) -> pa.Table:
            own = rows.select(used)
            if self.last is None:
                self.first = own.slice(0, 1)
            joined = own if self.last is None else pa.concat_tables([self.last, own])
            skip = joined.num_rows - own.num_rows
            new = np.concatenate(([False], _changes(joined, keys)))
            begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            early = ((begin == 0) & self.first_key)[skip:]
            open_ = []
            for c in columns:
                values = joined.column(c).combine_chunks()
                given = np.where(values.is_valid().to_numpy(zero_copy_only=False), np.arange(len(values)), -1)
                source = np.maximum.accumulate(given)
                known = source >= begin
                filled = values.take(pa.array(np.where(known, source, 0), mask=~known))
                rows = rows.set_column(rows.schema.get_field_index(c), c, filled.slice(skip))
                open_.append(early & ~known[skip:])
            self.first_key = bool(early[-1])
            self.last = rows.select(used).slice(rows.num_rows - 1)
            for i, flag in enumerate(open_):
                rows = rows.append_column(f"_open_{i}", pa.array(flag))
            return rows

        def edge(self) -> dict[str, pa.Array]:
            out = {f"first_{i}": self.first.column(k).combine_chunks() for i, k in enumerate(keys)}
            out |= {f"last_{i}": self.last.column(k).combine_chunks() for i, k in enumerate(keys)}
            return out | {f"value_{i}": self.last.column(c).combine_chunks() for i, c in enumerate(columns)}

    def kind(c: str) -> str:
        return df.schema[c].dataType.simpleString()

    ends = [f"{side}_{i} {kind(k)}" for side in ("first", "last") for i, k in enumerate(keys)] + [f"value_{i} {kind(c)}" for i, c in enumerate(columns)]
    opened = "".join(f", _open_{i} boolean" for i in range(len(columns)))
    rows, edges = ordered_pass(df, [*keys, *order], Fill, _fields(df) + opened, ", ".join(ends), "filled")
    carry, key, values = [], None, [None] * len(columns)  # the last key of the ranges so far, and its last values
    for i, e in enumerate(edges):
        first, last = ([e[f"{side}_{j}"] for j in range(len(keys))] for side in ("first", "last"))
        goes_on = i > 0 and _same(key, first)
        carry.append((e[PART], *(values if goes_on else [None] * len(columns))))
        stays = goes_on and _same(first, last)
        values = [old if stays and e[f"value_{j}"] is None else e[f"value_{j}"] for j, old in enumerate(values)]
        key = last
    carried = _by_part(df.sparkSession, carry, ", ".join(f"_carry_{i} {kind(c)}" for i, c in enumerate(columns)))
    filled = {c: F.when(F.col(f"_open_{i}"), F.col(f"_carry_{i}")).otherwise(F.col(c)) for i, c in enumerate(columns)}
    return rows.join(carried, PART).select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def first_per_group(df: DataFrame, group: str, order: Sequence[Column | str], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each ``group`` in ``order``, numbered from 1 in ``name``.

    Ranked twice: first within random parts of each group, as many as there are shuffle partitions, then among
    the k rows that each part keeps.  No task sorts a whole group, whatever ``k``.
    """
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
    near = salted.withColumn(name, F.row_number().over(W.partitionBy(group, "_salt").orderBy(*order))).where(F.col(name) <= k)
    last = W.partitionBy(group).orderBy(*order)
    return near.drop("_salt").withColumn(name, F.row_number().over(last)).where(F.col(name) <= k)


def value_counts(df: DataFrame, columns: Sequence[str], as_type: str = "double") -> DataFrame:
    """``(column_name, value, n)``: one row per column and distinct value, NULL included.

    Counted map-side first, so a value held by most rows is one row per task in the shuffle.
    """
    cast = df.select(*[F.col(c).cast(as_type).alias(c) for c in columns])
    long = cast.unpivot([], list(columns), "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))

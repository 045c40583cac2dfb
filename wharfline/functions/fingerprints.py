"""Exact counts of repeated rows by fingerprints: eight or sixteen bytes of a row are shuffled, not the row.

A row's fingerprint is one or two 64-bit hashes of its values and a mark for each NULL.  Rows that differ in a fingerprint are
different.  Those that share one are compared in full, and only those, so the counts do not rest on the hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions.scalars import observed
from wharfline.session import cut, scratch_path

NARROW = 16  # bytes of a row that is its own fingerprint
FEW = 100_000  # fingerprints, of a few bytes each, that are sent to every task
NULL_BITS = 62  # marks of NULLs in one number


def _plain(df: DataFrame, c: str) -> Column:
    """A value such that equal ones, as grouping sees them, have equal hashes."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.col(c) + F.lit(0).cast(kind)  # -0.0 is 0.0
    return F.array_sort(F.map_entries(c)) if isinstance(kind, T.MapType) else F.col(c)


def null_marks(columns: Sequence[str]) -> list[Column]:
    """One bit for each column that is NULL, NULL_BITS to a number."""
    out = []
    for lo in range(0, len(columns), NULL_BITS):
        bits = [F.when(F.col(c).isNull(), F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for k, c in enumerate(columns[lo : lo + NULL_BITS])]
        out.append(sum(bits[1:], bits[0]))
    return out


def fingerprint(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two hashes of the values and their NULL marks; a hash alone would pass over NULLs."""
    values = [*null_marks(columns), *[_plain(df, c) for c in columns]]
    return [F.xxhash64(F.lit("a"), *values), F.xxhash64(F.lit("b"), *values)]


def null_mark(columns: Sequence[str], c: str) -> Column:
    """1 in the groups whose rows are NULL in ``c``, one of all ``columns``."""
    i = list(columns).index(c)
    return F.shiftright(F.col(f"_s{i // NULL_BITS}"), i % NULL_BITS).bitwiseAND(F.lit(1))


def _width(kind: T.DataType) -> int:
    if isinstance(kind, (T.ByteType, T.BooleanType, T.ShortType, T.IntegerType, T.DateType, T.FloatType)):
        return 4
    if isinstance(kind, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)) or (isinstance(kind, T.DecimalType) and kind.precision <= 18):
        return 8
    return NARROW + 1


@dataclass(frozen=True)
class RowCounts:
    total: int
    repeated: int  # rows beyond the first of each value
    nulls: dict[str, int]


def row_counts(df: DataFrame, columns: Sequence[str] | None = None) -> RowCounts:
    """Rows, rows that repeat an earlier one (NULLs equal each other), and NULLs of ``columns``: one scan of the table.

    Fingerprints are counted map-side first, so a row with very many copies is one row a task in the shuffle.  Only if some of them
    repeat, the rows that have those are read again and compared.  Each figure is counted in a stage whose tasks count once.
    """
    columns = list(columns or df.columns)
    narrow = sum(_width(df.schema[c].dataType) for c in columns) <= NARROW
    keys = [F.col(c) for c in columns] if narrow else fingerprint(df, columns)
    marks = null_marks(columns)
    names, signs = [f"_k{i}" for i in range(len(keys))], [f"_s{i}" for i in range(len(marks))]
    rows = df.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], *[m.alias(s) for m, s in zip(marks, signs, strict=True)])
    # rows of one fingerprint have the same marks but for a clash, which the grouping then tells apart by itself
    groups = rows.groupBy(*names, *signs).agg(F.count("*").alias("_n"))
    figures = [F.sum("_n").alias("total"), F.sum(F.col("_n") - 1).alias("repeated"), F.count_if(F.col("_n") > 1).alias("groups")]
    figures += [F.sum(F.col("_n") * null_mark(columns, c)).alias(f"n{i}") for i, c in enumerate(columns)]
    if narrow:
        seen = groups.agg(*figures).first().asDict()
    else:
        path = scratch_path(df.sparkSession, "fingerprints")
        seen = observed(groups, figures, lambda g: g.where("_n > 1").select(*names).write.parquet(path))
    repeated = seen["repeated"] or 0
    if repeated and not narrow:
        again = df.sparkSession.read.schema(", ".join(f"{n} bigint" for n in names)).parquet(path).distinct()
        again = F.broadcast(again) if seen["groups"] <= FEW else again
        matched = df.select(*columns, *[k.alias(n) for k, n in zip(keys, names, strict=True)]).join(again, names, "left_semi")
        whole = matched.groupBy(*columns).agg(F.count("*").alias("_n"))
        repeated = whole.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).first()[0]
    return RowCounts(seen["total"] or 0, int(repeated), {c: seen[f"n{i}"] or 0 for i, c in enumerate(columns)})


def _repeats(df: DataFrame, columns: Sequence[str], again: DataFrame, found: int) -> int:
    """Rows of ``df`` beyond the first of each value, compared in full; ``again``: the ``_h`` that occur more than once."""
    if found <= FEW:
        df = df.withColumn("_h", fingerprint(df, columns)[0]).join(F.broadcast(again), "_h", "left_semi")
    whole = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return int(whole.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).first()[0])


def scan_counts(df: DataFrame, cells: Sequence[Column] = ()) -> tuple[RowCounts, DataFrame]:
    """The counts of ``row_counts`` for whole rows, and ``(place, number, text, n)`` of each value of the ``cells``: one scan.

    A cell is a struct of place (0 or more), number and text.  Rows are counted by one 64-bit hash and their NULL marks, cells by
    value, all map-side first and in one shuffle.  Rows whose hash occurs once differ from all others; if some occur more often,
    those rows are read again and compared.
    """
    columns = df.columns
    marks = {f"_s{i}": m for i, m in enumerate(null_marks(columns))}
    row = F.struct(
        F.lit(-1).alias("place"), fingerprint(df, columns)[0].alias("number"), F.lit(None).cast("string").alias("text"), *[m.alias(s) for s, m in marks.items()])
    others = [
        F.struct(c["place"].alias("place"), c["number"].alias("number"), c["text"].alias("text"), *[F.lit(0).cast("bigint").alias(s) for s in marks])
        for c in cells
    ]
    groups = df.select(F.inline(F.array(row, *others))).groupBy("place", "number", "text", *marks).agg(F.count("*").alias("n"))
    own = F.col("place") < 0
    figures = [F.sum(F.when(own, F.col("n"))).alias("total"), F.count_if(own & (F.col("n") > 1)).alias("groups")]
    figures += [F.sum(F.when(own, F.col("n") * null_mark(columns, c))).alias(f"n{i}") for i, c in enumerate(columns)]
    path = scratch_path(df.sparkSession, "counts")
    seen = observed(groups, figures, lambda g: g.where(~own | (F.col("n") > 1)).select("place", "number", "text", "n").write.parquet(path))
    kept = df.sparkSession.read.schema("place int, number bigint, text string, n bigint").parquet(path)
    found = seen["groups"] or 0
    again = kept.where(own).select(F.col("number").alias("_h")).distinct()
    repeated = _repeats(df, columns, again, found) if found else 0
    return RowCounts(seen["total"] or 0, repeated, {c: seen[f"n{i}"] or 0 for i, c in enumerate(columns)}), kept.where(~own)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df``, which should be stored, without repeated rows: ``df`` itself if there are none.

    One 64-bit hash of a row is shuffled.  Rows whose hash occurs once pass as they are read; only the others are compared, and
    what is left of them is stored.  If there are very many, the whole table is compared and stored without repeats.
    """
    groups = df.select(fingerprint(df, df.columns)[0].alias("_h")).groupBy("_h").agg(F.count("*").alias("_n"))
    path = scratch_path(df.sparkSession, "repeated")
    found = observed(groups, [F.count_if(F.col("_n") > 1).alias("groups")], lambda g: g.where("_n > 1").select("_h").write.parquet(path))["groups"] or 0
    if not found:
        return df
    if found > FEW:
        return cut(df.dropDuplicates(), "distinct")
    again = F.broadcast(df.sparkSession.read.schema("_h bigint").parquet(path))
    marked = df.withColumn("_h", fingerprint(df, df.columns)[0])
    single, others = (marked.join(again, "_h", how).select(*df.columns) for how in ("left_anti", "left_semi"))
    return single.unionByName(cut(others.dropDuplicates(), "distinct"))

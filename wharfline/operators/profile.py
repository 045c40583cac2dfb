"""Column and table profiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharfline.functions import global_order as G
from wharfline.functions.quantiles import ColumnDigits, digits, exact_quantiles
from wharfline.functions.scalars import percent_text
from wharfline.operators.validate import duplicate_count
from wharfline.schemas import is_numeric, is_temporal

QUARTILES = (0.25, 0.5, 0.75)
TOP = 10
NUMERIC_STATS = (
    "count bigint, missing bigint, mean double, median double, std double, min double, max double, "
    "q25 double, q75 double, skewness double, kurtosis double"
)
DATE_STATS = "count bigint, missing bigint, min_date string, max_date string, date_range_days bigint"
CATEGORICAL_STATS = (
    "count bigint, missing bigint, unique_count bigint, top_value string, top_frequency bigint, "
    "value_distribution array<struct<value:string,frequency:bigint>>"
)


def column_kinds(df: DataFrame) -> dict[str, str]:
    """numeric, date (by type, or by ``date`` in the name) or categorical, per column."""

    def kind(f: T.StructField) -> str:
        if is_numeric(f.dataType):
            return "numeric"
        return "date" if is_temporal(f.dataType) or "date" in f.name.lower() else "categorical"

    return {f.name: kind(f) for f in df.schema}


def _of_kind(df: DataFrame, kind: str, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else [c for c, k in column_kinds(df).items() if k == kind]


def _numeric_stats(df: DataFrame, columns: Sequence[str], counted: Sequence[ColumnDigits], approximate: bool) -> dict[str, tuple]:
    """Statistics per numeric column in the order of NUMERIC_STATS, from its digits with moments."""
    quartiles = quantiles(df, columns, QUARTILES, approximate, counted=counted)
    stats = {}
    for c, own in zip(columns, counted, strict=True):
        mean, *powers = own.moments()
        std, skewness, kurtosis = sample_moments(own.n, *(powers if own.n else (None,) * 3))
        q25, median, q75 = quartiles[c]
        stats[c] = (own.n, own.rows - own.n, mean, median, std, own.low, own.high, q25, q75, skewness, kurtosis)
    return stats


def sample_moments(
    n: int, s2: float | None, s3: float | None, s4: float | None
) -> tuple[float | None, float | None, float | None]:
    """Sample deviation, bias-corrected skewness and excess kurtosis from sums of powers of the distances.

    NULL below 2, 3 and 4 values; a constant column has skewness and kurtosis 0.
    """
    if s2 is None or n < 2:
        return None, None, None
    var = s2 / n
    g1, g2 = (s3 / n / var**1.5, s4 / n / var**2 - 3) if var > 0 else (0.0, 0.0)
    skewness = g1 * math.sqrt(n * (n - 1)) / (n - 2) if n > 2 else None
    kurtosis = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6) if n > 3 else None
    return math.sqrt(s2 / (n - 1)), skewness, kurtosis if var > 0 or kurtosis is None else 0.0


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = QUARTILES,
    approximate: bool = False,
    accuracy: int = 10_000,
    counted: Sequence[ColumnDigits] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles per column: exact by default, or within n/accuracy ranks from one sketch pass."""
    if not approximate:
        return exact_quantiles(df, columns, probs, counted)[0]
    if not columns:
        return {}
    sketches = [
        F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"_q{i}")
        for i, c in enumerate(columns)
    ]
    first = df.agg(*sketches).first()
    return {c: list(first[f"_q{i}"] or [None] * len(probs)) for i, c in enumerate(columns)}


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Count, missing, mean, median, std, min, max, quartiles, skewness and kurtosis: one row per column."""
    columns = _of_kind(df, "numeric", columns)
    stats = _numeric_stats(df, columns, digits(df, columns, moments=True), approximate)
    return df.sparkSession.createDataFrame([(c, *stats[c]) for c in columns], f"column_name string, {NUMERIC_STATS}")


def _top_values(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent values per column; only k rows per column and task are shuffled.

    NULL is ranked last and dropped afterwards: a filter before the window would
    reach into the counts and keep them from being shared with other readers.
    """
    by_frequency = [F.col("value").isNull(), F.desc("n"), F.col("value")]
    return (
        G.first_per_group(counts, "column_name", by_frequency, k)
        .where(F.col("value").isNotNull())
        .select("column_name", "rank", "value", F.col("n").alias("frequency"))
    )


TRACKED, LISTED = 10_000, 1_000  # values that the summary of a column holds, and that it names
# The summary's published bound: a count is off by 3.5 rows in its map's size at most, and the map is filled to three quarters.
SHARE_OFF = 3.5 * 0.75 / TRACKED


def _heavy_values(df: DataFrame, columns: Sequence[str], k: int) -> tuple[list[tuple], list[str]]:
    """(column, rank, value, frequency) of the columns whose k most frequent values can be proven so, and the other columns.

    A mergeable summary of bounded size names the candidates of each column, and a second scan counts them.  A value that it does not
    name occurs in less than twice its greatest error of the rows; if the k-th candidate occurs more often, no value is missing.
    What is shuffled does not depend on the number of distinct values.
    """
    names = [c.replace("`", "``") for c in columns]
    seen = df.agg(F.count("*").alias("n"), *[F.expr(f"approx_top_k(cast(`{c}` as string), {LISTED}, {TRACKED})").alias(f"t{i}") for i, c in enumerate(names)]).first()
    named = [(i, r["item"]) for i in range(len(columns)) for r in seen[f"t{i}"] or [] if r["item"] is not None]
    if not named:
        return [], list(columns)
    candidates = F.broadcast(df.sparkSession.createDataFrame(named, "c int, v string"))  # LISTED a column at most
    cells = df.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in names])).alias("c", "v"))
    counts = cells.join(candidates, ["c", "v"]).groupBy("c", "v").agg(F.count("*").alias("n")).collect()
    proven, others = [], []
    for i, c in enumerate(columns):
        own = sorted(((r["n"], r["v"]) for r in counts if r["c"] == i), key=lambda x: (-x[0], x[1].encode()))
        listed = seen[f"t{i}"] or []
        unseen = 2 * SHARE_OFF * seen["n"] + (listed[-1]["count"] if len(listed) == LISTED else 0)
        if len(own) >= k and own[k - 1][0] > unseen:
            proven += [(c, rank + 1, v, n) for rank, (n, v) in enumerate(own[:k])]
        else:
            others.append(c)
    return proven, others


def value_distribution(df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP) -> DataFrame:
    """``(column_name, rank, value, frequency)`` of the k most frequent values per column.

    Columns whose k-th value is not frequent enough to be told by a summary are counted by value.
    """
    columns = _of_kind(df, "categorical", columns)
    schema = "column_name string, rank int, value string, frequency bigint"
    proven, others = _heavy_values(df, columns, k) if columns else ([], [])
    heavy = df.sparkSession.createDataFrame(proven, schema)
    if not others:
        return heavy
    counted = _top_values(G.value_counts(df, others, "string"), k)
    return heavy.unionByName(counted) if proven else counted


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None, k: int = TOP) -> DataFrame:
    """Count, missing, distinct, top value and the k most frequent values per column."""
    columns = _of_kind(df, "categorical", columns)
    if not columns:
        return df.sparkSession.createDataFrame([], f"column_name string, {CATEGORICAL_STATS}")
    counts = G.value_counts(df, columns, "string")
    totals = counts.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("count"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.count("value").alias("unique_count"),
    )
    top = (
        _top_values(counts, k)
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "frequency"))).alias("_top"))  # k per column
    )
    first = F.get("_top", 0)
    return totals.join(F.broadcast(top), "column_name", "left").select(
        "column_name",
        "count",
        "missing",
        "unique_count",
        first["value"].alias("top_value"),
        F.coalesce(first["frequency"], F.lit(0)).alias("top_frequency"),
        F.transform(
            F.coalesce("_top", F.array().cast("array<struct<rank:int,value:string,frequency:bigint>>")),
            lambda t: F.struct(t["value"].alias("value"), t["frequency"].alias("frequency")),
        ).alias("value_distribution"),
    )


def _date_span(df: DataFrame, c: str, fmt: str) -> Column:
    is_text = isinstance(df.schema[c].dataType, T.StringType)
    t = F.try_to_timestamp(c, F.lit(fmt)) if is_text else F.col(c).cast("timestamp")
    days = F.floor((F.unix_micros(F.max(t)) - F.unix_micros(F.min(t))) / 86_400_000_000)
    return F.struct(
        F.count(t).alias("count"),
        F.count_if(t.isNull()).alias("missing"),
        F.date_format(F.min(t), "yyyy-MM-dd HH:mm:ss").alias("min_date"),
        F.date_format(F.max(t), "yyyy-MM-dd HH:mm:ss").alias("max_date"),
        F.coalesce(days, F.lit(0)).cast("bigint").alias("date_range_days"),
    )


def profile_date(df: DataFrame, columns: Sequence[str] | None = None, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Count, missing, first, last and range in days; text that does not parse is missing."""
    columns = _of_kind(df, "date", columns)
    if not columns:
        return df.sparkSession.createDataFrame([], f"column_name string, {DATE_STATS}")
    one = df.agg(*[_date_span(df, c, fmt).alias(f"_{i}") for i, c in enumerate(columns)])
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}.*")) for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*items)))


def profile_table(
    df: DataFrame, table: str, approximate: bool = False, fmt: str = "yyyy-MM-dd"
) -> DataFrame:
    """One row per column: type, NULLs and the statistics of its kind, with the table totals on each row.

    One scan counts the numbers and dates by digit, which gives their NULLs, moments and spans; the open
    digits of the quartiles, value counts and the duplicate count follow.
    """
    kinds = column_kinds(df)
    by_kind = {k: [c for c in df.columns if kinds[c] == k] for k in ("numeric", "date", "categorical")}
    is_text = {c: isinstance(df.schema[c].dataType, T.StringType) for c in by_kind["date"]}
    cells = [F.col(c) for c in by_kind["numeric"]]
    cells += [F.unix_micros(F.try_to_timestamp(c, F.lit(fmt)) if is_text[c] else F.col(c).cast("timestamp")) for c in by_kind["date"]]
    cells += [F.when(F.col(c).isNull(), 1) for c in by_kind["date"]] + [F.lit(1)]  # text that does not parse is no NULL
    counted = digits(df, cells, moments=True)
    n_numeric, n_date = len(by_kind["numeric"]), len(by_kind["date"])
    numeric = _numeric_stats(df, by_kind["numeric"], counted[:n_numeric], approximate)
    dates = dict(zip(by_kind["date"], counted[n_numeric : n_numeric + n_date], strict=True))
    total = counted[-1].rows
    nulls = {c: numeric[c][1] for c in numeric} | {c: d.n for c, d in zip(by_kind["date"], counted[n_numeric + n_date :])}

    def span(c: str) -> tuple | None:
        own = dates.get(c)
        if own is None:
            return None
        low, high = (None, None) if not own.n else (int(own.low), int(own.high))
        return own.n, own.rows - own.n, low, high, (high - low) // 86_400_000_000 if own.n else 0

    rows = [
        (table, total, len(df.columns), i, f.name, f.dataType.simpleString(), kinds[f.name], nulls.get(f.name), numeric.get(f.name), span(f.name))
        for i, f in enumerate(df.schema)
    ]
    profile = df.sparkSession.createDataFrame(
        rows,
        "table_name string, row_count bigint, column_count int, column_index int, column_name string, dtype string, "
        f"kind string, null_count bigint, numeric_stats struct<{NUMERIC_STATS}>, "
        "d struct<count bigint, missing bigint, low bigint, high bigint, date_range_days bigint>",
    )
    if by_kind["categorical"]:
        stats = profile_categorical(df, by_kind["categorical"])
        packed = stats.select("column_name", F.struct(*stats.columns[1:]).alias("categorical_stats"))
        profile = profile.join(F.broadcast(packed), "column_name", "left")  # one row per column
    else:
        profile = profile.withColumn("categorical_stats", F.lit(None).cast(f"struct<{CATEGORICAL_STATS}>"))

    def day(micros: str) -> Column:
        return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss")

    null_count = F.coalesce("null_count", "categorical_stats.missing", F.lit(0))
    return profile.withColumn("null_count", null_count).select(
        "table_name",
        "row_count",
        "column_count",
        "column_index",
        "column_name",
        "dtype",
        "kind",
        "null_count",
        (F.col("null_count") / total * 100 if total else F.lit(0.0)).alias("null_percentage"),
        "numeric_stats",
        F.when(F.col("d").isNotNull(), F.struct(
            "d.count", "d.missing", day("d.low").alias("min_date"), day("d.high").alias("max_date"), "d.date_range_days")).alias("date_stats"),
        duplicate_count(df).select("duplicate_count").scalar().alias("duplicate_rows"),
        "categorical_stats",
    )


def profile_summary(profile: DataFrame) -> DataFrame:
    return profile.select(
        "table_name",
        "column_name",
        "dtype",
        "null_count",
        percent_text(F.col("null_percentage")).alias("null_percentage"),
    )

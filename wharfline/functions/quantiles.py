"""Exact quantiles and moments of large columns without sorting or shuffling them.

A digit of a value is a whole number that never falls as the value grows: its sign and the first bits of its logarithm,
BINS to a doubling.  One scan counts all columns by digit, map-side first, with the least and greatest value
and the central moments of each digit; the result has as many rows as the columns have digits, whatever their length.
It says which digit holds a wanted rank, and settles every rank whose digit has one value only.
A second scan counts the distinct values of the digits that are still open, about a hundredth of a column each.  They
are written, split further where they are many, and the last few are sorted.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wharfline.session import cut

BINS = 128  # digits to a doubling: values of one digit differ by half a percent
ZERO = 1100 * BINS  # below the logarithm of the smallest number
ENDLESS = 1 << 29  # the digit of infinity; NaN, the greatest of all values, has the next one
FEW = 10_000  # distinct values that one task sorts in the end
SPLIT = 4096  # parts of equal width of an open digit with more


@dataclass
class Bin:
    """Values of one digit: how many, their range, and sums of powers of their distance from their mean."""

    n: int
    low: float
    high: float
    mean: float = 0.0
    s2: float = 0.0
    s3: float = 0.0
    s4: float = 0.0

    @property
    def single(self) -> bool:
        return self.low == self.high or math.isnan(self.low)


@dataclass
class ColumnDigits:
    """A column by digit, in the order of the values."""

    rows: int = 0  # NULLs included
    bins: list[Bin] = field(default_factory=list)

    @property
    def n(self) -> int:
        return sum(b.n for b in self.bins)

    @property
    def low(self) -> float | None:
        return self.bins[0].low if self.bins else None

    @property
    def high(self) -> float | None:
        return self.bins[-1].high if self.bins else None

    @property
    def least_distinct(self) -> int:
        """Distinct values, if ``exactly``; else a lower bound of them."""
        return sum(1 if b.single else 2 for b in self.bins)

    @property
    def exactly(self) -> bool:
        return all(b.single for b in self.bins)

    def moments(self) -> tuple[float | None, float, float, float]:
        """Mean, and sums of the second, third and fourth powers of the distances from it."""
        n = self.n
        if not n:
            return None, 0.0, 0.0, 0.0
        if self.low == self.high:
            return self.low, 0.0, 0.0, 0.0
        mean = math.fsum(b.n * b.mean for b in self.bins) / n if math.isfinite(self.low) and math.isfinite(self.high) else math.nan
        parts = [(b, b.mean - mean) for b in self.bins]
        return (
            mean,
            math.fsum(b.s2 + b.n * d * d for b, d in parts),
            math.fsum(b.s3 + 3 * d * b.s2 + b.n * d**3 for b, d in parts),
            math.fsum(b.s4 + 4 * d * b.s3 + 6 * d * d * b.s2 + b.n * d**4 for b, d in parts),
        )


def _digit(v: Column) -> Column:
    size = F.abs(v)
    place = F.when(size == math.inf, F.lit(ENDLESS)).otherwise(F.floor(F.log2(size) * BINS).cast("int") + ZERO)
    return F.when(F.isnan(v), F.lit(ENDLESS + 1)).when(v == 0, F.lit(0)).when(v < 0, -place).otherwise(place)


def _cells(df: DataFrame, values: Sequence[Column]) -> DataFrame:
    """``(c, v)``: one row per column and row."""
    return df.select(F.posexplode(F.array(*[v.cast("double") for v in values])).alias("c", "v"))


def digits(df: DataFrame, values: Sequence[Column | str], moments: bool = False) -> list[ColumnDigits]:
    """All ``values`` by digit, from one scan; with ``moments`` also their central moments."""
    out = [ColumnDigits() for _ in values]
    if not values:
        return out
    x = F.col("v")
    extra = [F.avg(x), F.var_pop(x), F.skewness(x), F.kurtosis(x)] if moments else []
    counted = (
        _cells(df, [F.col(v) if isinstance(v, str) else v for v in values])
        .groupBy("c", _digit(x).alias("d"))
        .agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"), *[e.alias(f"m{k}") for k, e in enumerate(extra)])
    )
    for r in sorted(counted.collect(), key=lambda r: (r["c"], r["d"] is None, r["d"])):
        own = out[r["c"]]
        own.rows += r["n"]
        if r["d"] is None:
            continue
        one = Bin(r["n"], r["low"], r["high"])
        if moments:
            one.mean = r["m0"]
            one.s2 = (r["m1"] or 0.0) * one.n
            if one.s2 > 0 and r["m2"] is not None:
                one.s3 = r["m2"] * math.sqrt(one.s2**3 / one.n)
                one.s4 = (r["m3"] + 3) * one.s2**2 / one.n
        while own.bins and own.bins[-1].high > one.low:  # a logarithm that fell where its value grew
            one = _joined(own.bins.pop(), one)
        own.bins.append(one)
    return out


def _joined(a: Bin, b: Bin) -> Bin:
    both = ColumnDigits(bins=[a, b])
    return Bin(a.n + b.n, min(a.low, b.low), max(a.high, b.high), *both.moments())


@dataclass
class _Open:
    """A stretch of values of one column that holds wanted ranks, as places in the stretch from 0."""

    column: int
    low: float
    high: float
    places: dict[int, tuple[int, int]]  # place in the stretch -> (column, rank) it settles


def _settle(bins: Sequence[Bin], column: int, wanted: dict[int, tuple[int, int]], known: dict[tuple[int, int], float]) -> list[_Open]:
    """Settle the wanted places that the ends of a bin answer, and return the stretches of the others."""
    ends = list(accumulate(b.n for b in bins))
    open_: dict[int, _Open] = {}
    for place, target in wanted.items():
        k = bisect.bisect_right(ends, place)
        b, inside = bins[k], place - (ends[k] - bins[k].n)
        if b.single or inside == 0:
            known[target] = b.low
        elif inside == b.n - 1:
            known[target] = b.high
        else:
            open_.setdefault(k, _Open(column, b.low, b.high, {})).places[inside] = target
    return list(open_.values())


def _stretches(stretches: Sequence[_Open], df: DataFrame) -> DataFrame:
    rows = [(k, s.column, s.low, s.high) for k, s in enumerate(stretches)]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "slot int, of int, low double, high double"))  # one row a wanted rank at most


def _sort(values: DataFrame, stretches: dict[int, _Open], known: dict[tuple[int, int], float]) -> None:
    """Settle the places of stretches of few values: sorted per stretch, only the wanted values leave the task."""
    if not stretches:
        return
    wanted = values.sparkSession.createDataFrame([(k, p) for k, s in stretches.items() for p in s.places], "slot int, place bigint")
    up_to = F.sum("n").over(W.partitionBy("slot").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    ranked = values.where(F.col("slot").isin(list(stretches))).withColumn("end", up_to)
    hit = ranked.join(F.broadcast(wanted), "slot").where((F.col("place") < F.col("end")) & (F.col("place") >= F.col("end") - F.col("n")))
    for r in hit.select("slot", "place", "v").collect():
        known[stretches[r["slot"]].places[r["place"]]] = r["v"]


def _search(df: DataFrame, values: Sequence[Column], stretches: list[_Open], known: dict[tuple[int, int], float], few: int) -> None:
    """Settle all open stretches: their distinct values are counted in one scan, then only those are read."""
    cells = _cells(df, values).join(_stretches(stretches, df), (F.col("of") == F.col("c")) & F.col("v").between(F.col("low"), F.col("high")))
    counted = cut(cells.groupBy("slot", "v").agg(F.count("*").alias("n")), "digits")
    while True:
        sizes = {r["slot"]: r["k"] for r in counted.groupBy("slot").agg(F.count("*").alias("k")).collect()}
        _sort(counted, {k: s for k, s in enumerate(stretches) if sizes[k] <= few}, known)
        wide = {k: s for k, s in enumerate(stretches) if sizes[k] > few}
        if not wide:
            return
        # split into parts of equal width: a monotone function of the value, whatever its rounding
        share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
        part = F.least(F.floor(share * SPLIT).cast("int"), F.lit(SPLIT - 1))
        own = counted.where(F.col("slot").isin(list(wide))).join(_stretches(stretches, df).drop("of"), "slot")
        parts = own.groupBy("slot", part.alias("part")).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        narrower: list[_Open] = []
        for k, s in wide.items():
            bins = [Bin(r["n"], r["low"], r["high"]) for r in sorted((r for r in parts if r["slot"] == k), key=lambda r: r["part"])]
            narrower += [_Open(k, x.low, x.high, x.places) for x in _settle(bins, k, s.places, known)]
        if not narrower:
            return
        inside = counted.withColumnRenamed("slot", "old").join(
            _stretches(narrower, df), (F.col("of") == F.col("old")) & F.col("v").between(F.col("low"), F.col("high")))
        counted, stretches = cut(inside.select("slot", "v", "n"), "digits"), narrower


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], counted: Sequence[ColumnDigits] | None = None, few: int = FEW
) -> tuple[dict[str, list[float | None]], list[ColumnDigits]]:
    """Linearly interpolated quantiles per column, NULLs ignored, and the columns by digit.

    ``counted``: the columns by digit, if they are known already.
    """
    values = [F.col(c).cast("double") for c in columns]
    counted = list(counted) if counted is not None else digits(df, values)
    probs = [float(p) for p in probs]
    known: dict[tuple[int, int], float] = {}
    stretches: list[_Open] = []
    for i, column in enumerate(counted):
        if column.n:
            ranks = {f((column.n - 1) * p) for p in probs for f in (math.floor, math.ceil)}
            stretches += _settle(column.bins, i, {r: (i, r) for r in ranks}, known)
    if stretches:
        _search(df, values, stretches, known, few)

    def quantile(i: int, n: int, p: float) -> float:
        place = (n - 1) * p
        low, high = known[(i, math.floor(place))], known[(i, math.ceil(place))]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {c: [quantile(i, counted[i].n, p) if counted[i].n else None for p in probs] for i, c in enumerate(columns)}, counted

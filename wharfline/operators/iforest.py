"""Isolation Forest (Liu, Ting and Zhou, ICDM 2008) for multivariate outliers."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wharfline.functions.quantiles import exact_quantiles
from wharfline.session import cut

NODE_SCHEMA = "tree int, node int, feature int, split double, child int, path double"


def _mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _grow(points: np.ndarray, rng: np.random.Generator) -> list[tuple[int, int, float, int, float]]:
    """``(node, feature, split, left child, path)``; the right child follows the left, leaves have feature -1."""
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: list[list] = [[0, -1, 0.0, -1, 0.0]]
    todo = [(0, points, 0)]
    while todo:
        node, at, depth = todo.pop()
        low, high = (at.min(axis=0), at.max(axis=0)) if len(at) else (np.empty(0), np.empty(0))
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(at) <= 1 or not len(varying):
            nodes[node][4] = depth + _mean_path(len(at))
            continue
        feature = int(rng.choice(varying))
        split = float(rng.uniform(low[feature], high[feature]))
        goes_left = at[:, feature] < split
        child = len(nodes)
        nodes[node][1:4] = [feature, split, child]
        nodes += [[child, -1, 0.0, -1, 0.0], [child + 1, -1, 0.0, -1, 0.0]]
        todo += [(child, at[goes_left], depth + 1), (child + 1, at[~goes_left], depth + 1)]
    return [tuple(n) for n in nodes]


def _sample(rows: DataFrame, key: Sequence[str], n: int, n_trees: int, psi: int, seed: int) -> DataFrame:
    """``(tree, features…)``: psi rows per tree, drawn by a hash of (key, tree, seed).

    The hash alone decides, so the draw does not depend on how the rows lie.  Each tree takes a row with the same small
    probability, which leaves a little over psi rows per tree (by six standard deviations); the psi smallest hashes of those are
    the sample.  The trees of a row are found by skips: the number of trees up to the next one that takes it is geometric, so
    one hash gives the first of them, which most rows of a large table do not have, and one more each of the next.
    """
    features = [c for c in rows.columns if c not in key]
    share = min(1.0, (psi + 6 * math.sqrt(psi) + 20) / n)

    def draw(tree: Column) -> Column:
        return F.xxhash64(F.lit(seed), tree, *key)

    def skip(after: Column | int) -> Column:
        """Trees that pass the row over, after the one numbered ``after``."""
        if share >= 1.0:
            return F.lit(0)
        even = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("skip"), F.lit(after) if isinstance(after, int) else after, *key), 11) + 0.5) * 2.0**-53
        return F.least(F.floor(F.log(even) / math.log1p(-share)), F.lit(n_trees)).cast("int")

    hits = rows.withColumn("tree", skip(-1)).where(F.col("tree") < n_trees)
    # the few rows that are left: their further trees, one after the other
    chain = F.aggregate(
        F.sequence(F.lit(2), F.lit(n_trees)), F.array("tree"),
        lambda seen, _: F.when(F.element_at(seen, -1) < n_trees, F.array_append(seen, F.element_at(seen, -1) + 1 + skip(F.element_at(seen, -1)))).otherwise(seen))
    drawn = hits.withColumn("tree", F.explode(chain)).where(F.col("tree") < n_trees) if n_trees > 1 else hits
    order = W.partitionBy("tree").orderBy(draw(F.col("tree")), *key, *features)
    return drawn.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= psi).select("tree", *features)


def isolation_forest(
    df: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    contamination: float = 0.1,
    n_trees: int = 100,
    max_samples: int = 256,
    seed: int = 42,
) -> DataFrame:
    """``key``, ``score`` and ``prediction`` (-1 outlier, 1 inlier) for each row without a NULL in ``columns``.

    Trees grow from small samples, one task per tree; the forest (at most
    n_trees * 2 * max_samples nodes) goes to every task, and each row is scored
    where it lies.  The same rows give the same scores, however they are partitioned;
    ``key`` should tell rows apart.
    """
    features = [f"_f{i}" for i in range(len(columns))]
    rows = df.select(*key, *[F.col(c).cast("double").alias(f) for c, f in zip(columns, features)])
    rows = rows.na.drop(subset=features)
    n = rows.count()
    if n == 0:
        return rows.select(*key, F.lit(0.0).alias("score"), F.lit(1).alias("prediction"))
    psi = min(max_samples, n)

    def grow(tree: pd.DataFrame) -> pd.DataFrame:
        number = int(tree["tree"].iloc[0])
        points = tree.sort_values(features)[features].to_numpy(float)
        nodes = _grow(points, np.random.default_rng([seed, number]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "child", "path"])
        out.insert(0, "tree", number)
        return out

    sample = _sample(rows, key, n, n_trees, psi, seed)
    forest = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    forest = forest.sort_values(["tree", "node"]).reset_index(drop=True)
    roots = forest.index[forest["node"] == 0].to_numpy()
    base = np.repeat(roots, np.diff([*roots, len(forest)]))
    feature = forest["feature"].to_numpy()
    shared = df.sparkSession.sparkContext.broadcast(
        {
            "roots": roots,
            "feature": np.maximum(feature, 0),
            # A leaf points to itself and never goes right, so all rows can take the same number of steps.
            "split": np.where(feature < 0, np.inf, forest["split"].to_numpy()),
            "child": np.where(feature < 0, forest.index.to_numpy(), forest["child"].to_numpy() + base),
            "path": forest["path"].to_numpy(),
            "steps": math.ceil(math.log2(max(psi, 2))) + 1,
            "norm": _mean_path(psi) or 1.0,
        }
    )

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        f = shared.value
        values = x.to_numpy(float)
        at = np.broadcast_to(f["roots"], (len(values), len(f["roots"]))).copy()
        line = np.arange(len(values))[:, None]
        for _ in range(f["steps"]):
            at = f["child"][at] + (values[line, f["feature"][at]] >= f["split"][at])
        return pd.Series(np.exp2(-f["path"][at].mean(axis=1) / f["norm"]))

    scored = cut(rows.select(*key, F.round(score(F.struct(*features)), 12).alias("score")), "scored")
    limit = exact_quantiles(scored, ["score"], [1.0 - contamination])[0]["score"][0]
    return scored.withColumn("prediction", F.when(F.col("score") > limit, -1).otherwise(1))

"""Trees on continuous features with candidate cuts that do not depend on the layout.

The learner draws its split candidates for a many-valued feature from a random
sample, so the tree changes with the seed and the partitioning. Here the cuts
are exact quantiles of every row, found before the fit: the learner sees bin
numbers, and its thresholds are mapped back to feature values afterwards.

A feature of at most ``max_bins`` values is cut halfway between neighbouring
values, as the learner does. Any other is cut at the values of rank
ceil(j * n / max_bins), j = 1 .. max_bins - 1; equal cuts fall together, and
the largest value is no cut. NULL and NaN have no rank.

The ranks are found by counting, not by sorting: a pass counts the rows in each
cell of a grid (per task first, so only the counts are shuffled), then the
cells that hold a wanted rank are divided again until each holds one value.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.model import fit_tree, load_model
from riskloom.operators.prepare import assemble
from riskloom.session import shared_path
from riskloom.specs import TreeParams

SEED_STEPS = 256  # cells of the first grid, at estimated quantiles
CELLS = 256  # parts a cell is divided into

Cuts = dict[str, list[float]]


def _number(feature: str) -> Column:
    return F.nanvl(F.col(feature).cast("double"), F.lit(None).cast("double"))


def quantile_cuts(df: DataFrame, features: list[str], max_bins: int = 32) -> Cuts:
    """Each feature's ascending cuts; a row is left of a cut when its value is at most the cut.

    The driver holds counts of at most ``max_bins`` x 256 cells a feature. An
    empty table or a constant feature has no cuts.
    """
    if max_bins < 2:
        raise ValueError("max_bins must be at least 2")
    numbers = df.select(*[_number(c).alias(f"f{i}") for i, c in enumerate(features)])
    steps = [k / SEED_STEPS for k in range(1, SEED_STEPS)]
    first = numbers.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.max(c).alias("top"),
                F.approx_count_distinct(c).alias("distinct"),
                F.percentile_approx(c, steps, 10_000).alias("grid"),
            ).alias(c)
            for c in numbers.columns
        ]
    ).first()
    cuts: dict[str, list[float]] = {c: [] for c in numbers.columns}
    filled = [c for c in numbers.columns if first[c]["n"]]
    # the estimate is within a few percent: twice the bins is a safe bound for a look at the values themselves
    few = [c for c in filled if first[c]["distinct"] <= 2 * max_bins]
    values: dict[str, list[float]] = {c: [] for c in few}
    if few:
        for row in _unpivoted(numbers, few).select("f", "v").distinct().collect():
            values[row["f"]].append(row["v"])
    for c in few:
        found = sorted(values[c])
        if len(found) <= max_bins:
            cuts[c] = [(a + b) / 2 for a, b in zip(found, found[1:])]
    many = [c for c in filled if len(values.get(c, ())) > max_bins or c not in values]
    wanted = {c: sorted({-(-j * first[c]["n"] // max_bins) for j in range(1, max_bins)}) for c in many}
    grids = {c: first[c]["grid"] for c in many}
    while grids:
        cells = _counts(numbers, grids)
        for c in list(grids):
            ends = list(accumulate(n for _, n, _, _ in cells[c]))
            hit = {bisect_left(ends, rank) for rank in wanted[c]}
            ranges = [cells[c][i][2:] for i in sorted(hit)]
            if any(low < high for low, high in ranges):
                grids[c] = [p for low, high in ranges for p in _divided(low, high)]
            else:
                cuts[c] = sorted({cells[c][i][2] for i in hit} - {first[c]["top"]})
                del grids[c]
    return {feature: cuts[c] for feature, c in zip(features, numbers.columns)}


def _divided(low: float, high: float) -> list[float]:
    # the largest value has a cell of its own, so every pass separates something
    inner = [low + (high / CELLS - low / CELLS) * k for k in range(1, CELLS)] if low < high else []
    return [low, *inner, high, math.nextafter(high, math.inf)]


def _unpivoted(numbers: DataFrame, names: list[str], cell: str = "") -> DataFrame:
    """One row (f, v, b) for each value that is not NULL; b is its cell where ``cell`` names their prefix."""
    rows = [F.struct(F.lit(c).alias("f"), F.col(c).alias("v"), (F.col(cell + c) if cell else F.lit(0.0)).alias("b")) for c in names]
    return numbers.select(F.inline(F.array(*rows))).where(F.col("v").isNotNull())


def _counts(numbers: DataFrame, grids: dict[str, list[float]]) -> dict[str, list[tuple[float, int, float, float]]]:
    """Per feature the filled cells in order: (cell, rows, smallest, largest value)."""
    names = list(grids)
    found = _bucketed(numbers.select(*names), names, [f"b_{c}" for c in names], [grids[c] for c in names])
    rows = _unpivoted(found, names, "b_").groupBy("f", "b").agg(F.count("v"), F.min("v"), F.max("v")).collect()
    cells: dict[str, list] = {c: [] for c in names}
    for f, b, n, low, high in sorted(tuple(r) for r in rows):
        cells[f].append((b, n, low, high))
    return cells


def _bucketed(df: DataFrame, names: list[str], outputs: list[str], starts: list[list[float]]) -> DataFrame:
    """Adds each column's number of ``starts`` that are at most its value."""
    inf = float("inf")
    # with one start given at least; infinities of the data stay in the outer cells
    splits = [[-inf, *sorted({p for p in (s or [0.0]) if -inf < p < inf} or {0.0}), inf] for s in starts]
    return Bucketizer(inputCols=names, outputCols=outputs, splitsArray=splits, handleInvalid="keep").transform(df)


def binned(df: DataFrame, cuts: Cuts, suffix: str = "_bin") -> DataFrame:
    """Adds a bin number for each feature: how many cuts are below its value (NULL and NaN: NULL)."""
    out = df
    for feature, found in cuts.items():
        starts = [math.nextafter(c, math.inf) for c in found]  # a value equal to a cut is left of it
        number = f"{feature}{suffix}"
        if starts:
            out = _bucketed(out.withColumn(number, _number(feature)), [number], [f"{number}_of"], [starts])
            out = out.withColumn(number, F.when(F.col(number).isNotNull(), F.col(f"{number}_of"))).drop(f"{number}_of")
        else:
            out = out.withColumn(number, F.when(_number(feature).isNotNull(), F.lit(0.0)))
    return out


def fit_quantile_tree(
    df: DataFrame,
    features: list[str],
    kind: str,
    label: str,
    params: TreeParams = TreeParams(),
    num_classes: int | None = None,
):
    """Fit a tree on exact quantile bins; the model returned takes the feature values themselves.

    The same rows give the same tree whatever their order and partitions. A
    bin of so few rows that the learner's sample of at least 10,000 rows misses
    it offers no cut: only a value held by about a bin's share of all rows, and
    so next to a shortened bin, can lead to one.
    """
    cuts = quantile_cuts(df.select(*features), features, params.max_bins)
    numbers = [f"{c}_bin" for c in features]
    bins = assemble(binned(df.select(*features, label), cuts), numbers, keep=[label])
    model = fit_tree(bins, kind, label, params, num_classes=num_classes)
    return _on_values(df, model, kind, [cuts[c] for c in features])


def _on_values(df: DataFrame, model, kind: str, cuts: list[list[float]]):
    """The fitted model with its thresholds on bin numbers replaced by the cuts they stand for.

    The saved form holds one row a node; the rows are written again with the
    other thresholds and loaded as a model (at most 2^depth rows).
    """
    if model.depth == 0:
        return model
    spark = df.sparkSession
    on_bins, on_values = shared_path(spark, "tree-bins"), shared_path(spark, "tree-values")
    model.save(on_bins)
    model.save(on_values)
    nodes = spark.read.parquet(f"{on_bins}/data")
    lists = F.array(*[F.array(*[F.lit(c) for c in found]).cast("array<double>") for found in cuts])
    at, feature = F.col("split.leftCategoriesOrThreshold"), F.col("split.featureIndex")
    value = F.get(F.get(lists, feature), F.floor(at[0]).cast("int"))
    changed = F.when(feature >= 0, F.array(value)).otherwise(at)  # a leaf names no feature
    nodes.withColumn("split", F.col("split").withField("leftCategoriesOrThreshold", changed)).write.mode("overwrite").parquet(f"{on_values}/data")
    return load_model(spark, on_values, kind)

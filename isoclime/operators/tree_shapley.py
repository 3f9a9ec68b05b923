"""Exact Shapley values of tree ensembles from the trees' own paths.

The explained output is the ensemble's margin (what its logistic function turns into a probability), and an absent
feature takes a background row's value. A leaf is reached by a mixture of a row and a background row if every feature
on its path lies within the path's bounds. So for one leaf only two facts count: which of its features the row keeps
within bounds (a bit mask), and which the background row does. The leaf then plays a game whose Shapley values are in
closed form: with a features that only the row satisfies and b that only the background row does,

    each of the a gets  value * (a - 1)! b! / (a + b)!,    each of the b gets  - value * a! (b - 1)! / (a + b)!

and nothing if some feature is satisfied by neither. Background rows of equal masks are counted together, so any
number of them may stand in the background, and a table with a row for each leaf and mask holds all there is to know.
Rows look up their masks there; everything is built-in expressions, and only leaves and masks are broadcast (their
number is the model's, never the data's).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAVES = "leaf int, value double, path array<struct<f: int, low: double, high: double>>"


def leaves(model: PipelineModel) -> list[tuple[int, float, list[tuple[int, float, float]]]]:
    """(number, weighted value, bounds low < x <= high of each feature on the path) of every leaf of a fitted ensemble."""
    ensemble, out = model.stages[-1], []
    inf = float("inf")

    def walk(node, bounds: dict[int, tuple[float, float]]) -> Iterator[tuple[float, dict]]:
        if node.subtreeDepth() == 0:
            yield node.prediction(), bounds
            return
        f, cut = node.split().featureIndex(), node.split().threshold()
        low, high = bounds.get(f, (-inf, inf))
        yield from walk(node.leftChild(), bounds | {f: (low, min(high, cut))})
        yield from walk(node.rightChild(), bounds | {f: (max(low, cut), high)})

    for tree, weight in zip(ensemble.trees, ensemble.treeWeights, strict=True):
        for value, bounds in walk(tree._java_obj.rootNode(), {}):
            out.append((len(out), float(value * weight), [(f, *b) for f, b in sorted(bounds.items())]))
    return out


def _bounds(tree: DataFrame, most: int) -> DataFrame:
    """The leaves with a column for each bound of their paths, so that masks are plain comparisons."""
    step = lambda i: F.get("path", F.lit(i))
    return tree.select("leaf", *(step(i)[c].alias(f"{c}{i}") for i in range(most) for c in ("f", "low", "high")))


def _mask(most: int) -> Column:
    """The bits of the path's features that lie within their bounds."""
    out = F.lit(0)
    for i in range(most):
        x = F.get("_x", F.col(f"f{i}"))
        out = out + F.when((x > F.col(f"low{i}")) & (x <= F.col(f"high{i}")), 1 << i).otherwise(0)
    return out


def _inputs(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` plus ``_x``: the features as the trees see them (missing ones filled in as in training)."""
    filled = model.stages[0].transform(df.withColumns({c: F.col(c).cast("double") for c in features}))
    return filled.select(*df.columns, F.array(*(F.col(f"{c}_filled") for c in features)).alias("_x"))


def leaf_masks(df: DataFrame, tree: DataFrame, n_leaves: int, most: int) -> DataFrame:
    """Every row with every leaf's number and the row's mask there; the leaves are bounded by the model and broadcast."""
    every = df.withColumn("leaf", F.explode(F.sequence(F.lit(0), F.lit(n_leaves - 1))))
    return every.join(F.broadcast(_bounds(tree, most)), "leaf").withColumn("mask", _mask(most)).select(*df.columns, "leaf", "mask")


def contributions(tree: DataFrame, background: DataFrame) -> DataFrame:
    """(leaf, mask, phi: array of (f, phi)): what a row with this mask gains from the leaf, on average over the background.

    ``background``: leaf, back (mask), share. Masks whose gains are all zero are left out.
    """
    grid = tree.join(background, "leaf").withColumn("n", F.size("path")).filter("n > 0")
    grid = grid.withColumn("mask", F.explode(F.expr("sequence(0, shiftleft(1, n) - 1)"))).filter("(mask | back) = shiftleft(1, n) - 1")
    grid = grid.withColumns({"a": F.expr("cast(bit_count(mask & ~back) as int)"), "b": F.expr("cast(bit_count(back & ~mask) as int)")})
    of = grid.select("leaf", "mask", "back", "value", "share", "a", "b", F.posexplode("path").alias("i", "c"))
    mine, theirs = F.expr("(shiftright(mask & ~back, i) & 1) = 1"), F.expr("(shiftright(back & ~mask, i) & 1) = 1")
    both = F.factorial(F.col("a") + F.col("b"))
    gain = F.when(mine, F.factorial(F.greatest(F.col("a") - 1, F.lit(0))) * F.factorial("b") / both).when(theirs, -F.factorial("a") * F.factorial(F.greatest(F.col("b") - 1, F.lit(0))) / both)
    each = of.withColumn("gain", gain).filter("gain IS NOT NULL").groupBy("leaf", "mask", F.col("c.f").alias("f")).agg(F.sum(F.col("value") * F.col("gain") * F.col("share")).alias("phi"))
    return each.groupBy("leaf", "mask").agg(F.collect_list(F.struct("f", "phi")).alias("phi"))


def tree_shapley(model: PipelineModel, rows: DataFrame, background: DataFrame, features: Sequence[str], keys: Sequence[str] = ("city_id", "obs_date")) -> DataFrame:
    """(keys, feature, phi) for every row and every feature of the ensemble that is the last stage of ``model``.

    Exact: the values of a row sum to its margin minus the mean margin of ``background``, over all of whose rows
    absent features are averaged. ``keys`` tell rows apart. Features that the trees don't use get 0. Trees may have at
    most 20 features on a path.
    """
    spark, made = rows.sparkSession, leaves(model)
    most = max(len(path) for _, _, path in made)
    if most > 20:
        raise ValueError("a path with more than 20 features")
    tree = spark.createDataFrame(made, LEAVES)
    back = leaf_masks(_inputs(model, background, features).select("_x"), tree, len(made), most).groupBy("leaf", F.col("mask").alias("back")).agg(F.count("*").alias("n"))
    shares = back.join(back.groupBy("leaf").agg(F.sum("n").alias("all")), "leaf").select("leaf", "back", (F.col("n") / F.col("all")).alias("share"))
    gains = contributions(tree, shares)
    seen = leaf_masks(_inputs(model, rows, features).select(*keys, "_x"), tree, len(made), most).select(*keys, "leaf", "mask")
    each = seen.join(F.broadcast(gains), ["leaf", "mask"]).select(*keys, F.inline("phi"))
    sums = each.groupBy(*keys, "f").agg(F.sum("phi").alias("phi"))
    names = F.array(*(F.struct(F.lit(i).alias("f"), F.lit(c).alias("feature")) for i, c in enumerate(features)))
    every = rows.select(*keys, F.inline(names))
    return every.join(sums, [*keys, "f"], "left").select(*keys, "feature", F.coalesce("phi", F.lit(0.0)).alias("phi"))


def margin(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` plus margin, the ensemble's weighted sum of leaves."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in features})
    out = model.transform(typed).withColumn("margin", vector_to_array("rawPrediction")[1])
    return out.select(*df.columns, "margin")

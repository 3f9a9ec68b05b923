"""Baselines and metrics of a binary risk score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import days
from .running import running


def persistence_baseline(df: DataFrame, width: int = 7) -> DataFrame:
    """score 1 if any of t-width+1..t was an anomaly, else 0."""
    hit = F.max(F.coalesce(F.col("is_anomaly").cast("int"), F.lit(0))).over(days(-width + 1, 0))
    return df.withColumn("score", hit.cast("double"))


def climatology_baseline(train: DataFrame, df: DataFrame, label: str = "label", day: str = "obs_date") -> DataFrame:
    """score: the training rate of the city's week of year, else of the city, else of all; no other split is looked at."""
    week = F.weekofyear(day)
    known = train.filter(F.col(label).isNotNull())
    by_week = known.groupBy("city_id", week.alias("_week")).agg(F.avg(label).alias("_by_week"))
    by_city = known.groupBy("city_id").agg(F.avg(label).alias("_by_city"))
    overall = known.agg(F.avg(label).alias("_overall"))
    out = df.withColumn("_week", week).join(by_week, ["city_id", "_week"], "left").join(by_city, "city_id", "left")
    out = out.join(F.broadcast(overall))  # one row
    return out.withColumn("score", F.coalesce("_by_week", "_by_city", "_overall")).drop("_week", "_by_week", "_by_city", "_overall")


def threshold_table(df: DataFrame, score: str = "score", label: str = "label", bins: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score s (and group of ``by``): rows and positives at s, cumulated over scores >= s (all, tp), and the total positives.

    Rows are grouped by score before anything is ordered; the running sums are taken range by range, so the
    number of distinct scores may be as large as the table. ``bins`` floors scores to that many steps.
    """
    s = F.col(score) if bins is None else F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)) / bins
    per = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(*by, s.alias("s"))
    per = per.agg(F.count("*").alias("n"), F.sum(label).cast("long").alias("pos"))
    cumulated = running(per, [F.desc("s")], {"all": "n", "tp": "pos"}, by)
    whole = F.broadcast(cumulated.groupBy(*by).agg(F.max("tp").alias("positives")))  # one row a group
    return cumulated.join(whole, list(by)) if by else cumulated.join(whole)


def pr_auc(df: DataFrame, score: str = "score", label: str = "label", bins: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row (a group of ``by``): average precision (ties taken together) and the trapezoid under the same points from recall 0 on."""
    t = threshold_table(df, score, label, bins, by)
    precision, recall = F.col("tp") / F.col("all"), F.try_divide(F.col("tp"), F.col("positives"))
    above_all, above_tp = F.col("all") - F.col("n"), F.col("tp") - F.col("pos")
    p0 = F.coalesce(F.try_divide(above_tp, above_all), F.lit(1.0))
    r0 = F.coalesce(F.try_divide(above_tp, F.col("positives")), F.lit(0.0))
    return t.groupBy(*by).agg(
        F.sum(F.try_divide(F.col("pos"), F.col("positives")) * precision).alias("average_precision"),
        F.sum((recall - r0) * (precision + p0) / 2).alias("trapezoid"),
    )


def confusion(df: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn at score >= threshold, of rows with a label."""
    called, true = F.col(score) >= threshold, F.col(label) == 1
    counts = {"tp": called & true, "fp": called & ~true, "fn": ~called & true, "tn": ~called & ~true}
    return df.filter(F.col(label).isNotNull()).groupBy(*by).agg(*(F.count_if(c).alias(n) for n, c in counts.items()))


def f1_at(df: DataFrame, threshold: float = 0.5, score: str = "score", label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    c = confusion(df, threshold, score, label, by)
    f1 = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return c.select(*by, F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"), f1.alias("f1"))


def best_threshold(df: DataFrame, score: str = "score", label: str = "label", bins: int | None = None) -> DataFrame:
    """The score with the greatest F1 (the highest such) as threshold, and that F1."""
    f1 = 2 * F.col("tp") / (F.col("all") + F.col("positives"))
    t = threshold_table(df, score, label, bins).select("s", f1.alias("f1"))
    return t.agg(F.max(F.struct("f1", F.col("s").alias("threshold"))).alias("b")).select("b.threshold", "b.f1")


def brier(df: DataFrame, score: str = "score", label: str = "label", reference: str | None = None) -> DataFrame:
    """Mean squared error of the probability, and its skill against a reference score if one is given."""
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    error = lambda c: F.avg((F.col(c) - F.col(label)) ** 2)
    out = known.agg(error(score).alias("brier"), *([error(reference).alias("reference")] if reference else []))
    return out.withColumn("skill", 1 - F.try_divide("brier", "reference")) if reference else out


def calibration_curve(df: DataFrame, bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """bin, n, mean score and observed rate."""
    known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return known.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("observed"))


def calibration_error(curve: DataFrame) -> DataFrame:
    """Expected calibration error of a curve."""
    return curve.agg((F.sum(F.col("n") * F.abs(F.col("mean_score") - F.col("observed"))) / F.sum("n")).alias("ece"))


def prior_correction(p: Column, weight: Column | float) -> Column:
    """Undo a positive-class weight in a probability: p / (p + w (1 - p))."""
    return F.try_divide(p, p + F.lit(weight) * (1 - p) if isinstance(weight, (int, float)) else p + weight * (1 - p))


def compare_models(predictions: dict[str, DataFrame], threshold: float = 0.5, score: str = "score", label: str = "label") -> DataFrame:
    """model, split, metric, value: average precision, F1 at the threshold, Brier score. Good and bad results alike."""
    out = None
    for name, df in predictions.items():
        known = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        ap = pr_auc(known, score, label, by=["split"]).select("split", "average_precision")
        f1 = f1_at(known, threshold, score, label, ["split"]).select("split", "f1")
        error = known.groupBy("split").agg(F.avg((F.col(score) - F.col(label)) ** 2).alias("brier"))
        wide = ap.join(f1, "split").join(error, "split").withColumn("model", F.lit(name))
        long = wide.unpivot(["model", "split"], ["average_precision", "f1", "brier"], "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out


def beats_baselines(metrics: DataFrame, model: str, split: str = "test") -> DataFrame:
    """One row: the model's average precision on the split, the best other one, and the verdict."""
    rows = metrics.filter((F.col("metric") == "average_precision") & (F.col("split") == split))
    mine, others = F.max(F.when(F.col("model") == model, F.col("value"))), F.max(F.when(F.col("model") != model, F.col("value")))
    return rows.agg(mine.alias("value"), others.alias("best_other")).withColumn("beats", F.col("value") > F.col("best_other"))


def drift(reference: DataFrame, current: DataFrame, edges: dict[str, Sequence[float]]) -> DataFrame:
    """Population stability index per feature over fixed inner edges; an empty bucket counts as half a row, nulls are a bucket."""

    def shares(df: DataFrame, name: str) -> DataFrame:
        buckets = [sum((F.when(F.col(c) >= e, 1).otherwise(0) for e in cuts), F.lit(0)).cast("int") for c, cuts in edges.items()]
        wide = df.select(*(F.when(F.col(c).isNull(), -1).otherwise(b).alias(c) for c, b in zip(edges, buckets, strict=True)))
        return wide.unpivot([], list(edges), "feature", "bucket").groupBy("feature", "bucket").agg(F.count("*").alias(name))

    both = shares(reference, "a").join(shares(current, "b"), ["feature", "bucket"], "full_outer").na.fill(0, ["a", "b"])
    whole = Window.partitionBy("feature")
    p = F.greatest("a", F.lit(0.5)) / F.sum("a").over(whole)
    q = F.greatest("b", F.lit(0.5)) / F.sum("b").over(whole)
    rows = both.select("feature", p.alias("p"), q.alias("q"))
    return rows.groupBy("feature").agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"))


SKETCH_K = 4096


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("year",), k: int = SKETCH_K) -> DataFrame:
    """feature, ``by``, n, nulls, sketch: a mergeable quantile sketch (KLL) of each column in each group.

    Store it beside the rows: drift between any two sets of groups is then read from sketches alone. Ranks are exact up
    to ``k`` values in what is merged, beyond that within about 1.8 / k of all values.
    """
    long = df.select(*by, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(list(by), list(columns), "feature", "_x")
    return long.groupBy("feature", *by).agg(F.count("_x").alias("n"), F.count_if(F.col("_x").isNull()).alias("nulls"), F.kll_sketch_agg_double("_x", F.lit(k)).alias("sketch"))


def merged(parts: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One sketch a feature; no observation is read."""
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_edges(whole: DataFrame, buckets: int) -> DataFrame:
    """feature, edges: the inner bucket edges, ascending and distinct; none for a feature without values."""
    ranks = F.array(*(F.lit(i / buckets) for i in range(1, buckets)))
    edges = F.when(F.col("n") > 0, F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", ranks)))).otherwise(F.array().cast("array<double>"))
    return whole.select("feature", edges.alias("edges"))


def sketch_drift(reference: DataFrame, current: DataFrame, buckets: int = 8, k: int = SKETCH_K) -> DataFrame:
    """feature, psi: population stability index between two sets of ``sketches`` rows, over the reference's quantiles.

    A value lies in the bucket up to and with its edge; nulls are a bucket, an empty bucket counts as half a row, as in
    ``drift``. Features that only one side has are left out. The driver sees the edges only, ``buckets`` - 1 a feature
    (ranks can be asked of a sketch for literal values alone).
    """
    a, b = merged(reference, k), merged(current, k)
    edges = {r["feature"]: r["edges"] for r in sketch_edges(a, buckets).collect()}
    zero = F.lit(0).cast("long")

    def counts(df: DataFrame, name: str) -> DataFrame:
        upto = F.array().cast("array<bigint>")
        for feature, cuts in edges.items():
            if cuts:
                ranks = F.kll_sketch_get_rank_double("sketch", F.array(*map(F.lit, cuts)))
                known = F.when(F.col("n") > 0, F.transform(ranks, lambda r: F.round(r * F.col("n")).cast("long"))).otherwise(F.array_repeat(zero, len(cuts)))
                upto = F.when(F.col("feature") == feature, known).otherwise(upto)
        rows = df.select("feature", "n", "nulls", upto.alias("upto"))
        steps = F.zip_with(F.concat("upto", F.array("n")), F.concat(F.array(zero), "upto"), lambda x, y: x - y)
        return rows.select("feature", F.concat(steps, F.array("nulls")).alias(name))

    both = counts(a, "a").join(counts(b, "b"), "feature")
    whole = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    rows = both.select("feature", whole("a").alias("n_a"), whole("b").alias("n_b"), F.inline(F.arrays_zip("a", "b"))).filter("a > 0 OR b > 0")
    p, q = F.greatest("a", F.lit(0.5)) / F.col("n_a"), F.greatest("b", F.lit(0.5)) / F.col("n_b")
    return rows.groupBy("feature").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))

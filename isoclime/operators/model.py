"""The classifier: training, prediction, importance, versioned artefacts, on Spark ML."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cleaning import dedup_latest
from .evaluation import pr_auc
from .features import FEATURES, LEAD_DAYS
from .running import running

PARTITIONS, SEED = 8, 42


def train(df: DataFrame, features: Sequence[str] = FEATURES, weight: float | None = None, seed: int = SEED, partitions: int = PARTITIONS, max_iter: int = 20, depth: int = 4) -> PipelineModel:
    """Gradient-boosted trees with a positive-class weight (default: negatives per positive).

    Rows are dealt and sorted by key first: the same seed and ``partitions`` give the same model again;
    another number of partitions gives another model, so it belongs in the artefact's record.
    """
    rows = df.filter("label IS NOT NULL").select("city_id", "obs_date", F.col("label").cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in features))
    if weight is None:
        n = rows.agg(F.sum("label"), F.count("*")).first()
        weight = (n[1] - n[0]) / n[0] if n[0] else 1.0
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, float(weight)).otherwise(1.0))
    rows = rows.repartition(partitions, "city_id", "obs_date").sortWithinPartitions("city_id", "obs_date")
    filled = [f"{c}_filled" for c in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="features"),
        GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", seed=seed, maxIter=max_iter, maxDepth=depth),
    ]
    return Pipeline(stages=stages).fit(rows)


def scored(model: PipelineModel, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``df`` with the probability of the positive class as score."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in features})
    out = model.transform(typed).withColumn("score", vector_to_array("probability")[1])
    return out.select(*df.columns, "score")


def predict(model: PipelineModel, df: DataFrame, version: str, scored_at: str, threshold: float = 0.5, features: Sequence[str] = FEATURES, lead: int = LEAD_DAYS) -> DataFrame:
    """fact_ml_predictions: forecast_date t covers t+1..t+lead."""
    out = scored(model, df, features)
    return out.select(
        "city_id", F.col("obs_date").alias("forecast_date"), F.col("score").alias("risk_score"), (F.col("score") >= threshold).cast("int").alias("label"),
        F.lit(version).alias("model_version"), F.lit(scored_at).cast("timestamp").alias("scored_at"), F.lit(lead).alias("lead_days"),
    )


def upsert_predictions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """One prediction a city and forecast date: the newest scored_at, then the greater version."""
    return dedup_latest(existing.unionByName(new), ["city_id", "forecast_date"], ["scored_at"], ["model_version", "risk_score"])


def store_predictions(new: DataFrame, path: str) -> None:
    """Upsert into the stored fact table, a folder a forecast date: only the dates of ``new`` are read, merged and replaced.

    Running it again, with the same or fewer rows, changes no row. The merged dates are first written out as a whole
    (``<path>-pending``) and then replaced from there; a run that ends in between leaves that folder, and the next one
    replaces from it before anything else, so no date is lost half-way. One writer at a time.
    """
    spark = new.sparkSession
    pending, conf = f"{path.rstrip('/')}-pending", spark._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)

    def replace() -> None:
        done = spark.read.parquet(pending)
        done.repartition("forecast_date").write.partitionBy("forecast_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        fs.delete(at(pending), True)

    if fs.exists(at(f"{pending}/_SUCCESS")):
        replace()
    fs.delete(at(pending), True)
    dates = [r[0] for r in new.select("forecast_date").distinct().collect()]  # days of a calendar
    if not dates:
        return
    merged = upsert_predictions(stored_predictions(spark, path, new, dates), new) if fs.exists(at(path)) else upsert_predictions(new.limit(0), new)
    merged.write.parquet(pending)
    replace()


def stored_predictions(spark: SparkSession, path: str, like: DataFrame, dates: Sequence | None = None) -> DataFrame:
    """The stored fact table, of some forecast dates if given: other dates' folders are not opened."""
    rows = spark.read.schema(like.schema).parquet(path).select(*like.columns)
    return rows if dates is None else rows.filter(F.col("forecast_date").isin(list(dates)))


def save_model(model: PipelineModel, path: str, meta: dict) -> None:
    """The artefact, and beside it a one-row JSON record (training window, features, metrics, seed, partitions)."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    meta = SparkSession.active().read.text(f"{path}/meta").first()[0]
    return PipelineModel.load(f"{path}/model"), json.loads(meta)


def mean_importance(phi: DataFrame) -> DataFrame:
    """feature, mean absolute Shapley value."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))


def permutation_importance(model: PipelineModel, df: DataFrame, columns: Sequence[str], features: Sequence[str] = FEATURES, seed: int = SEED) -> DataFrame:
    """feature, drop in average precision when its values change places among all rows.

    Rows are numbered range by range, and all features are moved, scored and measured in the same jobs.
    """
    base = df.filter("label IS NOT NULL").withColumn("_one", F.lit(1))
    base = running(base, [F.col("city_id"), F.col("obs_date")], {"_i": "_one"})
    known = pr_auc(scored(model, base, features)).select(F.col("average_precision").alias("_known"))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in columns)))
    long = base.select("_i", "_one", cells.alias("_c")).select("_i", "_one", "_c.feature", "_c._v")
    spot = F.xxhash64(F.lit(seed), "feature", "_i")
    moved = running(long, [spot, F.col("_i")], {"_j": "_one"}, ["feature"]).select("feature", F.col("_j").alias("_i"), "_v")
    mixed = base.join(moved, "_i").withColumns({c: F.when(F.col("feature") == c, F.col("_v")).otherwise(F.col(c)) for c in columns})
    after = pr_auc(scored(model, mixed, features), by=["feature"])
    return after.join(F.broadcast(known)).select("feature", (F.col("_known") - F.col("average_precision")).alias("importance"))  # known: one row

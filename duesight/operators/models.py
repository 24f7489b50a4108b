"""Mean and interval models.

The point estimate is a gradient-boosted regressor (``mean_boost``). Spark ML has no quantile loss, so the
interval comes from the training outcomes that share a regression-tree leaf with a row: their
10 % and 90 % quantiles (the idea behind quantile regression forests, Meinshausen 2006).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import sample_order
from ..params import ModelParams
from ..schemas import FEATURE_CATEGORY, FEATURE_COLS
from ..session import materialize
from .decision import order_interval
from .features import encode
from .history import fill_history
from .mean_boost import BoostedMean, fit_boosted_mean
from .ordering import rank_rows

LABEL = "days_late"
VECTOR = "features"


def assemble(df: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=VECTOR).transform(df)


def fit_mean(train: DataFrame, p: ModelParams = ModelParams(), columns: list[str] = FEATURE_COLS) -> BoostedMean:
    return fit_boosted_mean(train, p, columns)


@dataclass
class IntervalModel:
    """A tree that assigns leaves, and the outcome quantiles of each leaf."""

    tree: PipelineModel
    leaves: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        # At most 2^depth leaves.
        return (
            self.tree.transform(df)
            .join(F.broadcast(self.leaves), "leaf", "left")
            .drop("leaf", VECTOR, "_tree_mean")
        )


def fit_interval(
    train: DataFrame, p: ModelParams = ModelParams(), columns: list[str] = FEATURE_COLS
) -> IntervalModel:
    tree = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol=VECTOR),
            DecisionTreeRegressor(
                featuresCol=VECTOR,
                labelCol=LABEL,
                predictionCol="_tree_mean",
                leafCol="leaf",
                maxDepth=p.depth,
                minInstancesPerNode=20,
                seed=p.seed,
            ),
        ]
    ).fit(train)
    # Outcomes are whole days: few distinct values per leaf, so exact percentiles stay small.
    cuts = F.percentile(LABEL, F.array(F.lit(p.lower_quantile), F.lit(p.upper_quantile)))
    leaves = (
        tree.transform(train)
        .groupBy("leaf")
        .agg(cuts.alias("c"))
        .select("leaf", F.col("c")[0].alias("days_late_lower"), F.col("c")[1].alias("days_late_upper"))
    )
    # Stored: at most 2^depth rows that every prediction reads, instead of the training matrix.
    return IntervalModel(tree, materialize(leaves, "leaves"))


@dataclass
class LatenessModel:
    """Mean, interval, encoders and cold-start values behind one ``predict``.

    Callers pass raw categories; the mapping fitted in training is applied inside.
    """

    mean: BoostedMean
    interval: IntervalModel
    encoders: DataFrame
    defaults: dict

    def predict(self, rows: DataFrame) -> DataFrame:
        coded = encode(fill_history(rows, self.defaults), self.encoders)
        scored = self.interval.transform(self.mean.transform(coded))
        return order_interval(scored)

    def save(self, path: str) -> None:
        self.mean.save(self.encoders.sparkSession, f"{path}/mean")
        self.interval.tree.write().overwrite().save(f"{path}/tree")
        self.interval.leaves.write.mode("overwrite").parquet(f"{path}/leaves")
        self.encoders.write.mode("overwrite").parquet(f"{path}/encoders")
        spark = self.encoders.sparkSession
        spark.createDataFrame([self.defaults]).write.mode("overwrite").parquet(f"{path}/defaults")

    @staticmethod
    def load(spark, path: str) -> LatenessModel:
        return LatenessModel(
            BoostedMean.load(spark, f"{path}/mean"),
            IntervalModel(PipelineModel.load(f"{path}/tree"), spark.read.parquet(f"{path}/leaves")),
            spark.read.parquet(f"{path}/encoders"),
            spark.read.parquet(f"{path}/defaults").first().asDict(),
        )


def fit_bundle(
    train_features: DataFrame, encoders: DataFrame, defaults: dict, p: ModelParams = ModelParams()
) -> LatenessModel:
    """Fit mean and interval on an encoded training matrix."""
    return LatenessModel(
        fit_mean(train_features, p), fit_interval(train_features, p), encoders, defaults
    )


def importances(model: BoostedMean, columns: list[str] = FEATURE_COLS) -> DataFrame:
    """Impurity importance per feature with its category (13 rows)."""
    from pyspark.sql import SparkSession

    values = model.importances()
    rows = [(c, FEATURE_CATEGORY[c], float(values[i])) for i, c in enumerate(columns)]
    return SparkSession.active().createDataFrame(rows, "feature string, category string, importance double")


def importance_rollup(per_feature: DataFrame) -> DataFrame:
    """Importance per feature category."""
    return per_feature.groupBy("category").agg(
        F.count(F.lit(1)).alias("features"), F.sum("importance").alias("importance")
    )


def permutation_importance(
    model: BoostedMean,
    test: DataFrame,
    repeats: int = 5,
    columns: list[str] = FEATURE_COLS,
    seed: int = 42,
) -> DataFrame:
    """Mean increase of the absolute error when one feature is taken from another row.

    Rows are put in a random order and each is paired with the row a fixed distance away, which
    is a permutation. Rows are sent about as the bytes of their bins, and all (repeat, feature)
    variants of a pair are scored where it is, in one pass.
    """
    rows = test.select("invoice_id", F.col(LABEL).cast("double").alias("y"), model.cells().alias("own"))
    ranked = rank_rows(rows, [sample_order("invoice_id", seed), F.col("invoice_id")], "_pos")
    n = ranked.count()
    base = ranked.select((F.col("_pos") - 1).alias("_pos"), "y", "own")
    # Each row is sent to the positions it is paired with: one equi-join for all repeats.
    shifts = [max(1, (r + 1) * n // (repeats + 1)) for r in range(repeats)]
    partners = base.select(
        F.explode(F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(s).alias("shift")) for r, s in enumerate(shifts)])).alias("r"),
        "_pos",
        F.col("own").alias("other"),
    ).select(F.pmod(F.col("_pos") + F.col("r.shift"), F.lit(n)).alias("_pos"), "r.repeat", "other")
    errors = model.swapped_errors(base.join(partners, "_pos"), columns).filter("n > 0")
    errors = errors.select("repeat", F.coalesce("feature", F.lit("_none")).alias("feature"), (F.col("error") / F.col("n")).alias("mae"))
    # repeats * (features + 1) rows from here on.
    per_repeat = Window.partitionBy("repeat")
    base_mae = F.max(F.when(F.col("feature") == "_none", F.col("mae"))).over(per_repeat)
    return (
        errors.withColumn("increase", F.col("mae") - base_mae)
        .filter("feature <> '_none'")
        .groupBy("feature")
        .agg(F.avg("increase").alias("mae_increase"), F.stddev("increase").alias("std"))
    )


def run_record(
    run_id: str, version: str, params: dict, defaults: dict, cutoff: str, metrics: DataFrame, champion: bool
) -> DataFrame:
    """One row describing a fitted model, for the append-only ``model_runs`` table."""
    as_map = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in (kv[0], str(kv[1]))])
    names = metrics.columns
    measured = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("double"))])
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(version).alias("model_version"),
        as_map(params).alias("params"),
        as_map({f"default_{k}": v for k, v in defaults.items()}).alias("defaults"),
        F.lit(cutoff).cast("date").alias("cutoff_date"),
        measured.alias("metrics"),
        F.lit(champion).alias("champion"),
        F.current_timestamp().alias("created_at"),
    )


def champion(runs: DataFrame) -> DataFrame:
    """Latest run flagged as champion (one row)."""
    return runs.filter("champion").orderBy(F.col("created_at").desc(), F.col("run_id")).limit(1)

"""The pair classifier, its calibration, and what is mined with it (Spark ML)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.features import FEATURES
from kinfold.operators.graph import hashed


#: Trees, their step and records a leaf at least, and trees of the models out of fold.
TREES, STEP, LEAF, FOLD_TREES = 600, 0.05, 80, 250


def require_both(rows: DataFrame, label: str = "y") -> None:
    if rows.select(label).distinct().count() < 2:
        raise ValueError("both classes are needed")


def train_model(rows: DataFrame, stop: DataFrame | None, trees: int = TREES, features: list[str] = FEATURES, step: float = STEP, leaf: int = LEAF) -> PipelineModel:
    """Boosted trees on (features..., y); the loss on ``stop``, if given, ends the boosting."""
    require_both(rows)
    part = lambda df, held: df.select(*features, F.col("y").cast("double").alias("y"), F.lit(held).alias("held"))
    both = part(rows, False) if stop is None else part(rows, False).unionByName(part(stop, True))
    assembler = VectorAssembler(inputCols=features, outputCol="x")
    maker = GBTClassifier(featuresCol="x", labelCol="y", maxIter=trees, stepSize=step, maxDepth=5, maxBins=127, minInstancesPerNode=leaf, featureSubsetStrategy="0.9", seed=42)
    if stop is not None:
        maker = maker.setValidationIndicatorCol("held").setParams(validationTol=0.001)
    return PipelineModel([assembler, maker.fit(assembler.transform(both))])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with the probability ``p`` of a match."""
    done = model.transform(rows).withColumn("p", F.get(vector_to_array("probability"), 1))
    return done.select(*[c for c in rows.columns if c != "p"], "p")


def logit(p: Column) -> Column:
    cut = lambda x: F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(cut(p) / cut(1 - p))


class Calibrator:
    """'platt' (a logistic curve of the logit) or 'isotonic' (a rising step curve, clipped)."""

    def __init__(self, kind: str):
        if kind not in ("platt", "isotonic"):
            raise ValueError(kind)
        self.kind = kind

    def _assembled(self, rows: DataFrame) -> DataFrame:
        at = logit(F.col("p")) if self.kind == "platt" else F.col("p")
        return VectorAssembler(inputCols=["at"], outputCol="x").transform(rows.withColumn("at", at))

    def fit(self, rows: DataFrame) -> Calibrator:
        require_both(rows)
        ready = self._assembled(rows.withColumn("y", F.col("y").cast("double")))
        if self.kind == "platt":
            maker = LogisticRegression(featuresCol="x", labelCol="y", maxIter=300, regParam=1 / (1000 * rows.count()), standardization=False)
        else:
            maker = IsotonicRegression(featuresCol="x", labelCol="y")
        self.model = maker.fit(ready)
        return self

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``p`` calibrated."""
        done = self.model.transform(self._assembled(rows))
        new = F.get(vector_to_array("probability"), 1) if self.kind == "platt" else F.col("prediction")
        return done.select(*[c for c in rows.columns if c != "p"], F.least(F.greatest(new, F.lit(0.0)), F.lit(1.0)).alias("p"))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/{self.kind}")

    @classmethod
    def load(cls, path: str, kind: str) -> Calibrator:
        made = cls(kind)
        made.model = (LogisticRegressionModel if kind == "platt" else IsotonicRegressionModel).load(f"{path}/{kind}")
        return made


def brier(rows: DataFrame) -> Column:
    return F.avg((F.col("p") - F.col("y")) ** 2)


def choose_calibrator(fit: DataFrame, select: DataFrame) -> tuple[Calibrator, dict[str, float]]:
    """The calibrator, fitted on ``fit``, with the lower Brier loss on ``select``; platt on a tie."""
    made = [Calibrator(k).fit(fit) for k in ("platt", "isotonic")]
    losses = {c.kind: c.predict(select).agg(brier(select).alias("b")).first().b for c in made}
    return min(made, key=lambda c: (losses[c.kind], c.kind != "platt")), losses


def grouped_oof(rows: DataFrame, folds: int = 3, trees: int = FOLD_TREES, features: list[str] = FEATURES, step: float = STEP, leaf: int = LEAF) -> DataFrame:
    """``rows`` with p from models that saw no row of the same component."""
    fold = F.pmod(hashed(F.col("component")), F.lit(folds))
    parts = rows.withColumn("fold", fold)
    spark = rows.sparkSession

    def of(f: int) -> DataFrame:
        return predict(train_model(parts.where(F.col("fold") != f), None, trees, features, step, leaf), parts.where(F.col("fold") == f))

    # a fit is many small jobs, one after the other, so the fits go side by side
    with ThreadPoolExecutor(folds) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(of), f) for f in range(folds)]
    return reduce(DataFrame.unionByName, [d.result() for d in done]).drop("fold")


def hard_negatives(scored: DataFrame, truth: DataFrame, splits: DataFrame, cap: int | None = 100_000) -> DataFrame:
    """For each query the false candidate with the highest p, at most ``cap`` by q, or all; refuses queries
    that aren't in 'fit'."""
    if scored.select("q").distinct().join(splits.where("split = 'fit'"), "q", "left_anti").limit(1).count():
        raise ValueError("hard negatives may only be mined on 'fit'")
    first = F.row_number().over(Window.partitionBy("q").orderBy(F.col("p").desc(), "t"))
    false = scored.join(truth.select("q", "t"), ["q", "t"], "left_anti")
    found = false.withColumn("first", first).where("first = 1").drop("first")
    return found if cap is None else found.orderBy("q").limit(cap)

"""Batch scoring: probabilities, decisions and messages for many users at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.columns import doubles_to_floats
from ebbtide.schemas import ID

DEFAULT_THRESHOLD = 0.5
# Fixed value: the sentence about a user.
MESSAGE = "prediction for user %d is %s with probability of: %.3f"


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class Bundle:
    """What is needed to score: the fitted pipeline, its decision threshold, and the calibrator where there is one."""

    model: PipelineModel
    threshold: float = DEFAULT_THRESHOLD
    calibrator: IsotonicRegressionModel | None = None

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        if self.calibrator is not None:
            self.calibrator.write().overwrite().save(f"{path}/calibrator")
        facts = SparkSession.active().createDataFrame(
            [(float(self.threshold), self.calibrator is not None)], "threshold double, calibrated boolean"
        )
        facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")

    @classmethod
    def load(cls, path: str) -> "Bundle":
        facts = SparkSession.active().read.parquet(f"{path}/facts").first()
        calibrator = IsotonicRegressionModel.load(f"{path}/calibrator") if facts["calibrated"] else None
        return cls(load_model(f"{path}/model"), facts["threshold"], calibrator)

    def score(self, features: DataFrame) -> DataFrame:
        return score(features, self.model, self.threshold, self.calibrator)


def positive_probability(vector: str = "probability") -> Column:
    return vector_to_array(vector)[1]


def decide(scored: DataFrame, probability: str = "churn_probability", threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``prediction`` (strictly above the threshold) and the probability of the predicted class."""
    p = F.col(probability)
    return scored.withColumn("prediction", p > F.lit(threshold)).withColumn(
        "predicted_class_probability", F.when(F.col("prediction"), p).otherwise(1 - p)
    )


def score(
    features: DataFrame, model: PipelineModel, threshold: float = DEFAULT_THRESHOLD, calibrator=None
) -> DataFrame:
    """``ID, churn_probability, prediction, predicted_class_probability`` of every row, in the single precision the
    models are fitted on. The model was loaded once; Spark ships it to the executors."""
    scored = model.transform(doubles_to_floats(features)).withColumn("churn_probability", positive_probability())
    if calibrator is not None:
        scored = calibrator.transform(scored.withColumn("raw_probability", F.col("churn_probability"))).withColumn(
            "churn_probability", F.col("calibrated_probability")
        )
    return decide(scored.select(ID, "churn_probability"), threshold=threshold)


def with_message(scored: DataFrame) -> DataFrame:
    """One sentence per user, for churners and non-churners alike."""
    answer = F.when(F.col("prediction"), "True").otherwise("False")
    return scored.withColumn(
        "message",
        F.format_string(MESSAGE, ID, answer, "predicted_class_probability"),
    )

"""Feature, classifier and recommender pipelines on pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits and sizes of the models.
SIMILARITY_FEATURES = 1 << 18
NEWS_FEATURES = 200_000
DEMO_FEATURES = 20
CLASSIFIER_MIN_DOCS = 3
ALS_ITERATIONS = 8
ALS_REGULARIZATION = 0.01
TOP_N = 10


def split_by_hash(df: DataFrame, key: Column, percent: int = 80, seed: int = 0):
    """(train, test) by a hash of the id: the same rows on every run and retry."""
    slot = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(100))
    return df.where(slot < percent), df.where(slot >= percent)


def hashed_features(words: str = "words", features: int = SIMILARITY_FEATURES, min_docs: int = 0):
    return Pipeline(
        stages=[
            HashingTF(inputCol=words, outputCol="rawFeatures", numFeatures=features),
            IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=min_docs),
        ]
    )


def stored_entries(vector: Column) -> Column:
    """(index, value) pairs stored in a sparse ML vector, read from its text form.

    The text is "(size,[indices],[values])"; nothing is made dense and no Python runs.
    """
    text = vector.cast("string")

    def numbers(pattern, kind):
        found = F.split(F.regexp_extract(text, pattern, 1), ",")
        return F.transform(F.filter(found, lambda x: x != ""), lambda x: x.cast(kind))

    return F.zip_with(
        numbers(r"^\(\d+,\[([^\]]*)\]", "int"),
        numbers(r",\[([^\]]*)\]\)$", "double"),
        lambda i, v: F.struct(i.alias("index"), v.alias("value")),
    )


def text_classifier(features: int = SIMILARITY_FEATURES, min_docs: int = CLASSIFIER_MIN_DOCS):
    """Hashed tf-idf and naive Bayes as one pipeline: the test rows reuse the trained idf."""
    return Pipeline(
        stages=[
            *hashed_features("words", features, min_docs).getStages(),
            NaiveBayes(smoothing=1.0, modelType="multinomial"),
        ]
    )


def accuracy(predictions: DataFrame) -> float:
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions)


def recommender(seed: int = 7, checkpoint_interval: int = 10) -> ALS:
    return ALS(
        maxIter=ALS_ITERATIONS, regParam=ALS_REGULARIZATION, userCol="user", itemCol="item",
        ratingCol="rating", coldStartStrategy="drop", seed=seed,
        checkpointInterval=checkpoint_interval,
    )


def rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(
        metricName="rmse", labelCol="rating", predictionCol="prediction"
    ).evaluate(predictions)


def rmse_table(predictions: DataFrame, label: str = "rating", prediction: str = "prediction"):
    error = F.col(prediction) - F.col(label)
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def recommendations(model, side: str = "users", subset: DataFrame | None = None, n: int = TOP_N):
    """Top-n lists as rows (user/item, other, score, rank)."""
    if side == "users":
        key, other = "user", "item"
        top = model.recommendForAllUsers(n) if subset is None else model.recommendForUserSubset(
            subset, n
        )
    else:
        key, other = "item", "user"
        top = model.recommendForAllItems(n) if subset is None else model.recommendForItemSubset(
            subset, n
        )
    rows = top.select(key, F.posexplode("recommendations").alias("pos", "r"))
    return rows.select(
        key, F.col(f"r.{other}").alias(other), F.col("r.rating").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )

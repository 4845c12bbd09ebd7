"""Text classification with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, IDF, IndexToString, RegexTokenizer, StopWordsRemover, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.analytics.segments import probability_of_one
from millrace.scratch import materialise
from millrace.session import task_count


def text_model(texts: Sequence[str], numbers: Sequence[str], label: str, min_texts: int = 2, words: int = 1 << 18,
               trees: int = 20, seed: int = 42) -> Pipeline:
    """TF-IDF of the whole of each text column, as class likelihoods next to numeric columns, into a random forest.

    The vocabulary follows the data: every word of at least ``min_texts`` texts, ``words`` of them at most. The forest keeps a
    number for each of its features in every training row, so words are no features of it: a naive Bayes model weighs all
    of them while they are sparse, and its probability of each class is what the forest sees. A row costs it as many numbers as there
    are classes, however large the vocabulary is.
    """
    stages = []
    for c in texts:
        stages += [
            RegexTokenizer(inputCol=c, outputCol=f"_{c}_words", pattern="\\W+"),
            StopWordsRemover(inputCol=f"_{c}_words", outputCol=f"_{c}_kept"),
            CountVectorizer(inputCol=f"_{c}_kept", outputCol=f"_{c}_tf", minDF=min_texts, vocabSize=words),
            IDF(inputCol=f"_{c}_tf", outputCol=f"_{c}_tfidf"),
        ]
    stages += [
        VectorAssembler(inputCols=[f"_{c}_tfidf" for c in texts], outputCol="_weights"),
        NaiveBayes(labelCol="_label", featuresCol="_weights", predictionCol="_likeliest", rawPredictionCol="_likelihoods",
                   probabilityCol="_by_words"),
        VectorAssembler(inputCols=["_by_words", *numbers], outputCol="_features", handleInvalid="keep"),
        RandomForestClassifier(labelCol="_label", featuresCol="_features", predictionCol="_predicted",
                               numTrees=trees, maxDepth=8, seed=seed),
    ]
    index = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep", stringOrderType="alphabetAsc")
    return Pipeline(stages=[index, *stages])


def fit_text_model(train: DataFrame, texts: Sequence[str], numbers: Sequence[str], label: str, **settings) -> PipelineModel:
    """Fit on a written copy of the training rows, because every stage makes its own passes."""
    kept = materialise(train.select(*texts, *numbers, label), "text-training", task_count(train.sparkSession))
    return text_model(texts, numbers, label, **settings).fit(kept)


def split_by_key(df: DataFrame, key: str, test_share: float) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same rows on every run and retry."""
    digest = F.conv(F.substring(F.sha1(F.col(key).cast("string").cast("binary")), 1, 7), 16, 10).cast("bigint")
    side = digest < F.lit(int(round(test_share * 16 ** 7)))
    return df.filter(~side), df.filter(side)


def predict_labels(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    names = model.stages[0].labels
    back = IndexToString(inputCol="_predicted", outputCol="predicted", labels=[*names, "?"])
    return back.transform(model.transform(df)).select(*df.columns, "predicted", "_label", "_predicted")


def confusion(predicted: DataFrame, label: str) -> DataFrame:
    return predicted.groupBy(F.col(label).alias("actual"), "predicted").agg(F.count("*").alias("n"))


def micro_f1(predicted: DataFrame) -> float:
    """With one label per row the micro-averaged F1 equals the accuracy."""
    return MulticlassClassificationEvaluator(
        labelCol="_label", predictionCol="_predicted", metricName="accuracy").evaluate(predicted)


def encode_labels(df: DataFrame, column: str, output: str) -> DataFrame:
    """Label codes in alphabetical order."""
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc").fit(df).transform(df)


# ---- choosing a classifier -----------------------------------------------------------------

def candidates(label: str, seed: int = 42) -> dict[str, object]:
    common = {"labelCol": label, "featuresCol": "_features"}
    return {
        "logistic": LogisticRegression(maxIter=30, regParam=0.01, **common),
        "forest": RandomForestClassifier(numTrees=30, maxDepth=5, seed=seed, **common),
        "boosted": GBTClassifier(maxIter=10, maxDepth=3, seed=seed, **common),
    }


TASK_ROWS = 50_000  # training rows of a task


def dealt(rows: DataFrame, key: str, most: int = TASK_ROWS) -> DataFrame:
    """A written table in parts of about ``most`` rows.

    Features are mostly zero, so a scan packs very many rows into a task, which the fits then keep unpacked.
    """
    parts = -(-rows.count() // most)
    return rows.repartition(parts, key) if parts > rows.rdd.getNumPartitions() else rows


def without_summary(model):
    """A fitted model without its training summary, which holds the session: a session that has observed metrics cannot be sent to tasks."""
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def select_classifier(df: DataFrame, key: str, features: Sequence[str], label: str,
                      test_share: float = 0.3, seed: int = 42) -> tuple[str, PipelineModel, list[tuple[str, float]]]:
    """Fit every candidate and keep the one with the highest area under the ROC curve.

    Vectors and sides are made once and kept on local disk, in the rows and parts of the written table: fits pass over them dozens of times.
    """
    ready = materialise(df.select(key, F.col(label).cast("double").alias(label), *[
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]),
        "training", task_count(df.sparkSession))
    vectors = VectorAssembler(inputCols=list(features), outputCol="_features")
    train, test = [vectors.transform(side).select(label, "_features").persist(StorageLevel.DISK_ONLY)
                   for side in split_by_key(dealt(ready, key), key, test_share)]
    measure = BinaryClassificationEvaluator(labelCol=label)
    trials, best = [], None
    try:
        for name, classifier in candidates(label, seed).items():
            model = without_summary(classifier.fit(train))
            auc = measure.evaluate(model.transform(test))
            trials.append((name, auc))
            if best is None or auc > best[1]:
                best = (name, auc, model)
    finally:
        train.unpersist()
        test.unpersist()
    return best[0], PipelineModel(stages=[vectors, best[2]]), trials


def scores(model: PipelineModel, df: DataFrame, keys: Sequence[str], features: Sequence[str],
           name: str = "propensity_score") -> DataFrame:
    """Probability of class 1 for every row, missing features taken as 0."""
    filled = df.select(*keys, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    return model.transform(filled).select(*keys, probability_of_one().alias(name))

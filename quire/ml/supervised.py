"""Sentiment classifier, score regression and their evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, IDF, StopWordsRemover, StringIndexer, Tokenizer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.scalar import tokens
from quire.ml.features import assemble
from quire.operators.layout import stage_table


def text_features_stages(text: str, num_features: int = 10000, stopwords: list[str] | None = None):
    """Tokenizer (lower case, split on each white-space character) ->
    stop-word removal (default: Spark ML's English list) -> hashed term frequencies -> IDF."""
    chosen = {} if stopwords is None else {"stopWords": list(stopwords)}
    return [
        Tokenizer(inputCol=text, outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", **chosen),
        HashingTF(inputCol="filtered_tokens", outputCol="raw_features", numFeatures=num_features),
        IDF(inputCol="raw_features", outputCol="features"),
    ]


def sentiment_classifier(train: DataFrame, text: str, label: str, num_features: int = 10000,
                         max_iter: int = 20, reg: float = 0.01):
    """Fit text features + label index + logistic regression; returns the PipelineModel."""
    stages = text_features_stages(text, num_features) + [
        StringIndexer(inputCol=label, outputCol="label"),
        LogisticRegression(maxIter=max_iter, regParam=reg),
    ]
    return Pipeline(stages=stages).fit(train)


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(predictions)


def accuracy_table(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (n, correct, accuracy) as a DataFrame aggregate."""
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return predictions.agg(F.count(F.lit(1)).alias("n"), F.sum(hit).cast("bigint").alias("correct"),
                           F.avg(hit.cast("double")).alias("accuracy"))


def idf_weights(df: DataFrame, text: str) -> DataFrame:
    """(word, doc_freq, idf) with idf = ln((docs + 1) / (doc_freq + 1)), Spark ML's formula,
    per word (no hashing).

    The texts are read once: every document also contributes the empty
    string (never a token), whose document frequency is the document count.
    The vocabulary-sized aggregate is written once so both uses share it.
    """
    docs = df.where(F.col(text).isNotNull())
    marked = F.array_union(F.array_distinct(tokens(text)), F.array(F.lit("")))
    words = docs.select(F.explode(marked).alias("word"))
    dfreq = stage_table(words.groupBy("word").agg(F.count(F.lit(1)).alias("doc_freq")), "vocabulary")
    n = dfreq.where(F.col("word") == "").select("doc_freq").scalar()
    return dfreq.where(F.col("word") != "").withColumn("idf", F.log((n + 1) / (F.col("doc_freq") + 1)))


def score_regression(train: DataFrame, features: list[str], label: str):
    """Ordinary least squares with intercept (normal equations for few features)."""
    data = assemble(train.where(F.col(label).isNotNull()), features)
    return LinearRegression(featuresCol="features", labelCol=label).fit(data)


def regression_metrics(model, test: DataFrame, features: list[str], label: str) -> DataFrame:
    """One row (n, rmse, r2) on ``test``."""
    pred = model.transform(assemble(test.where(F.col(label).isNotNull()), features))
    err = F.col(label) - F.col("prediction")
    # R^2 = 1 - SS_res / SS_tot, with SS_tot = n * population variance of the label (one pass)
    return pred.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"),
                    (1 - F.avg(err * err) / F.var_pop(label)).alias("r2"))


def rmse(predictions: DataFrame, label: str, prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(predictions)

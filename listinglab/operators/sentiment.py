"""Review sentiment as a distributed text classifier.

The source scored each review one row at a time with a pretrained
transformer. Its weights are not available offline, so the classifier is a
Spark ML pipeline (tokenize -> hashed term frequencies -> IDF -> multinomial
logistic regression) trained on the labelled reviews, with the star rating
as the five-class label; the class index then maps to Negative / Neutral /
Positive (F16). Inference is a per-partition ``transform``: no driver loop.
A vectorised ``pandas_udf`` hook lets a user plug in any other model.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import review_text, sentiment_bucket
from .ordinal import fit_ordinal

TEXT = "_all_text"


def with_text(df: DataFrame, title: str = "Title", body: str = "Full Review") -> DataFrame:
    """``Title: t, Review: r``; NULL scored as ''."""
    return df.withColumn(TEXT, F.coalesce(review_text(F.col(f"`{title}`"), F.col(f"`{body}`")), F.lit("")))


def fit_sentiment(labelled: DataFrame, label_col: str = "label", num_features: int = 1 << 18, weight_col: str | None = None):
    """Fit the pipeline on rows with a class number as label (0..4 for stars);
    ``weight_col`` evens out classes of very different sizes."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=TEXT, outputCol="_tokens", pattern=r"(?U)[^\p{L}\p{N}_]+", minTokenLength=1)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features", minDocFreq=1)
    lr = LogisticRegression(featuresCol="_features", labelCol=label_col, family="multinomial",
                            maxIter=30, regParam=0.01, predictionCol="_class", probabilityCol="_prob",
                            rawPredictionCol="_raw", **({"weightCol": weight_col} if weight_col else {}))
    data = with_text(labelled).withColumn(label_col, F.col(label_col).cast("double"))
    return Pipeline(stages=[tok, tf, idf, lr]).fit(data)


def fit_ordinal_sentiment(labelled: DataFrame, label_col: str = "label", num_features: int = 1 << 18, classes: int = 5, weight_col: str | None = None,
                          steps: int = 100):
    """The same features under the ordinal model of :mod:`.ordinal`: stars are ordered, and one weight a word tells low from high."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    tok = RegexTokenizer(inputCol=TEXT, outputCol="_tokens", pattern=r"(?U)[^\p{L}\p{N}_]+", minTokenLength=1)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_weighted", minDocFreq=1)
    unit = Normalizer(inputCol="_weighted", outputCol="_features")
    data = with_text(labelled)
    prepare: PipelineModel = Pipeline(stages=[tok, tf, idf, unit]).fit(data)
    model = fit_ordinal(prepare.transform(data), classes, label=label_col, weight=weight_col, size=num_features, steps=steps, rate=0.6)
    return OrdinalPipeline(prepare, model)


class OrdinalPipeline:
    """Text to class: the fitted text features, then the ordinal model."""

    def __init__(self, prepare, model):
        self.prepare, self.model = prepare, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare.transform(df)).drop("_weighted")


def enrich_sentiment(df: DataFrame, model, out: str = "Sentiment") -> DataFrame:
    """Add ``Sentiment`` from the fitted pipeline."""
    scored = model.transform(with_text(df))
    return scored.withColumn(out, sentiment_bucket(F.col("_class").cast("int"))) \
        .drop(TEXT, "_tokens", "_tf", "_features", "_raw", "_prob", "_class")


def sentiment_udf(predict: Callable[[pd.Series], pd.Series]):
    """Hook: wrap a batch predictor (text Series -> class index Series) as an
    Arrow-batched pandas UDF."""
    @F.pandas_udf("int")
    def _udf(texts: pd.Series) -> pd.Series:
        return predict(texts.fillna("")).astype("int32")

    return _udf


def enrich_with_udf(df: DataFrame, predict: Callable[[pd.Series], pd.Series], out: str = "Sentiment") -> DataFrame:
    u = sentiment_udf(predict)
    return with_text(df).withColumn(out, sentiment_bucket(u(F.col(TEXT)))).drop(TEXT)

"""Three-class batch scoring with any model, and a trainable default."""

import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from voxseries import constants as K
from voxseries.functions.text import strip, words
from voxseries.operators.joins import is_small


def kept_model(name: str, load_model: Callable[[], Callable]) -> Callable:
    """The model of a worker process; only the latest one is kept.

    It is kept beside the interpreter's own state, as functions that are sent to workers may not share module state.
    """
    models = vars(sys).setdefault("_voxseries_models", {})
    if name not in models:
        models.clear()
        models[name] = load_model()
    return models[name]


def classify(
    df: DataFrame,
    text_col: str,
    load_model: Callable[[], Callable[[list[str]], np.ndarray]],
    out_col: str = "trans_sentiment",
    batch: int = 256,
) -> DataFrame:
    """Class of the highest of three scores: 0 negative, 1 neutral, 2 positive.

    ``load_model`` runs once per Python worker, which keeps the model for its later tasks, and
    returns a function from a list of texts to an array of shape (n, 3). Only the text column travels to Python, in Arrow batches. Null and blank text
    is neutral and never reaches the model. Text length is the model's affair.
    """
    name = uuid.uuid4().hex

    @F.pandas_udf(IntegerType())
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = kept_model(name, load_model)
        for texts in batches:
            out = np.full(len(texts), K.NEUTRAL, dtype=np.int32)
            filled = np.flatnonzero(texts.fillna("").str.strip() != "")
            for start in range(0, len(filled), batch):
                at = filled[start:start + batch]
                out[at] = np.argmax(np.asarray(model(texts.iloc[at].tolist())), axis=1)
            yield pd.Series(out)

    return df.withColumn(out_col, label(F.col(text_col)))


def _tokens(df: DataFrame, text_col: str, max_tokens: int | None) -> DataFrame:
    tokens = words(F.col(text_col))
    if max_tokens:
        tokens = F.slice(tokens, 1, max_tokens)
    return df.withColumn("_tokens", tokens)


def linear_weights(model: PipelineModel) -> tuple[DataFrame, list[float]]:
    """A model of ``train_linear`` as a table ``term, class, weight``, and the intercept of each class."""
    counts, idf, fitted = model.stages
    matrix = fitted.coefficientMatrix.toArray() * idf.idf.toArray()
    rows = [(term, c, float(matrix[c, i])) for i, term in enumerate(counts.vocabulary) for c in range(len(matrix))]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "term string, class int, weight double"), fitted.interceptVector.toArray().tolist()


def train_linear(
    labelled: DataFrame, text_col: str, label_col: str, terms: int = 1 << 15, max_iter: int = 20,
    max_tokens: int | None = None,
) -> PipelineModel:
    """Multinomial logistic regression over the ``terms`` most frequent words, for scoring by ``classify_linear``."""
    data = _tokens(labelled, text_col, max_tokens).select("_tokens", F.col(label_col).cast("double").alias(label_col))
    stages = [
        CountVectorizer(inputCol="_tokens", outputCol="_tf", vocabSize=terms),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(featuresCol="_tfidf", labelCol=label_col, family="multinomial", maxIter=max_iter, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(data)


def classify_linear(
    df: DataFrame, text_col: str, weights: DataFrame, intercepts, key, out_col: str = "trans_sentiment",
    max_tokens: int | None = None,
) -> DataFrame:
    """``key`` columns and class of a linear model, as joins and sums: the class of the highest score, of equal ones the least.

    ``weights`` is a table ``term, class, weight`` (measured, and broadcast if small); ``intercepts`` has one number per class.
    All words of a row sit in one task, which sums them up before they are shuffled. Null and blank text is neutral. The key
    must be unique.
    """
    classes = range(len(intercepts))
    wide = weights.filter((F.col("term") != "") & F.col("class").isin(list(classes))).groupBy("term").agg(*[
        F.coalesce(F.sum(F.when(F.col("class") == c, F.col("weight"))), F.lit(0.0)).alias(f"_w{c}") for c in classes])
    wide = F.broadcast(wide) if is_small(weights) else wide
    blank = F.coalesce(strip(F.col(text_col)) == "", F.lit(True)).alias("_blank")
    # Found before the explode: afterwards the text would go along with each of its words, to be trimmed for every one.
    cut = _tokens(df, text_col, max_tokens).select(*key, blank, "_tokens")
    # A place of its own closes each row, so that rows without a known word keep a score.
    terms = F.explode(F.concat("_tokens", F.array(F.lit("")))).alias("term")
    counted = cut.select(*key, "_blank", terms)
    known = counted.join(wide, "term", "left")
    sums = known.groupBy(*key, "_blank").agg(*[
        (F.coalesce(F.sum(f"_w{c}"), F.lit(0.0)) + F.lit(float(b))).alias(f"_s{c}") for c, b in zip(classes, intercepts)])
    best = F.greatest(*[F.struct(F.col(f"_s{c}").alias("score"), F.lit(-c).alias("less")) for c in classes])
    label = F.when(F.col("_blank"), K.NEUTRAL).otherwise(-best["less"])
    return sums.select(*key, label.cast("int").alias(out_col))


def train_classifier(
    labelled: DataFrame,
    text_col: str,
    label_col: str,
    features: int = 1 << 16,
    max_iter: int = 20,
    max_tokens: int | None = None,
) -> PipelineModel:
    """Multinomial logistic regression over hashed term weights.

    A stand-in for a pretrained model; its scores are not comparable with one.
    """
    data = _tokens(labelled, text_col, max_tokens).withColumn(
        label_col, F.col(label_col).cast("double")
    )
    stages = [
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(
            featuresCol="_tfidf", labelCol=label_col, predictionCol="_class",
            rawPredictionCol="_raw", probabilityCol="_prob",
            family="multinomial", maxIter=max_iter, regParam=0.01,
        ),
    ]
    return Pipeline(stages=stages).fit(data.select("_tokens", label_col))


def classify_with(
    df: DataFrame,
    text_col: str,
    model: PipelineModel,
    out_col: str = "trans_sentiment",
    max_tokens: int | None = None,
) -> DataFrame:
    """Apply the trained default. Whole texts unless ``max_tokens`` says otherwise."""
    scored = model.transform(_tokens(df, text_col, max_tokens))
    blank = F.coalesce(strip(F.col(text_col)) == "", F.lit(True))
    label = F.when(blank, K.NEUTRAL).otherwise(F.col("_class").cast("int"))
    return scored.select(*df.columns, label.alias(out_col))

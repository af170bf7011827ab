"""Models as scorers: inference in batches, and a classifier that Spark fits itself.

A model is given as a function that loads it. Spark calls it once per Python worker,
not once per batch or row, and hands the texts over as Arrow batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gladwire.functions.text import _col

# Maps an array of texts to an array of one score, or of one row of scores, per text.
Predict = Callable[[np.ndarray], np.ndarray]
# Texts of one call of the model.
BATCH = 256


def batch_model(load: Callable[[], Predict], batch_size: int = BATCH, many: bool = True) -> Callable[[Column], Column]:
    """A column function that runs a model on texts; null texts give null.

    With ``many`` the model gives a row of scores per text (probabilities of classes or labels), else
    one score. As scorer of headlines and, by ``probabilities_scorer``, as scorer of topics.
    """
    kind = T.ArrayType(T.DoubleType()) if many else T.DoubleType()

    def make() -> Predict:
        predict = load()
        return lambda texts: np.asarray(predict(texts), dtype=np.float64)

    run = predict_batch_udf(make, return_type=kind, batch_size=batch_size)

    def score(text: Column | str) -> Column:
        text = _col(text)
        return F.when(text.isNotNull(), run(F.coalesce(text, F.lit(""))))

    return score


def fit_headlines(labelled: DataFrame, words: Sequence[str], label: str = "label") -> PipelineModel:
    """Naive Bayes on how often each of the words occurs in ``title``; a scorer for ``score_news``.

    ``label`` is 0 or 1, 1 for uplifting. Rows without title or label teach nothing. The words are
    lower-case and without spaces; the model is as small as their number.
    """
    rows = labelled.filter(F.col("title").isNotNull() & F.col(label).isNotNull())
    tokens = RegexTokenizer(inputCol="title", outputCol="_words", pattern=r"[^\p{L}\p{N}_]+", minTokenLength=1)
    counts = CountVectorizerModel.from_vocabulary(list(words), inputCol="_words", outputCol="_counts", minTF=1.0)
    bayes = NaiveBayes(featuresCol="_counts", labelCol=label, modelType="multinomial", smoothing=1.0)
    return Pipeline(stages=[tokens, counts, bayes]).fit(rows)

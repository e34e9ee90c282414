"""Preparation of model rows (M3-M8) and reports on fitted models.

Preparation is fitted on training rows only: categories are imputed
(``MISSING``), optionally grouped (rare levels), numbered and one-hot encoded
(unknown level -> all zeros, no level dropped); numerics get the exact
training median and are standardised with the *population* std (what the
original pipelines do; Spark's ``Imputer``/``StandardScaler`` use the lower
median and the sample std).  Trees are in ``trees``, linear regression in
``linear``, logistic regression and the SVM in ``convex``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.config import GROUPER_MIN_COUNT
from lendlake.operators.pipeline import CategoryPlaces, CategoryPlacesModel, MedianScale, MedianScaleModel, place_column, vector_names


@dataclass
class Preprocessor:
    """Fitted preparation, one ``PipelineModel``: places of levels, one-hot marks, scaled numbers, the vector."""

    cat_cols: list[str]
    num_cols: list[str]
    pipeline: PipelineModel

    @property
    def places(self) -> CategoryPlacesModel:
        return self.pipeline.stages[0]

    @property
    def scaler(self) -> MedianScaleModel:
        return next(s for s in self.pipeline.stages if isinstance(s, MedianScaleModel))

    @property
    def medians(self) -> dict[str, float]:
        return dict(zip(self.num_cols, self.scaler.getOrDefault("medians")))

    @property
    def scales(self) -> dict[str, float]:
        return dict(zip(self.num_cols, self.scaler.getOrDefault("scales")))

    @property
    def feature_names(self) -> list[str]:
        return vector_names(self.num_cols, self.places)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``; the prepared columns go."""
        used = [*self.cat_cols, *self.num_cols, *[p(c) for c in self.cat_cols for p in (place_column, mark_column)]]
        return self.pipeline.transform(df).drop(*used)

    def then(self, model) -> PipelineModel:
        """Preparation and ``model`` as one pipeline, to be saved and applied as a whole."""
        return PipelineModel([*self.pipeline.stages, model])


def mark_column(c: str) -> str:
    return f"__marks_{c}"


def fit_preprocessor(
    train: DataFrame,
    cat_cols: Sequence[str],
    num_cols: Sequence[str],
    group_rare: bool = False,
    rare_min_count: int = GROUPER_MIN_COUNT,
) -> Preprocessor:
    """M3-M8: fit every preparation step on the training rows."""
    cat_cols, num_cols = list(cat_cols), list(num_cols)
    stages: list = [CategoryPlaces(columns=cat_cols, minCount=rare_min_count if group_rare else 0)]
    if cat_cols:
        # A place beyond the levels is kept as one more category, the last, which gets no mark.
        stages.append(
            OneHotEncoder(inputCols=[place_column(c) for c in cat_cols], outputCols=[mark_column(c) for c in cat_cols],
                          handleInvalid="keep", dropLast=True)
        )
    stages.append(MedianScale(columns=num_cols))
    stages.append(VectorAssembler(inputCols=[*num_cols, *[mark_column(c) for c in cat_cols]], outputCol="features", handleInvalid="keep"))
    return Preprocessor(cat_cols, num_cols, Pipeline(stages=stages).fit(train))


def positive_score(predictions: DataFrame, kind: str, out: str = "score") -> DataFrame:
    """Score of the positive class: probability[1], or rawPrediction[1] for the SVM."""
    col = "rawPrediction" if kind == "svm" else "probability"
    return predictions.withColumn(out, vector_to_array(F.col(col))[1])


def coefficient_table(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, coefficient) ranked by magnitude (small driver-side list)."""
    found = model.coefficients
    coefs = np.asarray(found.toArray() if hasattr(found, "toArray") else found).ravel()
    pairs = list(zip(names, coefs.tolist()))
    return sorted(pairs, key=lambda p: -abs(p[1]))

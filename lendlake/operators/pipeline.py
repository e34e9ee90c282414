"""Preparation and linear models as ML stages with persistence.

Each fitted step is a ``Model``, so preparation and model are one
``PipelineModel`` that is saved, loaded and applied as a whole.  Numbers of a
fitted step (one per column) are its params; the table of category levels, one
row per level, is a Parquet folder beside them, so there is no limit on the
number of levels and none of them needs to reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.config import GROUPER_LABEL, MISSING_CATEGORY
from lendlake.operators import convex, linear
from lendlake.operators import features as fx
from lendlake.operators.ranking import running_totals
from lendlake.session import stored


def place_column(c: str) -> str:
    return f"__place_{c}"


class _Categories(Params):
    columns = Param(Params._dummy(), "columns", "categorical columns", TypeConverters.toListString)
    minCount = Param(Params._dummy(), "minCount", "rows that a level needs to stand alone; 0: all levels do", TypeConverters.toInt)
    sizes = Param(Params._dummy(), "sizes", "number of places of each column", TypeConverters.toListInt)
    rarePlaces = Param(Params._dummy(), "rarePlaces", "place of the rare level of each column, or its size if it has none", TypeConverters.toListInt)


class CategoryPlaces(Estimator, _Categories, DefaultParamsReadable, DefaultParamsWritable):
    """M3, M5 fit: number the levels of each column in ascending order, rare ones as one level.

    NULL is the level ``MISSING``.  Levels are counted in one scan of all
    columns and numbered by ranges, however many there are.
    """

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, minCount: int = 0):
        super().__init__()
        self._set(**self._input_kwargs)
        if not self.isSet(self.minCount):
            self._set(minCount=0)

    def _fit(self, train: DataFrame) -> CategoryPlacesModel:
        columns, least = self.getOrDefault(self.columns), self.getOrDefault(self.minCount)
        spark = train.sparkSession
        counts = fx.fit_rare_levels(train, columns, 0) if columns else spark.createDataFrame([], "column_name string, level string, train_count bigint")
        named = F.when(F.col("train_count") >= least, F.col("level")).otherwise(F.lit(GROUPER_LABEL))
        distinct = counts.select("column_name", named.alias("level")).distinct()
        ranked = stored(running_totals(distinct, [("column_name", False), ("level", False)], {}, rank_col="rank"), "levels-ranked")
        starts = ranked.groupBy("column_name").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("size"))
        starts = stored(starts, "levels-starts")
        levels = ranked.join(F.broadcast(starts), "column_name").select("column_name", "level", (F.col("rank") - F.col("first")).cast("int").alias("place"))
        levels = stored(levels, "levels")
        sizes = {r["column_name"]: r["size"] for r in starts.collect()}  # one row a column
        grouped = levels.where(F.col("level") == GROUPER_LABEL) if least else levels.limit(0)
        rare = {r["column_name"]: r["place"] for r in grouped.collect()}
        model = CategoryPlacesModel(levels)
        model._set(columns=columns, minCount=least, sizes=[sizes.get(c, 0) for c in columns], rarePlaces=[rare.get(c, sizes.get(c, 0)) for c in columns])
        return model


class CategoryPlacesModel(Model, _Categories, MLReadable, MLWritable):
    """M3, M5 transform: ``__place_<column>``, the number of a row's level.

    A level that is not in the table counts as the rare one; where there is
    none its place is the number of levels, which the encoder takes as no level.
    """

    def __init__(self, levels: DataFrame | None = None):
        super().__init__()
        self.levels = levels

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, sizes, rare = (self.getOrDefault(p) for p in (self.columns, self.sizes, self.rarePlaces))
        for c, size, other in zip(columns, sizes, rare):
            table = self.levels.where(F.col("column_name") == c).select("level", F.col("place").alias("__place"))
            value = F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY))
            found = fx.lookup(df, value, table, size <= fx.MAX_BROADCAST_LEVELS)
            df = found.withColumn(place_column(c), F.coalesce("__place", F.lit(other)).cast("double")).drop("__place")
        return df

    def names(self) -> list[str]:
        """``column=level`` in the order of the encoded vector (one string a level: for reports)."""
        order = {c: i for i, c in enumerate(self.getOrDefault(self.columns))}
        rows = sorted(self.levels.collect(), key=lambda r: (order[r["column_name"]], r["place"]))
        return [f"{r['column_name']}={r['level']}" for r in rows]

    def write(self) -> MLWriter:
        return _LevelsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LevelsReader()


class _LevelsWriter(MLWriter):
    def __init__(self, instance: CategoryPlacesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.levels.write.parquet(f"{path}/levels")


class _LevelsReader(MLReader):
    def load(self, path: str) -> CategoryPlacesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryPlacesModel(self.sparkSession.read.parquet(f"{path}/levels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _Scaled(Params):
    columns = Param(Params._dummy(), "columns", "numeric columns", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "what stands for NULL", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means of the imputed columns", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "population deviations, 1 for a constant column", TypeConverters.toListFloat)


class MedianScale(Estimator, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    """M6, M7 fit: exact medians, then mean and population deviation of the imputed columns.

    A column that is NULL on every row gets 0.
    """

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, train: DataFrame) -> MedianScaleModel:
        columns = self.getOrDefault(self.columns)
        found = {r["column_name"]: r["median"] for r in fx.fit_medians(train, columns).collect()} if columns else {}
        medians = [float(found.get(c) or 0.0) for c in columns]
        imputed = [F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(columns, medians)]
        stats = [s for c, e in zip(columns, imputed) for s in (F.avg(e).alias(f"m_{c}"), F.stddev_pop(e).alias(f"s_{c}"))]
        row = train.agg(*stats).first() if columns else None
        model = MedianScaleModel()
        model._set(
            columns=columns, medians=medians, means=[float(row[f"m_{c}"] or 0.0) for c in columns],
            scales=[float(row[f"s_{c}"] or 1.0) for c in columns],
        )
        return model


class MedianScaleModel(Model, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    """M6, M7 transform, in place."""

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, medians, means, scales = (self.getOrDefault(p) for p in (self.columns, self.medians, self.means, self.scales))
        done = {
            c: (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(mean)) / F.lit(scale)
            for c, m, mean, scale in zip(columns, medians, means, scales)
        }
        return df.withColumns(done) if done else df


class LinearModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """``prediction`` of a linear model on ``features``."""

    coefficients = Param(Params._dummy(), "coefficients", "one number a feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "prediction of a row of zeros", TypeConverters.toFloat)

    @classmethod
    def of(cls, model) -> LinearModel:
        """From anything fitted that has ``coefficients`` and ``intercept``."""
        out = cls()
        out._set(coefficients=[float(c) for c in model.coefficients], intercept=float(model.intercept))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(c) for c in self.getOrDefault(self.coefficients)])
        products = F.zip_with(vector_to_array("features"), weights, lambda x, c: x * c)
        return df.withColumn("prediction", F.aggregate(products, F.lit(self.getOrDefault(self.intercept)), lambda s, x: s + x))


class LogisticModel(LinearModel):
    """L1: ``probability`` (a vector of two) and ``prediction`` (1 above one half)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        p = 1 / (1 + F.exp(-F.col("prediction")))
        out = super()._transform(df).withColumn("probability", array_to_vector(F.array(1 - p, p)))
        return out.withColumn("prediction", (F.col("prediction") > 0).cast("double"))


class Logistic(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """L1 fit: balanced logistic regression on ``features``, ``label`` and ``weight`` by Newton's method."""

    C = Param(Params._dummy(), "C", "weight of the losses against the penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, C: float = 1.0):
        super().__init__()
        self._set(C=float(self._input_kwargs.get("C", 1.0)))

    def _fit(self, train: DataFrame) -> LogisticModel:
        return LogisticModel.of(convex.fit_logistic(stored(convex.prepared(train), "logistic-sums"), self.getOrDefault(self.C)))


class Ridge(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """L6 fit: ridge on ``features`` and ``label`` by one pass of cross products."""

    alpha = Param(Params._dummy(), "alpha", "weight of the squared coefficients", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha: float = 0.0):
        super().__init__()
        self._set(alpha=float(self._input_kwargs.get("alpha", 0.0)))

    def _fit(self, train: DataFrame) -> LinearModel:
        width = len(train.select("features").first()[0])
        m = linear.moments(train.select("features", "label"), linear.Design(tuple(range(width))))
        return LinearModel.of(linear.ridge(m, self.getOrDefault(self.alpha)))


def vector_names(columns: Sequence[str], places: CategoryPlacesModel) -> list[str]:
    return [*columns, *places.names()]

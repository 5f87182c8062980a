"""Leakage-safe feature preparation.

``MedianStandardScaler`` is an Estimator: exact medians (fitted on the
training rows only, computed with the distributed exact quantile) fill
nulls, then each column is centred and divided by its *population*
standard deviation (a zero deviation divides by 1).  Spark ML's
``Imputer`` uses an approximate median and ``StandardScaler`` the sample
deviation, hence the own Estimator.  Categorical columns go through
``StringIndexer(alphabetAsc, keep)`` + ``OneHotEncoder(dropLast)``: every
seen level keeps a slot, an unseen or null level maps to all zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrite.operators.ordered import exact_quantiles
from ferrite.operators.profile import long_values
from ferrite.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES


class _ScalerParams(HasInputCols, HasOutputCols):
    pass


class MedianStandardScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "fitted medians", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means after imputation", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population std after imputation", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, medians=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def getMedians(self):
        return self.getOrDefault(self.medians)

    def getMeans(self):
        return self.getOrDefault(self.means)

    def getStds(self):
        return self.getOrDefault(self.stds)

    def _transform(self, df: DataFrame) -> DataFrame:
        outs = []
        for c, o, med, mu, sd in zip(self.getInputCols(), self.getOutputCols(), self.getMedians(),
                                     self.getMeans(), self.getStds()):
            x = F.coalesce(F.col(c).cast("double"), F.lit(med))
            outs.append(((x - F.lit(mu)) / F.lit(sd if sd > 0 else 1.0)).alias(o))
        return df.select("*", *outs)


class MedianStandardScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianStandardScalerModel:
        cols = list(self.getInputCols())
        med_rows = exact_quantiles(long_values(df, cols), ["column_name"], "value", [0.5]).collect()
        medians = {r["column_name"]: r["q_0"] for r in med_rows}
        med = [float(medians.get(c) if medians.get(c) is not None else 0.0) for c in cols]
        imputed = [F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in zip(cols, med)]
        stats = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(imputed)],
                       *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(imputed)]).first()
        means = [float(stats[f"m{i}"] or 0.0) for i in range(len(cols))]
        stds = [float(stats[f"s{i}"] or 0.0) for i in range(len(cols))]
        return MedianStandardScalerModel(inputCols=cols, outputCols=list(self.getOutputCols()),
                                         medians=med, means=means, stds=stds)


def num_name(c: str) -> str:
    return f"num__{c}"


def build_preprocessor(numeric: Sequence[str] = NUMERIC_FEATURES,
                       categorical: Sequence[str] = CATEGORICAL_FEATURES,
                       features_col: str = "features") -> Pipeline:
    """impute+scale numerics, one-hot categoricals, assemble one vector."""
    scaled = [num_name(c) for c in numeric]
    idx = [f"_{c}_idx" for c in categorical]
    ohe = [f"_{c}_ohe" for c in categorical]
    return Pipeline(stages=[
        MedianStandardScaler(inputCols=list(numeric), outputCols=scaled),
        StringIndexer(inputCols=list(categorical), outputCols=idx,
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=scaled + ohe, outputCol=features_col, handleInvalid="keep"),
    ])


def feature_names(model: PipelineModel, numeric: Sequence[str] = NUMERIC_FEATURES,
                  categorical: Sequence[str] = CATEGORICAL_FEATURES) -> list[str]:
    """Encoded names, ``num__<col>`` then ``cat__<col>_<level>``."""
    indexer = next(s for s in model.stages if s.__class__.__name__ == "StringIndexerModel")
    names = [num_name(c) for c in numeric]
    for c, labels in zip(categorical, indexer.labelsArray):
        names += [f"cat__{c}_{lv}" for lv in labels]
    return names


def feature_name_table(spark, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "slot INT, feature STRING")


def with_named_features(df: DataFrame, names: Sequence[str], features_col: str = "features",
                        keep: Sequence[str] = ()) -> DataFrame:
    """One DOUBLE column per vector slot, named by G5."""
    arr = vector_to_array(F.col(features_col))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def transform_columns(model: PipelineModel) -> list[str]:
    """Columns the pipeline adds besides the final vector (to drop them)."""
    out = []
    for s in model.stages:
        if s.hasParam("outputCols") and s.isDefined(s.getParam("outputCols")):
            out += s.getOrDefault(s.getParam("outputCols"))
    return out


def label_features(names: DataFrame, labels: dict[str, str], col: str = "feature") -> DataFrame:
    """Display label by dictionary, else the name without its prefix.

    The dictionary is a handful of rows: broadcast left join.
    """
    from ferrite.functions import strip_prefixes
    spark = names.sparkSession
    lab = spark.createDataFrame(list(labels.items()), f"{col} STRING, label STRING")
    j = names.join(F.broadcast(lab), col, "left")
    return j.withColumn("label", F.coalesce(F.col("label"), strip_prefixes(F.col(col))))

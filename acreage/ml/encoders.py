"""Preprocessing stages of the model pipelines."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
    MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.constants import NUMERIC_FEATURES, ONEHOT_FEATURES, TARGET_ENCODED_FEATURES
from acreage.operators import encoding
from acreage.operators.features import top_values
from acreage.operators.joins import lookup_join
from acreage.session import stage


class _Columns(HasInputCols, HasOutputCols):
    """Input and output columns of equal length."""

    def _pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols()))


class PopulationScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Zero mean and unit population deviation; Spark's own scaler uses the sample deviation."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        fitted = encoding.fit_scaler(dataset, self.getInputCols())
        values = [fitted.get(c, (0.0, 1.0)) for c in self.getInputCols()]
        return PopulationScalerModel(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(),
            means=[m for m, _ in values], deviations=[d for _, d in values],
        )


class PopulationScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, deviations=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(self._pairs(), self.getOrDefault("means"), self.getOrDefault("deviations"))
        return dataset.withColumns({out: encoding.scaled(c, m, d) for (c, out), m, d in fitted})


class FrequentCategories(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the most frequent categories of each column and call the rest `other`."""

    limit = Param(Params._dummy(), "limit", "categories kept per column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, limit=50):
        super().__init__()
        self._setDefault(limit=50)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequentCategoriesModel:
        names = self.getInputCols()
        kept = [
            f"{names.index(r['feature'])}:{r['value']}"
            for r in top_values(dataset, names, self.getOrDefault("limit")).orderBy("feature", "value").collect()
        ]
        return FrequentCategoriesModel(inputCols=names, outputCols=self.getOutputCols(), kept=kept)


class FrequentCategoriesModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    kept = Param(Params._dummy(), "kept", "column position and category", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, kept=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values: dict[int, list[str]] = {i: [] for i in range(len(self.getInputCols()))}
        for item in self.getOrDefault("kept"):
            position, value = item.split(":", 1)
            values[int(position)].append(value)
        return dataset.withColumns({
            out: F.when(F.col(c).isin(values[i]), F.col(c)).otherwise(F.lit("other"))
            for i, (c, out) in enumerate(self._pairs())
        })


class SmoothedTargetEncoder(Estimator, _Columns, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Category to smoothed mean of the label, fitted on the rows it is given and no others."""

    smoothing = Param(Params._dummy(), "smoothing", "smoothing strength", TypeConverters.toFloat)
    method = Param(Params._dummy(), "method", "sigmoid or m_estimate", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol=None, smoothing=10.0, method="sigmoid"):
        super().__init__()
        self._setDefault(smoothing=10.0, method="sigmoid")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SmoothedTargetEncoderModel:
        table, prior = encoding.target_encodings(
            dataset, self.getInputCols(), self.getLabelCol(), self.getOrDefault("method"),
            self.getOrDefault("smoothing"),
        )
        model = SmoothedTargetEncoderModel(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(), prior=prior)
        return model._bind(stage(table.drop("n"), "encodings", owned=True))


class SmoothedTargetEncoderModel(Model, _Columns, MLReadable, MLWritable):
    prior = Param(Params._dummy(), "prior", "value of unseen and missing categories", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, prior=None):
        super().__init__()
        self._set(**self._input_kwargs)
        self.encodings: DataFrame | None = None
        self.rows = 0

    def _bind(self, encodings: DataFrame) -> SmoothedTargetEncoderModel:
        self.encodings, self.rows = encodings, encodings.count()
        return self

    def copy(self, extra=None) -> SmoothedTargetEncoderModel:
        other = super().copy(extra)
        other.encodings, other.rows = self.encodings, self.rows
        return other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for c, name in self._pairs():
            table = self.encodings.filter(F.col("feature") == c).select(
                F.col("category").alias(f"_key_{name}"), F.col("encoded").alias(f"_enc_{name}"))
            keyed = out.withColumn(f"_key_{name}", F.col(c).cast("string"))
            out = lookup_join(keyed, table, [f"_key_{name}"], known_rows=self.rows).withColumn(
                name, F.coalesce(F.col(f"_enc_{name}"), F.lit(self.getOrDefault("prior")))
            ).drop(f"_key_{name}", f"_enc_{name}")
        return out

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, instance: SmoothedTargetEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.encodings.write.parquet(f"{path}/encodings")


class _EncoderReader(MLReader):
    def __init__(self, cls: type[SmoothedTargetEncoderModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SmoothedTargetEncoderModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._bind(spark.read.parquet(f"{path}/encodings"))


class DropColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Drop the intermediate columns of a pipeline."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getInputCols())


def preprocessing_stages(
    label: str, prefix: str = "", numeric: list[str] | None = None, onehot: list[str] | None = None,
    encoded: list[str] | None = None, fallback_onehot: bool = False, limit: int = 50,
) -> list:
    """Scale, one-hot and target-encode into `<prefix>features`; every other column is untouched.

    `prefix` keeps the columns of two pipelines over one table apart. With `fallback_onehot` the
    high-cardinality columns are one-hot encoded over their most frequent values instead.
    """
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    onehot = list(ONEHOT_FEATURES if onehot is None else onehot)
    encoded = list(TARGET_ENCODED_FEATURES if encoded is None else encoded)
    stages, vector, temporary = [], [], []

    scaled = [f"{prefix}{c}_z" for c in numeric]
    if numeric:
        stages.append(PopulationScaler(inputCols=numeric, outputCols=scaled))
    vector += scaled
    sources = list(onehot)
    if encoded and fallback_onehot:
        capped = [f"{prefix}{c}_top" for c in encoded]
        stages.append(FrequentCategories(inputCols=encoded, outputCols=capped, limit=limit))
        sources += capped
        temporary += capped
    if sources:
        index, hot = [f"{prefix}{c}_ix" for c in sources], [f"{prefix}{c}_oh" for c in sources]
        stages += [
            StringIndexer(inputCols=sources, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True, handleInvalid="keep"),
        ]
        vector += hot
        temporary += index
    if encoded and not fallback_onehot:
        means = [f"{prefix}{c}_te" for c in encoded]
        stages.append(SmoothedTargetEncoder(inputCols=encoded, outputCols=means, labelCol=label))
        vector += means
    stages.append(VectorAssembler(inputCols=vector, outputCol=f"{prefix}features"))
    stages.append(DropColumns(inputCols=temporary + vector))
    return stages


def build_pipeline(model, label: str, prefix: str = "", **columns) -> Pipeline:
    """Preprocessing followed by a model, refitted together on every training part."""
    return Pipeline(stages=[*preprocessing_stages(label, prefix, **columns), model])


class OrderedPipeline(Estimator):
    """Preprocessing followed by a model, which learns from target encodings that leave each row's own target out.

    The rows the model is fitted on are encoded by what stands before them in digest order; the fitted pipeline encodes
    other rows by all of them."""

    def __init__(self, model: Estimator, key: str, label: str, prefix: str = "", strength: float = 1.0, **columns):
        super().__init__()
        self.model, self.key, self.label, self.strength = model, key, label, strength
        self.stages = preprocessing_stages(label, prefix, **columns)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        fitted, rows = [], dataset
        for step in self.stages:
            own = step.fit(rows) if isinstance(step, Estimator) else step
            fitted.append(own)
            if isinstance(step, SmoothedTargetEncoder):
                rows = encoding.ordered_target_statistics(rows, self.key, step.getInputCols(), self.label, self.strength, suffix="_ordered")
                rows = rows.withColumnsRenamed({f"{c}_ordered": out for c, out in step._pairs()})
            else:
                rows = own.transform(rows)
        return PipelineModel([*fitted, self.model.fit(rows)])


def input_features(model: PipelineModel) -> list[str]:
    """Raw columns a fitted pipeline reads."""
    made: set[str] = set()
    wanted: list[str] = []
    for step in model.stages:
        if isinstance(step, DropColumns):
            break
        inputs = step.getInputCols() if step.hasParam("inputCols") and step.isDefined("inputCols") else []
        wanted += [c for c in inputs if c not in made and c not in wanted]
        if step.hasParam("outputCols") and step.isDefined("outputCols"):
            made |= set(step.getOutputCols())
    return wanted

"""M05 as estimators: everything that is learnt comes from the rows given to ``fit``.

Inside a pipeline that is fitted per fold, medians, modes, levels, moments and class
weights are those of the training rows. The fitted preparation is a pipeline of Spark's
own stages, so it can be saved with the model behind it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrona.scale import long_values
from patrona.session import materialize


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"({value!r}D)"


class Preparation(Estimator):
    """Numeric branch (median, scaling) and text branch (mode, one-hot) fitted in two aggregates.

    One aggregate gives medians, moments and rough level counts of all columns, another
    the counts of all levels. Moments of the filled columns follow from those of the
    given values. The one-hot encoding keeps every level of the training rows and gives
    zeros to others; without ``impute`` a null number is an error. A numeric column
    without any value is filled with 0, and a constant one becomes 0 when scaled. More
    levels than about ``max_levels`` in a column are an error: they become vector slots.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], impute: bool = False, scale: bool = True,
                 output: str = "features", max_levels: int = 10_000):
        super().__init__()
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.impute, self.scale, self.output, self.max_levels = impute, scale, output, max_levels

    def _statistics(self, train: DataFrame) -> dict:
        wanted = [F.count(F.lit(1)).alias("n")]
        for i, c in enumerate(self.numeric):
            x = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
            wanted.append(F.struct(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("variance"),
                                   F.percentile_approx(x, 0.5, 10_000).alias("median")).alias(f"x{i}"))
        wanted += [F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(self.categorical)]
        found = train.agg(*wanted).first().asDict()
        large = [c for i, c in enumerate(self.categorical) if found[f"d{i}"] > self.max_levels]
        if large:
            raise ValueError(f"too many levels to one-hot encode: {', '.join(large)}")
        return found

    def _levels(self, train: DataFrame) -> tuple[list[list[str]], list[str]]:
        """Sorted levels and mode (the smallest on a tie) of each text column."""
        if not self.categorical:
            return [], []
        counts: dict[str, list] = {c: [] for c in self.categorical}
        for r in (long_values(train, self.categorical, dtype="string").where(F.col("value").isNotNull())
                  .groupBy("column", "value").count().collect()):
            counts[r["column"]].append((-r["count"], r["value"]))
        modes = [min(counts[c])[1] if counts[c] else "" for c in self.categorical]
        return [sorted(v for _n, v in counts[c]) or [""] for c in self.categorical], modes

    def _filled(self, n_rows: int, column) -> tuple[float, float, float]:
        """Median, and mean and deviation once missing values hold the median."""
        n, median = column["n"], column["median"] if column["median"] is not None else 0.0
        mean, variance = column["mean"] or 0.0, column["variance"] or 0.0
        missing = n_rows - n if self.impute else 0
        total = n + missing
        if not total:
            return median, 0.0, 0.0
        centre = (n * mean + missing * median) / total
        squares = max(n - 1, 0) * variance + n * (mean - centre) ** 2 + missing * (median - centre) ** 2
        return median, centre, math.sqrt(squares / (total - 1)) if total > 1 else 0.0

    def _fit(self, train: DataFrame) -> PipelineModel:
        found = self._statistics(train)
        levels, modes = self._levels(train)
        inputs, exprs = [], []
        for i, c in enumerate(self.numeric):
            median, centre, spread = self._filled(found["n"], found[f"x{i}"])
            value = f"CAST(`{c}` AS DOUBLE)"
            if self.impute:
                value = f"coalesce(nanvl({value}, CAST(NULL AS DOUBLE)), {_number(median)})"
            if self.scale:
                factor = 1 / spread if spread > 0 else 0.0
                value = f"({value} - {_number(centre)}) * {_number(factor)}"
            exprs.append(f"{value} AS `_num_{i}`")
            inputs.append(f"_num_{i}")
        for i, (c, mode) in enumerate(zip(self.categorical, modes)):
            value = f"CAST(`{c}` AS STRING)"
            exprs.append(f"{f'coalesce({value}, {_text(mode)})' if self.impute else value} AS `_cat_{i}`")
        stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")] if exprs else []
        shape = train.limit(0)
        if self.categorical:
            indexed = stages[0].transform(train.limit(0))
            for i, labels in enumerate(levels):
                index = StringIndexerModel.from_labels(labels, inputCol=f"_cat_{i}", outputCol=f"_index_{i}",
                                                       handleInvalid="keep")
                indexed = index.transform(indexed)
                stages.append(index)
            hot = OneHotEncoder(inputCols=[f"_index_{i}" for i in range(len(levels))],
                                outputCols=[f"_hot_{i}" for i in range(len(levels))], dropLast=True)
            stages.append(hot.fit(indexed))  # the sizes are in the column metadata: no job
            inputs += [f"_hot_{i}" for i in range(len(levels))]
        stages.append(VectorAssembler(inputCols=inputs, outputCol=self.output))
        return PipelineModel(stages=stages)


class ClassWeighter(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a weight by class; rows without the label column pass unchanged, so a scored row needs none."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "list of label and weight pairs as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = "label", weightCol: str = "weight", table: str = "[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        label, name = self.getOrDefault(self.labelCol), self.getOrDefault(self.weightCol)
        if label not in df.columns:
            return df
        weight = F.lit(1.0)
        for value, share in json.loads(self.getOrDefault(self.table)):
            weight = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(share)).otherwise(weight)
        return df.withColumn(name, weight)


class BalancedWeights(Estimator):
    """M16 inside a pipeline: weight n / (classes * n_class) by the classes of the training rows."""

    def __init__(self, label: str = "label", weight: str = "weight", max_classes: int = 1000):
        super().__init__()
        self.label, self.weight, self.max_classes = label, weight, max_classes

    def _fit(self, train: DataFrame) -> ClassWeighter:
        counts = train.groupBy(self.label).count().limit(self.max_classes + 1).collect()
        if len(counts) > self.max_classes:
            raise ValueError(f"{self.label} has more than {self.max_classes} classes")
        total = sum(r["count"] for r in counts)
        table = sorted(([r[self.label], total / (len(counts) * r["count"])] for r in counts), key=str)
        return ClassWeighter(labelCol=self.label, weightCol=self.weight, table=json.dumps(table))


class PositiveWeight(Estimator):
    """L03 inside a pipeline: a given weight for class 1, 1 for the others."""

    def __init__(self, value: float, label: str = "label", weight: str = "weight"):
        super().__init__()
        self.value, self.label, self.weight = float(value), label, weight

    def _fit(self, train: DataFrame) -> ClassWeighter:
        return ClassWeighter(labelCol=self.label, weightCol=self.weight, table=json.dumps([[1.0, self.value]]))


def with_model(prepare: Estimator, estimator: Estimator, weights: Estimator | None = None) -> Pipeline:
    """Preparation, weights if any, and model as one pipeline that learns from its training rows only."""
    return Pipeline(stages=[prepare, *([weights] if weights else []), estimator])


def prepared_fold(prepare: Estimator | None, df: DataFrame, fold: str, i: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of fold i, prepared by what the training rows alone tell, each written once."""
    train, test = df.where(F.col(fold) != i), df.where(F.col(fold) == i)
    if prepare is None:
        return train, test
    fitted = prepare.fit(train)
    return materialize(fitted.transform(train), "fold-train"), materialize(fitted.transform(test), "fold-test")

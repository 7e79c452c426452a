"""Two-layer classifier: one boosted model per event label, then a forest over all of them."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonde.cluster import spread, staged
from sonde.functions import binary_target, col, is_missing, multiclass_target, present
from sonde.operators import features as feats
from sonde.operators import impute, models
from sonde.reference import EVENT_LABELS

PREFIX = "probability_label_"


@dataclass(frozen=True)
class StackedModel:
    """Everything that scoring needs, fitted on the training rows alone."""

    sensors: tuple[str, ...]
    fill: dict
    scaler: feats.Scaler
    layer_1: dict[int, PipelineModel]
    layer_2: PipelineModel
    classes: tuple[str, ...]

    @property
    def inputs(self) -> list[str]:
        return _inputs(self.sensors)

    def layer_1_scores(self, df: DataFrame) -> DataFrame:
        """The columns of ``df``, the prepared inputs, and the scores of the label models."""
        ready = _prepare(df, self.sensors, self.fill, self.scaler)
        return models.score_per_label(ready, self.layer_1, PREFIX)

    def transform(self, df: DataFrame) -> DataFrame:
        """Score observations: the input columns plus class, probabilities and layer-1 scores.

        Flags, imputation, scaling and all models are columns of one plan over one scan.
        """
        scored = self.layer_2.transform(self.layer_1_scores(df))
        names = F.array(*[F.lit(c) for c in self.classes])
        klass = F.try_element_at(names, F.col("prediction").cast("int") + 1)
        return scored.select(
            *[col(c) for c in df.columns], "prediction", klass.alias("predicted_class"),
            vector_to_array("probability").alias("probability"),
            *[col(f"{PREFIX}{k}") for k in sorted(self.layer_1)])

    def save(self, spark: SparkSession, path: str) -> None:
        for k, model in self.layer_1.items():
            models.save_model(model, f"{path}/layer_1/label_{k}")
        models.save_model(self.layer_2, f"{path}/layer_2")
        meta = {"sensors": self.sensors, "fill": self.fill, "means": self.scaler.means,
                "deviations": self.scaler.deviations, "labels": sorted(self.layer_1),
                "classes": self.classes}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str, sensors: Sequence[str]) -> StackedModel:
        """Load and check that the model was fitted on exactly these sensors, in this order."""
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        if meta["sensors"] != list(sensors):
            raise ValueError(f"model at {path} expects {meta['sensors']}, got {list(sensors)}")
        inputs = _inputs(sensors)
        layer_1 = {k: models.load_model(f"{path}/layer_1/label_{k}", inputs)
                   for k in meta["labels"]}
        layer_2 = models.load_model(f"{path}/layer_2",
                                    inputs + [f"{PREFIX}{k}" for k in meta["labels"]])
        scaler = feats.Scaler(tuple(sensors), tuple(meta["means"]), tuple(meta["deviations"]))
        return StackedModel(tuple(sensors), meta["fill"], scaler, layer_1, layer_2,
                            tuple(meta["classes"]))


def _inputs(sensors: Sequence[str]) -> list[str]:
    return [f"_x_{s}" for s in sensors] + [f"_x_{s}_missing" for s in sensors]


def _prepare(df: DataFrame, sensors: Sequence[str], fill: dict, scaler: feats.Scaler
             ) -> DataFrame:
    """Append scaled sensors and missing flags; the original columns stay as they are."""
    def scaled(name: str, mean: float, dev: float):
        value = F.coalesce(present(df, name), F.lit(float(fill[name])))
        return ((value - F.lit(mean)) / F.lit(dev) if dev else F.lit(0.0)).alias(f"_x_{name}")

    return df.select(
        *[col(c) for c in df.columns],
        *[scaled(s, m, v) for s, m, v in zip(sensors, scaler.means, scaler.deviations)],
        *[F.when(is_missing(df, s), 1.0).otherwise(0.0).alias(f"_x_{s}_missing")
          for s in sensors])


def fit_stacked(train: DataFrame, continuous: Sequence[str], categorical: Sequence[str],
                labels: Sequence[int] = EVENT_LABELS, layer_1: Estimator | None = None,
                layer_2: Estimator | None = None, label: str = "label", klass: str = "class"
                ) -> StackedModel:
    """Fit fills, scaling, the label models and the final model on training rows.

    The columns in use are written to the shared folder once before, the prepared inputs once
    after the fills and the scaling are fitted, and the scores of layer 1 once before layer 2; all
    later passes read these tables.  Without a ``layer_1`` the label models are boosted together.
    """
    sensors = [*continuous, *categorical]
    train = staged(train.select(*[col(c) for c in dict.fromkeys([label, klass, *sensors])]), "train")
    fill = {**impute.fit_continuous(train, continuous).values,
            **impute.fit_categorical(train, categorical).values}
    empty = [s for s in sensors if fill.get(s) is None]
    if empty:
        raise ValueError(f"no values at all in {empty}")
    scaler = feats.fit_scaler(impute.Imputer(fill).transform(train), sensors)
    inputs = _inputs(sensors)
    ready = staged(_prepare(spread(train), sensors, fill, scaler).select(
        col(label), *inputs, binary_target(col(klass)).alias("target"),
        multiclass_target(col(klass)).alias("final_class")), "inputs")
    first = models.fit_per_label(ready, inputs, labels, layer_1, label, "target", stored=True)
    indexer = feats.frequency_index(ready, "final_class", "indexed_class")
    # The forest passes over its rows many times: the scores are written, not computed each time.
    scored = staged(indexer.transform(models.score_per_label(
        ready.select("final_class", *inputs), first, PREFIX)), "scored")
    second = models.fit_on(scored, inputs + [f"{PREFIX}{k}" for k in sorted(first)],
                           layer_2 or models.forest(), "indexed_class")
    return StackedModel(tuple(sensors), fill, scaler, first, second, tuple(indexer.labels))

"""Fitted-model store.  Spark ML models use their own writers; our
estimators (preprocessor, linear models, PCA) are small parameter documents
written as one-row JSON tables through Spark.

``ModelStore`` keeps the models of a run together as versions of one name: each version is a fresh folder with its
models, the preprocessor and a manifest (kinds, feature signature, schema hash of the fit rows, what the
caller notes), and becomes the latest by the pointer that is swapped last.  Loading checks the rows to be
scored against the manifest and refuses a mismatch."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from panelforge.operators.linear import LinearModel
from panelforge.operators.pca import PCAModel
from panelforge.operators.preprocess import PreprocessModel
from panelforge.operators.trees import TreeModel
from panelforge.sources.publish import current_version, new_version, publish


def _write(spark: SparkSession, doc: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "params string").coalesce(1) \
        .write.mode("overwrite").json(path)


def _read(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.json(path).first()["params"])


def save_linear(spark: SparkSession, m: LinearModel, path: str) -> None:
    _write(spark, {"features": m.features, "coef": [float(x) for x in m.coef], "intercept": m.intercept,
                   "params": {k: (float(v) if isinstance(v, (int, float, np.floating)) else v)
                              for k, v in m.params.items()}}, path)


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    d = _read(spark, path)
    return LinearModel(d["features"], np.asarray(d["coef"], dtype=float), d["intercept"], d["params"])


def save_pca(spark: SparkSession, m: PCAModel, path: str) -> None:
    _write(spark, {"features": m.features, "mean": m.mean.tolist(), "components": m.components.tolist(),
                   "eigenvalues": m.eigenvalues.tolist(), "total_variance": m.total_variance}, path)


def load_pca(spark: SparkSession, path: str) -> PCAModel:
    d = _read(spark, path)
    return PCAModel(d["features"], np.asarray(d["mean"]), np.asarray(d["components"]), np.asarray(d["eigenvalues"]),
                    d["total_variance"])


def save_spark_model(model, path: str) -> None:
    model.write().overwrite().save(path)


class ModelMismatch(ValueError):
    pass


def feature_signature(features: list[str]) -> str:
    """Names of the features in their order."""
    return hashlib.sha256(json.dumps(list(features)).encode()).hexdigest()


def schema_hash(df: DataFrame, features: list[str]) -> str:
    """Names and types of the feature columns; all columns that are missing are named in the error."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = [c for c in features if c not in types]
    if missing:
        raise ModelMismatch(f"the rows lack {missing}")
    return hashlib.sha256(json.dumps([(c, types[c]) for c in features]).encode()).hexdigest()


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, name: str, models: dict, fitted_on: DataFrame, *, preprocessor: PreprocessModel | None = None, note: dict | None = None) -> str:
        """Write a new version of ``name`` and make it the latest; returns the version. ``fitted_on`` gives the schema only."""
        version = new_version()
        root = f"{self.path}/{name}/{version}"
        manifest = {"models": {}, "preprocessor": preprocessor is not None, "note": note or {}}
        for key, m in models.items():
            kind = "linear" if isinstance(m, LinearModel) else "pca" if isinstance(m, PCAModel) else "tree"
            entry = {"kind": kind, "features": list(m.features), "signature": feature_signature(m.features), "schema": schema_hash(fitted_on, m.features)}
            if kind == "linear":
                save_linear(self.spark, m, f"{root}/{key}")
            elif kind == "pca":
                save_pca(self.spark, m, f"{root}/{key}")
            else:
                save_spark_model(m.model, f"{root}/{key}")
                entry.update(tree=m.kind, params=m.params)
            manifest["models"][key] = entry
        if preprocessor is not None:
            preprocessor.save(self.spark, f"{root}/_preprocessor")
        _write(self.spark, manifest, f"{root}/_manifest")
        publish(self.spark, f"{self.path}/{name}", version)
        return version

    def manifest(self, name: str, version: str | None = None) -> dict:
        version = version or current_version(self.spark, f"{self.path}/{name}")
        return {**_read(self.spark, f"{self.path}/{name}/{version}/_manifest"), "version": version}

    def load(self, name: str, key: str, rows: DataFrame, *, version: str | None = None):
        """The model ``key`` of a version (default: the latest) for scoring ``rows``; ModelMismatch if their feature columns are not
        those of the fit or the stored model is not the one of the manifest."""
        manifest = self.manifest(name, version)
        if key not in manifest["models"]:
            raise ModelMismatch(f"{name} {manifest['version']} holds {sorted(manifest['models'])}, not {key}")
        entry, path = manifest["models"][key], f"{self.path}/{name}/{manifest['version']}/{key}"
        if schema_hash(rows, entry["features"]) != entry["schema"]:
            raise ModelMismatch(f"the types of the feature columns differ from those {name} {manifest['version']} was fitted on")
        if entry["kind"] == "tree":
            model = TreeModel(entry["tree"], entry["features"], entry["params"], DefaultParamsReader.loadParamsInstance(path, self.spark))
        else:
            model = (load_linear if entry["kind"] == "linear" else load_pca)(self.spark, path)
        if feature_signature(model.features) != entry["signature"]:
            raise ModelMismatch(f"the features of {key} are not those of its manifest")
        return model

    def preprocessor(self, name: str, *, version: str | None = None) -> PreprocessModel:
        manifest = self.manifest(name, version)
        if not manifest["preprocessor"]:
            raise ModelMismatch(f"{name} {manifest['version']} has no preprocessor")
        return PreprocessModel.load(self.spark, f"{self.path}/{name}/{manifest['version']}/_preprocessor")

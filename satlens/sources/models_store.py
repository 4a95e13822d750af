"""Versioned model store: ``<root>/<name>/<YYYY-MM-DD>/`` folders (MLlib format).

Resolving a version lists one folder level on the driver (model versions are
metadata: a handful of names), then picks the latest date <= as-of.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_version(model, root: str, name: str, version: str) -> str:
    path = os.path.join(root, name, version)
    model.write().overwrite().save(path)
    return path


def list_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(root, name))
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def latest_version(spark: SparkSession, root: str, name: str, as_of: str, n: int = 1) -> str | None:
    """n-th latest version folder whose date <= as_of (None when there is none)."""
    ok = [v for v in list_versions(spark, root, name) if v <= as_of]
    return ok[-n] if len(ok) >= n else None


# -- versions that count once they are whole ---------------------------------
#: Written last into a version's folder.
READY = "_READY"


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@contextmanager
def ready_version(spark: SparkSession, root: str, name: str, version: str):
    """The folder to write a version into; the mark that makes it count is set when the block ends without an error.

    Writing a version again takes its mark away first, so readers fall back to the one before."""
    path = f"{root.rstrip('/')}/{name}/{version}"
    fs, mark = _file_system(spark, f"{path}/{READY}")
    fs.delete(mark, False)
    yield path
    fs.create(mark, True).close()


def ready_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Whole versions, oldest first."""
    out = []
    for v in list_versions(spark, root, name):
        fs, mark = _file_system(spark, f"{root.rstrip('/')}/{name}/{v}/{READY}")
        if fs.exists(mark):
            out.append(v)
    return out


# -- champion ----------------------------------------------------------------
#: Names the folder of the version in use; it is replaced in one step.
POINTER = "CURRENT"


@dataclass
class Champion:
    version: str
    models: dict
    metrics: DataFrame  # model, dataset, metric, value
    features: list[str]


def publish(spark: SparkSession, root: str, version: str, models: Mapping, metrics: DataFrame, features: Sequence[str]) -> str:
    """Write models, metrics and feature list as one version, then point to it.

    Until the pointer moves nobody sees the new folder, so a run that is killed
    on the way leaves the old version in use; a rerun writes a folder of its own.
    """
    folder = f"{version}-{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/versions/{folder}"
    for label, model in models.items():
        model.write().save(f"{path}/models/{label}")
    metrics.write.parquet(f"{path}/metrics")
    about = spark.createDataFrame([(version, list(features), list(models))], "version string, features array<string>, labels array<string>")
    about.coalesce(1).write.json(f"{path}/about")
    point_to(spark, root, folder)
    return path


def point_to(spark: SparkSession, root: str, folder: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    draft, pointer = hadoop.Path(f"{root.rstrip('/')}/_draft-{uuid.uuid4().hex}"), hadoop.Path(f"{root.rstrip('/')}/{POINTER}")
    fs = pointer.getFileSystem(conf)
    out = fs.create(draft, True)
    out.write(bytearray(folder.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(draft), fs.makeQualified(pointer), how)


def champion(spark: SparkSession, root: str) -> Champion | None:
    """The version in use, None before the first."""
    base = root.rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    folder = f"{base}/versions/{spark.read.text(f'{base}/{POINTER}').first()[0]}"
    about = spark.read.schema("version string, features array<string>, labels array<string>").json(f"{folder}/about").first()
    models = {label: GBTClassificationModel.load(f"{folder}/models/{label}") for label in about["labels"]}
    return Champion(about["version"], models, spark.read.parquet(f"{folder}/metrics"), list(about["features"]))


def deploy_or_reject(spark: SparkSession, root: str, version: str, models: Mapping, metrics: DataFrame, features: Sequence[str],
                     **rules) -> DataFrame:
    """One cycle: judge the new models against the champion of the store and publish them, or file their metrics as rejected.

    The pair is one version: it is published if every model passes.  A champion
    with other features cannot be compared, so the new pair is published.
    """
    from satlens.operators.metrics import champion_gate, rejected_metrics
    old = champion(spark, root)
    if old and sorted(old.features) != sorted(features):
        decision = champion_gate(metrics, None, **rules).withColumn("reason", F.lit("other features than the champion's"))
    else:
        decision = champion_gate(metrics, old.metrics if old else None, **rules)
    rows = decision.collect()  # one a model
    decision = spark.createDataFrame(rows, decision.schema)
    if all(r["deploy"] for r in rows):
        publish(spark, root, version, models, metrics, features)
    else:
        rejected_metrics(metrics, decision).write.mode("overwrite").parquet(f"{root.rstrip('/')}/rejected/{version}")
    return decision.withColumns({"version": F.lit(version), "published": F.lit(all(r["deploy"] for r in rows))})

"""Run and model tables: parquet below one shared root folder.

``<root>/runs/<run_id>`` holds the row of a run, ``<root>/models/<name digest>/<version>`` the row of
a registered version, ``<root>/claims`` who has which version, and ``<root>/artifacts/<run_id>/model`` the fitted model. Every record has a
folder of its own, so concurrent trials never write to the same place.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.models import param_values
from millrace.sources.tables import load_model, save_model

RUNS_SCHEMA = (
    "run_id string, parent_run_id string, run_name string, start_time timestamp, "
    "params map<string,string>, metrics map<string,double>, model_path string, signature string"
)
MODELS_SCHEMA = "name string, version int, run_id string, model_path string, created timestamp"


def new_run_id() -> str:
    return uuid.uuid4().hex


def _records(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def _record(spark: SparkSession, row: tuple, schema: str, path: str) -> None:
    """Write one row to its own folder; a folder that is taken is an error."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("error").parquet(path)


def runs_table(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, RUNS_SCHEMA, f"{root}/runs")


def models_table(spark: SparkSession, root: str) -> DataFrame:
    return _records(spark, MODELS_SCHEMA, f"{root}/models")


def _name_digest(name: str) -> str:
    return hashlib.md5(name.encode()).hexdigest()


def _name_folder(root: str, name: str) -> str:
    return f"{root}/models/{_name_digest(name)}"


def log_run(
    spark: SparkSession,
    root: str,
    run_name: str | None = None,
    model: Model | None = None,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    parent_run_id: str | None = None,
    run_id: str | None = None,
    start_time: datetime | None = None,
    signature: str | None = None,
) -> str:
    """Record a run and return its id. A model's own parameters are recorded with it; ``params``
    are added to them and win."""
    run_id = run_id or new_run_id()
    path = None
    recorded = {}
    if model is not None:
        path = save_model(model, f"{root}/artifacts/{run_id}/model")
        recorded = param_values(model)
    recorded |= {k: str(v) for k, v in (params or {}).items()}
    start = start_time or datetime.now(timezone.utc)
    scores = {k: float(v) for k, v in (metrics or {}).items()}
    row = (run_id, parent_run_id, run_name, start, recorded, scores, path, signature)
    _record(spark, row, RUNS_SCHEMA, f"{root}/runs/{run_id}")
    return run_id


def report_metrics(report: DataFrame) -> dict[str, float]:
    """Metrics to record from a classification report: accuracy and the averages."""
    names = {"accuracy": "accuracy", "macro avg": "macro", "weighted avg": "weighted"}
    rows = {r["name"]: r for r in report.filter(F.col("name").isin(list(names))).collect()}
    out = {"accuracy": rows["accuracy"]["f1"]}
    for name in ("macro avg", "weighted avg"):
        out |= {f"{names[name]}_{m}": rows[name][m] for m in ("precision", "recall", "f1")}
    return out


def _order(text: str) -> Column:
    """``metrics.test_auc DESC`` or ``start_time ASC`` as a sort column; missing values come last."""
    name, _, direction = text.strip().partition(" ")
    head, _, entry = name.partition(".")
    column = F.try_element_at(F.col(head), F.lit(entry)) if entry else F.col(head)
    if direction.strip().upper() == "DESC":
        return column.desc_nulls_last()
    return column.asc_nulls_last()


def search_runs(
    runs: DataFrame,
    order_by: Sequence[str] = ("start_time DESC",),
    max_results: int | None = None,
    parent_run_id: str | None = None,
) -> DataFrame:
    """Order the runs and keep the first ones (one top-n step, no full sort)."""
    if parent_run_id is not None:
        runs = runs.filter(F.col("parent_run_id") == parent_run_id)
    ordered = runs.orderBy(*[_order(o) for o in order_by])
    return ordered if max_results is None else ordered.limit(max_results)


def best_run(runs: DataFrame, metric: str = "test_auc"):
    """The run with the highest metric; the most recent one among equals."""
    return search_runs(runs, [f"metrics.{metric} DESC", "start_time DESC"], 1).first()


def get_run(spark: SparkSession, root: str, run_id: str):
    """One run, read from its own folder."""
    try:
        return _records(spark, RUNS_SCHEMA, f"{root}/runs/{run_id}").first()
    except AnalysisException as missing:
        raise KeyError(f"no run {run_id}") from missing


def _versions(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return _records(spark, MODELS_SCHEMA, _name_folder(root, name))
    except AnalysisException:  # nothing registered under the name yet
        return None


def _claim(spark: SparkSession, path: str) -> bool:
    """Create a file that must not be there yet; False if another writer has it. One call of the file system decides.

    Hadoop's ``create`` without overwriting is atomic in a distributed file system; its local one looks first, so there
    the operating system's exclusive create is asked.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(conf)
    system.mkdirs(place.getParent())
    if system.getUri().getScheme() == "file":
        try:
            os.close(os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return True
        except FileExistsError:
            return False
    try:
        system.create(place, False).close()
        return True
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise


def register_model(spark: SparkSession, root: str, name: str, run_id: str) -> int:
    """Give the run's model the next version of a name.

    A version belongs to the writer whose claim file was created first; others take the next one. A writer that dies
    after its claim leaves a version without a row.
    """
    path = get_run(spark, root, run_id)["model_path"]
    if path is None:
        raise ValueError(f"run {run_id} has no model")
    known = _versions(spark, root, name)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1 if known is not None else 1
    while not _claim(spark, f"{root}/claims/{_name_digest(name)}/{version}"):
        version += 1
    row = (name, version, run_id, path, datetime.now(timezone.utc))
    _record(spark, row, MODELS_SCHEMA, f"{_name_folder(root, name)}/{version}")
    return version


def load_run_model(spark: SparkSession, root: str, run_id: str) -> Model:
    return load_model(get_run(spark, root, run_id)["model_path"])


def load_registered(spark: SparkSession, root: str, name: str, version: int | None = None) -> Model:
    """A registered model by name; the latest version unless given."""
    known = _versions(spark, root, name)
    if known is not None and version is not None:
        known = known.filter(F.col("version") == version)
    row = None if known is None else known.orderBy(F.desc("version")).first()
    if row is None:
        raise KeyError(f"no model {name}, version {version or 'any'}")
    return load_model(row["model_path"])

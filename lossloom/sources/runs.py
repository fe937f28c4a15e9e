"""Dated runs that count only once their record is written: a repeated or broken run leaves what was published as it is."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

RECORD = "run_date string, paths string, notes string"


def published_runs(spark: SparkSession, root: str) -> list[dict]:
    """Records of the published runs by date, one small row a run; a run without a record does not exist."""
    try:
        rows = spark.read.schema(RECORD).json(f"{root.rstrip('/')}/published/*").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [{"run_date": r["run_date"], "paths": json.loads(r["paths"]), **json.loads(r["notes"])} for r in rows]
    return sorted(found, key=lambda r: r["run_date"])


def published_run(spark: SparkSession, root: str, run_date: str) -> dict | None:
    return next((r for r in published_runs(spark, root) if r["run_date"] == run_date), None)


def stage_table(df: DataFrame, root: str, name: str, run_date: str) -> str:
    """Write one table of a run under a path of its own, which no other attempt shares."""
    path = f"{root.rstrip('/')}/{name}/run_date={run_date}/attempt={uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def publish(spark: SparkSession, root: str, run_date: str, paths: Mapping[str, str], **notes) -> dict:
    """Write the record of a run, last of all; from here on its tables are read."""
    record = spark.createDataFrame([(run_date, json.dumps(dict(paths)), json.dumps(notes))], RECORD)
    record.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/published/{run_date}")
    return {"run_date": run_date, "paths": dict(paths), **notes}


def read_published(spark: SparkSession, root: str, name: str, run_date: str | None = None) -> DataFrame | None:
    """A table of one published run, or of all of them; None if there is none."""
    runs = [r for r in published_runs(spark, root) if run_date in (None, r["run_date"]) and name in r["paths"]]
    return spark.read.parquet(*[r["paths"][name] for r in runs]) if runs else None

"""Run tables: parameters, metrics, importances and curves of every training run.

Each write goes to a folder of its own, so that two writers never share a commit. A run and the runs
below it become visible together, when :meth:`RunLog.finish` has written their manifest as one file; what
a killed job left behind has no manifest and is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.readers import table_exists

TABLES = {
    "runs": "run_id string, parent_run_id string, name string, parameters string, started timestamp",
    "metrics": "run_id string, metric string, value double",
    "importances": "run_id string, feature string, importance double",
    "curves": "run_id string, iteration int, split string, value double",
    "calibration": "run_id string, stage string, bin int, mean_score double, positive_share double, bin_rows bigint",
}
MANIFEST = "run_id string, finished timestamp"


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._below: dict[str, list[str]] = {}

    def start(self, name: str, parameters: dict | None = None, parent: str | None = None) -> str:
        run_id = uuid.uuid4().hex
        self._below[run_id] = []
        if parent is not None:
            self._below.setdefault(parent, []).append(run_id)
        row = self.spark.createDataFrame(
            [(run_id, parent, name, json.dumps(parameters or {}), None)], TABLES["runs"]
        ).withColumn("started", F.current_timestamp())
        self._append("runs", row)
        return run_id

    def finish(self, run_id: str) -> None:
        """Make the run and all runs started below it visible."""
        family, found = [run_id], []
        while family:
            found.append(family.pop())
            family += self._below.get(found[-1], [])
        rows = self.spark.createDataFrame([(one, None) for one in found], MANIFEST)
        self._append("manifest", rows.withColumn("finished", F.current_timestamp()))

    @contextmanager
    def run(self, name: str, parameters: dict | None = None, parent: str | None = None) -> Iterator[str]:
        """A run that counts once its block has ended without an error; one below another waits for that one."""
        run_id = self.start(name, parameters, parent)
        yield run_id
        if parent is None:
            self.finish(run_id)

    def values(self, run_id: str, values: dict[str, float]) -> None:
        rows = [(run_id, k, float(v)) for k, v in values.items()]
        self._append("metrics", self.spark.createDataFrame(rows, TABLES["metrics"]))

    def metrics(self, run_id: str, rows: DataFrame) -> None:
        """``metric, value`` rows and whatever else they carry is left out."""
        self._named("metrics", run_id, rows)

    def importances(self, run_id: str, table: DataFrame) -> None:
        self._named("importances", run_id, table)

    def curves(self, run_id: str, curve: DataFrame) -> None:
        self._named("curves", run_id, curve)

    def calibration(self, run_id: str, points: DataFrame, stage: str) -> None:
        self._named("calibration", run_id, points.withColumn("stage", F.lit(stage)))

    def read(self, table: str) -> DataFrame:
        """Rows of the finished runs."""
        rows = self._read(table, TABLES[table])
        return rows.join(self._read("manifest", MANIFEST).select("run_id").distinct(), "run_id", "left_semi")

    def _named(self, table: str, run_id: str, rows: DataFrame) -> None:
        schema = self.spark.createDataFrame([], TABLES[table]).schema
        columns = [F.col(f.name).cast(f.dataType) for f in schema if f.name != "run_id"]
        self._append(table, rows.select(F.lit(run_id).alias("run_id"), *columns))

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/{table}/{uuid.uuid4().hex}")

    def _read(self, table: str, schema: str) -> DataFrame:
        if not table_exists(self.spark, f"{self.path}/{table}/*"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}/*")

"""Steps of a job that are stored when they end, so that a second start takes up where the first
one stopped."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from halyard.sources.models import load_model, save_model
from halyard.sources.tables import materialise

_IDENTITY = "job"


class DifferentJobError(ValueError):
    """The output folder holds the steps of another job."""


class Steps:
    """The steps below ``output``: tables and models in folders of their own, and actions.

    A step counts as done once its mark is written, which is after its data: a driver that dies in
    between leaves a step that is made again. With ``resume`` done steps are read instead of
    made, if they belong to a job of the same ``identity``; without it all are made anew.
    """

    def __init__(
        self, spark: SparkSession, output: str, identity: Mapping[str, object], resume: bool
    ):
        self.spark, self.output = spark, output
        self._marks = f"{output}/_steps"
        known = json.dumps(dict(identity), sort_keys=True, default=str)
        if not resume:
            self._files(self._marks).delete(self._path(self._marks), True)
        elif self.done(_IDENTITY) and self._read(_IDENTITY) != known:
            raise DifferentJobError(f"{output} holds steps of {self._read(_IDENTITY)}, not {known}")
        if not self.done(_IDENTITY):
            self._write(_IDENTITY, known)

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _write(self, name: str, text: str) -> None:
        path = f"{self._marks}/{name}"
        stream = self._files(path).create(self._path(path), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _read(self, name: str) -> str:
        return self.spark.read.text(f"{self._marks}/{name}", wholetext=True).first()[0]

    def done(self, name: str) -> bool:
        path = f"{self._marks}/{name}"
        return self._files(path).exists(self._path(path))

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stored table of a step; ``make`` gives it where it is not done."""
        path = f"{self.output}/{name}"
        if self.done(name):
            return self.spark.read.parquet(path)
        stored = materialise(make(), path)
        self._write(name, "")
        return stored

    def model(self, name: str, make: Callable[[], PipelineModel]) -> PipelineModel:
        """The stored model of a step; ``make`` fits it where it is not done."""
        path = f"{self.output}/{name}"
        if self.done(name):
            return load_model(path)
        fitted = make()
        save_model(fitted, path)
        self._write(name, "")
        return fitted

    def once(self, name: str, action: Callable[[], object]) -> None:
        """An action whose result lies outside the steps, such as a report; not repeated once done."""
        if not self.done(name):
            action()
            self._write(name, "")

"""The folder of one run: its stages as Parquet tables, a manifest of the whole ones, removal at the end.

A run that lost its driver is started again with the same folder and goes on after the last whole stage.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Workspace:
    """Stages under ``folder``, which every executor reaches.

    ``identity`` says what the run is (its settings and the columns it reads).  A folder that holds the stages
    of another run raises ``ValueError``; that the rows of the input are the same is the caller's to see to.
    A stage is in the manifest only when all its tables are written, so a half-written one is written again.
    """

    def __init__(self, spark: SparkSession, folder: str, identity: object = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        identity = json.loads(json.dumps(identity, default=str))
        if not self._fs.exists(self._path("manifest.json")):
            self._manifest = {"identity": identity, "stages": {}}
            return
        text = spark.read.text(f"{self.folder}/manifest.json", wholetext=True).first()[0]
        self._manifest = json.loads(text)
        if self._manifest["identity"] != identity:
            raise ValueError(f"{folder} holds the stages of another run")

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.folder}/{name}" if name else self.folder)

    @property
    def stages(self) -> list[str]:
        """Whole stages, in the order in which they were written."""
        return list(self._manifest["stages"])

    def stage(self, name: str, build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """The tables of a stage, read back; ``build`` is called only if the stage is not whole yet."""
        if name not in self._manifest["stages"]:
            tables = build()
            for table, df in tables.items():
                df.write.mode("overwrite").parquet(f"{self.folder}/{name}/{table}")
            self._manifest["stages"][name] = list(tables)
            self._save()
        return {t: self.spark.read.parquet(f"{self.folder}/{name}/{t}") for t in self._manifest["stages"][name]}

    def _save(self) -> None:
        """The new manifest beside the old one, then in its place: a reader finds one that is whole or none."""
        out = self._fs.create(self._path("manifest.new"), True)
        out.write(bytearray(json.dumps(self._manifest).encode()))
        out.close()
        self._fs.delete(self._path("manifest.json"), False)
        if not self._fs.rename(self._path("manifest.new"), self._path("manifest.json")):
            raise OSError(f"cannot write the manifest in {self.folder}")

    def remove(self) -> None:
        """The folder goes, when the results stand elsewhere."""
        self._fs.delete(self._path(""), True)

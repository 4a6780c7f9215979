"""The folder of one run: stage tables written once, the journal of its calls, its objects.

A stage table that is already whole is read instead of made again, and calls in the journal are not
repeated, so a run that broke goes on from the folder it left: with the same folder, the same ids, the
same calls and the same files. A folder belongs to one set of requests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from castwright.session import drop_folder, ensure_checkpoint_dir, is_whole


class RunFolder:
    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}").rstrip("/")

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def journal(self, name: str) -> str:
        return self.at(f"calls/{name}")

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage table, made and written unless a whole one is there."""
        path = self.at(f"tables/{name}")
        if not is_whole(self.spark, path):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def drop(self) -> None:
        """Remove the folder and all that it holds."""
        drop_folder(self.spark, self.path)

"""Places reached in a change log, by name, and changes kept aside: small tables that survive a lost driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.sources.records import exists

ROW = "name string, seq bigint, written bigint"
PARKED = "seq bigint, ts double, namespace string, doc_id string, reason string"


class Cursors:
    """Each set appends a row, so a failure never loses the place before it; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(ROW).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], ROW)

    def all(self) -> DataFrame:
        """(name, seq): where each cursor stands."""
        return self._rows().groupBy("name").agg(F.max_by("seq", "written").alias("seq"))

    def get(self, name: str) -> int:
        """0 for a name that was never set."""
        found = self.all().where(F.col("name") == name).first()
        return found["seq"] if found else 0

    def set(self, name: str, seq: int) -> None:
        last = self._rows().agg(F.coalesce(F.max("written"), F.lit(0)).alias("n")).first()["n"]
        self.spark.createDataFrame([(name, seq, last + 1)], ROW).coalesce(1).write.mode("append").parquet(self.path)


class Unapplied:
    """Changes that a replay kept aside. One that is parked again replaces its row."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def park(self, parked: DataFrame, now: float) -> None:
        """parked: seq, namespace, doc_id, reason."""
        parked.select("seq", F.lit(float(now)).alias("ts"), "namespace", "doc_id", "reason").write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], PARKED)
        rows = self.spark.read.schema(PARKED).parquet(self.path)
        return rows.groupBy("seq").agg(F.max_by(F.struct("ts", "namespace", "doc_id", "reason"), "ts").alias("x")).select("seq", "x.*")

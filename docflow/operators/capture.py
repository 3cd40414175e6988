"""Writing to a source so that every write also stands in the change log: the source first, the log second.

Whatever could reach the source without its changes being known one by one is refused before anything is written.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.values import parse_metadata
from docflow.operators import changelog
from docflow.sources.records import exists

LOG = "seq bigint, ts double, namespace string, doc_id string, op string, values array<double>, metadata map<string,variant>"
RECORD = "id string, values array<double>, metadata string"
#: Writes of an index that name no single record.
REFUSED = ("upsert_from_dataframe", "upsert_records", "delete_namespace", "start_import")


class CaptureError(ValueError):
    """A write that cannot be captured."""


def normalized(spark: SparkSession, items: DataFrame | Iterable) -> DataFrame:
    """id, values array<double>, metadata map<string,variant> of records as a table, or as mappings, tuples (id, values, metadata), rows or objects.

    Null values become an empty vector and null metadata an empty map; a record without an id raises. A table may hold
    any number of rows, its metadata as JSON texts or maps; other columns are left out.
    """
    if not isinstance(items, DataFrame):
        found = []
        for item in items:
            if isinstance(item, Mapping):
                i, v, m = (item.get(k) for k in ("id", "values", "metadata"))
            elif isinstance(item, tuple) and not hasattr(item, "__fields__"):
                i, v, m = (*item, None, None)[:3]
            else:
                i, v, m = (getattr(item, k, None) for k in ("id", "values", "metadata"))
            found.append((i, [float(x) for x in (() if v is None or callable(v) else v)], json.dumps(dict(m or {}))))
        items = spark.createDataFrame(found, RECORD)
    meta = F.col("metadata")
    kind = items.schema["metadata"].dataType.simpleString()
    if kind == "string":
        meta = parse_metadata(meta)
    elif kind != "map<string,variant>":
        meta = parse_metadata(F.to_json(meta))
    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    out = items.select(F.col("id").cast("string").alias("id"), F.coalesce(F.col("values").cast("array<double>"), F.array().cast("array<double>")).alias("values"), F.coalesce(meta, empty).alias("metadata"))
    if not out.where(F.coalesce("id", F.lit("")) == "").isEmpty():
        raise CaptureError("a record has no id")
    return out


class Capture:
    """write(op, namespace, rows) changes the source; the log is a folder of Parquet files that one writer appends to.

    A call is one write to the source and one append. If the append fails the call raises: the source is then ahead of
    the log, and calling again is safe, for upserts, updates and deletes by id may be repeated.
    """

    def __init__(self, spark: SparkSession, write: Callable[[str, str, DataFrame], None], log_path: str, namespace: str = "__default__", clock: Callable[[], float] = time.time):
        self.spark, self.write, self.log_path, self.namespace, self.clock = spark, write, log_path, namespace, clock

    def __getattr__(self, name: str):
        if name in REFUSED:
            raise CaptureError(f"{name} would pass the log by; use upsert, update or delete")
        raise AttributeError(name)

    def log(self) -> DataFrame:
        if not exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(self.log_path)

    def _both(self, op: str, namespace: str | None, rows: DataFrame) -> int:
        """rows: doc_id, values, metadata. Returns how many changes were logged; none for no rows, which write nothing."""
        if rows.isEmpty():
            return 0
        ns = namespace or self.namespace
        self.write(op, ns, rows)
        changes = rows.withColumns({"namespace": F.lit(ns), "op": F.lit(op), "order": F.struct("doc_id", F.monotonically_increasing_id())})
        logged = changelog.append(self.log(), changes, self.clock())
        logged.write.mode("append").parquet(self.log_path)
        return rows.count()

    def upsert(self, records: DataFrame | Iterable, namespace: str | None = None, **more) -> int:
        if "batch_size" in more:
            raise CaptureError("batch_size splits a call, and a failure between its parts would leave some of them out of the log; make one call a batch")
        _known(more)
        return self._both("upsert", namespace, normalized(self.spark, records).withColumnRenamed("id", "doc_id"))

    def update(self, id: str | None = None, values: Iterable[float] | None = None, set_metadata: Mapping | None = None, namespace: str | None = None, filter: Mapping | None = None, **more) -> int:
        if filter or not id:
            raise CaptureError("an update by a filter names no record; find the ids first and update each")
        if more.pop("dry_run", False):
            raise CaptureError("dry_run has no effect on an update by id, which would be written and not logged")
        _known(more)
        vector = None if values is None else [float(x) for x in values]
        row = self.spark.createDataFrame([(id, vector, json.dumps(dict(set_metadata or {})))], RECORD)
        return self._both("update", namespace, row.select(F.col("id").alias("doc_id"), "values", parse_metadata(F.col("metadata")).alias("metadata")))

    def delete(self, ids: DataFrame | Iterable[str] | None = None, namespace: str | None = None, delete_all: bool = False, filter: Mapping | None = None, **more) -> int:
        """ids: texts, or a table with a column id."""
        if delete_all or filter:
            raise CaptureError("a delete of all, or by a filter, names no record; find the ids first")
        _known(more)
        if ids is None:
            return 0
        rows = ids.select("id") if isinstance(ids, DataFrame) else self.spark.createDataFrame([(i,) for i in ids], "id string")
        return self._both("delete", namespace, rows.select(F.col("id").alias("doc_id"), F.lit(None).cast("array<double>").alias("values"), F.lit(None).cast("map<string,variant>").alias("metadata")))


def _known(more: dict) -> None:
    if more:
        raise CaptureError(f"cannot be captured: {', '.join(sorted(more))}")

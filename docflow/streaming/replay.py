"""Following a change log with Structured Streaming: each micro-batch is folded and merged into a new version of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docflow.operators import changelog, replay

LOG = "seq bigint, ts double, namespace string, doc_id string, op string, values array<double>, metadata map<string,string>"
DOCUMENTS = "namespace string, doc_id string, values array<double>, metadata map<string,string>"


class Versions:
    """Documents in folders v=0, v=1 and so on; the last complete one is the present. Works on any store that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self.hadoop = jvm.org.apache.hadoop.fs.Path
        self.fs = self.hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folder(self, version: int) -> str:
        return f"{self.path}/v={version:09d}"

    def versions(self) -> list[int]:
        root = self.hadoop(self.path)
        if not self.fs.exists(root):
            return []
        names = [s.getPath() for s in self.fs.listStatus(root) if s.getPath().getName().startswith("v=")]
        return sorted(int(p.getName()[2:]) for p in names if self.fs.exists(self.hadoop(p, "_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        found = [v for v in self.versions() if before is None or v < before]
        if not found:
            return self.spark.createDataFrame([], DOCUMENTS)
        return self.spark.read.schema(DOCUMENTS).parquet(self.folder(found[-1]))

    def write(self, documents: DataFrame, version: int) -> None:
        """Replaces the version as a whole, so a batch that runs again after a failure does no harm; only the one before stays besides."""
        documents.write.mode("overwrite").parquet(self.folder(version))
        for v in self.versions():
            if v < version - 1:
                self.fs.delete(self.hadoop(self.folder(v)), True)


def follow(spark: SparkSession, log_path: str, target_path: str, checkpoint: str, namespace: str | None = None, text_key: str | None = None, interval: str | None = None):
    """Starts a query over new files of the log: once over what is there, or every interval. Windows are the micro-batches."""
    target = Versions(spark, target_path)

    def merge(batch: DataFrame, number: int) -> None:
        actions, parked = replay.park(changelog.fold(batch, 0, None, namespace), text_key)
        target.write(replay.merge(target.read(before=number), actions), number)
        if text_key is not None:
            parked.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}.parked/v={number:09d}")

    writer = spark.readStream.schema(LOG).parquet(log_path).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

"""Reading and writing collections: exports in Parquet, documents in JSON lines, namespaces as folders."""

from __future__ import annotations

import json
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.values import parse_metadata
from docflow.operators.batching import by_count
from docflow.sources.settings import struct_type

EXPORT = "id string, values array<float>, metadata string"


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """id, values array<double>, metadata map<string,variant>, bad_json: metadata that are no JSON object."""
    raw = spark.read.schema(EXPORT).parquet(path)
    parsed = parse_metadata(F.col("metadata"))
    found = raw.withColumn("_parsed", parsed).withColumn("bad_json", F.col("metadata").isNotNull() & F.col("_parsed").isNull())
    return found.select("id", F.col("values").cast("array<double>").alias("values"), F.col("_parsed").alias("metadata"), "bad_json")


def export(records: DataFrame, path: str, rows_per_file: int = 25_000, include_text: bool = True, text_key: str = "text", snapshot_seq: int = 0, namespace: str = "__default__", now: float = 0.0) -> dict:
    """Writes id, values and metadata as JSON in Parquet files of at most rows_per_file rows, and returns the manifest, also written beside them."""
    meta = F.col("metadata") if include_text else F.map_filter("metadata", lambda k, _: k != text_key)
    out = records.select("id", F.col("values").cast("array<float>").alias("values"), F.to_json(meta).alias("metadata"))
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    spark = records.sparkSession
    written = spark.read.schema(EXPORT).parquet(path).select(F.input_file_name().alias("f")).agg(F.count("*").alias("rows"), F.count_distinct("f").alias("files")).first()
    manifest = {"namespace": namespace, "rows": written["rows"], "files": written["files"], "include_text": include_text, "snapshot_seq": snapshot_seq, "exported_at": now}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.manifest")
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path.rstrip('/')}.manifest").first()["value"])


def sharded(json_lines: DataFrame, order: str, rows_per_file: int = 25_000) -> DataFrame:
    """Adds shard: consecutive runs of exactly rows_per_file rows in the given order; the last may be shorter."""
    return by_count(json_lines, order, rows_per_file, "shard")


def write_json_lines(json_lines: DataFrame, path: str, order: str = "id", rows_per_file: int = 25_000, gzip: bool = True) -> None:
    """json_lines: value and the order column. One folder for each shard, replacing what was there."""
    out = sharded(json_lines, order, rows_per_file).select("shard", "value")
    out.repartition(F.col("shard")).write.mode("overwrite").partitionBy("shard").option("compression", "gzip" if gzip else "none").text(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(shard, value) of every line that is not blank, from plain and gzip files; shard is null for files in no shard's folder."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    shard = F.nullif(F.regexp_extract(F.input_file_name(), r"shard=(\d+)", 1), F.lit("")).cast("long")
    return raw.select(shard.alias("shard"), F.trim("value").alias("value")).where("value <> ''")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on any store that Spark reads; a store that cannot be asked raises."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)


def write_namespace(documents: DataFrame, path: str, must_be_absent: bool = False) -> None:
    """One folder for each namespace; with must_be_absent a namespace that is there already is an error, before any row is written."""
    if must_be_absent and exists(documents.sparkSession, path):
        known = documents.sparkSession.read.schema(documents.schema).parquet(path).select("namespace").distinct()
        taken = documents.select("namespace").distinct().join(known.withColumnRenamed("namespace", "known"), F.col("namespace").eqNullSafe(F.col("known"))).orderBy("namespace").first()
        if taken:
            raise ValueError(f"namespace {taken['namespace']!r} is there already; an import only makes new ones")
    documents.write.mode("append").partitionBy("namespace").parquet(path)


def create_collection(spark: SparkSession, path: str, schema: dict) -> bool:
    """Makes an empty collection of the declared fields beside namespace and metadata, unless there is one; tells whether it did."""
    if exists(spark, path):
        return False
    kind = struct_type(schema).add("metadata", "string").add("namespace", "string")
    spark.createDataFrame([], kind).write.parquet(path)
    return True


def describe(records: DataFrame, name: str, metric: str = "cosine") -> DataFrame:
    """One row: name, dimension (of the longest vector, null if there is none), metric, uniform (all vectors are of one length).

    The metric is the one that the column values declares in its metadata, else the given one.
    """
    declared = records.schema["values"].metadata.get("metric", metric)
    sizes = F.nullif(F.size("values"), F.lit(0))
    return records.where("values is not null").agg(F.max(sizes).cast("long").alias("dimension"), F.coalesce(F.min(sizes) == F.max(sizes), F.lit(True)).alias("uniform")).select(F.lit(name).alias("name"), "dimension", F.lit(declared).alias("metric"), "uniform")


def parse_uri(uri: str) -> tuple[str, str, str]:
    """(store, bucket, prefix) of an s3, gs or https address."""
    u = urlparse(uri)
    if u.scheme not in ("s3", "gs", "https") or not u.netloc:
        raise ValueError(f"not an address of an object store: {uri!r}")
    return "azure" if u.scheme == "https" else u.scheme, u.netloc, u.path.strip("/")


def scan_ids(records: DataFrame, namespace: str | None = None, limit: int | None = None) -> DataFrame:
    out = (records if namespace is None else records.where(F.col("namespace") == namespace)).select("id")
    return out if limit is None else out.orderBy("id").limit(limit)


def fetch(records: DataFrame, ids: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """The records of given ids, with the named fields only; absent ids have no row."""
    found = records.join(ids.select("id").distinct(), "id", "left_semi")
    return found if fields is None else found.select("id", *[f for f in fields if f != "id"])


def join_text(records: DataFrame, texts: DataFrame, text_key: str = "text") -> DataFrame:
    """Puts texts (id, text), kept elsewhere, into the metadata of records, a map of texts or variants."""
    both = records.join(texts.select("id", F.col("text").alias("_text")), "id", "left")
    kind = records.schema["metadata"].dataType.valueType.simpleString()
    value = F.col("_text").cast(kind) if kind != "variant" else F.to_variant_object(F.array("_text"))
    if kind == "variant":
        value = F.variant_get(value, "$[0]", "variant")
    added = F.map_concat(F.map_filter("metadata", lambda k, _: k != text_key), F.create_map(F.lit(text_key), value))
    return both.withColumn("metadata", F.when(F.col("_text").isNotNull(), added).otherwise(F.col("metadata"))).drop("_text")

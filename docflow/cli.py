"""python -m docflow.cli: the phases of a move as commands over folders."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from docflow.operators import changelog, mapping, reconcile, routing
from docflow.sources import records, settings, synthetic
from docflow.streaming.replay import LOG, Versions, follow


def session() -> SparkSession:
    return SparkSession.builder.appName("docflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docflow")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *args: str, **more):
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a)
        for a, default in more.items():
            s.add_argument(f"--{a.replace('_', '-')}", default=default, type=type(default) if default is not None else str, dest=a)
        return s

    add("simulate", "out", records=2000, dimension=384)
    add("convert", "export", "out", settings=None, error_mode="strict", dimension=0)
    add("schema", "settings", dimension=384, metric="cosine")
    add("replay", "log", "target", "checkpoint", namespace=None, text_key=None)
    add("tail", "log", "target", "checkpoint", namespace=None, text_key=None, interval="5 seconds", duration=0.0)
    add("reconcile", "export", "target")
    add("status", "log", cursor=0)
    add("cutover", "state", mode=None, pct=None)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "schema":
        print(json.dumps(settings.build_schema(settings.load(a.settings), a.dimension, a.metric), indent=2))
        return 0
    if a.command == "cutover":
        state = routing.Cutover.load(a.state)
        if a.mode or a.pct is not None:
            state = state.moved(a.mode, None if a.pct is None else float(a.pct))
            state.save(a.state)
        print(state)
        return 0
    spark = session()
    if a.command == "simulate":
        print(records.export(synthetic.records(spark, a.records, a.dimension), a.out, now=time.time()))
    elif a.command == "convert":
        s = settings.load(a.settings) if a.settings else settings.Settings()
        m = mapping.Mapping(s.target.dense_field, s.target.text_fields, a.dimension or None, s.rename_fields, s.drop_fields)
        mapped = mapping.map_records(records.read_export(spark, a.export), m)
        good = mapping.strict(mapped) if a.error_mode == "strict" else mapping.documents(mapped)
        records.write_json_lines(good.select("id", mapping.document_json(m).alias("value")), a.out, "id", s.rows_per_file, s.gzip)
        mapping.mapping_stats(mapped).show()
    elif a.command in ("replay", "tail"):
        q = follow(spark, a.log, a.target, a.checkpoint, a.namespace, a.text_key, a.interval if a.command == "tail" else None)
        q.awaitTermination(*([a.duration] if a.command == "tail" and a.duration else []))
        q.stop()
    elif a.command == "reconcile":
        source = records.read_export(spark, a.export)
        target = Versions(spark, a.target).read().select(F.col("doc_id").alias("id"), "values", F.element_at("metadata", F.lit("text")).alias("text"), "metadata")
        texts = source.withColumn("metadata", F.transform_values("metadata", lambda _, v: F.try_variant_get(v, "$", "string")))
        found = reconcile.verdict(texts, target, reconcile.diff_fields(texts, target, canonical_of=lambda v: v)).first()
        print(found)
        return 0 if found["ok"] else 1
    elif a.command == "status":
        log = spark.read.schema(LOG).parquet(a.log)
        print(changelog.head_seq(log).first(), changelog.lag(log, a.cursor, time.time()).first())
    return 0


if __name__ == "__main__":
    sys.exit(main())

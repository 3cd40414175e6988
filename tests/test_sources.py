import json

import pytest
from pyspark.sql import functions as F

from docflow import cli
from docflow.sources import records as R
from docflow.sources import settings as S
from docflow.sources import synthetic
from docflow.streaming.replay import LOG, Versions, follow


def test_export_and_back(spark, tmp_path):
    r = synthetic.records(spark, 25, 8, 10)
    manifest = R.export(r, str(tmp_path / "x"), rows_per_file=10, include_text=False)
    back = R.read_export(spark, str(tmp_path / "x"))
    assert manifest["rows"] == 25 == back.count() and R.read_manifest(spark, str(tmp_path / "x"))["include_text"] is False
    assert back.where(F.map_contains_key("metadata", "text")).count() == 0 and back.where("bad_json").count() == 0
    assert synthetic.records(spark, 25, 8, 10).orderBy("id").collect() == r.orderBy("id").collect()


def test_json_lines_in_shards(spark, tmp_path):
    df = spark.range(10).select(F.format_string("%02d", "id").alias("id"), F.to_json(F.struct("id")).alias("value"))
    for size in (7, 4):  # the second write replaces the first
        R.write_json_lines(df, str(tmp_path / "j"), "id", size)
    got = R.read_json_lines(spark, str(tmp_path / "j"))
    assert [r["count"] for r in got.groupBy("shard").count().orderBy("shard").collect()] == [4, 4, 2] and got.count() == 10


def test_scans(spark):
    r = spark.createDataFrame([("a", "n", 1), ("b", "m", 2)], "id string, namespace string, v int")
    assert [x["id"] for x in R.scan_ids(r, "m").collect()] == ["b"] and R.scan_ids(r, limit=0).count() == 0 and R.scan_ids(r, limit=1).count() == 1
    assert R.fetch(r, r.where("id = 'a'").unionByName(r.select(F.lit("zz").alias("id"), "namespace", "v")), ["v"]).collect() == [("a", 1)]
    assert R.parse_uri("s3://b/p/q") == ("s3", "b", "p/q") and R.parse_uri("https://h/x")[0] == "azure"
    with pytest.raises(ValueError):
        R.parse_uri("/local")


def test_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("HERE", "yes")
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"source": {"index": "${HERE}-${GONE}"}, "target": {"text_fields": {"body": None, "sku": {"ngram": {"min_gram": 3, "max_gram": 4}}}, "full_text_search": {"language": "en"}}, "export": {"rows_per_file": 5}}))
    s = S.load(str(path))
    assert s.source.index == "yes-" and s.unresolved == {"GONE"} and s.rows_per_file == 5 and s.target.text_fields == ("body", "sku")
    schema = S.build_schema(s, 4)
    assert schema["fields"]["body"]["full_text_search"] == {"language": "en"} and schema["fields"]["embedding"]["dimension"] == 4
    assert S.struct_type(schema)["embedding"].metadata == {"dimension": 4, "metric": "cosine"}
    path.write_text('{"source": {"speed": 1}}')
    with pytest.raises(S.ConfigError):
        S.load(str(path))
    for bad in ("[]", "{", '{"fields": {}}', '{"fields": {"_a": {"type": "string"}}}', '{"fields": {"v": {"type": "dense_vector"}}}', '{"fields": {"t": {"type": "string", "full_text_search": {}}}}'):
        path.write_text(bad)
        with pytest.raises(S.ConfigError):
            S.load_schema(str(path))
    with pytest.raises(S.ConfigError):
        S.build_schema(S.Settings(target=S.Target(schema={"fields": {"v": {"type": "dense_vector", "dimension": 3}}})), 4)
    with pytest.raises(S.ConfigError):
        S.check_analyzer({"ngram": {"min_gram": 2, "max_gram": 3}, "stemming": True})


def test_stream_follows_a_log(spark, tmp_path):
    log, target, state = (str(tmp_path / x) for x in ("log", "target", "state"))
    add = lambda *rows: spark.createDataFrame([(s, 0.0, "n", i, op, v, m) for s, i, op, v, m in rows], LOG).write.mode("append").parquet(log)
    run = lambda: follow(spark, log, target, state).awaitTermination()
    add((1, "a", "upsert", [1.0], {"t": "x"}), (2, "b", "upsert", [2.0], {"t": "y"}))
    run()
    add((3, "a", "update", None, {"t": "z"}), (4, "b", "delete", None, None))
    run()
    run()
    docs = Versions(spark, target).read().collect()
    assert [(r["doc_id"], r["values"], r["metadata"]) for r in docs] == [("a", [1.0], {"t": "z"})]


def test_command_line(tmp_path, capsys):
    assert cli.main(["cutover", str(tmp_path / "c.json"), "--pct", "5"]) == 0 and "ramp" in capsys.readouterr().out


def test_workload(spark):
    mix = synthetic.workload_stats(synthetic.workload(spark, 4000, 100)).first()
    assert 0.5 < mix["inserts"] / 4000 < 0.6 and mix["writes"] == 4000 - mix["querys"]
    assert synthetic.workload_stats(synthetic.workload(spark, 50, 0)).first()["inserts"] == 50


def test_collections_and_namespaces(spark, tmp_path):
    from docflow.sources import records

    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([("a", "x"), ("01", "y"), (None, "z")], "namespace string, id string")
    records.write_namespace(docs.where("namespace = 'a'"), path, must_be_absent=True)
    records.write_namespace(docs.where("namespace = '01'"), path, must_be_absent=True)
    for again in ("namespace = 'a'", "namespace = '01'", "namespace in ('a', 'b')"):
        with pytest.raises(ValueError, match="there already"):
            records.write_namespace(docs.where(again), path, must_be_absent=True)
    records.write_namespace(docs.where("namespace is null"), path, must_be_absent=True)
    with pytest.raises(ValueError):
        records.write_namespace(docs.where("namespace is null"), path, must_be_absent=True)
    assert spark.read.schema(docs.schema).parquet(path).count() == 3
    schema = {"fields": {"v": {"type": "dense_vector", "dimension": 2}, "t": {"type": "string"}}}
    assert records.create_collection(spark, str(tmp_path / "new"), schema) and not records.create_collection(spark, str(tmp_path / "new"), schema)
    assert spark.read.parquet(str(tmp_path / "new")).columns == ["_id", "v", "t", "metadata", "namespace"]


def test_description_of_a_source(spark):
    from docflow.sources import records

    df = spark.createDataFrame([([1.0, 2.0],), (None,), ([1.0],)], "values array<double>")
    assert tuple(records.describe(df, "x", "dotproduct").first()) == ("x", 2, "dotproduct", False)
    assert tuple(records.describe(df.where("false"), "x").first()) == ("x", None, "cosine", True)


def test_state_follows_its_file(tmp_path):
    from docflow.operators.routing import Cutover

    path = str(tmp_path / "state.json")
    held = Cutover.load(path)
    Cutover("ramp", 30.0, "go").save(path)
    assert held.reload(path) is held and (held.mode, held.target_read_pct) == ("ramp", 30.0)
    (tmp_path / "state.json").write_text('{"mode": "none"}')
    with pytest.raises(ValueError):
        held.reload(path)
    assert held.mode == "ramp"


def test_passing_failures_are_retried():
    from docflow.sources.retry import with_retry

    waits, left = [], [TimeoutError(), ConnectionError()]
    assert with_retry(lambda: left and (_ for _ in ()).throw(left.pop()) or "done", sleep=waits.append) == "done" and waits == [2.0, 4.0]

    def bad(kind, calls):
        calls.append(1)
        raise kind

    for kind, tries in ((ValueError, 1), (TimeoutError, 4)):
        calls = []
        with pytest.raises(kind):
            with_retry(lambda: bad(kind, calls), sleep=waits.append)
        assert len(calls) == tries

import json

import pytest
from pyspark.sql import functions as F

from docflow.functions.values import canonical, parse_metadata
from docflow.operators import batching, mapping
from docflow.operators.mapping import Limits, Mapping


def records(spark, *rows):
    df = spark.createDataFrame([(i, v, json.dumps(m) if isinstance(m, dict) else m) for i, v, m in rows], "id string, values array<double>, m string")
    return df.withColumn("metadata", parse_metadata(F.col("m")))


def codes(spark, rows, m=Mapping(dimension=3)):
    return {r["id"]: r["error_code"] for r in mapping.map_records(records(spark, *rows), m).collect()}


V = [0.1, 0.2, 0.3]


def test_each_check_and_their_order(spark):
    rows = [
        ("ok", V, {"text": "hello world", "year": 2024}), ("", V, {"text": "x"}), ("i" * 512, V, {"text": "x"}), ("j" * 513, V, {"text": "x"}), ("none", None, {"text": "x"}), ("short", [1.0, 2.0], {"text": "x"}),
        ("reserved", V, {"text": "x", "_internal": 1}), ("dollar", V, {"text": "x", "$a": 1}), ("long", V, {"text": "x", "n" * 65: 1}), ("fits", V, {"text": "x", "n" * 64: 1}), ("wide", V, {"text": "x", "é" * 33: 1}),
        ("numbers", V, {"text": "x", "scores": [1, 2]}), ("texts", V, {"text": "x", "tags": ["a", "b"]}), ("empty", V, {"text": "x", "tags": []}), ("nested", V, {"text": "x", "o": {"a": 1}}), ("clash", V, {"text": "x", "embedding": 1}),
        ("untold", V, {"year": 1}), ("blank", V, {"text": ""}), ("number", V, {"text": 5}), ("null", V, {"text": "x", "_gone": None}), ("no metadata", V, None),
    ]
    assert codes(spark, rows) == {
        "ok": None, "": "empty_id", "i" * 512: None, "j" * 513: "id_too_long", "none": "no_dense_values", "short": "wrong_dimension", "reserved": "bad_name:_internal", "dollar": "bad_name:$a", "long": "bad_name:" + "n" * 65,
        "fits": None, "wide": "bad_name:" + "é" * 33, "numbers": "list_of_non_strings:scores", "texts": None, "empty": None, "nested": "unsupported_type:o", "clash": "name_collision:embedding", "untold": "missing_text", "blank": "missing_text",
        "number": "missing_text", "null": None, "no metadata": "missing_text",
    }


def test_limits_at_their_edges(spark):
    m = Mapping(limits=Limits(text_bytes=10, text_tokens=3, metadata_bytes=30))
    rows = [("10", V, {"text": "é" * 5}), ("12", V, {"text": "é" * 6}), ("3 tokens", V, {"text": "a b c"}), ("4 tokens", V, {"text": "a b c\x1cd"}), ("30", V, {"text": "x", "k": "v" * 21}), ("31", V, {"text": "x", "k": "v" * 22}), ("esc", V, {"text": "x", "k": "é" * 5})]
    assert len(json.dumps({"k": "v" * 21})) == 30
    assert codes(spark, rows, m) == {"10": None, "12": "text_too_large:text", "3 tokens": None, "4 tokens": "too_many_tokens:text", "30": None, "31": "metadata_too_large", "esc": "metadata_too_large"}


def test_rename_drop_and_last_of_equal_names(spark):
    m = Mapping(rename={"body": "text", "a": "z", "b": "z"}, drop=("junk",))
    df = mapping.documents(mapping.map_records(records(spark, ("1", V, {"body": "hello", "junk": 1, "a": 1, "b": 2})), m))
    row = df.select("texts.text", F.map_keys("meta").alias("k"), canonical(F.element_at("meta", F.lit("z"))).alias("z")).first()
    assert (row["text"], row["k"], row["z"]) == ("hello", ["z"], "n:2.0")


def test_policies_and_counts(spark):
    df = records(spark, ("1", V, {"text": "x"}), ("2", V, {}), ("3", None, {"text": "x"}))
    stats = mapping.mapping_stats(mapping.map_records(df, Mapping(allow_missing_text=True))).first().asDict()
    assert stats == {"rows": 3, "converted": 1, "skipped_missing_text": 1, "failed": 1}
    with pytest.raises(mapping.MappingError, match="2: missing_text"):
        mapping.strict(mapping.map_records(df, Mapping()))
    assert [tuple(r) for r in mapping.first_errors(mapping.map_records(df)).collect()] == [("2", "missing_text"), ("3", "no_dense_values")]
    assert mapping.mapping_stats(mapping.map_records(df.where("false"))).first()["rows"] == 0


def test_json_is_flat_and_last_key_wins(spark):
    df = records(spark, ("1", [0.5], '{"text": "t", "a": 1, "a": 2, "l": ["x"]}'))
    out = mapping.map_records(df).select(mapping.document_json(Mapping()).alias("j")).first()["j"]
    assert json.loads(out) == {"_id": "1", "embedding": [0.5], "text": "t", "a": 2, "l": ["x"]}


def test_malformed_metadata_is_null(spark):
    df = spark.createDataFrame([("{bad",), ("[1]",), (None,), ("{}",)], "m string").select(parse_metadata(F.col("m")).alias("p"))
    assert [r["p"] is None for r in df.collect()] == [True, True, True, False]


def test_patches_check_names_and_types_only(spark):
    got = {r["id"]: r["error_code"] for r in mapping.map_patches(records(spark, ("1", None, {"year": 1}), ("2", [1.0], {"_x": 1}))).collect()}
    assert got == {"1": None, "2": "bad_name:_x"}


def test_canonical_values(spark):
    rows = [r[0] for r in spark.createDataFrame([('{"a": 2024}',), ('{"a": 2024.0}',), ('{"a": "2024"}',), ('{"a": true}',), ('{"a": 1}',), ('{"a": null}',)], "m string").select(canonical(F.element_at(parse_metadata(F.col("m")), F.lit("a")))).collect()]
    assert rows[0] == rows[1] != rows[2] and rows[3] == rows[4] and rows[5] is None


def test_batches(spark):
    df = spark.range(500).withColumn("g", F.lit(0))
    sizes = batching.batch_sizes(batching.by_count(df, "id", 200)).orderBy("batch").collect()
    assert [r["rows"] for r in sizes] == [200, 200, 100]
    packed = batching.by_bytes(spark.range(2500).select("id", F.lit(0).alias("g"), F.lit(10).cast("long").alias("b")), "g", "id", "b", most_rows=5000)
    assert [r["rows"] for r in batching.batch_sizes(packed).orderBy("batch").collect()] == [1000, 1000, 500]
    big = spark.createDataFrame([(0, 0, 5), (0, 1, 100), (0, 2, 5), (0, 3, 5)], "g int, id long, b long")
    assert [r["batch"] for r in batching.by_bytes(big, "g", "id", "b", most_bytes=50).orderBy("id").collect()] == [0, 1, 2, 2]
    assert batching.by_count(df.where("false"), "id", 3).count() == 0

"""What reconciliation deals out: digests, not texts, and as much whether tables are small enough for a broadcast or not."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from docflow.operators import reconcile
from docflow.plans import catalogue

N, WITH_VECTORS, CHARS = 300, 200, 6_000
FIELDS = ["field_report", "field_diff_vector", "field_diff_text", "field_diff_meta"]
VERDICTS = ["reconcile_verdict", "reconcile_verdict_clean"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Long texts, some of which begin with what marks a text among variants; a vector that is there twice."""
    rng, d = random.Random(5), str(tmp_path_factory.mktemp("tables"))
    docs = [(i, ("s:" if i % 3 == 0 else "") + f"{rng.getrandbits(4 * CHARS):x}", "de", None if i % 5 == 0 else "web" * (i % 40), CHARS) for i in range(N)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    vecs = [(i, [rng.random() for _ in range(8)], 0) for i in range(WITH_VECTORS)]
    spark.createDataFrame([*vecs, vecs[60]], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d


def shuffled(spark) -> dict[int, int]:
    """Bytes that each stage wrote for shuffles; Spark forgets early stages in time."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    j = sc._jvm
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(j.double, 0), j.java.util.ArrayList())
    return {x.stageId(): x.shuffleWriteBytes() for x in (stages.apply(i) for i in range(stages.size()))}


def run(spark, d, name, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        last = max(shuffled(spark), default=-1)
        df = catalogue.QUERIES[name](spark, d)
        columns = sorted(df.columns)
        rows = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
        return rows, sum(n for stage, n in shuffled(spark).items() if stage > last)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def sql(d, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
    r = con.execute(catalogue.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    return sorted((tuple(x[names.index(c)] for c in sorted(names)) for x in r.fetchall()), key=repr)


@pytest.mark.parametrize("name", FIELDS + VERDICTS)
def test_no_text_is_dealt_out(spark, tables, name):
    (small, a), (large, b) = run(spark, tables, name, "10m"), run(spark, tables, name, "-1")
    assert small == large == sql(tables, name)
    assert a <= b * 1.1 and b <= a * 1.1, "as much at any size"
    assert b < N * CHARS / 4


def test_texts_like_marks_and_long_values(spark):
    long = "x" * 5_000
    s = spark.createDataFrame([("a", [1.0], {"text": "s:one", "k": long, "z": "1"}), ("b", [1.0], {"text": "two", "k": long}), ("c", [1.0], {"text": None, "k": None}), ("d", [1.0], {"text": long})], "id string, values array<double>, metadata map<string,string>")
    t = spark.createDataFrame([("a", [1.0], "s:one", {"k": long, "z": "2"}), ("b", [1.0], "two", {"k": long + "x"}), ("c", [1.0], None, {}), ("d", [1.0], long + "y", {"text": "of no account"})], "id string, values array<double>, text string, metadata map<string,string>")
    want = [("a", False, False, "z"), ("b", False, False, "k"), ("d", False, True, None)]
    assert sorted(tuple(r) for r in reconcile.diff_fields(s, t, canonical_of=lambda v: v).collect()) == want
    variant = lambda df: df.withColumn("metadata", F.from_json(F.to_json("metadata"), "map<string,variant>"))
    assert sorted(tuple(r) for r in reconcile.diff_fields(variant(s), variant(t)).collect()) == want

import pytest
from pyspark.sql import functions as F

from docflow.functions import vectors
from docflow.operators import reconcile, routing


def ids(spark, *x):
    return spark.createDataFrame([(i,) for i in x], "id string")


def hits(spark, **by_query):
    return spark.createDataFrame([(int(q[1:]), i) for q, found in by_query.items() for i in found], "query_id long, id string")


def test_ids_and_counts(spark):
    s, t = ids(spark, "a", "b"), ids(spark, "a", "c")
    assert {tuple(r) for r in reconcile.diff_ids(s, t).collect()} == {("b", "missing"), ("c", "orphaned")}
    assert [r["id"] for r in reconcile.sampled_missing(s, t, 1).collect()] == [] and [r["id"] for r in reconcile.sampled_missing(s, t, 2).collect()] == ["b"]
    assert tuple(reconcile.compare_counts(s, t).first()) == (2, 2, 0, True) and tuple(reconcile.compare_counts(s, t.where("false")).first()) == (2, 0, 2, False)


def test_fields(spark):
    schema = "id string, values array<double>, metadata map<string,string>"
    s = spark.createDataFrame([("a", [1.0, 2.0], {"text": "one", "year": "1", "body": "b"}), ("b", [1.0], {"text": "two"}), ("x", [1.0], {"text": "t"})], schema)
    t = spark.createDataFrame([("a", [1.0, 2.00005], "changed", {"year": "2"}), ("b", [1.0], "two", {}), ("y", [1.0], "t", {})], "id string, values array<double>, text string, metadata map<string,string>")
    found = reconcile.diff_fields(s, t, rename={"body": "text_body"}, drop=("text_body",), canonical_of=lambda v: v)
    assert [tuple(r) for r in found.collect()] == [("a", False, True, "year")]
    assert tuple(reconcile.field_report(found, 2).first()) == (2, 0, 1, 1, False)
    v = reconcile.verdict(s.where("id <> 'x'"), t.where("id <> 'y'"), found.where("false")).first()
    assert tuple(v) == (True, True, True, 0, True)
    assert not reconcile.verdict(s, t, found).first()["ok"]


def test_all_close(spark):
    n, i = float("nan"), float("inf")
    rows = [([1.0], [1.0001], True), ([1.0], [1.001], False), ([n], [n], False), ([i], [i], True), ([i], [1.0], False), ([1.0], [1.0, 2.0], False), (None, [], True), ([i], [-i], False)]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>, want boolean")
    assert df.where(vectors.all_close(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_parity(spark):
    s, t = hits(spark, q1=["a", "b"], q2=["c"]), hits(spark, q1=["a", "x"], q2=["c"])
    p = {r["query_id"]: (r["recall"], r["jaccard"], r["shortfall"]) for r in reconcile.parity(s, t).collect()}
    assert p == {1: (0.5, 1 / 3, 1), 2: (1.0, 1.0, 0)}
    held, gone = ids(spark, "a", "b", "c"), ids(spark, "a", "c")
    ok = reconcile.parity_report(reconcile.parity(s, t), reconcile.absent_hits(s, t, held)).first()
    bad = reconcile.parity_report(reconcile.parity(s, t), reconcile.absent_hits(s, t, gone)).first()
    assert ok["ok"] and ok["absent"] == 0 and not bad["ok"] and bad["absent"] == 1
    none = reconcile.parity_report(reconcile.parity(s, t).where("false"), ids(spark)).first()
    assert none["ok"] and none["queries"] == 0 and none["recall"] == 0


def test_routing(spark, tmp_path):
    asked = spark.range(1000).withColumnRenamed("id", "query_id")
    n = lambda state, **k: {r["route"]: r["count"] for r in routing.routed(asked, state, **k).groupBy("route").count().collect()}
    assert n(routing.Cutover()) == {"source": 1000} and n(routing.Cutover("done")) == {"target": 1000} and n(routing.Cutover("ramp", 100)) == {"target": 1000}
    assert n(routing.Cutover("ramp", 0)) == {"source": 1000} and 200 < n(routing.Cutover("ramp", 25))["target"] < 300 and n(routing.Cutover(), text=True) == {"target": 1000}
    diffs = routing.shadow_diffs(hits(spark, q1=["a", "b"], q2=["c"]), hits(spark, q1=["b", "a"], q2=["d"]))
    assert {r["query_id"]: r["differs"] for r in diffs.collect()} == {1: False, 2: True}
    assert tuple(routing.router_stats(routing.routed(asked.where("query_id in (1, 2)"), routing.Cutover()), diffs).first()) == (2, 0, 2, 1, 0.5)
    path = str(tmp_path / "state.json")
    assert routing.Cutover.load(path) == routing.Cutover()
    routing.Cutover("ramp", 10.0, "x").save(path)
    assert routing.Cutover.load(path).moved(pct=0.0) == routing.Cutover("ramp", 0.0, "x")
    (tmp_path / "state.json").write_text('{"speed": 1}')
    with pytest.raises(ValueError):
        routing.Cutover.load(path)
    with pytest.raises(ValueError):
        routing.Cutover("ramp", 500.0)

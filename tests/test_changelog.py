import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import changelog, replay

LOG = "seq long, ts double, namespace string, doc_id string, op string, values array<double>, metadata map<string,string>"


def log(spark, *rows):
    return spark.createDataFrame([(s, float(s), "n", i, op, v, m) for s, i, op, v, m in rows], LOG)


def folded(spark, *rows, **how):
    return {r["doc_id"]: (r["op"], r["values"], r["metadata"]) for r in changelog.fold(log(spark, *rows), **how).collect()}


def naive(rows):
    """Each document's changes one after the other."""
    out = {}
    for s, i, op, v, m in sorted(rows, key=lambda r: r[0]):
        base, patch, last = out.get(i, (None, None, None))
        if op == "upsert":
            base, patch = (v, dict(m or {})), None
        elif op == "delete":
            base, patch = None, None
        elif base is not None:
            base = (v if v is not None else base[0], {**base[1], **(m or {})})
        else:
            patch = (v if v is not None else patch and patch[0], {**(patch[1] if patch else {}), **(m or {})})
        out[i] = (base, patch, op)
    return {i: ("delete", None, None) if last == "delete" else ("upsert", b[0], b[1] or None) if b else ("update", p[0], p[1] or None) for i, (b, p, last) in out.items()}


def test_collapse_keeps_the_last(spark):
    rows = log(spark, (1, "a", "upsert", [1.0], {"t": "v1"}), (2, "a", "upsert", [2.0], {"t": "v2"}), (3, "b", "upsert", [1.0], {}), (4, "b", "delete", None, None))
    assert {(r["doc_id"], r["op"], r["seq"]) for r in changelog.collapse(rows).collect()} == {("a", "upsert", 2), ("b", "delete", 4)}


def test_fold_cases(spark):
    assert folded(spark, (1, "a", "upsert", [1.0], {"t": "x", "y": "1"}), (2, "a", "update", None, {"t": "z"})) == {"a": ("upsert", [1.0], {"t": "z", "y": "1"})}
    assert folded(spark, (1, "a", "update", None, {"p": "1"}), (2, "a", "update", [2.0], {"q": "2"})) == {"a": ("update", [2.0], {"p": "1", "q": "2"})}
    assert folded(spark, (1, "a", "update", None, {"p": "1"}), (2, "a", "delete", None, None)) == {"a": ("delete", None, None)}
    again = ((1, "a", "upsert", [1.0], {"t": "x"}), (2, "a", "delete", None, None), (3, "a", "update", None, {"p": "1"}))
    assert folded(spark, *again) == {"a": ("update", None, {"p": "1"})}
    assert folded(spark, *again, resolve_delete=True) == {"a": ("upsert", None, {"p": "1"})}


def test_fold_equals_one_change_after_the_other(spark):
    rng = random.Random(5)
    rows = []
    for s in range(1, 1500):
        op = rng.choice(["upsert", "update", "update", "update", "delete"])
        m = None if op == "delete" else {k: str(s) for k in rng.sample("abcd", rng.randint(0 if op == "upsert" else 1, 3))}
        v = None if op == "delete" or op == "update" and rng.random() < 0.6 else [float(s)]
        rows.append((s, f"d{rng.randint(0, 200)}", op, v, m))
    got = {i: (op, v, m or None) for i, (op, v, m) in folded(spark, *rows).items()}
    assert got == naive(rows)


def test_windows_and_namespaces(spark):
    rows = log(spark, (1, "a", "upsert", [1.0], {"t": "x"}), (2, "a", "update", None, {"t": "y"}))
    other = rows.withColumn("namespace", F.lit("m")).withColumn("seq", F.col("seq") + 10)
    both = rows.unionByName(other)
    assert changelog.fold(both, 1, 2).first()["op"] == "update"
    assert {r["namespace"] for r in changelog.fold(both).collect()} == {"n", "m"}
    assert [r["namespace"] for r in changelog.collapse(both, namespace="m").collect()] == ["m"]
    assert changelog.history(both, namespace="n").count() == 2


def test_head_and_lag(spark):
    rows = log(spark, (1, "a", "upsert", [1.0], {}), (5, "a", "delete", None, None))
    assert changelog.head_seq(rows).first()["head"] == 5 and changelog.head_seq(rows.where("false")).first()["head"] == 0
    assert tuple(changelog.lag(rows, 1, 9.0).first()) == (1, 4.0) and tuple(changelog.lag(rows, 5, 9.0).first()) == (0, 0.0)


def test_append_numbers_after_the_head(spark):
    new = spark.createDataFrame([(2, "n", "b", "delete", None, None), (1, "n", "a", "upsert", [1.0], {})], "order int, namespace string, doc_id string, op string, values array<double>, metadata map<string,string>")
    old = log(spark, (7, "z", "delete", None, None))
    assert [(r["seq"], r["doc_id"]) for r in changelog.append(old, new, 1.0).orderBy("seq").collect()] == [(8, "a"), (9, "b")]
    with pytest.raises(ValueError):
        changelog.append(old, new.withColumn("op", F.lit("replace")), 1.0)


def documents(spark, *rows):
    return spark.createDataFrame([("n", i, v, m) for i, v, m in rows], "namespace string, doc_id string, values array<double>, metadata map<string,string>")


def state(df):
    return {r["doc_id"]: (r["values"], r["metadata"]) for r in df.collect()}


def test_replay_merges_and_is_idempotent(spark):
    docs = documents(spark, ("a", [0.0], {"t": "old", "k": "1"}), ("b", [0.0], {"t": "b"}), ("c", [0.0], {"t": "c"}))
    rows = log(spark, (1, "a", "update", None, {"t": "new"}), (2, "b", "delete", None, None), (3, "d", "upsert", [1.0], {"t": "d"}), (4, "e", "update", None, {"t": "e"}), (5, "zz", "delete", None, None))
    once = replay.apply(docs, rows)
    want = {"a": ([0.0], {"t": "new", "k": "1"}), "c": ([0.0], {"t": "c"}), "d": ([1.0], {"t": "d"}), "e": (None, {"t": "e"})}
    assert state(once.documents) == want and once.cursor == 5
    assert state(replay.apply(once.documents, rows).documents) == want
    assert state(replay.apply(once.documents, rows, once.cursor).documents) == want
    stats = changelog.action_stats(once.actions).first()
    assert tuple(stats) == (1, 2, 2, 5)


def test_upserts_without_text_are_parked(spark):
    rows = log(spark, (1, "a", "upsert", [1.0], {"t": ""}), (2, "b", "upsert", [1.0], None), (3, "c", "upsert", [1.0], {"t": "x"}), (4, "d", "update", None, {"k": "1"}))
    done = replay.apply(documents(spark, ("q", None, None)).where("false"), rows, text_key="t")
    assert {r["doc_id"] for r in done.documents.collect()} == {"c", "d"} and [r["seq"] for r in replay.unapplied(done.parked).collect()] == [1, 2]
    assert replay.clear_unapplied(done.parked, done.parked.where("seq = 1")).count() == 1 and done.cursor == 4


def test_searchable(spark):
    docs = documents(spark, ("a", None, None))
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "doc_id string")
    assert replay.all_searchable(docs, ids("a")) and replay.all_searchable(docs, ids()) and not replay.all_searchable(docs, ids("a", "b"))


VARIANTS = LOG.replace("map<string,string>", "string")


def variants(spark, *rows):
    import json

    made = spark.createDataFrame([(s, float(s), ns, i, op, v, None if m is None else json.dumps(m)) for s, ns, i, op, v, m in rows], VARIANTS)
    return made.withColumn("metadata", F.from_json("metadata", "map<string,variant>"))


def as_json(documents):
    return {r["doc_id"]: (r["values"], r["m"]) for r in documents.select("doc_id", "values", F.to_json("metadata").alias("m")).collect()}


def none_yet(spark):
    return spark.createDataFrame([], "namespace string, doc_id string, values array<double>, metadata map<string,variant>")


def test_empty_metadata_stay_empty(spark):
    assert folded(spark, (1, "a", "upsert", [1.0], {})) == {"a": ("upsert", [1.0], {})}
    assert folded(spark, (1, "a", "update", [1.0], None)) == {"a": ("update", [1.0], None)}
    assert folded(spark, (1, "a", "update", None, {"p": "1"}), (2, "a", "upsert", [1.0], {})) == {"a": ("upsert", [1.0], {})}


def test_mapped_replay(spark):
    from docflow.operators.mapping import Mapping, MappingError

    m = Mapping(rename={"t": "title"}, drop=("x",), allow_missing_text=True, dimension=1)
    rows = variants(
        spark, (1, "n", "a", "upsert", [1.0], {"text": "one", "t": "T", "x": 1, "z": None}), (2, "n", "b", "upsert", [1.0], {"t": "no text"}), (3, "n", "c", "update", [3.0, 4.0], {"t": "P"}),
        (4, "n", "d", "delete", None, None), (5, "m", "e", "upsert", [1.0], {"text": "other"}),
    )
    before = variants(spark, (0, "n", "c", "upsert", [9.0], {"title": "old", "text": "keep"}), (0, "n", "d", "upsert", [9.0], {"text": "gone"})).select("namespace", "doc_id", "values", "metadata")
    done = replay.apply_mapped(before, rows, m, namespace="n")
    assert as_json(done.documents) == {"a": ([1.0], '{"title":"T","text":"one"}'), "c": ([3.0, 4.0], '{"text":"keep","title":"P"}')}
    assert [tuple(r) for r in done.parked.collect()] == [(2, "n", "b", "no text for the full-text field")] and done.cursor == 5
    assert replay.unapplied_count(done.parked).first()[0] == 1
    assert tuple(replay.applied_stats(done.actions, done.cursor).first()) == (1, 1, 1, 1, 5)
    again = replay.apply_mapped(done.documents, rows, m, namespace="n")
    assert as_json(again.documents) == as_json(done.documents)
    dry = replay.apply_mapped(before, rows, m, namespace="n", dry_run=True)
    assert dry.cursor == 0 and dry.parked.isEmpty() and as_json(dry.documents) == as_json(before)
    with pytest.raises(MappingError, match="change 2 of b: missing_text"):
        replay.apply_mapped(before, rows, Mapping(), namespace="n")
    with pytest.raises(MappingError, match="change 7 of f: bad_name"):
        replay.apply_mapped(before, variants(spark, (7, "n", "f", "update", None, {"_p": 1}), (8, "n", "g", "update", None, {"$p": 1})), m)
    nothing = replay.apply_mapped(none_yet(spark), rows.where("false"), m)
    assert nothing.documents.isEmpty() and nothing.cursor == 0


def test_capture_writes_both_and_refuses_the_rest(spark, tmp_path):
    from docflow.operators.capture import Capture, CaptureError

    written = []
    c = Capture(spark, lambda op, ns, rows: written.append((op, ns, sorted(r["doc_id"] for r in rows.collect()))), str(tmp_path / "log"), "n", clock=lambda: 5.0)
    assert c.upsert([{"id": "a", "values": None, "metadata": None}, ("b", [1.0], {"k": 1}), ("c", [2.0])]) == 3
    assert c.update("a", set_metadata={"p": "x"}) == 1 and c.delete(["b"], namespace="other") == 1 and c.delete([]) == 0 and c.delete() == 0
    assert written == [("upsert", "n", ["a", "b", "c"]), ("update", "n", ["a"]), ("delete", "other", ["b"])]
    got = [tuple(r) for r in c.log().select("seq", "ts", "namespace", "doc_id", "op", "values", F.to_json("metadata")).orderBy("seq").collect()]
    assert got == [(1, 5.0, "n", "a", "upsert", [], "{}"), (2, 5.0, "n", "b", "upsert", [1.0], '{"k":1}'), (3, 5.0, "n", "c", "upsert", [2.0], "{}"), (4, 5.0, "n", "a", "update", None, '{"p":"x"}'), (5, 5.0, "other", "b", "delete", None, None)]
    refused = [
        lambda: c.upsert([("a", [1.0])], batch_size=10), lambda: c.update("a", filter={"k": 1}), lambda: c.update(values=[1.0]), lambda: c.update("a", dry_run=True), lambda: c.delete(delete_all=True),
        lambda: c.delete(filter={"k": 1}), lambda: c.upsert([{"id": "", "values": [1.0]}]), lambda: c.start_import("s3://x"), lambda: c.delete_namespace("n"), lambda: c.upsert([("a", [1.0])], later=True),
    ]
    for call in refused:
        with pytest.raises(CaptureError):
            call()
    assert len(written) == 3 and c.log().count() == 5


def test_a_failing_source_leaves_no_log(spark, tmp_path):
    from docflow.operators.capture import Capture

    def fail(*_):
        raise OSError("down")

    c = Capture(spark, fail, str(tmp_path / "log"))
    with pytest.raises(OSError):
        c.delete(["a"])
    assert c.log().isEmpty()


def test_cursors_and_parked_changes_are_kept(spark, tmp_path):
    from docflow.sources.cursors import Cursors, Unapplied

    c = Cursors(spark, str(tmp_path / "cursors"))
    assert c.get("target") == 0
    c.set("target", 7)
    c.set("other", 3)
    c.set("target", 5)
    assert c.get("target") == 5 and c.get("other") == 3 and Cursors(spark, c.path).get("target") == 5
    u = Unapplied(spark, str(tmp_path / "parked"))
    assert u.read().isEmpty()
    row = lambda seq, why: spark.createDataFrame([(seq, "n", "a", why)], "seq long, namespace string, doc_id string, reason string")
    u.park(row(2, "x"), 1.0)
    u.park(row(2, "y"), 2.0)
    u.park(row(1, "z"), 3.0)
    assert [(r["seq"], r["reason"]) for r in replay.unapplied(u.read()).collect()] == [(1, "z"), (2, "y")]

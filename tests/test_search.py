import math

import pytest
from pyspark.sql import functions as F

from docflow.functions import text as T
from docflow.operators import search
from docflow.operators.search import Analyzer


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("1", "The quick brown fox", [1.0, 0.0]), ("2", "the lazy dog and the fox fox", [0.6, 0.8]), ("3", "Nothing here", [0.0, 1.0]), ("4", "", [0.0, 0.0]), ("5", None, None)]
    return spark.createDataFrame(rows, "id string, text string, values array<double>")


def test_dense(docs):
    assert [tuple(r) for r in search.dense(docs, [1.0, 0.0], 2).collect()] == [("1", 1.0), ("2", 0.6)]
    assert [r["id"] for r in search.dense(docs, [0.0, 1.0], 9, "euclidean").collect()] == ["3", "2", "4", "1"]
    assert search.dense(docs, [1.0], 3).count() == 0


def test_dense_batch(spark, docs):
    q = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "query_id long, vector array<double>")
    got = [(r["query_id"], r["rank"], r["id"]) for r in search.dense_batch(docs, q, 1).orderBy("query_id").collect()]
    assert got == [(7, 1, "1"), (8, 1, "3")] and search.dense_batch(docs, q.where("false"), 1).count() == 0


def test_bm25_by_hand(docs):
    got = {r["id"]: r["score"] for r in search.bm25(docs, "fox", 5).collect()}
    lengths = [4, 7, 2, 0, 0]
    avg, idf = sum(lengths) / 5, math.log(1 + (5 - 2 + 0.5) / 2.5)
    want = {i: round(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg)), 6) for i, tf, dl in (("1", 1, 4), ("2", 2, 7))}
    assert got == want and search.bm25(docs, "!!", 3).count() == 0


def test_boolean_queries(docs):
    found = lambda q: {r["id"] for r in search.query_string(docs, q, 9).collect()}
    assert found("fox AND dog") == {"2"} and found("fox NOT dog") == {"1"} and found("fox nothing") == {"1", "2", "3"} and found("+fox -dog") == {"1"}
    assert found('"quick brown"') == {"1"} and found('"brown quick"') == set() and found("text:(fox AND (quick OR lazy)) NOT lazy") == {"1"}
    for bad in ("(fox", "fox)", "other:fox"):
        with pytest.raises(ValueError):
            found(bad)


def test_analyzers(spark, docs):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(T.ngrams(F.lit("search"), 3, 4)) == "sea ear arc rch sear earc arch".split() and one(T.ngrams(F.lit("search"), 3, 4, True)) == ["sea", "sear"] and one(T.ngrams(F.lit("a"), 2, 3)) == []
    assert [r["id"] for r in search.bm25(docs, "laz", 5, analyzer=Analyzer(ngram=(3, 3))).collect()] == ["2"]
    assert one(T.terms(F.lit("The DOG, the é1!"), T.STOP_WORDS)) == ["dog", "é1"]
    assert [T.porter(w) for w in "caresses ponies relational hopping running agreed generalizations happy sky controll".split()] == "caress poni relat hop run agre gener happi sky control".split()
    t = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(T.contains_all(t, ["a", "c"])) and not one(T.contains_all(t, ["a", "d"])) and one(T.contains_any(t, ["d", "b"])) and one(T.contains_phrase(t, ["b", "c"])) and not one(T.contains_phrase(t, ["a", "c"]))


def test_sparse(spark):
    df = spark.createDataFrame([("1", ([0, 5], [1.0, 2.0])), ("2", ([7], [1.0])), ("3", None)], "id string, sparse struct<indices:array<int>,values:array<float>>")
    assert [tuple(r) for r in search.sparse(df, {5: 2.0, 0: 1.0}, 5).collect()] == [("1", 5.0)]


def test_fields_score_and_match_apart(spark):
    df = spark.createDataFrame([("1", "x here", "zz"), ("2", "nothing", "x zz"), ("3", "x", "other"), ("4", None, None)], "id string, text string, title string")
    got = {r["id"]: r["score"] for r in search.query_string(df, "text:x title:zz", 9).collect()}
    assert set(got) == {"1", "2", "3"}
    alone = {r["id"]: r["score"] for r in search.query_string(df, "title:zz", 9).collect()}
    assert got["2"] == alone["2"] and abs(got["1"] - alone["1"] - {r["id"]: r["score"] for r in search.query_string(df, "text:x", 9).collect()}["1"]) < 2e-6
    assert {r["id"] for r in search.query_string(df, "text:x NOT title:zz", 9).collect()} == {"3"}


def test_ngram_fields_answer_query_strings(docs, spark):
    df = spark.createDataFrame([("1", "computer science"), ("2", "company"), ("3", "mop")], "id string, text string")
    grams = Analyzer(ngram=(3, 4))
    assert {r["id"] for r in search.query_string(df, "text:comp", 9, analyzer=grams).collect()} == {"1", "2"}
    assert {r["id"] for r in search.query_string(df, "comput AND scien", 9, analyzer={"text": grams}).collect()} == {"1"}
    assert search.query_string(df, "co", 9, analyzer=grams).count() == 0


def test_words_left_out_ask_for_nothing(docs):
    stop = Analyzer(stop_words=("the", "and"))
    assert {r["id"] for r in search.query_string(docs, "the OR dog", 9, analyzer=stop).collect()} == {"2"}
    assert {r["id"] for r in search.query_string(docs, "the AND dog", 9, analyzer=stop).collect()} == {"2"} and search.query_string(docs, "the", 9, analyzer=stop).count() == 0


def test_stemming(spark):
    df = spark.createDataFrame([("1", "running dogs"), ("2", "he runs"), ("3", "a runner"), ("4", "happy dog run"), ("5", "happiness")], "id string, text string")
    stems = Analyzer(stemming=True)
    found = lambda q: {r["id"] for r in search.query_string(df, q, 9, analyzer=stems).collect()}
    assert found("run") == {"1", "2", "4"} and found('"run dog"') == {"1"} and found("happy NOT dog") == {"5"} and found("dogs AND happiness") == {"4"}
    scores = {r["id"]: r["score"] for r in search.bm25(df, "run runs", 9, analyzer=stems).collect()}
    assert scores == {r["id"]: r["score"] for r in search.bm25(df, "running", 9, analyzer=stems).collect()} and scores["1"] == scores["2"] > scores["4"]


def test_ngrams_are_counted_without_making_them(spark):
    words = F.array(*map(F.lit, "banana an b nanana".split()))
    for prefix in (False, True):
        grams = F.flatten(F.transform(words, lambda t: T.ngrams(t, 1, 3, prefix)))
        row = spark.range(1).select(F.size(grams), T.n_ngrams(words, 1, 3, prefix), *[F.size(F.filter(grams, lambda x: x == g)) for g in ("ana", "b", "an", "xx")], *[T.ngram_frequency(T.joined(words), g, prefix) for g in ("ana", "b", "an", "xx")]).first()
        assert row[0] == row[1] and row[2:6] == row[6:]


def test_phrases(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    t = F.array(*map(F.lit, "a a b c ab".split()))
    assert one(T.contains_phrase(t, ["a", "b", "c"])) and not one(T.contains_phrase(t, ["a", "c"])) and not one(T.contains_phrase(t, ["b", "c", "a"])) and one(T.contains_phrase(t, ["ab"])) and not one(T.contains_phrase(t, ["c", "a"]))
    assert one(T.contains_phrase(t, [["x", "a"], ["b"]])) and not one(T.contains_phrase(t, [["b"], []])) and not one(T.contains_phrase(F.array().cast("array<string>"), ["a"]))


def test_many_queries_in_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x, q = rng.integers(-3, 4, (500, 4)).astype(float), rng.integers(-3, 4, (1200, 4)).astype(float)
    df = spark.createDataFrame([(f"d{i:03}", v) for i, v in enumerate(x.tolist())] + [("odd", [1.0]), ("null", None)], "id string, values array<double>").repartition(3)
    asked = spark.createDataFrame(list(enumerate(q.tolist())), "query_id long, vector array<double>")
    for metric in ("dotproduct", "euclidean", "cosine"):
        got = {}
        for r in search.dense_batch(df, asked, 3, metric).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["id"], r["score"])
        for i, v in enumerate(q):
            with np.errstate(all="ignore"):
                s = {"dotproduct": x @ v, "euclidean": -((x - v) ** 2).sum(1), "cosine": x @ v / (np.linalg.norm(x, axis=1) * np.linalg.norm(v))}[metric]
            want = sorted((-round(float(a), 6), f"d{j:03}") for j, a in enumerate(s) if a == a)[:3]
            assert [got.get(i, {}).get(k + 1, ("", 0))[0] for k in range(len(want))] == [w[1] for w in want], (metric, i)

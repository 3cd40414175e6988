"""Exact ranking: dense vectors, BM25, boolean text queries and sparse vectors."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import text as T
from docflow.functions import vectors

#: Parameters of the published BM25 formula.
K1, B = 1.2, 0.75


def dense(documents: DataFrame, vector: list[float], k: int, metric: str = "cosine", id_col: str = "id", vector_col: str = "values", digits: int = 6) -> DataFrame:
    """The k nearest documents: id, score, ties to smaller ids. Scores are rounded, so that ties are the same everywhere. A bounded top-k on each task, then one of all."""
    score, larger = vectors.METRICS[metric]
    scored = documents.select(F.col(id_col), F.round(score(F.col(vector_col), F.array(*[F.lit(float(x)) for x in vector])), digits).alias("score")).where("score is not null")
    return scored.orderBy(F.desc("score") if larger else F.asc("score"), id_col).limit(k)


#: Rows of a block of documents and of queries.
BLOCK, QUERY_BLOCK = 2048, 256


def _packed(df: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """(part, dim, ids, data): blocks of at most size sound vectors of one length, as packed doubles."""
    x = F.col(vector_col).cast("array<double>")
    sound = F.coalesce(F.forall(x, lambda v: v.isNotNull()), F.lit(False))

    def run(batches):
        held: dict[int, tuple[list, list[bytes]]] = {}
        part = TaskContext.get().partitionId()

        def block(dim: int):
            ids, data = held.pop(dim)
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([dim], pa.int32()), lists, pa.array([b"".join(data)], pa.binary())], names=["part", "dim", "ids", "data"])

        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy(zero_copy_only=False)
            for i, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                ids, data = held.setdefault(hi - lo, ([], []))
                ids.append(batch.column(0).slice(i, 1))
                data.append(flat[lo:hi].tobytes())
                if len(ids) >= size:
                    yield block(hi - lo)
        for dim in list(held):
            yield block(dim)

    return df.where(sound).select(F.col(id_col), x.alias("v")).mapInArrow(run, f"part int, dim int, ids array<{df.schema[id_col].dataType.simpleString()}>, data binary")


def _scores(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Scores of all pairs, NaN where there is none."""
    if metric == "dotproduct":
        return q @ x.T
    if metric == "euclidean":
        return np.stack([((x - v) ** 2).sum(1) for v in q])
    length = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None, :]
    return np.divide(q @ x.T, length, out=np.full((len(q), len(x)), np.nan), where=length != 0)


def dense_batch(documents: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", id_col: str = "id", vector_col: str = "values", digits: int = 6) -> DataFrame:
    """queries: query_id, vector; a stated set of any size. Returns query_id, id, score, rank, ties to smaller ids.

    Blocks of documents meet blocks of queries by an equi-join on a slot number; of each pair of blocks only the k best
    of each query go on. Vectors of unequal lengths do not meet; those that are null or hold nulls have no hits.
    """
    if metric not in vectors.METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    larger = vectors.METRICS[metric][1]
    slots = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    asked = _packed(queries.coalesce(1), "query_id", "vector", QUERY_BLOCK).select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    blocks = _packed(documents, id_col, vector_col, BLOCK).withColumn("slot", F.pmod(F.hash("part", F.monotonically_increasing_id()), F.lit(slots)))
    pairs = blocks.join(asked, ["slot", "dim"]).select("dim", "ids", "data", "q_ids", "q_data")
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (documents, id_col))]

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch.column(0)[r].as_py()
                ids, q_ids = batch.column(1)[r].values, batch.column(3)[r].values
                x, q = (np.frombuffer(batch.column(c)[r].as_buffer(), np.float64).reshape(len(i), dim) for c, i in ((2, ids), (4, q_ids)))
                place = np.argsort(np.array(pc.sort_indices(ids)))  # of each id in their order
                with np.errstate(all="ignore"):
                    score = _scores(q, x, metric)
                    score = np.copysign(np.floor(np.abs(score) * 10.0**digits + 0.5) / 10.0**digits, score) + 0.0
                cost = np.where(np.isnan(score), np.inf, -score if larger else score)
                least = np.partition(cost, min(k, cost.shape[1]) - 1, axis=1)[:, min(k, cost.shape[1]) - 1]
                a, b = np.nonzero((cost <= least[:, None]) & ~np.isnan(score))
                order = np.lexsort((place[b], cost[a, b], a))
                a, b = a[order], b[order]
                some = np.arange(len(a)) - np.searchsorted(a, a) < k
                a, b = a[some], b[some]
                yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array(score[a, b], pa.float64())], names=["query_id", "id", "score"])

    scored = pairs.mapInArrow(run, f"query_id {kinds[0]}, id {kinds[1]}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score") if larger else F.asc("score"), "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("id").alias(id_col), "score", "rank")


@dataclass(frozen=True)
class Analyzer:
    """How a field's text becomes terms. With stemming, terms are compared by their stems; n-grams go without stemming and stop words."""

    stop_words: tuple[str, ...] = ()
    ngram: tuple[int, int] | None = None
    prefix_only: bool = False
    stemming: bool = False

    def column(self, text: Column) -> Column:
        found = T.terms(text, self.stop_words)
        return found if self.ngram is None else F.flatten(F.transform(found, lambda t: T.ngrams(t, *self.ngram, self.prefix_only)))

    def words(self, query: str) -> list[str]:
        found = [w for w in re.findall(r"[^\W_]+", query.lower()) if w not in self.stop_words]
        if self.ngram is None:
            return found
        least, most = self.ngram
        return [w[i : i + n] for w in found for n in range(least, most + 1) for i in range(1 if self.prefix_only else len(w) - n + 1) if i + n <= len(w)]


Analyzers = Analyzer | dict[str, Analyzer]


def _of(analyzers: Analyzers, name: str) -> Analyzer:
    return analyzers.get(name, Analyzer()) if isinstance(analyzers, dict) else analyzers


def _among(terms: Column, wanted: list[str]) -> Column:
    return F.filter(terms, lambda t: t.isin(*wanted))


def variants(documents: DataFrame, wanted: list[tuple[str, str]], analyzers: Analyzers) -> dict[tuple[str, str], list[str]]:
    """Of each (field, word) the terms of the field that count as it: itself, or with stemming all with its stem.

    Only terms that begin as the stem does are gathered, once each, and stemmed in Arrow batches; what reaches the driver
    are the forms of the words asked for.
    """
    out = {(f, w): [w] for f, w in wanted}
    for f in dict.fromkeys(f for f, _ in wanted if _of(analyzers, f).stemming and _of(analyzers, f).ngram is None):
        stems = {T.porter(w) for g, w in out if g == f}
        begins = "^(?:" + "|".join(rf"\Q{s[: max(1, len(s) - 1)]}\E" for s in sorted(stems)) + ")"
        terms = documents.select(F.explode(F.array_distinct(F.filter(_of(analyzers, f).column(F.col(f)), lambda t: t.rlike(begins)))).alias("term")).distinct()
        found = terms.withColumn("stem", T.stemmer()(F.col("term"))).where(F.col("stem").isin(*stems)).collect()
        for key in [k for k in out if k[0] == f]:
            out[key] = sorted({key[1], *(r["term"] for r in found if r["stem"] == T.porter(key[1]))})
    return out


def bm25(
    documents: DataFrame, query: str | list[str] | list[tuple[str, str]], k: int, fields: tuple[str, ...] = ("text",), analyzer: Analyzers = Analyzer(), id_col: str = "id",
    matching: Column | None = None, digits: int = 6, test=None, forms: dict[tuple[str, str], list[str]] | None = None,
) -> DataFrame:
    """The k best documents with a term of the query: id, score, ties to smaller ids.

    query: a text or terms, asked of each field, or (field, term) pairs, each asked of its own field. Statistics are over
    all documents (`matching`, and `test` on the terms of the fields, only filter results): one pass counts, a second
    scores against those few numbers, so no postings are shuffled. In each pass a text is analyzed once. Scores add up.
    """
    if isinstance(query, str):
        pairs = [(f, w) for f in fields for w in _of(analyzer, f).words(query)]
    else:
        pairs = [(f, w) for w in query for f in fields] if all(isinstance(w, str) for w in query) else list(query)
    pairs = list(dict.fromkeys(pairs))
    if not pairs:
        return documents.select(id_col, F.lit(0.0).alias("score")).where("false")
    forms = forms or variants(documents, pairs, analyzer)
    pairs = list({tuple([f, *forms[f, w]]): (f, w) for f, w in pairs}.values())  # words with one stem count once
    asked = list(dict.fromkeys(f for f, _ in pairs))
    read = [f for f in documents.columns if f in asked or test is not None and f in test.fields]
    terms = F.struct(*[T.terms(F.col(f), _of(analyzer, f).stop_words).alias(f"t{i}") for i, f in enumerate(read)])
    of = {f: f"t{i}" for i, f in enumerate(read)}

    def once(x: Column, make) -> Column:
        """make(x) with x evaluated once, however often it is used."""
        return F.get(F.transform(F.array(x), make), F.lit(0))

    def length(f: str, t: Column) -> Column:
        x = _of(analyzer, f)
        return F.size(t) if x.ngram is None else T.n_ngrams(t, *x.ngram, x.prefix_only)

    def frequency(f: str, w: str, h: Column) -> Column:
        x = _of(analyzer, f)
        return F.size(_among(h, forms[f, w])) if x.ngram is None else T.ngram_frequency(h, w, x.prefix_only)

    def hits(f: str, t: Column) -> Column:
        """What the frequencies of a field are counted in: its terms that are asked for, or all terms in one text."""
        return _among(t, [w for g, v in pairs if g == f for w in forms[g, v]]) if _of(analyzer, f).ngram is None else T.joined(t)

    def facts(with_test: bool) -> Column:
        """fits, and of each field its length, of each pair its frequency."""

        def counted(t: Column) -> Column:
            fits = F.coalesce(test(lambda f: t[of[f]]), F.lit(False)) if with_test and test is not None else F.lit(True)
            tf = lambda h: F.struct(*[frequency(f, w, h[of[f]]).alias(f"tf{j}") for j, (f, w) in enumerate(pairs)])
            return F.struct(fits.alias("fits"), *[length(f, t[of[f]]).alias(f"dl{i}") for i, f in enumerate(asked)], once(F.struct(*[hits(f, t[of[f]]).alias(of[f]) for f in asked]), tf).alias("tf"))

        return once(terms, counted)

    s = documents.select(facts(False).alias("x")).agg(
        F.count("*").alias("n"), *[F.sum(f"x.dl{i}").alias(f"dl{i}") for i in range(len(asked))], *[F.count_if(F.col(f"x.tf.tf{j}") > 0).alias(f"df{j}") for j in range(len(pairs))]
    ).first()

    def score(x: Column) -> Column:
        total: Column = F.lit(0.0)
        some: Column = F.lit(False)
        for j, (f, _) in enumerate(pairs):
            i = asked.index(f)
            average = (s[f"dl{i}"] or 0) / max(1, s["n"])
            tf, df = x["tf"][f"tf{j}"], s[f"df{j}"]
            relative = F.lit(1 - B) + x[f"dl{i}"] * (B / average if average else 0.0)
            total = total + F.lit(math.log(1 + (s["n"] - df + 0.5) / (df + 0.5))) * tf * (K1 + 1) / (tf + relative * K1)
            some = some | (tf > 0)
        return F.when(x["fits"] & some, F.round(total, digits))

    base = documents.where(matching) if matching is not None else documents
    scored = base.select(id_col, once(facts(True), score).alias("score"))
    # hits are told by their score after the limit, or the text would be analyzed once more to filter
    return scored.orderBy(F.desc_nulls_last("score"), id_col).limit(k).where("score is not null")


@dataclass
class Query:
    """A parsed clause: whether a document's terms match (None: nothing is asked), the (field, term) pairs that score and all fields that are looked at."""

    test: Callable[[Callable[[str], Column]], Column] | None
    scoring: list[tuple[str, str]] = field(default_factory=list)
    fields: set[str] = field(default_factory=set)

    def __call__(self, terms: Callable[[str], Column]) -> Column:
        return self.test(terms)


def words_asked(query: str, default: str, analyzers: Analyzers = Analyzer()) -> list[tuple[str, str]]:
    """All (field, word) pairs of a query, the negated ones too."""
    seen: list[tuple[str, str]] = []
    parser = Parser(query, default, analyzers)
    parser.note = seen.append
    parser.parse()
    return list(dict.fromkeys(seen))


class Parser:
    """field:term, "a phrase", AND, OR, NOT, +must, -mustn't and parentheses; juxtaposed clauses are joined by OR.

    On a field with n-grams a word asks for all of its grams, which are looked up in the terms themselves. Words that the analyzer leaves out ask for nothing.
    """

    def __init__(self, query: str, default: str, analyzers: Analyzers = Analyzer(), forms: dict[tuple[str, str], list[str]] | None = None):
        self.tokens = re.findall(r'\(|\)|[+-](?=\S)|"[^"]*"|[^\s()":]+:(?=[("\w])|[^\s()"]+', query)
        self.at, self.default, self.analyzers, self.forms = 0, default, analyzers, forms or {}
        self.note: Callable = lambda pair: None

    def peek(self) -> str | None:
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self) -> str:
        self.at += 1
        return self.tokens[self.at - 1]

    def parse(self) -> Query:
        q = self.clauses(self.default)
        if self.peek() is not None:
            raise ValueError(f"unexpected {self.peek()!r}")
        return q

    def clauses(self, name: str) -> Query:
        must: list[Query] = []
        may: list[Query] = []
        never: list[Query] = []
        joined: str | None = None
        while (t := self.peek()) is not None and t != ")":
            if t in ("AND", "OR"):
                joined = self.take()
                continue
            sign = "+" if joined == "AND" else ""
            if sign and may:  # AND binds both of its sides
                must.append(may.pop())
            if t in ("NOT", "+", "-"):
                sign = "-" if self.take() != "+" else "+"
            q = self.clause(name)
            (never if sign == "-" else must if sign == "+" else may).append(q)
            joined = None
        fields = {f for q in [*must, *may, *never] for f in q.fields}
        must, may, never = ([q for q in some if q.test is not None] for some in (must, may, never))
        scoring = [x for q in [*must, *may] for x in q.scoring]

        def test(terms) -> Column:
            out = F.lit(True)
            for q in must:
                out = out & q(terms)
            if may and not must:
                some = F.lit(False)
                for q in may:
                    some = some | q(terms)
                out = out & some
            for q in never:
                out = out & ~q(terms)
            return out

        return Query(test if must or may else None, scoring, fields)

    def clause(self, name: str) -> Query:
        if self.peek() is None:
            raise ValueError("the query ends within a clause")
        t = self.take()
        if t.endswith(":") and len(t) > 1:
            return self.clause(t[:-1])
        if t == "(":
            q = self.clauses(name)
            if self.peek() != ")":
                raise ValueError("a parenthesis is not closed")
            self.take()
            return q
        analyzer = _of(self.analyzers, name)
        words = analyzer.words(t.strip('"'))
        for w in words:
            self.note((name, w))
        if not words:
            return Query(None, [], {name})
        forms = [self.forms.get((name, w), [w]) for w in words]

        def test(terms) -> Column:
            if analyzer.ngram is not None:
                whole = T.joined(terms(name))
                return reduce(Column.__and__, [F.contains(whole, F.lit("\n" * analyzer.prefix_only + w)) for w in dict.fromkeys(words)])
            if len(words) == 1:
                return T.contains_any(terms(name), forms[0])
            return T.contains_phrase(terms(name), words if all(len(x) == 1 for x in forms) else forms)

        return Query(test, [(name, w) for w in words], {name})


def query_string(documents: DataFrame, query: str, k: int, default: str = "text", analyzer: Analyzers = Analyzer(), id_col: str = "id", digits: int = 6) -> DataFrame:
    """The k best documents that match a boolean query, scored by BM25 over its terms that are not negated, each in its own field."""
    parsed = Parser(query, default, analyzer).parse()
    unknown = sorted(f for f in parsed.fields if f not in documents.columns)
    if unknown:
        raise ValueError(f"unknown field {unknown[0]!r}")
    if parsed.test is None:
        return documents.select(id_col, F.lit(0.0).alias("score")).where("false")
    forms = variants(documents, words_asked(query, default, analyzer), analyzer)
    parsed = Parser(query, default, analyzer, forms).parse()
    return bm25(documents, parsed.scoring, k, (default,), analyzer, id_col, digits=digits, test=parsed, forms=forms)


def sparse(documents: DataFrame, query: dict[int, float], k: int, id_col: str = "id", sparse_col: str = "sparse", digits: int = 6) -> DataFrame:
    """The k best documents by the inner product of sparse vectors, struct<indices:array<int>,values:array<float>>; those without a common index are no hits."""
    if not query:
        return documents.select(id_col, F.lit(0.0).alias("score")).where("false")
    weights = F.create_map(*[F.lit(x) for i, w in query.items() for x in (int(i), float(w))])
    pairs = F.filter(F.arrays_zip(F.col(sparse_col)["indices"].alias("i"), F.col(sparse_col)["values"].alias("v")), lambda p: p["i"].isin(*map(int, query)))
    score = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["v"].cast("double") * F.element_at(weights, p["i"].cast("int")))
    return documents.select(id_col, F.when(F.size(pairs) > 0, F.round(score, digits)).alias("score")).where("score is not null").orderBy(F.desc("score"), id_col).limit(k)

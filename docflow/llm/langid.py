"""Language identification by words with a backoff to character n-grams.

A word that the model knows is scored by its log frequency in each language. For an unseen word the n-grams of the
longest length of which one is known are scored instead, from LONGEST down to 1. The language with the best mean
score over the words of a text wins.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.shared import letter_runs, slices

LONGEST = 5
#: Bounds of the fitted model: documents of a language that it is fitted on (expected), and what it keeps for each.
FIT_DOCS, KEPT_WORDS, KEPT_GRAMS = 1_500, 20_000, 6_000
#: A language without a word or n-gram that another has gets this log10 frequency.
ABSENT = -7.0
CACHE_WORDS = 200_000
#: Text that is split into words in one go, in bytes: its words as Python strings take many times that.
SPLIT_BYTES = 512 << 10
#: Words whose evidence the score counts at most; beyond, words of a text are too dependent.
EVIDENCE = 20


def words(text: str) -> list[str]:
    return letter_runs().findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Model:
    """languages in order; row: the place of (0, word) or (n, n-gram) in logs, its log10 frequency in each language."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        """rows: (language, 0 for a word or else n, string, count)."""
        self.languages = sorted({r[0] for r in rows})
        place = {g: i for i, g in enumerate(self.languages)}
        totals: Counter = Counter()
        for g, n, _, c in rows:
            totals[g, n] += c
        self.row: dict[tuple[int, str], int] = {}
        for _, n, s, _ in rows:
            self.row.setdefault((n, s), len(self.row))
        self.logs = np.full((len(self.row), len(self.languages)), ABSENT)
        for g, n, s, c in rows:
            self.logs[self.row[n, s], place[g]] = math.log10(c / totals[g, n])

    def word(self, w: str) -> np.ndarray:
        i = self.row.get((0, w))
        if i is not None:
            return self.logs[i]
        for n in range(min(LONGEST, len(w) + 2), 0, -1):
            found = [i for g in grams(w, n) if (i := self.row.get((n, g))) is not None]
            if found:
                return self.logs[found].mean(0)
        return np.full(len(self.languages), ABSENT)

    def decide(self, scores: np.ndarray, n_words: int) -> tuple[str, float]:
        """From the mean scores of a text: its language and how sure it is, from 0 to 1."""
        best = int(np.argmax(scores))
        odds = np.exp((scores - scores[best]) * math.log(10) * min(n_words, EVIDENCE))
        return self.languages[best], float(1 / odds.sum())


def _grams(padded: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, F.lit(n)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_docs: int = FIT_DOCS, kept_words: int = KEPT_WORDS, kept_grams: int = KEPT_GRAMS) -> Model:
    """Fits a model on about fit_docs documents of each language, chosen by a hash of the id; rows without text or language are left out.

    What reaches the driver is bounded by the kept words and n-grams of each language. Without a labelled row the
    model has no language and predicts nothing.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = base.where("lang is not null and text is not null")
    per_lang = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not per_lang:
        return Model([])
    share = F.element_at(F.create_map(*[F.lit(x) for g, n in per_lang.items() for x in (g, min(1.0, fit_docs / n))]), F.col("lang"))
    sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found: Counter = Counter()
                for t, g in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found.update((g, w) for w in words(t))
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(found.values(), pa.int64())], names=["lang", "s", "c"])

    word = sample.select("text", "lang").mapInArrow(count, "lang string, s string, c bigint").groupBy("lang", "s").agg(F.sum("c").alias("c")).withColumn("n", F.lit(0))
    padded = F.concat(F.lit(" "), F.col("s"), F.lit(" "))
    gram = None
    for n in range(1, LONGEST + 1):
        x = word.where(F.length(padded) >= n).select("lang", F.explode(_grams(padded, n)).alias("s"), "c", F.lit(n).alias("n"))
        gram = x if gram is None else gram.unionByName(x)
    gram = gram.groupBy("lang", "n", "s").agg(F.sum("c").alias("c"))
    every = word.where("c > 1").unionByName(gram)
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("c"), "s"))
    kept = every.withColumn("r", rank).where(F.col("r") <= F.when(F.col("n") == 0, kept_words).otherwise(kept_grams))
    return Model([(r["lang"], r["n"], r["s"], r["c"]) for r in kept.select("lang", "n", "s", "c").collect()])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Returns (id, lang_pred, score) and the columns of keep for each row, from the whole text alone; other columns are not carried.

    A text that is null or has no letter is 'und' with score 0, as is every text if the model has no language.
    Equal scores go to the language that is first in alphabetic order. Texts are read whole, whatever their length;
    repeated rows and null ids stay as they are; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    kept = keep or []
    sent = ["id", "text", *[f"kept_{c}" for c in kept if c != text_col]]
    back = [sent.index("text" if c == text_col else f"kept_{c}") for c in kept]  # a kept text is the one that is read, not a second copy
    names = ["id", "lang_pred", "score", *[f"kept_{c}" for c in kept]]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the kept words and n-grams

    def run(batches):
        model = shared.value
        width = len(model.languages)
        index: dict[str, int] = {}
        matrix = np.zeros((CACHE_WORDS + 1, width))
        for batch in batches:
            for part in slices(batch, "text", SPLIT_BYTES):
                split = [words(t) if t else [] for t in part.column(1).to_pylist()]
                seen = set().union(*split) if width else set()
                if len(index) + len(seen) > CACHE_WORDS:
                    index.clear()
                new = [w for w in seen if w not in index]
                if len(index) + len(new) >= len(matrix):  # one slice with more words than the cache holds
                    matrix = np.resize(matrix, (len(index) + len(new) + 1, width))
                for w in new:
                    matrix[len(index)] = model.word(w)
                    index[w] = len(index)
                langs, scores = [], []
                for found in split:
                    if not found or not width:
                        langs.append("und")
                        scores.append(0.0)
                    else:
                        lang, score = model.decide(matrix[list(map(index.__getitem__, found))].mean(0), len(found))
                        langs.append(lang)
                        scores.append(score)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *[part.column(i) for i in back]], names=names)

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), *[docs[c].alias(f"kept_{c}") for c in kept if c != text_col])
    out = picked.mapInArrow(run, f"id {kind}, lang_pred string, score double" + "".join(f", `kept_{c}` {docs.schema[c].dataType.simpleString()}" for c in kept))
    return out.select(F.col("id").alias(id_col), "lang_pred", "score", *[F.col(f"kept_{c}").alias(c) for c in kept])

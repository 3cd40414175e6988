"""Made-up records and workloads, the same for the same seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topics with their words, and the words of all topics.
TOPICS = {
    "billing": ("invoice", "refund", "payment", "charge", "balance"),
    "search": ("index", "query", "ranking", "vector", "recall"),
    "storage": ("bucket", "volume", "snapshot", "replica", "archive"),
    "network": ("latency", "gateway", "packet", "route", "proxy"),
    "security": ("token", "policy", "audit", "role", "secret"),
}
FILLER = ("the", "a", "of", "and", "with", "for", "system", "team", "service", "report", "update", "case")
#: Upper ends of the shares of insert, revise, patch and delete; the rest are queries.
MIX = (("insert", 0.55), ("revise", 0.80), ("patch", 0.87), ("delete", 0.93), ("query", 1.0))


def _unit(i, salt: int):
    """A number from 0 to below 1, told by the row and a salt alone."""
    return F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def records(spark: SparkSession, n: int, dimension: int = 384, words: int = 40, seed: int = 7) -> DataFrame:
    """id, values (of length 1), metadata map of texts: topic, year, title, text."""
    i = F.col("i")
    names = list(TOPICS)
    topic = F.element_at(F.array(*map(F.lit, names)), (F.floor(_unit(i, seed) * len(names)) + 1).cast("int"))
    vocabulary = F.element_at(F.create_map(*[x for t, w in TOPICS.items() for x in (F.lit(t), F.array(*map(F.lit, w)))]), F.col("topic"))
    filler = F.array(*map(F.lit, FILLER))

    def word(k):
        u = F.pmod(F.xxhash64(i, k, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        v = F.pmod(F.xxhash64(k, i, F.lit(seed + 1)), F.lit(1 << 30))
        pick = lambda a, size: F.element_at(a, (F.pmod(v, F.lit(size)) + 1).cast("int"))
        return F.when(u < 0.55, pick(F.col("vocabulary"), 5)).otherwise(pick(filler, len(FILLER)))

    def normal(k):
        u1 = (F.pmod(F.xxhash64(i, k, F.lit(seed + 2)), F.lit(1 << 30)) + 1) / float((1 << 30) + 1)
        u2 = F.pmod(F.xxhash64(i, k, F.lit(seed + 3)), F.lit(1 << 30)) / float(1 << 30)
        return F.sqrt(-2 * F.log(u1)) * F.cos(2 * 3.141592653589793 * u2)

    base = spark.range(n).select(F.col("id").alias("i")).withColumn("topic", topic).withColumn("vocabulary", vocabulary)
    base = base.withColumn("raw", F.transform(F.sequence(F.lit(1), F.lit(dimension)), normal)).withColumn("words", F.transform(F.sequence(F.lit(1), F.lit(words)), word))
    length = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, x: s + x * x))
    meta = F.create_map(
        F.lit("topic"), F.col("topic"), F.lit("year"), (F.lit(2019) + F.floor(_unit(i, seed + 4) * 8)).cast("string"),
        F.lit("title"), F.initcap(F.array_join(F.slice("words", 1, 4), " ")), F.lit("text"), F.array_join("words", " "),
    )
    return base.select(F.format_string("doc-%07d", "i").alias("id"), F.transform("raw", lambda x: x / length).alias("values"), meta.alias("metadata"))


def workload(spark: SparkSession, ticks: int, live: int, seed: int = 11) -> DataFrame:
    """(tick, action, doc): inserts beyond what is live, and other actions on live documents; all insert while none is live."""
    u = _unit(F.col("id"), seed)
    action = F.lit("query")
    for name, end in reversed(MIX[:-1]):
        action = F.when(u < end, name).otherwise(action)
    action = F.when(F.lit(live) == 0, "insert").otherwise(action)
    doc = F.when(action == "insert", F.lit(live) + F.col("id")).otherwise(F.floor(_unit(F.col("id"), seed + 1) * max(1, live)))
    return spark.range(ticks).select(F.col("id").alias("tick"), action.alias("action"), doc.cast("long").alias("doc"))


def workload_stats(actions: DataFrame) -> DataFrame:
    """One row: a count for each action, and writes."""
    n = lambda a: F.count_if(F.col("action") == a)
    return actions.agg(*[n(a).alias(f"{a}s") for a, _ in MIX], F.count_if(F.col("action") != "query").alias("writes"))

"""The change log: seq, ts, namespace, doc_id, op (upsert, update, delete), values, metadata.

A window is the changes with since < seq <= until. An upsert carries a whole record, an update what it sets, a delete
nothing. Order is by seq alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["namespace", "doc_id"]
OPS = ("upsert", "update", "delete")


def window(log: DataFrame, since: int = 0, until: int | None = None, namespace: str | None = None) -> DataFrame:
    out = log.where(F.col("seq") > since)
    if until is not None:
        out = out.where(F.col("seq") <= until)
    return out if namespace is None else out.where(F.col("namespace") == namespace)


def head_seq(log: DataFrame) -> DataFrame:
    """One row: the last seq, 0 for an empty log."""
    return log.agg(F.coalesce(F.max("seq"), F.lit(0)).cast("long").alias("head"))


def lag(log: DataFrame, cursor: int, now: float) -> DataFrame:
    """One row: changes of all namespaces after the cursor, and the seconds since the oldest of them (0 if none)."""
    return (
        log.where(F.col("seq") > cursor)
        .agg(F.count("*").alias("pending"), F.coalesce(F.min("ts"), F.lit(0.0)).alias("oldest"))
        .select("pending", F.when(F.col("pending") > 0, F.lit(now) - F.col("oldest")).otherwise(F.lit(0.0)).alias("seconds"))
    )


def collapse(log: DataFrame, since: int = 0, until: int | None = None, namespace: str | None = None) -> DataFrame:
    """The last change of each document in the window; combined before the shuffle."""
    rest = [c for c in log.columns if c not in KEY]
    return window(log, since, until, namespace).groupBy(*KEY).agg(F.max_by(F.struct(*rest), "seq").alias("last")).select(*KEY, "last.*")


def history(log: DataFrame, since: int = 0, until: int | None = None, namespace: str | None = None) -> DataFrame:
    """All changes in the window of the documents whose last one is an update."""
    inside = window(log, since, until, namespace)
    patched = inside.groupBy(*KEY).agg(F.max_by("op", "seq").alias("op")).where("op = 'update'").select(*KEY)
    return inside.join(patched, KEY, "left_semi")


def fold(log: DataFrame, since: int = 0, until: int | None = None, namespace: str | None = None, resolve_delete: bool = False) -> DataFrame:
    """One action for each document: namespace, doc_id, seq, op, values, metadata.

    An upsert or delete forgets what came before; updates after an upsert are merged into its record, others into one
    patch. After delete and update in one window only the patch is left; with resolve_delete it becomes an upsert of
    what the patch holds. Values merge key by key with partial aggregation and the log itself is never joined, so a
    document with a third of all changes is neither gathered in one place nor a hot key. Metadata are null only if no
    change that counts has any; an upsert with none of its own keeps its empty map.
    """
    inside = window(log, since, until, namespace)
    full, live = F.col("op") != "update", F.col("op") != "delete"
    at = lambda c: F.when(live & F.col(c).isNotNull(), F.col("seq"))
    state = inside.groupBy(*KEY).agg(
        F.max("seq").alias("last_seq"), F.max_by("op", "seq").alias("last_op"), F.max(F.when(full, F.col("seq"))).alias("full_seq"), F.max_by("op", F.when(full, F.col("seq"))).alias("full_op"),
        F.max_by("values", at("values")).alias("values"), F.max(at("values")).alias("values_at"), F.max(at("metadata")).alias("metadata_at"),
    )
    # The last value of each name in the whole window; it counts if no upsert or delete came after it.
    names = inside.where(live).select(*KEY, "seq", F.explode("metadata").alias("k", "v")).groupBy(*KEY, "k").agg(F.max_by("v", "seq").alias("v"), F.max("seq").alias("at"))
    meta = names.groupBy(*KEY).agg(F.collect_list(F.struct("at", "k", "v")).alias("names"))
    patch = F.lit("upsert") if resolve_delete else F.lit("update")
    op = F.when(F.col("last_op") != "update", F.col("last_op")).when(F.col("full_op") == "upsert", "upsert").when(F.col("full_op") == "delete", patch).otherwise("update")
    folded = state.join(meta, KEY, "left").withColumn("op", op).withColumn("begin", F.coalesce("full_seq", F.lit(since)))
    kept = F.filter(F.coalesce("names", F.array()), lambda e: e["at"] >= F.col("begin"))
    there = F.col("op") != "delete"
    metadata = F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))
    return folded.select(
        *KEY, F.col("last_seq").alias("seq"), "op", F.when(there & (F.col("values_at") >= F.col("begin")), F.col("values")).alias("values"),
        F.when(there & (F.col("metadata_at") >= F.col("begin")), metadata).alias("metadata"),
    )


def action_stats(actions: DataFrame) -> DataFrame:
    """One row: upserted, updated, deleted, through_seq."""
    n = lambda op: F.count_if(F.col("op") == op)
    return actions.agg(n("upsert").alias("upserted"), n("update").alias("updated"), n("delete").alias("deleted"), F.coalesce(F.max("seq"), F.lit(0)).cast("long").alias("through_seq"))


def append(log: DataFrame, changes: DataFrame, now: float) -> DataFrame:
    """Rows to add to a log: changes (order, namespace, doc_id, op, values, metadata) numbered after its head, stamped with one time."""
    from docflow.operators.batching import numbered

    bad = changes.where(~F.col("op").isin(*OPS)).select("op").first()
    if bad:
        raise ValueError(f"unknown operation {bad['op']!r}")
    head = head_seq(log).first()["head"]
    rows = numbered(changes, "order")
    return rows.select((F.col("row_number") + head).cast("long").alias("seq"), F.lit(float(now)).alias("ts"), *KEY, "op", "values", "metadata")

"""Replaying a log into a collection of documents as one idempotent merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.values import merged
from docflow.lineage import cut
from docflow.operators import changelog, mapping

DOC = ["namespace", "doc_id", "values", "metadata"]


@dataclass
class Applied:
    """documents: the collection after the merge. parked: changes kept aside (seq, namespace, doc_id, reason). cursor: where to go on."""

    documents: DataFrame
    parked: DataFrame
    actions: DataFrame
    cursor: int


def park(actions: DataFrame, text_key: str | None) -> tuple[DataFrame, DataFrame]:
    """(actions to apply, parked): upserts without a text are parked; the cursor passes them all the same."""
    if text_key is None:
        return actions, actions.where("false").select("seq", "namespace", "doc_id", F.lit("").alias("reason"))
    no_text = (F.col("op") == "upsert") & (F.coalesce(F.element_at("metadata", F.lit(text_key)).cast("string"), F.lit("")) == "")
    no_text = F.coalesce(no_text, F.col("op") == "upsert")
    return actions.where(~no_text), actions.where(no_text).select("seq", "namespace", "doc_id", F.concat(F.lit("no text in "), F.lit(text_key)).alias("reason"))


def merge(documents: DataFrame, actions: DataFrame) -> DataFrame:
    """Upserts replace or add, updates change the fields that they name (adding an absent document), deletes remove if present."""
    a = actions.select(*changelog.KEY, F.col("op").alias("_op"), F.col("values").alias("_values"), F.col("metadata").alias("_metadata"))
    both = documents.select(*DOC).join(a, changelog.KEY, "full_outer").where("_op is null or _op <> 'delete'")
    patch = F.col("_op") == "update"
    return both.select(
        *changelog.KEY,
        F.when(F.col("_op").isNull(), F.col("values")).when(patch, F.coalesce("_values", "values")).otherwise(F.col("_values")).alias("values"),
        F.when(F.col("_op").isNull(), F.col("metadata")).when(patch, merged(F.col("metadata"), F.col("_metadata"))).otherwise(F.col("_metadata")).alias("metadata"),
    )


def apply(documents: DataFrame, log: DataFrame, cursor: int = 0, until: int | None = None, namespace: str | None = None, text_key: str | None = None) -> Applied:
    """Folds the window after the cursor and merges it. The cursor moves to the head of the whole log, or to until."""
    head = changelog.head_seq(log).first()["head"] if until is None else until
    actions, parked = park(changelog.fold(log, cursor, head, namespace), text_key)
    return Applied(merge(documents, actions), parked, actions, max(cursor, head))


def mapped(actions: DataFrame, m: mapping.Mapping) -> DataFrame:
    """seq, namespace, doc_id, op, values, metadata, error_code, status (converted, skipped, failed) of folded actions with metadata of variants.

    Upserts go through all checks of a record and patches through those of names and types; both get their new names.
    Deletes pass as they are. Texts stand among the metadata under the names of their fields.
    """
    as_records = actions.withColumnRenamed("doc_id", "id")
    whole = mapping.map_records(as_records.where("op = 'upsert'"), m)
    texts = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(f).alias("key"), F.col(f"texts.{f}").cast("variant").alias("value")) for f in m.text_fields]), lambda e: e["value"].isNotNull()))
    part = mapping.map_patches(as_records.where("op = 'update'"), m)
    part = part.withColumn("error_code", F.when(F.coalesce("id", F.lit("")) == "", "empty_id").otherwise(F.col("error_code")))
    cols = ["seq", "namespace", F.col("id").alias("doc_id"), "op", "values"]
    return (
        whole.select(*cols, F.map_concat("meta", texts).alias("metadata"), "error_code", "status")
        .unionByName(part.select(*cols, F.col("meta").alias("metadata"), "error_code", F.when(F.col("error_code").isNull(), "converted").otherwise("failed").alias("status")))
        .unionByName(as_records.where("op = 'delete'").select(*cols, "metadata", F.lit(None).cast("string").alias("error_code"), F.lit("converted").alias("status")))
    )


def applied_stats(actions: DataFrame, head: int) -> DataFrame:
    """One row of mapped actions: upserted, updated, deleted, skipped, through_seq (head)."""
    n = lambda op: F.count_if((F.col("status") == "converted") & (F.col("op") == op))
    return actions.agg(n("upsert").alias("upserted"), n("update").alias("updated"), n("delete").alias("deleted"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.lit(head).cast("long").alias("through_seq"))


def apply_mapped(documents: DataFrame, log: DataFrame, m: mapping.Mapping, cursor: int = 0, until: int | None = None, namespace: str | None = None, dry_run: bool = False) -> Applied:
    """Folds the window after the cursor, maps every action and merges it.

    One action that fails a check raises MappingError, the one of the smallest seq, before anything is merged. Upserts
    without a text, where the mapping allows for that, are parked and the cursor passes them. A dry run gives the
    actions alone: documents and cursor stay, nothing is parked.
    """
    head = changelog.head_seq(log).first()["head"] if until is None else until
    actions = cut(mapped(changelog.fold(log, cursor, head, namespace), m))
    bad = actions.where("status = 'failed'").orderBy("seq").select("seq", "doc_id", "error_code").first()
    if bad:
        raise mapping.MappingError(f"change {bad['seq']} of {bad['doc_id']}: {bad['error_code']}")
    parked = actions.where("status = 'skipped'").select("seq", "namespace", "doc_id", F.lit("no text for the full-text field").alias("reason"))
    if dry_run:
        return Applied(documents.select(*DOC), parked.where("false"), actions, cursor)
    return Applied(merge(documents, actions.where("status = 'converted'")), parked, actions, max(cursor, head))


def unapplied_count(parked: DataFrame) -> DataFrame:
    """One row: how many changes are kept aside."""
    return parked.agg(F.count_distinct("seq").alias("unapplied"))


def unapplied(parked: DataFrame, limit: int = 100) -> DataFrame:
    return parked.orderBy("seq").limit(limit)


def clear_unapplied(parked: DataFrame, done: DataFrame) -> DataFrame:
    return parked.join(done.select("seq"), "seq", "left_anti")


def all_searchable(documents: DataFrame, ids: DataFrame, sample: int = 100) -> bool:
    """Whether the first ids are all among the documents; true for none."""
    return ids.orderBy("doc_id").limit(sample).join(documents.select("doc_id"), "doc_id", "left_anti").isEmpty()

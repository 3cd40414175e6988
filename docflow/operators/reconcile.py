"""Proof that two collections agree: counts, ids, fields and search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import vectors
from docflow.functions.values import canonical
from docflow.operators.mapping import renamed


def record_counts(records: DataFrame) -> DataFrame:
    """Rows of each namespace; an empty name is the default one."""
    name = F.coalesce(F.nullif(F.col("namespace"), F.lit("")), F.lit("__default__"))
    return records.groupBy(name.alias("namespace")).agg(F.count("*").alias("records"))


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: source, target, differ_by, ok."""
    both = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(target.select(F.lit(0).alias("s"), F.lit(1).alias("t")))
    n = both.agg(F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("source"), F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("target"))
    return n.withColumn("differ_by", F.abs(F.col("source") - F.col("target"))).withColumn("ok", F.col("source") == F.col("target"))


def missing_ids(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.select("id").join(target.select("id"), "id", "left_anti").distinct()


def diff_ids(source: DataFrame, target: DataFrame) -> DataFrame:
    """(id, side): missing from the target or orphaned in it; one shuffle of both sides."""
    marked = source.select("id", F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(target.select("id", F.lit(0).alias("s"), F.lit(1).alias("t")))
    sides = marked.groupBy("id").agg(F.max("s").alias("s"), F.max("t").alias("t")).where("s <> t")
    return sides.select("id", F.when(F.col("s") == 1, "missing").otherwise("orphaned").alias("side"))


def sampled_missing(source: DataFrame, target: DataFrame, sample: int) -> DataFrame:
    """Of the first `sample` ids of the source those that the target lacks."""
    return source.select("id").distinct().orderBy("id").limit(sample).join(target.select("id"), "id", "left_anti")


def digest(text: Column) -> Column:
    """32 bytes that stand for a text: its SHA-256; a text of fewer bytes stands for itself."""
    own = text.cast("binary")
    return F.when(F.octet_length(own) < 32, own).otherwise(F.unhex(F.sha2(own, 256)))


def source_digests(source: DataFrame, text_key: str = "text", text_fields: tuple[str, ...] = ("text",), rename: dict[str, str] | None = None, drop: tuple[str, ...] = (), canonical_of=canonical) -> DataFrame:
    """The metadata map replaced by text_digest, names and digests: of the text, and of what is compared besides in the map's order, under new names."""

    def compared(key: Column, _: Column) -> Column:
        name = renamed(key, rename or {})
        skip = (key == text_key) | name.isin(*text_fields)
        if drop:
            skip = skip | name.isin(*drop) | key.isin(*drop)
        return ~skip

    kept = F.map_filter("metadata", compared)
    names = F.transform(F.map_keys(kept), lambda k: renamed(k, rename or {}))
    digests = F.transform(F.transform(F.map_values(kept), canonical_of), digest)
    return source.select("*", digest(canonical_of(F.element_at("metadata", F.lit(text_key)))).alias("text_digest"), names.alias("names"), digests.alias("digests")).drop("metadata")


def target_digests(target: DataFrame, text_fields: tuple[str, ...] = ("text",), drop: tuple[str, ...] = (), canonical_of=canonical) -> DataFrame:
    """The text and the metadata map replaced by text_digest and by_name, a map of digests."""
    text = F.concat(F.lit("s:"), F.col("text")) if canonical_of is canonical else F.col("text")
    texts = F.transform_values(F.map_filter("metadata", lambda k, _: ~k.isin(*text_fields, *drop)), lambda _, v: canonical_of(v))
    return target.select("*", digest(text).alias("text_digest"), F.transform_values(texts, lambda _, v: digest(v)).alias("by_name")).drop("text", "metadata")


def compare_fields(source: DataFrame, target: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """(id, vector_differs, text_differs, key) of all rows on both sides, from source_digests and target_digests; vectors are compared as they are."""
    both = source.select("id", F.col("values").alias("sv"), F.col("text_digest").alias("sd"), "names", "digests").join(target.select("id", F.col("values").alias("tv"), F.col("text_digest").alias("td"), "by_name"), "id")
    key = F.get(F.filter("names", lambda name, i: ~F.get("digests", i).eqNullSafe(F.element_at("by_name", name))), F.lit(0))
    return both.select("id", (~vectors.all_close(F.col("sv"), F.col("tv"), tolerance)).alias("vector_differs"), (~F.col("sd").eqNullSafe(F.col("td"))).alias("text_differs"), key.alias("key"))


def differing(compared: DataFrame) -> DataFrame:
    return compared.where("vector_differs or text_differs or key is not null")


def diff_fields(source: DataFrame, target: DataFrame, text_key: str = "text", text_fields: tuple[str, ...] = ("text",), rename: dict[str, str] | None = None, drop: tuple[str, ...] = (), tolerance: float = 1e-4, canonical_of=canonical) -> DataFrame:
    """(id, vector_differs, text_differs, key) of rows on both sides that differ.

    source: id, values, metadata map; target: id, values, text, metadata map. key is the first metadata name, in the
    source's order, whose value differs; the text, dropped names and declared text fields are not compared.
    canonical_of gives a value's text. Only digests of texts and values meet, not they themselves.
    """
    s = source_digests(source.select("id", "values", "metadata"), text_key, text_fields, rename, drop, canonical_of)
    t = target_digests(target.select("id", "values", "text", "metadata"), text_fields, drop, canonical_of)
    return differing(compare_fields(s, t, tolerance))


def field_report(differences: DataFrame, checked: int | None = None) -> DataFrame:
    """One row: checked, vector_mismatches, text_mismatches, metadata_mismatches, ok. checked: how many were compared; by default as many as there are rows, for all that compare_fields gives."""
    n = lambda c: F.count_if(c)
    out = differences.agg((F.count("*") if checked is None else F.lit(checked)).cast("long").alias("checked"), n(F.col("vector_differs")).alias("vector_mismatches"), n(F.col("text_differs")).alias("text_mismatches"), n(F.col("key").isNotNull()).alias("metadata_mismatches"))
    return out.select("*", ((F.col("vector_mismatches") + F.col("text_mismatches") + F.col("metadata_mismatches")) == 0).alias("ok"))


def verdict(source: DataFrame, target: DataFrame, differences: DataFrame, parked: DataFrame | None = None) -> DataFrame:
    """One row: counts_ok, ids_ok, fields_ok, parked, ok. Parked changes are told but do not count."""
    parts = [compare_counts(source, target).select(F.col("ok").cast("int").alias("c"), F.lit(0).alias("i"), F.lit(0).alias("f"), F.lit(0).alias("p"))]
    parts.append(diff_ids(source, target).select(F.lit(1).alias("c"), F.lit(1).alias("i"), F.lit(0).alias("f"), F.lit(0).alias("p")))
    parts.append(differences.select(F.lit(1).alias("c"), F.lit(0).alias("i"), F.lit(1).alias("f"), F.lit(0).alias("p")))
    if parked is not None:
        parts.append(parked.select(F.lit(1).alias("c"), F.lit(0).alias("i"), F.lit(0).alias("f"), F.lit(1).alias("p")))
    whole = parts[0]
    for x in parts[1:]:
        whole = whole.unionAll(x)
    one = whole.agg((F.min("c") == 1).alias("counts_ok"), (F.max("i") == 0).alias("ids_ok"), (F.max("f") == 0).alias("fields_ok"), F.sum("p").cast("long").alias("parked"))
    return one.withColumn("ok", F.col("counts_ok") & F.col("ids_ok") & F.col("fields_ok"))


def parity(source_hits: DataFrame, target_hits: DataFrame) -> DataFrame:
    """hits: query_id, id. Of each query of either side: recall (share of the source's hits that the target has), jaccard, and how many the target lacks; recall is null without source hits."""
    marked = source_hits.select("query_id", "id", F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(target_hits.select("query_id", "id", F.lit(0).alias("s"), F.lit(1).alias("t")))
    each = marked.groupBy("query_id", "id").agg(F.max("s").alias("s"), F.max("t").alias("t"))
    n = each.groupBy("query_id").agg(F.sum(F.col("s") * F.col("t")).alias("both"), F.sum("s").alias("source"), F.count("*").alias("either"))
    return n.select("query_id", (F.col("both") / F.nullif(F.col("source"), F.lit(0))).alias("recall"), F.when(F.col("source") > 0, F.col("both") / F.col("either")).alias("jaccard"), (F.col("source") - F.col("both")).alias("shortfall"))


def absent_hits(source_hits: DataFrame, target_hits: DataFrame, target: DataFrame) -> DataFrame:
    """Ids that the target's results lack and that it does not hold at all."""
    short = source_hits.select("query_id", "id").join(target_hits.select("query_id", "id"), ["query_id", "id"], "left_anti")
    return short.select("id").distinct().join(target.select("id"), "id", "left_anti")


def parity_report(of_queries: DataFrame, absent: DataFrame, min_recall: float = 0.99) -> DataFrame:
    """One row: queries, recall, jaccard, absent, ok. Results may rank otherwise: it is sound with enough recall, or if no id is absent."""
    a = of_queries.where("recall is not null").select("recall", "jaccard", F.lit(0).alias("absent"), F.lit(1).alias("q")).unionAll(absent.select(F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(1), F.lit(0)))
    one = a.agg(F.coalesce(F.sum("q"), F.lit(0)).cast("long").alias("queries"), F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall"), F.coalesce(F.avg("jaccard"), F.lit(0.0)).alias("jaccard"), F.coalesce(F.sum("absent"), F.lit(0)).cast("long").alias("absent"))
    return one.withColumn("ok", (F.col("recall") >= min_recall) | (F.col("absent") == 0))


def probes(records: DataFrame, n: int, seed: int = 3) -> DataFrame:
    """n records chosen by a hash of the id: the same ones for the same seed."""
    return records.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n)

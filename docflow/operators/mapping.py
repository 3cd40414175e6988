"""Records to documents: renaming, validation in a fixed order, limits and an error policy, all in one projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import text as T
from docflow.functions import values as V


class MappingError(ValueError):
    """A record that cannot become a document, under the strict policy."""


@dataclass(frozen=True)
class Limits:
    """Fixed values of the document service."""

    id_chars: int = 512
    name_bytes: int = 64
    text_bytes: int = 102_400
    text_tokens: int = 10_000
    metadata_bytes: int = 40_960
    document_bytes: int = 2_097_152


@dataclass(frozen=True)
class Mapping:
    dense_field: str = "embedding"
    text_fields: tuple[str, ...] = ("text",)
    dimension: int | None = None
    rename: dict[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    allow_missing_text: bool = False
    limits: Limits = Limits()


def valid_name(name: Column, limit: int = Limits.name_bytes) -> Column:
    """Not empty, no reserved first character, short enough."""
    return name.rlike(r"(?s)^[^_$]") & (F.octet_length(name) <= limit)


def renamed(key: Column, rename: dict[str, str]) -> Column:
    if not rename:
        return key
    table = F.create_map(*[F.lit(x) for pair in rename.items() for x in pair])
    return F.coalesce(F.element_at(table, key), key)


def clean_metadata(metadata: Column, m: Mapping) -> Column:
    """Metadata under their new names without what is dropped or null; of keys renamed alike the last counts."""
    entries = F.transform(F.map_entries(metadata), lambda e: F.struct(renamed(e["key"], m.rename).alias("key"), e["key"].alias("raw"), e["value"].alias("value")))
    kept = F.filter(entries, lambda e: ~V.is_null(e["value"]) & (~(e["key"].isin(*m.drop) | e["raw"].isin(*m.drop)) if m.drop else F.lit(True)))
    if not m.rename:  # the names of a map differ
        return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))

    def last_of_each(kept: Column) -> Column:
        names = F.transform(kept, lambda e: e["key"])
        last = F.filter(kept, lambda e, i: ~F.exists(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), lambda k: k == e["key"]))
        return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))

    return once(kept, last_of_each)


def once(x: Column, make) -> Column:
    """make(x) with x evaluated once, however often it is used."""
    return F.get(F.transform(F.array(x), make), F.lit(0))


def entry_error(key: Column, value: Column, m: Mapping) -> Column:
    def of_kind(k: Column) -> Column:
        return (
            F.when(~valid_name(key, m.limits.name_bytes), F.concat(F.lit("bad_name:"), key))
            .when(key.isin(m.dense_field, "_id"), F.concat(F.lit("name_collision:"), key))
            .when(k["storable"], F.lit(None).cast("string"))
            .when(k["kind"].startswith("ARRAY"), F.concat(F.lit("list_of_non_strings:"), key))
            .otherwise(F.concat(F.lit("unsupported_type:"), key))
        )

    return once(once(V.kind(value), lambda k: F.struct(k.alias("kind"), V.is_storable(value, k).alias("storable"))), of_kind)


def first_entry_error(clean: Column, m: Mapping) -> Column:
    return F.get(F.filter(F.transform(F.map_entries(clean), lambda e: entry_error(e["key"], e["value"], m)), lambda x: x.isNotNull()), F.lit(0))


def map_records(records: DataFrame, m: Mapping = Mapping()) -> DataFrame:
    """records: id, values array<double>, metadata map<string,variant>, maybe sparse struct<indices:array<int>,values:array<float>>; other columns are carried.

    Adds texts (struct of the text fields), meta (the other metadata under their new names), error_code (the first
    check that fails; null for a sound row) and status: converted, skipped (no text, where allowed) or failed. Metadata
    are cleaned once a row; a record whose sparse indices and values differ in number, or repeat an index, fails.
    """
    values = F.col("values")

    def parts(clean: Column) -> Column:
        texts = F.struct(*[V.as_text(F.element_at(clean, F.lit(f))).alias(f) for f in m.text_fields])
        return once(F.struct(texts.alias("texts"), first_entry_error(clean, m).alias("entry")), lambda t: F.struct(t["texts"].alias("texts"), F.map_filter(clean, lambda k, _: ~k.isin(*m.text_fields)).alias("meta"), code(t).alias("code")))

    def code(t: Column) -> Column:
        missing = F.lit(False)
        for f in m.text_fields:
            missing = missing | (F.coalesce(t["texts"][f], F.lit("")) == "")
        out = (
            F.when(F.coalesce("id", F.lit("")) == "", F.lit("empty_id"))
            .when(F.char_length("id") > m.limits.id_chars, F.lit("id_too_long"))
            .when(values.isNull(), F.lit("no_dense_values"))
        )
        if m.dimension is not None:
            out = out.when(F.size("values") != m.dimension, F.lit("wrong_dimension"))
        if "sparse" in records.columns:
            x = F.col("sparse")
            out = out.when(x.isNotNull() & ~F.coalesce((F.size(x["indices"]) == F.size(x["values"])) & (F.size(F.array_distinct(x["indices"])) == F.size(x["indices"])), F.lit(False)), F.lit("bad_sparse_values"))
        out = out.when(t["entry"].isNotNull(), t["entry"]).when(missing, F.lit("missing_text"))
        for f in m.text_fields:
            text = t["texts"][f]  # a text has at most half as many tokens as characters, and one
            many = (F.char_length(text) + 1 > 2 * m.limits.text_tokens) & (T.n_tokens(text) > m.limits.text_tokens)
            out = out.when(T.n_bytes(text) > m.limits.text_bytes, F.lit(f"text_too_large:{f}")).when(many, F.lit(f"too_many_tokens:{f}"))
        return out

    clean = clean_metadata(F.coalesce("metadata", F.from_json(F.lit("{}"), "map<string,variant>")), m)
    df = records.withColumn("_x", once(clean, parts)).withColumn("texts", F.col("_x.texts")).withColumn("meta", F.col("_x.meta"))
    df = _sizes(df.withColumn("error_code", F.col("_x.code")).drop("_x"), m)
    status = F.when(F.col("error_code").isNull(), "converted").when((F.col("error_code") == "missing_text") & F.lit(m.allow_missing_text), "skipped").otherwise("failed")
    return df.withColumn("status", status)


def _sizes(df: DataFrame, m: Mapping) -> DataFrame:
    """Limits on the written JSON. Its exact size needs Python, which gets the JSON of only those rows that a bound does not clear."""
    meta = F.to_json("meta")
    of_meta = V.json_size_bound(meta)
    of_whole = of_meta + 27 * F.size("values") + V.json_size_bound(F.col("id")) + 7 * F.size("meta") + 100 + 8 * len(m.dense_field)
    for f in m.text_fields:
        of_whole = of_whole + F.coalesce(V.json_size_bound(F.col(f"texts.{f}")), F.lit(4)) + 8 * len(f)
    if "sparse" in df.columns:
        of_whole = of_whole + F.coalesce(40 * F.size("sparse.indices"), F.lit(0)) + 40
    sound = F.col("error_code").isNull()
    df = df.withColumn("_meta", V.json_size(F.when(sound & (of_meta > m.limits.metadata_bytes), meta))).withColumn("_whole", V.json_size(F.when(sound & (of_whole > m.limits.document_bytes), document_json(m, "sparse" in df.columns))))
    code = F.when(F.col("error_code").isNotNull(), F.col("error_code")).when(F.col("_meta") > m.limits.metadata_bytes, "metadata_too_large").when(F.col("_whole") > m.limits.document_bytes, "document_too_large")
    return df.withColumn("error_code", code).drop("_meta", "_whole")


def document_json(m: Mapping, sparse: bool = False) -> Column:
    """One JSON object with the id, the vector, sparse values where there are some, the text fields and all metadata at the top level."""
    more = [F.col("sparse").alias("sparse_values")] if sparse else []
    head = F.to_json(F.struct(F.col("id").alias("_id"), F.col("values").cast("array<double>").alias(m.dense_field), *more, *[F.col(f"texts.{f}").alias(f) for f in m.text_fields]))
    tail = F.to_json("meta")
    return F.when(F.size("meta") > 0, F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(","), F.substring(tail, F.lit(2), F.length(tail)))).otherwise(head)


def documents(mapped: DataFrame) -> DataFrame:
    return mapped.where("status = 'converted'").drop("status", "error_code")


def mapping_stats(mapped: DataFrame) -> DataFrame:
    """One row: rows, converted, skipped_missing_text, failed."""
    n = lambda s: F.count_if(F.col("status") == s)
    return mapped.agg(F.count("*").alias("rows"), n("converted").alias("converted"), n("skipped").alias("skipped_missing_text"), n("failed").alias("failed"))


def first_errors(mapped: DataFrame, n: int = 20) -> DataFrame:
    return mapped.where("status = 'failed'").select("id", "error_code").orderBy("id").limit(n)


def strict(mapped: DataFrame) -> DataFrame:
    """The documents, or the first error by id raised."""
    bad = mapped.where("status = 'failed'").orderBy("id").select("id", "error_code").first()
    if bad:
        raise MappingError(f"{bad['id']}: {bad['error_code']}")
    return documents(mapped)


def map_patches(patches: DataFrame, m: Mapping = Mapping()) -> DataFrame:
    """Partial writes: only names and types are checked. Adds meta and error_code."""
    clean = clean_metadata(F.coalesce("metadata", F.from_json(F.lit("{}"), "map<string,variant>")), m)
    df = patches.withColumn("_x", once(clean, lambda c: F.struct(c.alias("meta"), first_entry_error(c, m).alias("code"))))
    return df.withColumn("meta", F.col("_x.meta")).withColumn("error_code", F.col("_x.code")).drop("_x")

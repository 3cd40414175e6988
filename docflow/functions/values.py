"""Expressions over dynamically typed metadata: maps from names to variants."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_metadata(text: Column) -> Column:
    """map<string,variant> of a JSON object, the last of repeated keys counting; null for what is no JSON object."""
    parsed = F.from_json(text, "map<string,variant>")
    keys = F.map_keys(parsed)
    last = F.filter(F.map_entries(parsed), lambda e, i: ~F.exists(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), lambda k: k == e["key"]))
    return F.map_from_entries(last)


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_null(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def is_storable(value: Column, of_kind: Column | None = None) -> Column:
    """A text, number or boolean, or a list of texts. of_kind: the value's kind, where it is known."""
    k = kind(value) if of_kind is None else of_kind
    return k.rlike(r"^(STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|ARRAY<(STRING|VOID)>)$") & ~((k == "ARRAY<VOID>") & (F.to_json(F.struct(value.alias("v"))) != '{"v":[]}'))


def as_text(value: Column) -> Column:
    """The text of a variant that is one, else null."""
    return F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def canonical(value: Column) -> Column:
    """A text that is equal for equal values: numbers and booleans by their value as doubles (whole numbers beyond 2^53 lose digits)."""
    k = kind(value)
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("string"))
        .when(k == "BOOLEAN", F.concat(F.lit("n:"), F.when(F.try_variant_get(value, "$", "boolean"), F.lit("1.0")).otherwise(F.lit("0.0"))))
        .when(k.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.concat(F.lit("n:"), number.cast("string")))
        .when(k == "STRING", F.concat(F.lit("s:"), F.try_variant_get(value, "$", "string")))
        .otherwise(F.concat(F.lit("j:"), F.to_json(F.struct(value.alias("v")))))
    )


def merged(base: Column, patch: Column) -> Column:
    """Both maps, the patch's values counting for keys of both; a null map is empty."""
    return F.when(base.isNull(), patch).when(patch.isNull(), base).otherwise(F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(patch), k)), patch))


def json_size(text: Column) -> Column:
    """Bytes of a JSON text as written with spaces after separators and other than ASCII characters escaped; an Arrow-batched function."""

    def size(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else len(json.dumps(json.loads(t)).encode())).astype("Int64")

    size.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(size, "long").asNondeterministic()(text)  # else filters on its result would run the function once more


def json_size_bound(text: Column) -> Column:
    """A number of bytes that json_size never exceeds: six for each byte, and a space after each."""
    return F.octet_length(text).cast("long") * 7

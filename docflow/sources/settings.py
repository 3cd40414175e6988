"""Settings from a YAML or JSON file with ${NAME} taken from the environment, and the schema of a document collection."""

from __future__ import annotations

import copy
import json
import os
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import types as Y

METRICS = ("cosine", "dotproduct", "euclidean")


class ConfigError(ValueError):
    pass


@dataclass
class Source:
    index: str = ""
    namespace: str = "__default__"
    text_metadata_key: str = "text"


@dataclass
class Target:
    index: str = ""
    dense_field: str = "embedding"
    text_fields: tuple[str, ...] = ("text",)
    namespace: str = "__default__"
    schema_file: str | None = None
    schema: dict | None = None
    full_text_search: dict = field(default_factory=dict)
    field_options: dict = field(default_factory=dict)

    def options_for(self, name: str) -> dict:
        """A field's own analyzer options, or the shared ones."""
        return self.field_options.get(name) or self.full_text_search


@dataclass
class Settings:
    source: Source = field(default_factory=Source)
    target: Target = field(default_factory=Target)
    rows_per_file: int = 25_000
    gzip: bool = True
    drop_fields: tuple[str, ...] = ()
    rename_fields: dict = field(default_factory=dict)
    batch_size: int = 500
    unresolved: set[str] = field(default_factory=set)


def expand(value, unresolved: set[str]):
    """Replaces ${NAME} and known $NAME in texts at any depth; an unknown ${NAME} becomes blank and is remembered."""

    def found(m: re.Match) -> str:
        braced, bare = m.groups()
        if (known := os.environ.get(bare if braced is None else braced)) is not None:
            return known
        if braced is None:
            return m.group()
        unresolved.add(braced)
        return ""

    match value:
        case str():
            return re.sub(r"\$(?:\{([^}]*)\}|(\w+))", found, value, flags=re.ASCII)
        case dict():
            return {k: expand(v, unresolved) for k, v in value.items()}
        case list():
            return [expand(v, unresolved) for v in value]
    return value


def load(path: str) -> Settings:
    text = Path(path).read_text()
    if path.endswith(".json"):
        raw = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise ConfigError("YAML settings need the yaml package; JSON works without") from e
        raw = yaml.safe_load(text)
    missing: set[str] = set()
    raw = expand(raw or {}, missing)

    def part(kind, given: dict):
        unknown = set(given) - set(kind.__dataclass_fields__)
        if unknown:
            raise ConfigError(f"unknown settings: {', '.join(sorted(unknown))}")
        return kind(**given)

    target = dict(raw.get("target") or {})
    fields_ = target.get("text_fields")
    if isinstance(fields_, dict):
        target |= {"text_fields": tuple(fields_), "field_options": {k: v or {} for k, v in fields_.items()}}
    elif fields_ is not None:
        target["text_fields"] = tuple(fields_)
    if target.get("schema_file"):
        target["schema"] = load_schema(target["schema_file"])
        declared = target["schema"]["fields"]
        target["dense_field"] = next(k for k, v in declared.items() if v["type"] == "dense_vector")
        target["text_fields"] = tuple(k for k, v in declared.items() if v["type"] == "string" and v.get("full_text_search") is not None)
    convert = raw.get("convert") or {}
    return Settings(
        part(Source, raw.get("source") or {}), part(Target, target), int((raw.get("export") or {}).get("rows_per_file", 25_000)), bool(convert.get("gzip", True)),
        tuple(convert.get("drop_fields") or ()), dict(convert.get("rename_fields") or {}), int((raw.get("cdc") or {}).get("batch_size", 500)), missing,
    )


def load_schema(path: str) -> dict:
    """A schema file, checked in this order: there, JSON, fields, names, one dense vector, a searchable text."""
    if not Path(path).exists():
        raise ConfigError(f"no schema file {path}")
    try:
        raw = json.loads(Path(path).read_text())
    except ValueError as e:
        raise ConfigError(f"{path} is not JSON: {e}") from e
    fields_ = raw.get("fields") if isinstance(raw, dict) else None
    if not isinstance(fields_, dict) or not fields_:
        raise ConfigError("a schema needs fields")
    if any(n.startswith("_") for n in fields_):
        raise ConfigError("field names may not begin with _")
    if sum(f.get("type") == "dense_vector" for f in fields_.values()) != 1:
        raise ConfigError("a schema needs one dense_vector")
    if not any(f.get("type") == "string" and f.get("full_text_search") is not None for f in fields_.values()):
        raise ConfigError("a schema needs a string field with full_text_search")
    return raw


def build_schema(settings: Settings, dimension: int, metric: str = "cosine") -> dict:
    """The declared fields; a given schema gets dimension and metric filled in, or must agree with them."""
    t = settings.target
    if t.schema is None:
        fields_ = {t.dense_field: {"type": "dense_vector", "dimension": dimension, "metric": metric}}
        return {"fields": fields_ | {f: {"type": "string", "full_text_search": t.options_for(f) or True} for f in t.text_fields}}
    out = copy.deepcopy(t.schema)
    for name, f in out["fields"].items():
        if f["type"] == "dense_vector":
            for key, value in (("dimension", dimension), ("metric", metric)):
                if f.setdefault(key, value) != value:
                    raise ConfigError(f"{name}: {key} is {f[key]}, the source has {value}")
    return out


def check_analyzer(options: dict) -> None:
    """N-grams of 1 to 10 characters, without stemming or stop words on the same field."""
    if gram := options.get("ngram"):
        if not 1 <= gram.get("min_gram", 1) <= gram.get("max_gram", 10) <= 10:
            raise ConfigError("n-grams have 1 to 10 characters")
        if options.get("stemming") or options.get("stop_words"):
            raise ConfigError("a field with n-grams has neither stemming nor stop words")


def struct_type(schema: dict) -> Y.StructType:
    """Columns of the declared fields; what was declared of them stands in their metadata."""
    kinds = {"dense_vector": Y.ArrayType(Y.DoubleType()), "sparse_vector": Y.StructType([Y.StructField("indices", Y.ArrayType(Y.IntegerType())), Y.StructField("values", Y.ArrayType(Y.FloatType()))]), "string": Y.StringType()}
    return Y.StructType([Y.StructField("_id", Y.StringType(), False), *[Y.StructField(n, kinds[f["type"]], True, {k: v for k, v in f.items() if k != "type"}) for n, f in schema["fields"].items()]])

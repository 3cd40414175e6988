"""Registered queries over the generated tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions import text as T
from docflow.functions import vectors
from docflow.lineage import cut, shared_folder
from docflow.operators import batching, changelog, mapping, reconcile, replay, routing, search
from docflow.sources import records as R
from docflow.sources import synthetic

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# The tables as records, documents and a change log.


def metadata() -> Column:
    return F.create_map(F.lit("text"), "text", F.lit("lang"), "lang", F.lit("source"), "source", F.lit("n_chars"), F.col("n_chars").cast("string"))


def records(spark: SparkSession, d: str, with_vectors: str = "inner") -> DataFrame:
    """Documents with vectors of the same number, text and other columns as metadata of texts."""
    docs, e = table(spark, d, "documents"), table(spark, d, "embeddings")
    joined = docs.join(e, docs["doc_id"] == e["vec_id"], with_vectors)
    return joined.select(F.col("doc_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("values"), metadata().alias("metadata"), F.col("lang").alias("namespace"), "doc_id", "text", "label")


def variants(df: DataFrame) -> DataFrame:
    """The same with numbers as numbers: metadata as it comes out of a JSON text."""
    meta = F.struct(F.element_at("metadata", F.lit("text")).alias("text"), F.element_at("metadata", F.lit("lang")).alias("lang"), F.element_at("metadata", F.lit("source")).alias("source"), F.element_at("metadata", F.lit("n_chars")).cast("long").alias("n_chars"))
    return df.withColumn("metadata", F.from_json(F.to_json(meta), "map<string,variant>"))


def changes(spark: SparkSession, d: str) -> DataFrame:
    """Events as a change log: signups and purchases write whole records, clicks and views change them, errors delete."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    op = F.when(F.col("event_type").isin("signup", "purchase"), "upsert").when(F.col("event_type") == "error", "delete").otherwise("update")
    kind = F.col("event_type")
    meta = (
        F.when(op == "upsert", F.create_map(F.lit("type"), kind, F.lit("k"), k))
        .when(kind == "click", F.create_map(F.lit("clicked"), F.col("event_id").cast("string")))
        .when(kind == "view", F.create_map(F.lit("k"), k))
    )
    return e.select(
        (F.col("event_id") + 1).alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("ts"), F.concat(F.lit("ns"), F.col("user_id") % 2).alias("namespace"), F.col("user_id").cast("string").alias("doc_id"),
        op.alias("op"), F.when(op == "upsert", F.array("value")).when(kind == "click", F.array("value")).alias("values"), meta.alias("metadata"),
    )


LOG = """log AS (
    SELECT event_id + 1 AS seq, ts, 'ns' || (user_id % 2) AS namespace, CAST(user_id AS VARCHAR) AS doc_id, event_type, value, json_extract_string(props, '$.k') AS k,
           CASE WHEN event_type IN ('signup', 'purchase') THEN 'upsert' WHEN event_type = 'error' THEN 'delete' ELSE 'update' END AS op
    FROM events)"""
FOLD = LOG + """, w AS (SELECT * FROM log WHERE {window}),
    st AS (SELECT namespace, doc_id, max(seq) AS last_seq, arg_max(op, seq) AS last_op, max(seq) FILTER (op <> 'update') AS full_seq, arg_max(op, seq) FILTER (op <> 'update') AS full_op FROM w GROUP BY ALL),
    live AS (SELECT w.* FROM w JOIN st USING (namespace, doc_id) WHERE w.op <> 'delete' AND (st.full_seq IS NULL OR w.seq >= st.full_seq)),
    folded AS (
        SELECT namespace, doc_id, last_seq AS seq,
               CASE WHEN last_op <> 'update' THEN last_op WHEN full_op = 'upsert' THEN 'upsert' ELSE 'update' END AS op,
               CASE WHEN last_op = 'delete' THEN NULL ELSE v END AS v, CASE WHEN last_op = 'delete' THEN NULL ELSE m_type END AS m_type,
               CASE WHEN last_op = 'delete' THEN NULL ELSE m_k END AS m_k, CASE WHEN last_op = 'delete' THEN NULL ELSE m_clicked END AS m_clicked
        FROM st LEFT JOIN (
            SELECT namespace, doc_id, arg_max(value, seq) FILTER (op = 'upsert' OR event_type = 'click') AS v, arg_max(event_type, seq) FILTER (op = 'upsert') AS m_type,
                   arg_max(k, seq) FILTER (op = 'upsert' OR event_type = 'view') AS m_k, arg_max(CAST(seq - 1 AS VARCHAR), seq) FILTER (event_type = 'click') AS m_clicked
            FROM live GROUP BY ALL) USING (namespace, doc_id))"""
RECORDS = """rec AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, text, lang, source, n_chars, CAST(embedding AS DOUBLE[]) AS v, label
    FROM documents JOIN embeddings ON doc_id = vec_id)"""
#: The records as they arrived elsewhere: some missing, some more, some changed.
TARGET = RECORDS + """, tgt AS (
    SELECT id, doc_id, CASE WHEN doc_id % 13 = 0 THEN text || '!' ELSE text END AS text, CASE WHEN doc_id % 11 = 0 THEN 'xx' ELSE lang END AS lang, source, n_chars,
           CASE WHEN doc_id % 7 = 0 THEN list_transform(v, lambda x: x + 0.01) ELSE v END AS v
    FROM rec WHERE doc_id % 17 <> 0
    UNION ALL SELECT '-' || id, -doc_id, text, lang, source, n_chars, v FROM rec WHERE doc_id % 50 = 1)"""
COS = "list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"


def arrived(df: DataFrame) -> DataFrame:
    """The rows that arrived elsewhere, some texts and metadata changed."""
    meta = F.transform_values("metadata", lambda k, v: F.when((k == "lang") & (F.col("doc_id") % 11 == 0), "xx").otherwise(v))
    return df.where("doc_id % 17 <> 0").withColumns({"text": F.when(F.col("doc_id") % 13 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")), "metadata": meta})


def drifted(df: DataFrame) -> DataFrame:
    """Some vectors changed."""
    return df.withColumn("values", F.when(F.col("doc_id") % 7 == 0, F.transform("values", lambda x: x + 0.01)).otherwise(F.col("values")))


def orphans(df: DataFrame) -> DataFrame:
    return df.where("doc_id % 50 = 1").withColumn("id", F.concat(F.lit("-"), "id"))


def target(spark: SparkSession, d: str) -> DataFrame:
    """id, values, text, metadata: the records as they arrived elsewhere."""
    r = records(spark, d).select("id", "values", "text", "metadata", "doc_id")
    return drifted(arrived(r)).unionByName(orphans(r)).drop("doc_id")


def probe(spark: SparkSession, d: str, vec_id: int = 0) -> list[float]:
    found = table(spark, d, "embeddings").where(F.col("vec_id") == vec_id).select(F.col("embedding").cast("array<double>")).first()
    return found[0] if found else []


# Scans and projection.

TOKENS = r"len(list_filter(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'), lambda x: x <> ''))"
WITHIN_LIMITS = f"strlen(text) <= 102400 AND {TOKENS} <= 10000"


@query(f"WITH {RECORDS} SELECT id FROM rec WHERE lang = 'en' ORDER BY id LIMIT 100")
def id_scan(spark, d):
    return R.scan_ids(records(spark, d), "en", 100)


@query(f"WITH {RECORDS} SELECT id, CAST(length(text) AS BIGINT) AS chars, CAST(len(v) AS BIGINT) AS dimension FROM rec WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def fetch_by_ids(spark, d):
    ids = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    found = R.fetch(records(spark, d), ids, ["id", "text", "values"])
    return found.select("id", F.length("text").cast("long").alias("chars"), F.size("values").cast("long").alias("dimension"))


@query(f"WITH {RECORDS} SELECT coalesce(nullif(CASE WHEN lang = 'es' THEN '' ELSE lang END, ''), '__default__') AS namespace, count(*) AS records FROM rec GROUP BY 1")
def record_counts_by_ns(spark, d):
    return reconcile.record_counts(records(spark, d).withColumn("namespace", F.when(F.col("namespace") == "es", "").otherwise(F.col("namespace"))))


@query(f"WITH {RECORDS} SELECT id, md5(text) AS text_md5, lang, source, n_chars, CAST(len(v) AS BIGINT) AS dimension FROM rec WHERE {WITHIN_LIMITS}")
def map_documents(spark, d):
    m = mapping.documents(mapping.map_records(variants(records(spark, d)), mapping.Mapping(dimension=64)))
    get = lambda k, t="string": F.variant_get(F.element_at("meta", F.lit(k)), "$", t)
    return m.select("id", F.md5("texts.text").alias("text_md5"), get("lang").alias("lang"), get("source").alias("source"), get("n_chars", "bigint").alias("n_chars"), F.size("values").cast("long").alias("dimension"))


@query(f"WITH {RECORDS}, fit AS (SELECT * FROM rec WHERE {WITHIN_LIMITS}) SELECT id, 'language' AS name, 's:' || lang AS value FROM fit UNION ALL SELECT id, 'n_chars', 'n:' || CAST(n_chars AS VARCHAR) || '.0' FROM fit")
def map_rename_drop(spark, d):
    from docflow.functions.values import canonical

    m = mapping.documents(mapping.map_records(variants(records(spark, d)), mapping.Mapping(rename={"lang": "language"}, drop=("source",))))
    return m.where("doc_id is not null").select("id", F.explode("meta").alias("name", "v")).select("id", "name", canonical(F.col("v")).alias("value"))


SMALL = mapping.Mapping(dimension=64, limits=mapping.Limits(text_bytes=4000, text_tokens=300))


@query(rf"""SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN embedding IS NULL THEN 'no_dense_values' WHEN doc_id % 10 = 3 THEN 'missing_text' WHEN strlen(text) > 4000 THEN 'text_too_large:text'
    WHEN {TOKENS} > 300 THEN 'too_many_tokens:text' END AS error_code FROM documents LEFT JOIN embeddings ON doc_id = vec_id
    WHERE embedding IS NULL OR doc_id % 10 = 3 OR strlen(text) > 4000 OR {TOKENS} > 300""")
def map_errors(spark, d):
    return mapping.map_records(_some_without_text(records(spark, d, "left")), SMALL).where("status = 'failed'").select("id", "error_code")


def _some_without_text(r: DataFrame) -> DataFrame:
    return variants(r.withColumn("metadata", F.when(F.col("doc_id") % 10 == 3, F.map_filter("metadata", lambda k, _: k != "text")).otherwise(F.col("metadata"))))


@query(rf"""WITH s AS (SELECT CASE WHEN embedding IS NULL THEN 'f' WHEN doc_id % 10 = 3 THEN 's' WHEN strlen(text) > 4000 OR {TOKENS} > 300 THEN 'f' ELSE 'c' END AS s FROM documents LEFT JOIN embeddings ON doc_id = vec_id)
    SELECT count(*) AS rows, count(*) FILTER (s = 'c') AS converted, count(*) FILTER (s = 's') AS skipped_missing_text, count(*) FILTER (s = 'f') AS failed FROM s""")
def map_stats(spark, d):
    lenient = mapping.Mapping(dimension=64, limits=SMALL.limits, allow_missing_text=True)
    return mapping.mapping_stats(mapping.map_records(_some_without_text(records(spark, d, "left")), lenient))


@query(f"WITH {RECORDS} SELECT id, CASE WHEN doc_id % 10 = 3 THEN 'skipped' ELSE 'converted' END AS status FROM rec")
def missing_text_split(spark, d):
    m = mapping.Mapping(allow_missing_text=True, limits=mapping.Limits(text_bytes=1 << 30, text_tokens=1 << 30))
    return mapping.map_records(_some_without_text(records(spark, d)), m).select("id", "status")


@query(rf"SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, CAST({TOKENS} AS BIGINT) AS tokens, strlen(text) > 4000 OR {TOKENS} > 300 AS over FROM documents")
def text_limits(spark, d):
    text = F.col("text")
    docs = table(spark, d, "documents")
    return docs.select("doc_id", T.n_bytes(text).alias("bytes"), T.n_tokens(text).alias("tokens")).withColumn("over", (F.col("bytes") > 4000) | (F.col("tokens") > 300))


@query(r"""WITH n AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '_' || event_type WHEN 1 THEN '$' || event_type WHEN 2 THEN repeat('é', CAST(event_id % 40 AS INTEGER)) ELSE event_type END AS name FROM events)
    SELECT event_id, name <> '' AND left(name, 1) NOT IN ('_', '$') AND strlen(name) <= 64 AS valid FROM n""")
def field_name_validity(spark, d):
    e = table(spark, d, "events")
    i = F.col("event_id") % 5
    name = F.when(i == 0, F.concat(F.lit("_"), "event_type")).when(i == 1, F.concat(F.lit("$"), "event_type")).when(i == 2, F.expr("repeat('é', cast(event_id % 40 as int))")).otherwise(F.col("event_type"))
    return e.select("event_id", mapping.valid_name(name).alias("valid"))


@query(f"WITH {RECORDS} SELECT id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM rec")
def export_metadata_json(spark, d):
    meta = F.to_json(F.map_filter("metadata", lambda k, _: k != "text"))
    back = F.from_json(meta, "map<string,string>")
    return records(spark, d).select("id", *[F.element_at(back, F.lit(k)).alias(k) for k in ("lang", "source", "n_chars")])


@query(f"WITH {RECORDS}, n AS (SELECT id, row_number() OVER (ORDER BY id) AS r FROM rec) SELECT id, CAST(floor((r - 1) / 40) AS BIGINT) AS shard FROM n")
def jsonl_shards(spark, d):
    return R.sharded(records(spark, d).select("id"), "id", 40)


@query(f"WITH {RECORDS}, n AS (SELECT row_number() OVER (ORDER BY doc_id) AS r FROM rec) SELECT CAST(floor((r - 1) / 200) AS BIGINT) AS batch, count(*) AS rows FROM n GROUP BY 1")
def batch_by_count(spark, d):
    return batching.batch_sizes(batching.by_count(records(spark, d).select("doc_id"), "doc_id", 200))


@query(f"""WITH RECURSIVE {RECORDS}, n AS (SELECT doc_id, strlen(text) + 600 AS bytes, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM rec),
    s AS (SELECT doc_id, bytes, CAST(r // 1000 AS BIGINT) AS shard, r % 1000 AS i FROM n),
    b AS (SELECT shard, doc_id, bytes, i, CAST(0 AS BIGINT) AS batch, 1 AS held, CAST(bytes AS BIGINT) AS total FROM s WHERE i = 0
        UNION ALL SELECT s.shard, s.doc_id, s.bytes, s.i, b.batch + CASE WHEN b.held >= 200 OR b.total + s.bytes > 100000 THEN 1 ELSE 0 END, CASE WHEN b.held >= 200 OR b.total + s.bytes > 100000 THEN 1 ELSE b.held + 1 END,
            CASE WHEN b.held >= 200 OR b.total + s.bytes > 100000 THEN s.bytes ELSE b.total + s.bytes END FROM b JOIN s ON s.shard = b.shard AND s.i = b.i + 1)
    SELECT shard, doc_id, CAST(bytes AS BIGINT) AS bytes, batch FROM b""")
def batch_by_bytes(spark, d):
    sized = records(spark, d).select("doc_id", (F.octet_length("text") + 600).cast("long").alias("bytes"))
    return batching.by_bytes(batching.by_count(sized, "doc_id", 1000, "shard"), "shard", "doc_id", "bytes", 200, 100_000)


@query(f"WITH {RECORDS} SELECT id, label, CASE WHEN doc_id % 2 = 0 THEN 'moved ' || doc_id ELSE text END AS text FROM rec")
def join_text(spark, d):
    r = records(spark, d)
    texts = r.where("doc_id % 2 = 0").select("id", F.concat(F.lit("moved "), "doc_id").alias("text"))
    return R.join_text(r.select("id", "label", "metadata"), texts).select("id", "label", F.element_at("metadata", F.lit("text")).alias("text"))


@query(f"WITH {RECORDS} SELECT 'documents' AS name, CAST(max(len(v)) AS BIGINT) AS dimension, 'cosine' AS metric, min(len(v)) = max(len(v)) AS uniform FROM rec")
def describe_source(spark, d):
    return R.describe(records(spark, d), "documents")


@query("""WITH j AS (SELECT event_id, event_id % 6 AS i, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT CAST(event_id AS VARCHAR) AS id, CASE i WHEN 0 THEN 'unsupported_type:m' WHEN 1 THEN 'list_of_non_strings:m' WHEN 2 THEN 'name_collision:embedding' WHEN 3 THEN 'bad_name:_id' END AS error_code FROM j""")
def map_value_types(spark, d):
    """Objects and lists of numbers are no metadata, nor is a name that is taken; lists of texts, numbers and nulls are."""
    e = table(spark, d, "events")
    i = F.col("event_id") % 6
    meta = (
        F.when(i == 0, F.concat(F.lit('{"text":"a","m":'), "props", F.lit("}"))).when(i == 1, F.concat(F.lit('{"text":"a","m":['), "event_id", F.lit("]}"))).when(i == 2, '{"text":"a","embedding":1}')
        .when(i == 3, '{"text":"a","_id":"b"}').when(i == 4, '{"text":"a","m":["b"],"n":null,"_n":null}').otherwise('{"text":"a","m":1.5,"n":true}')
    )
    parsed = e.select(F.col("event_id").cast("string").alias("id"), F.array("value").alias("values"), F.from_json(meta, "map<string,variant>").alias("metadata"))
    return mapping.map_records(parsed, mapping.Mapping()).select("id", "error_code")


#: Written with a space after each colon and comma.
META_BYTES = "(39 + strlen(lang) + strlen(source) + strlen(CAST(n_chars AS VARCHAR)))"


@query(f"WITH {RECORDS} SELECT id, CASE WHEN {META_BYTES} > 50 THEN 'metadata_too_large' END AS error_code FROM rec")
def map_metadata_size(spark, d):
    m = mapping.Mapping(limits=mapping.Limits(metadata_bytes=50, text_bytes=1 << 30, text_tokens=1 << 30, document_bytes=1 << 40))
    return mapping.map_records(variants(records(spark, d)), m).select("id", "error_code")


@query("""WITH j AS (SELECT event_id, event_id % 4 AS i, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT event_id, CASE i WHEN 0 THEN true WHEN 3 THEN k = 1 OR k = 0 ELSE false END AS same FROM j""")
def metadata_equality(spark, d):
    """A number equals the same one written with a fraction and, being 0 or 1, a boolean, but no text and no other number."""
    from docflow.functions.values import canonical

    k = F.get_json_object("props", "$.k").cast("long")
    i = F.col("event_id") % 4
    other = F.when(i == 0, F.concat(k, F.lit(".0"))).when(i == 1, F.concat(F.lit('"'), k, F.lit('"'))).when(i == 2, (k + 1).cast("string")).otherwise((k > 0).cast("string"))
    e = table(spark, d, "events")
    return e.select("event_id", canonical(F.parse_json(k.cast("string"))).eqNullSafe(canonical(F.parse_json(other))).alias("same"))


# The change log.


@query("SELECT CAST(coalesce(max(event_id + 1), 0) AS BIGINT) AS head FROM events")
def log_head(spark, d):
    return changelog.head_seq(changes(spark, d))


@query("WITH p AS (SELECT count(*) AS pending, max(epoch_us(ts)) - min(epoch_us(ts)) AS s FROM events WHERE event_id + 1 > 100) SELECT pending, CAST(s AS DOUBLE) AS seconds FROM p")
def log_lag(spark, d):
    log = changes(spark, d)
    return changelog.lag(log, 100, log.agg(F.max("ts")).first()[0] or 0.0)


@query(f"WITH {LOG} SELECT namespace, doc_id, max(seq) AS seq, arg_max(op, seq) AS op FROM log GROUP BY ALL")
def collapse_latest(spark, d):
    return changelog.collapse(changes(spark, d)).select("namespace", "doc_id", "seq", "op")


@query(f"WITH {LOG} SELECT namespace, doc_id, max(seq) AS seq, arg_max(op, seq) AS op FROM log WHERE namespace = 'ns1' AND seq > 50 GROUP BY ALL")
def collapse_ns(spark, d):
    return changelog.collapse(changes(spark, d), 50, None, "ns1").select("namespace", "doc_id", "seq", "op")


@query(f"WITH {LOG} SELECT seq, namespace, doc_id, op FROM log WHERE (namespace, doc_id) IN (SELECT (namespace, doc_id) FROM (SELECT namespace, doc_id, arg_max(op, seq) AS o FROM log GROUP BY ALL) WHERE o = 'update')")
def history_of_patched(spark, d):
    return changelog.history(changes(spark, d)).select("seq", "namespace", "doc_id", "op")


@query("WITH " + FOLD.format(window="true") + " SELECT namespace, doc_id, seq, op, v FROM folded")
def fold_actions(spark, d):
    return changelog.fold(changes(spark, d)).select("namespace", "doc_id", "seq", "op", F.get("values", F.lit(0)).alias("v"))


@query("WITH " + FOLD.format(window="true") + """ SELECT namespace, doc_id, 'type' AS name, m_type AS value FROM folded WHERE m_type IS NOT NULL
    UNION ALL SELECT namespace, doc_id, 'k', m_k FROM folded WHERE m_k IS NOT NULL UNION ALL SELECT namespace, doc_id, 'clicked', m_clicked FROM folded WHERE m_clicked IS NOT NULL""")
def fold_metadata_keys(spark, d):
    return changelog.fold(changes(spark, d)).select("namespace", "doc_id", F.explode("metadata").alias("name", "value"))


@query("WITH " + FOLD.format(window="true") + " SELECT count(*) FILTER (op = 'upsert') AS upserted, count(*) FILTER (op = 'update') AS updated, count(*) FILTER (op = 'delete') AS deleted, CAST(max(seq) AS BIGINT) AS through_seq FROM folded")
def replay_stats(spark, d):
    return changelog.action_stats(changelog.fold(changes(spark, d)))


def flat(documents: DataFrame) -> DataFrame:
    meta = lambda k: F.element_at("metadata", F.lit(k)).alias(f"m_{k}")
    return documents.select("namespace", "doc_id", F.get("values", F.lit(0)).alias("v"), meta("type"), meta("k"), meta("clicked"))


def seeded(spark: SparkSession, d: str) -> DataFrame:
    """Documents that stand before the replay: one for every user number below 60."""
    return spark.range(60).select(F.concat(F.lit("ns"), F.col("id") % 2).alias("namespace"), F.col("id").cast("string").alias("doc_id"), F.array(F.lit(-1.0)).alias("values"), F.create_map(F.lit("type"), F.lit("seed")).alias("metadata"))


@query("WITH " + FOLD.format(window="true") + """, seed AS (SELECT 'ns' || (i % 2) AS namespace, CAST(i AS VARCHAR) AS doc_id, -1.0::DOUBLE AS v, 'seed' AS m_type FROM range(60) t(i))
    SELECT namespace, doc_id, CASE WHEN f.op IS NULL THEN s.v WHEN f.op = 'update' THEN coalesce(f.v, s.v) ELSE f.v END AS v, CASE WHEN f.op IS NULL THEN s.m_type WHEN f.op = 'update' THEN coalesce(f.m_type, s.m_type) ELSE f.m_type END AS m_type,
           f.m_k, f.m_clicked FROM seed s FULL OUTER JOIN folded f USING (namespace, doc_id) WHERE f.op IS NULL OR f.op <> 'delete'""")
def replay_merge(spark, d):
    return flat(replay.apply(seeded(spark, d), changes(spark, d)).documents)


@query("WITH " + FOLD.format(window="true") + " SELECT seq, namespace, doc_id, 'no text in clicked' AS reason FROM folded WHERE op = 'upsert' AND m_clicked IS NULL")
def parked(spark, d):
    return replay.apply(seeded(spark, d), changes(spark, d), text_key="clicked").parked


#: How the replay maps: one name changes, and upserts without their text are passed over.
REPLAYED = mapping.Mapping(text_fields=("clicked",), rename={"type": "kind"}, allow_missing_text=True)


def log_of_variants(spark: SparkSession, d: str) -> DataFrame:
    return changes(spark, d).withColumn("metadata", F.transform_values("metadata", lambda _, v: v.cast("variant")))


@query("WITH " + FOLD.format(window="true") + """, seed AS (SELECT 'ns' || (i % 2) AS namespace, CAST(i AS VARCHAR) AS doc_id, -1.0::DOUBLE AS v, 'seed' AS kind FROM range(60) t(i)),
    f AS (SELECT * FROM folded WHERE NOT (op = 'upsert' AND m_clicked IS NULL))
    SELECT namespace, doc_id, CASE WHEN f.op IS NULL THEN s.v WHEN f.op = 'update' THEN coalesce(f.v, s.v) ELSE f.v END AS v, CASE WHEN f.op IS NULL THEN s.kind WHEN f.op = 'update' THEN coalesce(f.m_type, s.kind) ELSE f.m_type END AS kind,
           f.m_k AS k, f.m_clicked AS clicked FROM seed s FULL OUTER JOIN f USING (namespace, doc_id) WHERE f.op IS NULL OR f.op <> 'delete'""")
def replay_mapped(spark, d):
    """The log through the mapping of records and patches."""
    before = seeded(spark, d).withColumn("metadata", F.create_map(F.lit("kind"), F.lit("seed").cast("variant")))
    after = replay.apply_mapped(before, log_of_variants(spark, d), REPLAYED).documents
    meta = lambda k: F.try_variant_get(F.element_at("metadata", F.lit(k)), "$", "string").alias(k)
    return after.select("namespace", "doc_id", F.get("values", F.lit(0)).alias("v"), meta("kind"), meta("k"), meta("clicked"))


@query("WITH " + FOLD.format(window="true") + """ SELECT count(*) FILTER (op = 'upsert' AND m_clicked IS NOT NULL) AS upserted, count(*) FILTER (op = 'update') AS updated, count(*) FILTER (op = 'delete') AS deleted,
    count(*) FILTER (op = 'upsert' AND m_clicked IS NULL) AS skipped, CAST((SELECT max(seq) FROM log) AS BIGINT) AS through_seq FROM folded""")
def replay_mapped_stats(spark, d):
    done = replay.apply_mapped(seeded(spark, d).withColumn("metadata", F.lit(None).cast("map<string,variant>")), log_of_variants(spark, d), REPLAYED, dry_run=True)
    return replay.applied_stats(done.actions, changelog.head_seq(changes(spark, d)).first()["head"])


@query("WITH " + FOLD.format(window="true") + " SELECT seq, namespace, doc_id, 'bad_name:$clicked' AS error_code FROM folded WHERE op <> 'delete' AND m_clicked IS NOT NULL")
def replay_rejected(spark, d):
    """What would stop a replay: folded writes, whole and partial, one of whose new names is not allowed."""
    m = mapping.Mapping(text_fields=("type",), rename={"clicked": "$clicked"}, allow_missing_text=True)
    return replay.mapped(changelog.fold(log_of_variants(spark, d)), m).where("status = 'failed'").select("seq", "namespace", "doc_id", "error_code")


@query("WITH " + FOLD.format(window="true") + " SELECT count(*) AS unapplied FROM folded WHERE op = 'upsert' AND m_clicked IS NULL")
def unapplied_count(spark, d):
    return replay.unapplied_count(replay.apply(seeded(spark, d), changes(spark, d), text_key="clicked").parked)


@query(f"WITH {LOG} SELECT CAST((SELECT max(seq) FROM log) + row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS seq, 7.0::DOUBLE AS ts, 'customers' AS namespace, CAST(c_custkey AS VARCHAR) AS doc_id, 'upsert' AS op FROM customer")
def log_append(spark, d):
    new = table(spark, d, "customer").select(F.col("c_custkey").alias("order"), F.lit("customers").alias("namespace"), F.col("c_custkey").cast("string").alias("doc_id"), F.lit("upsert").alias("op"), F.array("c_acctbal").alias("values"), F.create_map(F.lit("name"), "c_name").alias("metadata"))
    return changelog.append(changes(spark, d), new, 7.0).select("seq", "ts", "namespace", "doc_id", "op")


WINDOW_2 = FOLD.format(window="seq > (SELECT max(seq) // 3 FROM log)").replace(LOG + ", ", "").replace("w AS", "w2 AS").replace("st AS", "st2 AS").replace("live AS", "live2 AS").replace("folded AS", "folded2 AS").replace("FROM w JOIN st ", "FROM w2 w JOIN st2 st ").replace("FROM w GROUP", "FROM w2 GROUP").replace("FROM st LEFT", "FROM st2 st LEFT").replace("FROM live ", "FROM live2 ")


@query("WITH " + FOLD.format(window="seq <= (SELECT max(seq) // 3 FROM log)") + ", one AS (SELECT namespace, doc_id, v, m_type, m_k, m_clicked FROM folded WHERE op <> 'delete'), " + WINDOW_2 + """
    SELECT namespace, doc_id, CASE WHEN f.op IS NULL THEN o.v WHEN f.op = 'update' THEN coalesce(f.v, o.v) ELSE f.v END AS v, CASE WHEN f.op IS NULL THEN o.m_type WHEN f.op = 'update' THEN coalesce(f.m_type, o.m_type) ELSE f.m_type END AS m_type,
           CASE WHEN f.op IS NULL THEN o.m_k WHEN f.op = 'update' THEN coalesce(f.m_k, o.m_k) ELSE f.m_k END AS m_k, CASE WHEN f.op IS NULL THEN o.m_clicked WHEN f.op = 'update' THEN coalesce(f.m_clicked, o.m_clicked) ELSE f.m_clicked END AS m_clicked
    FROM one o FULL OUTER JOIN folded2 f USING (namespace, doc_id) WHERE f.op IS NULL OR f.op <> 'delete'""")
def replay_incremental(spark, d):
    log = changes(spark, d)
    third = changelog.head_seq(log).first()["head"] // 3
    first = replay.apply(seeded(spark, d).where("false"), log, 0, third)
    return flat(replay.apply(cut(first.documents), log, first.cursor).documents)


@query("WITH " + FOLD.format(window="true") + " SELECT namespace, doc_id, v, m_type, m_k, m_clicked FROM folded WHERE op <> 'delete'")
def stream_replay(spark, d):
    """The whole log through a streaming query that takes what is there as one micro-batch."""
    from docflow.streaming.replay import LOG as SCHEMA
    from docflow.streaming.replay import Versions, follow

    base = f"{shared_folder(spark)}/stream-{spark.sparkContext.applicationId}-{abs(hash((d, id(spark)))) % 10**9}-{next(_COUNT)}"
    changes(spark, d).select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.mode("overwrite").parquet(f"{base}/log")
    q = follow(spark, f"{base}/log", f"{base}/target", f"{base}/state")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return flat(Versions(spark, f"{base}/target").read())


def _counter():
    n = 0
    while True:
        yield n
        n += 1


_COUNT = _counter()


# Reconciliation.


@query(f"WITH {TARGET} SELECT (SELECT count(*) FROM rec) AS source, (SELECT count(*) FROM tgt) AS target, abs((SELECT count(*) FROM rec) - (SELECT count(*) FROM tgt)) AS differ_by, (SELECT count(*) FROM rec) = (SELECT count(*) FROM tgt) AS ok")
def compare_counts(spark, d):
    return reconcile.compare_counts(records(spark, d), target(spark, d))


@query(f"WITH {TARGET} SELECT id FROM rec EXCEPT SELECT id FROM tgt")
def ids_missing(spark, d):
    return reconcile.missing_ids(records(spark, d), target(spark, d))


@query(f"WITH {TARGET} SELECT id FROM tgt EXCEPT SELECT id FROM rec")
def ids_orphaned(spark, d):
    return reconcile.missing_ids(target(spark, d), records(spark, d))


@query(f"WITH {TARGET} SELECT coalesce(r.id, t.id) AS id, CASE WHEN t.id IS NULL THEN 'missing' ELSE 'orphaned' END AS side FROM rec r FULL OUTER JOIN tgt t ON r.id = t.id WHERE r.id IS NULL OR t.id IS NULL")
def ids_diff_full(spark, d):
    return reconcile.diff_ids(records(spark, d), target(spark, d))


@query(f"WITH {TARGET} SELECT id FROM (SELECT id FROM rec ORDER BY id LIMIT 80) WHERE id NOT IN (SELECT id FROM tgt)")
def ids_sample_missing(spark, d):
    return reconcile.sampled_missing(records(spark, d), target(spark, d), 80)


def sides(spark: SparkSession, d: str, clean: bool = False) -> tuple[DataFrame, DataFrame]:
    """The records, and they as they arrived elsewhere (clean: unchanged), with digests for texts and metadata.

    Digests are taken before documents meet their vectors, so no text is dealt out. They meet by the id that the sides are
    compared by, so records are dealt out once; always by merging, so that what is dealt out follows the input.
    """
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id", "text", metadata().alias("metadata"))
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "embedding")

    def embedded(digests: DataFrame) -> DataFrame:
        return digests.join(e.hint("merge"), "id").withColumn("values", F.col("embedding").cast("array<double>")).drop("embedding")

    def digested(df: DataFrame) -> DataFrame:
        return embedded(reconcile.target_digests(df, canonical_of=lambda v: v))

    source = embedded(reconcile.source_digests(docs.drop("text"), canonical_of=lambda v: v))
    return source, digested(docs) if clean else drifted(digested(arrived(docs))).unionByName(orphans(digested(docs)))


def differences(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.differing(reconcile.compare_fields(*sides(spark, d)))


@query(f"WITH {TARGET} SELECT r.id FROM rec r JOIN tgt t USING (id) WHERE r.doc_id % 7 = 0")
def field_diff_vector(spark, d):
    return differences(spark, d).where("vector_differs").select("id")


@query(f"WITH {TARGET} SELECT r.id FROM rec r JOIN tgt t USING (id) WHERE r.text IS DISTINCT FROM t.text")
def field_diff_text(spark, d):
    return differences(spark, d).where("text_differs").select("id")


@query(f"WITH {TARGET} SELECT r.id, 'lang' AS key FROM rec r JOIN tgt t USING (id) WHERE r.lang IS DISTINCT FROM t.lang")
def field_diff_meta(spark, d):
    return differences(spark, d).where("key is not null").select("id", "key")


def verdict_sql(target: str) -> str:
    """counts_ok, ids_ok, fields_ok, parked and ok of rec against a table of the same shape."""
    return f"""v AS (SELECT (SELECT count(*) FROM rec) = (SELECT count(*) FROM {target}) AS counts_ok,
        NOT EXISTS (SELECT 1 FROM rec r FULL OUTER JOIN {target} t ON r.id = t.id WHERE r.id IS NULL OR t.id IS NULL) AS ids_ok,
        NOT EXISTS (SELECT 1 FROM rec r JOIN {target} t ON r.id = t.id WHERE r.text IS DISTINCT FROM t.text OR r.lang IS DISTINCT FROM t.lang OR r.source IS DISTINCT FROM t.source OR r.n_chars IS DISTINCT FROM t.n_chars
            OR len(list_filter(list_zip(r.v, t.v), lambda z: abs(z[1] - z[2]) > 1e-4 + 1e-5 * abs(z[2]))) > 0) AS fields_ok)
        SELECT counts_ok, ids_ok, fields_ok, CAST(0 AS BIGINT) AS parked, counts_ok AND ids_ok AND fields_ok AS ok FROM v"""


@query(f"WITH {TARGET}, {verdict_sql('rec')}")
def reconcile_verdict_clean(spark, d):
    source, same = sides(spark, d, clean=True)
    return reconcile.verdict(source, same, reconcile.differing(reconcile.compare_fields(source, same)))


@query(f"WITH {TARGET}, r AS (SELECT rec.id, rec.doc_id FROM rec JOIN tgt USING (id)) SELECT count(*) AS checked, count(*) FILTER (doc_id % 7 = 0) AS vector_mismatches, count(*) FILTER (doc_id % 13 = 0) AS text_mismatches, count(*) FILTER (doc_id % 11 = 0) AS metadata_mismatches, count(*) FILTER (doc_id % 7 = 0 OR doc_id % 13 = 0 OR doc_id % 11 = 0) = 0 AS ok FROM r")
def field_report(spark, d):
    return reconcile.field_report(reconcile.compare_fields(*sides(spark, d)))


@query(f"WITH {TARGET}, {verdict_sql('tgt')}")
def reconcile_verdict(spark, d):
    source, arrived_there = sides(spark, d)
    return reconcile.verdict(source, arrived_there, reconcile.differing(reconcile.compare_fields(source, arrived_there)))


# Search.


def dense_sql(score: str, order: str, where: str = "true", k: int = 10) -> str:
    return f"""WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0), {RECORDS}
        SELECT id, round({score}, 6) AS score FROM rec, q WHERE {where} ORDER BY score {order}, id LIMIT {k}"""


@query(f"""WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0), {RECORDS},
    h AS (SELECT id, round({COS.format(a="v", b="q")}, 6) AS score FROM rec, q ORDER BY score DESC, id LIMIT 10) SELECT id, score, text FROM h JOIN rec USING (id)""")
def dense_cosine_topk(spark, d):
    r = records(spark, d)
    hits = search.dense(r, probe(spark, d), 10, "cosine")
    return hits.join(r.select("id", "text"), "id")


@query(dense_sql("list_dot_product(v, q)", "DESC"))
def dense_dot_topk(spark, d):
    return search.dense(records(spark, d), probe(spark, d), 10, "dotproduct")


@query(dense_sql("list_sum(list_transform(list_zip(v, q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))", "ASC"))
def dense_l2_topk(spark, d):
    return search.dense(records(spark, d), probe(spark, d), 10, "euclidean")


@query(dense_sql(COS.format(a="v", b="q"), "DESC", "lang = 'de'"))
def dense_filtered_topk(spark, d):
    return search.dense(records(spark, d).where("namespace = 'de'"), probe(spark, d), 10, "cosine")


BATCH = """q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id < 20)"""


@query(f"""WITH {BATCH}, {RECORDS}, s AS (SELECT query_id, id, round({COS.format(a="v", b="q")}, 6) AS score FROM rec, q),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM s) SELECT * FROM r WHERE rank <= 5""")
def dense_batch_topk(spark, d):
    return search.dense_batch(records(spark, d), batch(spark, d), 5, "cosine")


def batch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id < 20").select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))


def bm25_sql(terms: list[str], where: str = "true", k: int = 20, stop: tuple[str, ...] = (), source: str = "documents") -> str:
    words = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
    if stop:
        words = f"list_filter({words}, lambda t: t NOT IN ({', '.join(map(repr, stop))}))"
    wanted = ", ".join(f"('{t}')" for t in terms)
    return f"""WITH t AS (SELECT *, {words} AS ts FROM {source}), st AS (SELECT count(*) AS n, avg(len(ts)) AS avgdl FROM t), w(term) AS (VALUES {wanted}),
        tf AS (SELECT doc_id, len(ts) AS dl, term, CAST(len(list_filter(ts, lambda x: x = term)) AS DOUBLE) AS tf, {where} AS fits FROM t, w),
        df AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM tf GROUP BY 1)
        SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
        FROM tf JOIN df USING (term), st WHERE fits GROUP BY doc_id HAVING sum(tf) > 0 ORDER BY score DESC, doc_id LIMIT {k}"""


WORDS = ["the", "ention", "vera", "ciones", "with", "reth"]


@query(bm25_sql(WORDS))
def bm25_topk(spark, d):
    return search.bm25(table(spark, d, "documents"), " ".join(WORDS), 20, id_col="doc_id")


@query(bm25_sql(WORDS, "lang = 'en'"))
def bm25_filtered(spark, d):
    return search.bm25(table(spark, d, "documents"), " ".join(WORDS), 20, id_col="doc_id", matching=F.col("lang") == "en")


@query(bm25_sql(["the", "of", "with", "reth", "ention"], "list_contains(ts, 'the') AND list_contains(ts, 'of') AND (list_contains(ts, 'with') OR list_contains(ts, 'reth') OR list_contains(ts, 'ention')) AND NOT list_contains(ts, 'was')"))
def query_string_bool(spark, d):
    return search.query_string(table(spark, d, "documents"), "text:(the AND of) AND (with OR reth ention) NOT was", 20, id_col="doc_id")


@query(bm25_sql(["with", "reth", "ention"], stop=T.STOP_WORDS))
def bm25_stop_words(spark, d):
    return search.bm25(table(spark, d, "documents"), ["with", "reth", "ention"], 20, analyzer=search.Analyzer(stop_words=T.STOP_WORDS), id_col="doc_id")


ALL_TERMS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(f"SELECT doc_id FROM documents WHERE len(list_intersect(list_distinct({ALL_TERMS}), ['the', 'with', 'was'])) = 3")
def match_all(spark, d):
    return table(spark, d, "documents").where(T.contains_all(T.terms(F.col("text")), ["the", "with", "was"])).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE len(list_intersect(list_distinct({ALL_TERMS}), ['und', 'les'])) > 0")
def match_any(spark, d):
    return table(spark, d, "documents").where(T.contains_any(T.terms(F.col("text")), ["und", "les"])).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE contains(' ' || array_to_string({ALL_TERMS}, ' ') || ' ', ' of the ')")
def match_phrase(spark, d):
    return table(spark, d, "documents").where(T.contains_phrase(T.terms(F.col("text")), ["of", "the"])).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE contains(' ' || array_to_string({ALL_TERMS}, ' ') || ' ', ' to the of ')")
def match_phrase_three_words(spark, d):
    return table(spark, d, "documents").where(T.contains_phrase(T.terms(F.col("text")), ["to", "the", "of"])).select("doc_id")


GRAMS = f"flatten(list_transform({ALL_TERMS}, lambda w: list_transform(range(1, CAST(greatest(length(w) - 2, 0) AS BIGINT) + 1), lambda i: substr(w, CAST(i AS INTEGER), 3))))"


@query(f"""WITH t AS (SELECT doc_id, {GRAMS} AS ts FROM documents), st AS (SELECT count(*) AS n, avg(len(ts)) AS avgdl FROM t), w(term) AS (VALUES ('ent'), ('nti'), ('tio')),
    tf AS (SELECT doc_id, len(ts) AS dl, term, CAST(len(list_filter(ts, lambda x: x = term)) AS DOUBLE) AS tf FROM t, w), df AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM tf GROUP BY 1)
    SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
    FROM tf JOIN df USING (term), st GROUP BY doc_id HAVING min(tf) > 0 ORDER BY score DESC, doc_id LIMIT 20""")
def query_string_ngram(spark, d):
    return search.query_string(table(spark, d, "documents"), "text:entio", 20, analyzer=search.Analyzer(ngram=(3, 3)), id_col="doc_id")


@query(r"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS a, regexp_extract_all(lower(coalesce(source, '')), '[\p{L}\p{N}]+') AS b FROM documents),
    st AS (SELECT count(*) AS n, avg(len(a)) AS la, avg(len(b)) AS lb FROM t), w(f, term) AS (VALUES ('a', 'with'), ('b', 'web')),
    tf AS (SELECT doc_id, f, term, CASE f WHEN 'a' THEN len(a) ELSE len(b) END AS dl, CAST(len(list_filter(CASE f WHEN 'a' THEN a ELSE b END, lambda x: x = term)) AS DOUBLE) AS tf FROM t, w),
    df AS (SELECT f, term, count(*) FILTER (tf > 0) AS df FROM tf GROUP BY ALL)
    SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / CASE f WHEN 'a' THEN la ELSE lb END))), 6) AS score
    FROM tf JOIN df USING (f, term), st GROUP BY doc_id HAVING sum(tf) > 0 ORDER BY score DESC, doc_id LIMIT 25""")
def query_string_fields(spark, d):
    return search.query_string(table(spark, d, "documents"), "with source:web", 25, id_col="doc_id")


@query("""WITH n AS (SELECT DISTINCT lower(event_type) AS term FROM events), g AS (SELECT term, unnest([3, 4]) AS n FROM n)
    SELECT term, substr(term, CAST(i AS INTEGER), CAST(n AS INTEGER)) AS gram FROM g, range(1, 20) t(i) WHERE i + n - 1 <= length(term)""")
def ngram_terms(spark, d):
    words = table(spark, d, "events").select(F.lower("event_type").alias("term")).distinct()
    return words.select("term", F.explode(T.ngrams(F.col("term"), 3, 4)).alias("gram"))


@query("SELECT DISTINCT p_partkey FROM part WHERE contains(lower(p_name), 'ed') AND EXISTS (SELECT 1 FROM (SELECT unnest(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}]+')) AS w) WHERE starts_with(w, 're'))")
def ngram_search(spark, d):
    part = table(spark, d, "part")
    grams = lambda prefix: search.Analyzer(ngram=(2, 2), prefix_only=prefix).column(F.col("p_name"))
    return part.where(F.array_contains(grams(False), "ed") & F.array_contains(grams(True), "re")).select("p_partkey")


@query(f"SELECT doc_id, CAST(len(list_filter({ALL_TERMS}, lambda t: t NOT IN ({', '.join(map(repr, T.STOP_WORDS))}))) AS BIGINT) AS terms FROM documents")
def stopword_terms(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.terms(F.col("text"), T.STOP_WORDS)).cast("long").alias("terms"))


@query()
def stem_search(spark, d):
    """Documents by the stem of a word. SQL has no stemmer; a test compares with stems made term by term."""
    docs = table(spark, d, "documents").where("lang = 'en'")
    return search.query_string(docs, "things AND was", 20, analyzer=search.Analyzer(stemming=True), id_col="doc_id")


@query(f"""WITH {RECORDS}, s AS (SELECT id, round(v[1] * 0.5 + v[4] * 2.0 + v[10] * -1.0, 6) AS score FROM rec) SELECT id, score FROM s ORDER BY score DESC, id LIMIT 15""")
def sparse_topk(spark, d):
    r = records(spark, d).select("id", F.struct(F.sequence(F.lit(0), F.lit(63)).alias("indices"), "values").alias("sparse"))
    return search.sparse(r, {0: 0.5, 3: 2.0, 9: -1.0}, 15)


# Parity and routing.


def hits(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    q = batch(spark, d)
    return search.dense_batch(records(spark, d), q, 10), search.dense_batch(target(spark, d), q, 10)


HITS = f"""{BATCH}, {TARGET}, sh AS (SELECT query_id, id FROM (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round({COS.format(a="v", b="q")}, 6) DESC, id) AS r FROM rec, q) WHERE r <= 10),
    th AS (SELECT query_id, id FROM (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round({COS.format(a="v", b="q")}, 6) DESC, id) AS r FROM tgt, q) WHERE r <= 10),
    n AS (SELECT coalesce(s.query_id, t.query_id) AS query_id, count(s.id) AS s, count(*) FILTER (s.id IS NOT NULL AND t.id IS NOT NULL) AS b, count(*) AS e FROM sh s FULL OUTER JOIN th t ON s.query_id = t.query_id AND s.id = t.id GROUP BY 1)"""


@query(f"WITH {HITS} SELECT query_id, round(b / nullif(s, 0), 9) AS recall, round(CASE WHEN s > 0 THEN b / e END, 9) AS jaccard, CAST(s - b AS BIGINT) AS shortfall FROM n")
def parity_recall_jaccard(spark, d):
    p = reconcile.parity(*hits(spark, d))
    return p.select("query_id", F.round("recall", 9).alias("recall"), F.round("jaccard", 9).alias("jaccard"), "shortfall")


@query(f"WITH {HITS} SELECT DISTINCT id FROM (SELECT query_id, id FROM sh EXCEPT SELECT query_id, id FROM th) WHERE id NOT IN (SELECT id FROM tgt)")
def parity_absent(spark, d):
    return reconcile.absent_hits(*hits(spark, d), target(spark, d))


@query(f"""WITH {HITS} SELECT count(*) FILTER (s > 0) AS queries, round(avg(b / nullif(s, 0)), 9) AS recall,
    (SELECT count(DISTINCT id) FROM (SELECT query_id, id FROM sh EXCEPT SELECT query_id, id FROM th) WHERE id NOT IN (SELECT id FROM tgt)) AS absent FROM n""")
def parity_report(spark, d):
    s, t = hits(spark, d)
    report = reconcile.parity_report(reconcile.parity(s, t), reconcile.absent_hits(s, t, target(spark, d)))
    return report.select("queries", F.round("recall", 9).alias("recall"), "absent")


@query(f"WITH {HITS} SELECT query_id, NOT (b = s AND b = e) AS differs FROM n")
def router_shadow(spark, d):
    return routing.shadow_diffs(*hits(spark, d))


@query("SELECT vec_id AS query_id, CASE WHEN ((vec_id * 7919) % 10007) * 100.0 / 10007 < 25 THEN 'target' ELSE 'source' END AS route FROM embeddings")
def router_ramp(spark, d):
    asked = table(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"))
    return routing.routed(asked, routing.Cutover("ramp", 25.0)).select("query_id", "route")


@query(f"""WITH {HITS} SELECT count(*) AS source_reads, CAST(0 AS BIGINT) AS target_reads, count(*) AS comparisons, count(*) FILTER (NOT (b = s AND b = e)) AS diffs,
    round(count(*) FILTER (NOT (b = s AND b = e)) / count(*), 9) AS diff_rate FROM n""")
def router_stats(spark, d):
    routes = routing.routed(batch(spark, d), routing.Cutover("shadow"))
    return routing.router_stats(routes, routing.shadow_diffs(*hits(spark, d))).withColumn("diff_rate", F.round("diff_rate", 9))


@query()
def workload_mix(spark, d):
    """Made-up actions, as many as events; their shares are drawn, not in the tables."""
    return synthetic.workload_stats(synthetic.workload(spark, table(spark, d, "events").count(), live=1000))


@query()
def synthetic_records(spark, d):
    """Made-up records, as many as embeddings."""
    r = synthetic.records(spark, table(spark, d, "embeddings").count(), 64)
    return r.select("id", F.round(vectors.norm(F.col("values")), 6).alias("norm"), F.element_at("metadata", F.lit("topic")).alias("topic"), T.n_tokens(F.element_at("metadata", F.lit("text"))).alias("tokens"))

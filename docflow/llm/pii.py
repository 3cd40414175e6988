"""Personal data by patterns and by information-theoretic sanitisation, in DataFrame functions.

The patterns find protected entities (addresses, numbers). A term that stands near an entity in several independent
contexts, and rarely elsewhere in the corpus, reveals it: its pointwise mutual information with the entity is close
to the entity's information content. Terms above a threshold of that share are reported wherever they stand and can
be generalised to the kind of entity that they reveal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.shared import cut
from docflow.llm.spans import joined, no_spans, ordered, overlaps, redacted, with_spans

KINDS = ["email", "ip", "card", "phone", "term"]
TERM = r"\p{L}{4,}"
#: Characters on either side of an entity that are its context, and that tell contexts apart.
CONTEXT, KEY = 80, 20
#: Independent contexts in which a term must stand with an entity, and the share of the entity's information that a term may not exceed.
SUPPORT, DISCLOSURE = 3, 0.8
#: Documents of which terms are counted first (expected), to leave out those that are common; the others are counted in all.
SAMPLE_DOCS = 8192
#: Rows of a table that is broadcast at most; larger ones are joined by shuffles.
BROADCAST_ROWS = 50_000


def patterns(text: Column) -> dict[str, tuple[str, str, Column]]:
    """Of each span column: its kind, pattern and a condition without which there is no match.

    The look-behinds keep the search linear: where a run has no match from its start it has none from its middle.
    """
    return {
        "_email": ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", text.contains("@")),
        "_ip": ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", text.contains(".")),
        "_card": ("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+", F.lit(True)),
        "_phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", text.contains("+")),
    }


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def is_ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def is_card(match: Column) -> Column:
    d = digits(match)
    n = F.length(d)

    def step(s: Column, i: Column) -> Column:
        x = F.substring(d, n - i + 1, F.lit(1)).cast("int")
        return s + F.when(i % 2 == 1, x).otherwise(F.when(x > 4, x * 2 - 9).otherwise(x * 2))

    return F.when((n < 13) | (n > 19), F.lit(False)).otherwise(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0)


def is_phone(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


def with_base(docs: DataFrame) -> DataFrame:
    """Adds _base, the spans of the patterns in _text."""
    found = with_spans(docs, "_text", patterns(F.col("_text")))
    base = F.concat(
        F.col("_email"), F.filter("_ip", lambda s: is_ip(s["match"])), F.filter("_card", lambda s: is_card(s["match"])), F.filter("_phone", lambda s: is_phone(s["match"]))
    )
    return found.withColumn("_base", base).drop("_email", "_ip", "_card", "_phone")


def picked(docs: DataFrame, id_col: str, text_col: str, kept: list[str] | None = None) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *[F.col(c).alias(f"_kept_{c}") for c in kept or []])


def row_key(id_: Column, text: Column) -> Column:
    """What a row is joined by: its id, or a hash of its text if it has none. Rows that share one may share their terms, for each finds only those in its own text."""
    return F.coalesce(id_.cast("string"), F.concat(F.lit("text:"), F.xxhash64(F.coalesce(text, F.lit(""))).cast("string")))


def small(df: DataFrame) -> DataFrame:
    """The table marked for broadcast if it is small; it is counted, so it should be cut from its lineage."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def revealing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(term, kind): terms that reveal a protected entity, with the kind of the one that they reveal most of.

    Of an entity e and a term t in its context, n_e, n_t and n_et count distinct contexts of e, distinct texts with t
    (n_et at least) and distinct contexts of e with t; N is the number of distinct texts. t reveals
    log(n_et N / (n_t n_e)) of the log(N / n_e) that e holds. So copies of documents change no term.
    """
    base = with_base(picked(docs, id_col, text_col)).where(F.size("_base") > 0)
    context = F.substring(F.col("_text"), F.greatest(F.col("s.start") + 1 - CONTEXT, F.lit(1)).cast("int"), (F.col("s.end") - F.col("s.start") + F.least(F.lit(CONTEXT).cast("long"), F.col("s.start")) + CONTEXT).cast("int"))
    key = F.xxhash64(
        F.substring(F.col("_text"), F.greatest(F.col("s.start") + 1 - KEY, F.lit(1)).cast("int"), F.least(F.lit(KEY).cast("long"), F.col("s.start")).cast("int")),
        F.substring(F.col("_text"), (F.col("s.end") + 1).cast("int"), F.lit(KEY)),
    )
    entity = F.concat(F.col("s.kind"), F.lit(":"), F.lower(F.col("s.match")))
    seen = base.select("_text", F.explode("_base").alias("s")).select(entity.alias("e"), F.col("s.kind").alias("kind"), key.alias("key"), F.lower(context).alias("context"), F.lower("s.match").alias("match"))
    terms = F.array_distinct(F.regexp_extract_all(F.replace(F.col("context"), F.col("match"), F.lit(" ")), F.lit(TERM), F.lit(0)))
    windows = cut(seen.select("e", "kind", "key", F.explode_outer(terms).alias("term")))
    distinct = windows.distinct()
    of_entity = distinct.groupBy("e", "key").agg(F.lit(1)).groupBy("e").agg(F.count("*").alias("n_e"))
    pairs = distinct.where("term is not null").groupBy("e", "kind", "term").agg(F.count("*").alias("n_et"))
    often = pairs.where(F.col("n_et") >= support)
    likely = cut(often.join(of_entity, "e").select("e", "kind", "term", "n_et", "n_e"))
    whole = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    size = docs.groupBy(whole.alias("whole")).count().agg(F.count("*").alias("n"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows")).first()
    n = size["n"]

    def documents_with(some: DataFrame, terms: DataFrame) -> DataFrame:
        words = some.select(whole.alias("whole"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TERM), F.lit(0)))).alias("term"))
        return words.join(small(terms), "term").distinct().groupBy("term").agg(F.count("*").alias("n_t"))

    def revealing(counted: DataFrame) -> DataFrame:
        held = F.log(F.lit(float(n)) / F.col("n_e"))
        told = F.log(F.col("n_et") * F.lit(float(n)) / (F.greatest(F.coalesce("n_t", F.lit(0)), "n_et") * F.col("n_e")))
        return counted.withColumn("share", F.when(held > 0, told / held).otherwise(F.lit(0.0))).where(F.col("share") >= disclosure)

    # documents of a sample are fewer than all: a term that they already make too common is too common
    sample = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE_DOCS / max(1, size["rows"]))))
    at_least = documents_with(sample, cut(likely.select("term").distinct()))
    likely = cut(revealing(likely.join(at_least, "term", "left")).drop("n_t", "share"))
    if likely.isEmpty():
        return likely.select("term", "kind")
    share = revealing(likely.join(documents_with(docs, cut(likely.select("term").distinct())), "term"))
    return share.groupBy("term").agg(F.max_by("kind", F.struct("share", "kind")).alias("kind"))


def scan(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Returns (id, base, spans) and the columns of keep for each row; base and spans are arrays of (kind, start, end, match).

    A null text counts as empty; texts are scanned whole, whatever their length. Spans of different patterns may overlap;
    a term's span overlaps none of them. Rows with a null id are scanned like others. Repeated rows stay repeated; an
    empty table gives no rows. Columns of the same names as those returned are replaced.
    """
    kept = keep or []
    found = with_base(picked(docs, id_col, text_col, kept))
    terms = cut(terms.select("term"))
    if terms.isEmpty():
        found = found.withColumn("_spans", F.col("_base"))
    else:
        words = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("_key"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TERM), F.lit(0)))).alias("term"))
        of_doc = cut(words.join(small(terms), "term").groupBy("_key").agg(F.collect_set("term").alias("_terms")))
        found = with_spans(found.withColumn("_key", row_key(F.col("_id"), F.col("_text"))).join(small(of_doc), "_key", "left"), "_text", {"_words": ("term", TERM, F.col("_terms").isNotNull())})
        extra = F.filter("_words", lambda s: F.array_contains(F.col("_terms"), F.lower(s["match"])) & ~overlaps(s, F.col("_base")))
        found = found.withColumn("_spans", F.concat("_base", F.when(F.col("_terms").isNotNull(), extra).otherwise(no_spans())))
    return found.select(F.col("_id").alias(id_col), *[F.col(f"_kept_{c}").alias(c) for c in kept], ordered(F.col("_base"), KINDS, True).alias("base"), ordered(F.col("_spans"), KINDS, True).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the patterns' spans and the joined forms of all."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(id_col, *map(n, KINDS[:4]), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def sanitise(docs: DataFrame, terms: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The named columns of all rows, with entities removed and revealing terms generalised to their kind in brackets. A null text stays null."""
    found = scan(docs, terms, id_col, text_col, keep=[c for c in columns if c != id_col])
    text = F.when(F.size("spans") > 0, redacted(F.col(text_col), F.col("spans"))).otherwise(F.col(text_col))
    return found.withColumn(text_col, text).select(*columns)

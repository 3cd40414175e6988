"""Secrets by patterns and by character Markov models, in DataFrame functions.

Two first-order models of characters, one of random strings and one of ordinary identifiers, are fitted on labelled
samples. A token is reported if the log-likelihood ratio of the two exceeds a threshold and no pattern found it.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.spans import joined, ordered, overlaps, redacted, with_spans

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Tokens of at least so many characters are scored; the least ratio, for each pair of characters and in all (natural logarithm).
LEAST_CHARS, LEAST_EACH, LEAST_TOTAL = 20, 1.0, 20.0
#: Labelled as ordinary: words joined by _ or -, with a few digits at the end, or a number.
ORDINARY = r"^(?:[A-Za-z]+(?:[_-][A-Za-z]+)*[0-9]{0,4}|[0-9]+)$"
#: Shares of a pair's own frequency, of its second character's and of all characters alike in the probability of a pair.
SHARES = (0.9, 0.09, 0.01)
#: Identifiers are made from runs of JOINED words, one run in EVERY words; rules and sequences stand RULES times in the sample.
JOINED, EVERY, RULES = 4, 32, 50
#: Labelled samples: rows of identifiers taken from so many documents (expected), and random strings of each make.
SAMPLE_DOCS, SAMPLE_STRINGS = 2_000, 3_000


def patterns(text: Column) -> dict[str, tuple[str, str, Column]]:
    """Of each span column: its kind, pattern and a condition without which there is no match."""
    return {
        "_assign": ("assign", ASSIGN, text.contains(":") | text.contains("=")),
        "_access": ("access", r"AKIA[A-Z0-9]{16,}", text.contains("AKIA")),
        "_hex": ("hex", r"[0-9a-f]{24,}", F.lit(True)),
        "_tokens": ("markov", rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}", F.lit(True)),
    }


def random_strings(df: DataFrame, n: int) -> DataFrame:
    """Labelled samples of random strings: base64, hexadecimal and upper-case keys made from digests."""
    digest = F.sha2(F.concat(F.lit("random"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(digest))
    upper = F.upper(F.regexp_replace(b64, "[+/=]", ""))
    return df.sparkSession.range(n, numPartitions=1).select(F.explode(F.array(b64, F.substring(digest, 1, 40), F.substring(upper, 1, 24))).alias("token"))


def made_identifiers(clean: DataFrame) -> DataFrame:
    """Labelled samples of ordinary identifiers: the words of texts joined as paths, constants and camel case, and ruled lines and sequences."""
    words = F.regexp_extract_all(F.col("clean"), F.lit("[A-Za-z]{2,}"), F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size("words") / EVERY).cast("int")), lambda i: F.slice("words", i * EVERY + 1, F.lit(JOINED)))
    each = clean.select(words.alias("words")).select(F.explode(runs).alias("w")).where(F.size("w") == JOINED)
    low, caps = F.transform("w", F.lower), F.transform("w", F.initcap)
    first, rest = F.get(low, F.lit(0)), F.array_join(F.slice(caps, 2, JOINED), "")
    number = F.pmod(F.xxhash64("w"), F.lit(100)).cast("string")
    makes = [
        F.concat(first, rest), F.concat(first, rest, number), F.array_join(caps, ""), F.array_join(low, "_"), F.upper(F.array_join(low, "_")), F.array_join(low, "-"), F.array_join(low, "/"),
        F.concat(F.array_join(low, "/"), F.lit("/"), F.array_join(caps, "")), F.concat(F.upper(first), rest, number), F.concat(first, F.lit("="), rest), F.concat_ws("+", first, rest), F.concat(F.lit("/"), F.array_join(low, "-"), F.lit("/"), number),
    ]
    lines = [c * 40 for c in "=-_+/"] + ["=-" * 20, "+-" * 20, "-=" * 20, "/-" * 10, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01234567890123456789"]
    ruled = clean.sparkSession.range(RULES, numPartitions=1).select(F.explode(F.array(*map(F.lit, lines))).alias("token"))
    return each.select(F.explode(F.array(*makes)).alias("token")).unionByName(ruled)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_strings: int = SAMPLE_STRINGS) -> list[float]:
    """Log-likelihood ratios, random against ordinary, of each pair of characters of ALPHABET.

    Ordinary identifiers are the tokens of about sample_docs documents, chosen by a hash of the id, outside the spans of
    the patterns, and identifiers made from their words. The counts that reach the driver are two for each pair of
    characters at most. Null texts and ids add nothing; an empty table leaves what is made of no text.
    """
    n = docs.count()
    sample = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample_docs / max(1, n))))
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(text_col), ASSIGN, " "), r"AKIA[A-Z0-9]{16,}", " "), r"[0-9a-f]{24,}", " ")
    cleaned = sample.select(clean.alias("clean"))
    ordinary = cleaned.select(F.explode(F.regexp_extract_all("clean", F.lit("[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("token")).where(F.col("token").rlike(ORDINARY)).unionByName(made_identifiers(cleaned))
    both = ordinary.withColumn("label", F.lit(0)).unionByName(random_strings(docs, sample_strings).withColumn("label", F.lit(1)))
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, 2)))
    rows = both.select("label", pair.alias("pair")).groupBy("label", "pair").count().collect()
    counts: list[Counter] = [Counter(), Counter()]
    first: list[Counter] = [Counter(), Counter()]
    second: list[Counter] = [Counter(), Counter()]
    for r in rows:
        if all(c in ALPHABET for c in r["pair"]):
            counts[r["label"]][r["pair"]] += r["count"]
            first[r["label"]][r["pair"][0]] += r["count"]
            second[r["label"]][r["pair"][1]] += r["count"]

    def log(y: int, a: str, b: str) -> float:
        of_pair = counts[y][a + b] / first[y][a] if first[y][a] else 0.0
        alone = (second[y][b] + 0.5) / (second[y].total() + 0.5 * len(ALPHABET))
        return math.log(SHARES[0] * of_pair + SHARES[1] * alone + SHARES[2] / len(ALPHABET))

    logs = [{(a, b): log(y, a, b) for a in ALPHABET for b in ALPHABET} for y in (0, 1)]
    return [round(logs[1][a, b] - logs[0][a, b], 3) for a in ALPHABET for b in ALPHABET]


def ratio(token: Column, ratios: list[float]) -> Column:
    """Sum of the log-likelihood ratios over the pairs of characters of a token of ALPHABET."""
    values = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda s, i: s + F.element_at(values, (place(i) - 1) * len(ALPHABET) + place(i + 1)))


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Returns (id, base, spans) and the columns of keep for each row; base and spans are arrays of (kind, start, end, match).

    A null text counts as empty; rows with a null id are scanned like others. Texts are scanned whole, whatever their
    length. Spans of the patterns may overlap one another; the model's span overlaps none of them. Repeated rows stay
    repeated; an empty table gives no rows. Columns of the same names as those returned are replaced.
    """
    kept = keep or []
    picked = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), *[F.col(c).alias(f"_kept_{c}") for c in kept])
    found = with_spans(picked, "_text", patterns(F.col("_text")))
    long_enough = F.filter("_assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 6)
    found = found.withColumn("_base", F.concat(long_enough, "_access", "_hex"))

    def random_like(s: Column) -> Column:
        x = ratio(s["match"], ratios)
        return ~overlaps(s, F.col("_base")) & (x >= LEAST_TOTAL) & (x >= LEAST_EACH * (F.length(s["match"]) - 1))

    found = found.withColumn("_spans", F.when(F.size("_tokens") > 0, F.concat("_base", F.filter("_tokens", random_like))).otherwise(F.col("_base")))
    return found.select(F.col("_id").alias(id_col), *[F.col(f"_kept_{c}").alias(c) for c in kept], ordered(F.col("_base"), KINDS, False).alias("base"), ordered(F.col("_spans"), KINDS, False).alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the patterns' spans and the joined forms of all."""
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(id_col, *map(n, KINDS[:3]), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, ratios: list[float], columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The named columns of all rows, with each secret in the text replaced by its kind in brackets. A null text stays null."""
    found = scan(docs, ratios, id_col, text_col, keep=[c for c in columns if c != id_col])
    text = F.when(F.size("spans") > 0, redacted(F.col(text_col), F.col("spans"))).otherwise(F.col(text_col))
    return found.withColumn(text_col, text).select(*columns)

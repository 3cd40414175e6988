"""Spans of regular-expression matches by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places summed at a time.
RUN = 256
SPAN = "array<struct<kind:string,start:bigint,end:bigint,match:string>>"


def no_spans() -> Column:
    return F.from_json(F.lit("[]"), SPAN)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)


def with_spans(df: DataFrame, text: str, wanted: dict[str, tuple[str, str, Column]]) -> DataFrame:
    """Adds a column for each name: (kind, start, end, match) of the leftmost non-overlapping matches of its pattern in the text column.

    wanted: name to (kind, pattern, a cheap condition without which there is no match). Matches are never empty; start
    and end count code points, end exclusive. The gaps between the matches come from a split by the same pattern;
    places are sums of the lengths of gaps and matches, taken in runs of RUN so that n matches take about n times RUN
    steps. Each step is a column of its own, or Spark would compute it once for each use.
    """
    before = df.columns
    names = list(wanted)

    def step(df: DataFrame, prefix: str, make) -> DataFrame:
        return df.select("*", *[make(n).alias(f"_{prefix}_{n}") for n in names])

    col = lambda prefix, n: F.col(f"_{prefix}_{n}")
    run = lambda x, r: F.slice(x, r * RUN + 1, F.lit(RUN))
    none = F.array().cast("array<string>")
    df = step(df, "m", lambda n: F.when(wanted[n][2], F.regexp_extract_all(F.col(text), F.lit(wanted[n][1]), F.lit(0))).otherwise(none))
    df = step(df, "g", lambda n: F.when(F.size(col("m", n)) > 0, F.slice(F.transform(F.split(text, wanted[n][1], -1), F.length), F.lit(1), F.size(col("m", n)))))
    df = step(df, "x", lambda n: F.zip_with(col("m", n), col("g", n), lambda m, g: (F.length(m) + g).cast("long")))
    df = step(df, "w", lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(col("x", n)) - 1) / RUN).cast("int")), lambda r: total(run(col("x", n), r))))
    df = step(df, "b", lambda n: F.transform(col("w", n), lambda _, r: total(F.slice(col("w", n), F.lit(1), r))))
    df = step(df, "s", lambda n: F.flatten(F.transform(col("b", n), lambda base, r: F.transform(run(col("x", n), r), lambda _, k: base + total(F.slice(col("x", n), r * RUN + 1, k))))))

    def whole(n: str) -> Column:
        def one(z: Column) -> Column:
            start = z["s"] + z["g"]
            return F.struct(F.lit(wanted[n][0]).alias("kind"), start.alias("start"), (start + F.length(z["m"])).alias("end"), z["m"].alias("match"))

        return F.when(F.size(col("m", n)) > 0, F.transform(F.arrays_zip(col("s", n).alias("s"), col("g", n).alias("g"), col("m", n).alias("m")), one)).otherwise(no_spans())

    return df.select(*before, *[whole(n).alias(n) for n in names])


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ordered(found: Column, kinds: list[str], by_kind: bool) -> Column:
    """Spans by kind as listed and then start, or by start and then kind as listed."""

    def key(s: Column) -> Column:
        place = F.array_position(F.array(*map(F.lit, kinds)), s["kind"]).cast("long")
        parts = (place, s["start"]) if by_kind else (s["start"], place)
        return F.struct(parts[0].alias("a"), parts[1].alias("b"), s["end"].alias("c"), s.alias("s"))

    return F.transform(F.array_sort(F.transform(found, key)), lambda x: x["s"])


def overlaps(s: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans are replaced as one, by the kind of the one that begins first."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    state = F.aggregate(
        F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k")))),
        zero,
        lambda acc, s: F.when(
            s["a"] >= acc["at"],
            F.struct(s["b"].alias("at"), F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["a"] - acc["at"]).cast("int")), F.lit("["), s["k"], F.lit("]")).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], s["b"]).alias("at"), acc["out"].alias("out"))),
    )
    return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))
